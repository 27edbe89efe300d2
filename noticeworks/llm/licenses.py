"""License scans: exact phrases and fuzzy search for short notices.

Texts are reduced to words of digits, small letters and characters beyond ASCII, joined by single
spaces. A notice of m characters may be found with up to k errors (insertions, deletions,
substitutions). By the pigeonhole principle one of k + 1 parts of the notice then stands in the
text unchanged, so the parts are searched for as exact seeds. Around every seed the regex
library's bounded-error matching decides, counts the errors and gives the span; the window is
searched again on both sides of what was found. A notice starts and ends at spaces. Texts are
searched whole and all seeds are followed up. Of spans of one notice that overlap, the one with
the fewest errors stays, of those the first and the shortest.

Defined results: null, empty and wordless texts have no words, no labels, empty label strings and
score 0; repeated rows are scanned one by one; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import columns

# Phrases that are counted exactly, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices that are found with errors, their labels and the errors allowed.
NOTICES = [
    ("released under the mit license", "mit", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit", 5),
    ("licensed under the apache license version 2 0", "apache", 3),
    ("gnu general public license", "gpl", 2),
    ("gnu lesser general public license", "lgpl", 3),
    ("gnu affero general public license", "agpl", 3),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd", 5),
    ("mozilla public license", "mpl", 2),
    ("eclipse public license", "epl", 2),
    ("creative commons attribution", "cc by", 2),
    ("this is free and unencumbered software released into the public domain", "unlicense", 4),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", 4),
    ("licensed under cc by", "cc by", 1),
    ("all rights reserved", "proprietary", 1),
]

# Words: everything but digits, letters and characters beyond ASCII separates; A-Z become small.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

SCHEMA = (
    "doc_id {}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label:string,first_word:long,last_word:long,errors:int>>")


def seeds(notice: str, errors: int) -> list[tuple[str, int]]:
    """errors + 1 parts of the notice with their places."""
    cuts = [round(i * len(notice) / (errors + 1)) for i in range(errors + 2)]
    return [(notice[a:b], a) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    def __init__(self, notices=NOTICES):
        import regex

        self.notices = []
        for notice, label, errors in notices:
            pattern = regex.compile(rf"(?be)(?<= )(?:{regex.escape(notice, special_only=True)}){{e<={errors}}}(?= )".encode())
            parts = [(s.encode(), at) for s, at in seeds(notice, errors)]
            self.notices.append((len(notice), label, errors, pattern, parts))

    @staticmethod
    def phrases(line: bytes):
        """Places, in words, of every phrase; ``line`` has a space at both ends."""
        for phrase, label in PHRASES.items():
            needle, at, words, done = f" {phrase} ".encode(), -1, 0, 0
            while (at := line.find(needle, at + 1)) >= 0:
                words += line.count(b" ", done, at)
                done = at
                yield words, label

    def notices_in(self, line: bytes):
        """label, first and last byte and errors of every notice found."""
        for length, label, errors, pattern, parts in self.notices:
            windows = set()
            for seed, place in parts:
                at = -1
                while (at := line.find(seed, at + 1)) >= 0:
                    windows.add((max(0, at - place - errors - 1), min(len(line), at - place + length + errors + 1)))
            found, left = set(), list(windows)
            while left:
                a, b = left.pop()
                m = pattern.search(line, a, b) if b - a >= length - errors else None
                if m:
                    found.add((sum(m.fuzzy_counts), m.start(), m.end()))
                    left += [(a, m.start()), (m.end(), b)]
            yield from ((label, a, b, wrong, length) for wrong, a, b in self._apart(found))

    @staticmethod
    def _apart(found):
        """Spans (errors, start, end) in that order, without those that overlap one taken before."""
        import bisect

        starts, taken = [], []
        for wrong, a, b in sorted(found):
            i = bisect.bisect(starts, a)
            if (i == 0 or taken[i - 1][2] <= a) and (i == len(taken) or b <= starts[i]):
                starts.insert(i, a)
                taken.insert(i, (wrong, a, b))
        return taken

    def scan(self, text: str | None) -> tuple:
        words = (text or "").encode().translate(_TABLE).split()
        if not words:
            return 0, 0, None, None, "", "", 0.0, []
        line = b" " + b" ".join(words) + b" "
        base = sorted(self.phrases(line))
        spans, score = [], 1.0 if base else 0.0
        for label, a, b, errors, length in self.notices_in(line):
            spans.append((label, line.count(b" ", 0, a) - 1 + (line[a:a + 1] == b" "), line.count(b" ", 0, b) - 1 - (line[b - 1:b] == b" "), errors))
            score = max(score, 1 - errors / length)
        exact = {label for _, label in base}
        return (
            len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None,
            ",".join(sorted(exact)), ",".join(sorted(exact | {s[0] for s in spans})), score, sorted(spans))


def scan(docs: DataFrame, notices=NOTICES) -> DataFrame:
    """One row per document: doc_id, counts, labels, score and spans of notices in words."""
    own = columns(docs, "doc_id", "text")
    schema = SCHEMA.format(own.schema["doc_id"].dataType.simpleString())

    def task(batches):
        import pyarrow as pa

        scanner = Scanner(notices)
        span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("errors", pa.int32())])
        kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.list_(span)]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [scanner.scan(text.as_py()) for text in batch.column("text")]
            cols = [list(c) for c in zip(*found)]
            cols[-1] = [[dict(zip(("label", "first_word", "last_word", "errors"), s)) for s in x] for x in cols[-1]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names)

    return own.mapInArrow(task, schema)


def span_text(spans="spans"):
    """Spans as one string, label:first-last:errors, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["label"], F.concat_ws("-", s["first_word"], s["last_word"]), s["errors"])), ",")
