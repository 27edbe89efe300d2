"""Benchmark decontamination with a distributed positional inverted index.

The index is a table of segments. A task turns the documents that it reads into segments of about
half a million words, each a row of its own: the documents with their sizes, the terms, and for
each term the sorted positions of all its occurrences. All words of all documents are indexed, and
nothing is shuffled for it. A search hands the terms of the test items to the tasks in blocks of
bounded size. In a segment the lists of a window's terms are adjusted by their offset in the window
and intersected, from the term that is rarest there to the most frequent one; what is left are the
exact places of the phrase. Terms are compared as strings, so nothing rests on hashes.

Phrase matches are windows of 10 consecutive item words (an item of fewer words is one window);
proximity matches are stretches of a document that hold all terms of a window in any order.

Defined results: null, empty and wordless texts have no words and no matches, but their documents
are returned; repeated documents are documents of their own; null doc_ids stay null; items without
words match nothing; repeated items, and windows that items share, count once for each item_id; an
item with a null id counts, and its id is written as an empty string; empty tables give empty
tables, and no items give documents without hits; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import columns, stored
from noticeworks.llm.terms import BLOCK_CHARS, Parts, item_blocks, terms_of, texts_of

WINDOW = 10              # words of a window
SEGMENT_WORDS = 1 << 19  # a segment is closed beyond that many words; documents are not cut
NEAR = 2 * WINDOW        # words of the stretch that a proximity match may take

INDEX = "segment long, doc_ids array<long>, sizes array<int>, terms array<binary>, counts binary, positions binary"


def build(docs: DataFrame, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The index of all documents, written to the shared folder."""
    own = columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def task(batches):
        import numpy as np
        import pyarrow as pa

        class Places(dict):
            def __missing__(self, term):
                self[term] = place = len(self)
                return place

        segment = TaskContext.get().partitionId() << 32
        places, doc_ids, words, held = Places(), [], [], 0

        def closed():
            all_words = np.concatenate(words)
            order = np.argsort(all_words, kind="stable").astype(np.int32)
            counts = np.bincount(all_words, minlength=len(places)).astype(np.int32)
            one = lambda x, kind: pa.array([x], kind)
            return pa.RecordBatch.from_pydict({
                "segment": one(segment, pa.int64()), "doc_ids": one(doc_ids, pa.list_(pa.int64())),
                "sizes": one([len(w) for w in words], pa.list_(pa.int32())),
                "terms": one(list(places), pa.list_(pa.binary())),
                "counts": one(counts.tobytes(), pa.binary()), "positions": one(order.tobytes(), pa.binary())})

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                found = terms_of(text)
                doc_ids.append(doc_id)
                words.append(np.fromiter(map(places.__getitem__, found), np.int32, len(found)))
                held += len(found)
                if held >= segment_words:
                    yield closed()
                    segment += 1
                    places, doc_ids, words, held = Places(), [], [], 0
        if doc_ids:
            yield closed()

    return stored(own.mapInArrow(task, INDEX), "positions")


class Segment:
    """One segment with the posting lists of the terms that are asked for."""

    def __init__(self, row: dict, asked):
        import numpy as np
        import pyarrow.compute as pc

        sizes = np.array(row["sizes"].values.to_numpy(), np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        counts = np.frombuffer(row["counts"].as_buffer(), np.int32)
        self.positions = np.frombuffer(row["positions"].as_buffer(), np.int32)
        last = np.cumsum(counts, dtype=np.int64)
        place = pc.index_in(asked, value_set=row["terms"].values).fill_null(-1).to_numpy()
        self.count = np.where(place >= 0, counts[place] if len(counts) else 0, 0)
        self.last = last[place] if len(last) else np.zeros(len(place), np.int64)

    def places(self, term: int):
        """The sorted positions of a term."""
        return self.positions[self.last[term] - self.count[term]:self.last[term]]

    def documents(self, place):
        """The documents of positions, by their place in the segment."""
        import numpy as np

        return np.searchsorted(self.ends, place, side="right")

    def phrase(self, terms: list[int]):
        """First positions of all places where the terms stand consecutively in one document."""
        import numpy as np

        order = sorted(range(len(terms)), key=lambda i: (self.count[terms[i]], i))
        start = self.places(terms[order[0]]) - order[0]
        for offset in order[1:]:
            own = self.places(terms[offset])
            at = np.minimum(np.searchsorted(own, start + offset), len(own) - 1)
            start = start[own[at] == start + offset]
            if not len(start):
                return start
        start = start[start >= 0]
        doc = self.documents(start)
        return start[(start >= self.starts[doc]) & (start + len(terms) <= self.ends[doc])]

    def near(self, terms: list[int], within: int) -> set[tuple[int, int]]:
        """(first, end) of the shortest stretches, up to ``within`` words, that hold all terms around
        an occurrence of the rarest one; of equally short ones the first."""
        import numpy as np

        order = sorted(set(terms), key=lambda t: (self.count[t], t))
        middle = self.places(order[0])
        for t in order[1:]:
            own = self.places(t)
            at = np.searchsorted(own, middle - within + 1)
            middle = middle[(at < len(own)) & (own[np.minimum(at, len(own) - 1)] < middle + within)]
        found = set()
        for p in middle.tolist():
            doc = int(self.documents(p))
            first = np.arange(max(p - within + 1, int(self.starts[doc])), p + 1, dtype=np.int32)
            end = np.full(len(first), p, np.int64)
            for t in order:
                own = self.places(t)
                at = np.searchsorted(own, first)
                end = np.maximum(end, np.where(at < len(own), own[np.minimum(at, len(own) - 1)], self.ends[doc]))
            width = end + 1 - first
            width[end >= self.ends[doc]] = within + 1
            i = int(np.argmin(width))
            if width[i] <= within:
                found.add((int(first[i]), int(end[i]) + 1))
        return found


def _asked(block: list, window: int):
    """The terms of a block and its windows: (item, offset in the item, terms), each window of an item once."""
    vocabulary = sorted({t for _, terms in block for t in terms})
    place = {t: i for i, t in enumerate(vocabulary)}
    windows = {}
    for item, terms in block:
        own = [place[t] for t in terms]
        width = min(window, len(own))
        for at in range(len(own) - width + 1 if own else 0):
            windows.setdefault((item, tuple(own[at:at + width])), at)
    return vocabulary, [(item, at, terms) for (item, terms), at in windows.items()]


def _segments(batches, shared) -> Iterator:
    """Each segment with the windows whose terms all occur in it."""
    import numpy as np
    import pyarrow as pa

    vocabulary, windows = shared.value
    asked = pa.array(vocabulary, pa.binary())
    flat = np.array([t for _, _, terms in windows for t in terms], np.int64)
    ends = np.cumsum([len(terms) for _, _, terms in windows], dtype=np.int64)
    starts = np.r_[0, ends[:-1]] if len(ends) else ends
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            segment = Segment(row, asked)
            absent = np.r_[0, np.cumsum(segment.count[flat] == 0)]
            yield row, segment, [windows[w] for w in np.flatnonzero(absent[ends] == absent[starts])]


def phrases(index: DataFrame, items: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document: segment, place in it, doc_id, n_words, the hit stretches (first, end; words from
    0) and the ids of the items that have windows there."""
    out = Parts(index.sparkSession, "phrases")
    schema = "segment long, place int, doc_id long, n_words long, spans array<struct<first:long,end:long>>, items array<string>"

    def task(batches, shared):
        import numpy as np
        import pyarrow as pa

        spans_type = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        for row, segment, windows in _segments(batches, shared):
            spans: dict[int, list] = {}
            names: dict[int, set] = {}
            for item, _, terms in windows:
                start = segment.phrase(terms)
                for doc, first in zip(segment.documents(start).tolist(), start.tolist()):
                    first -= int(segment.starts[doc])
                    known = spans.setdefault(doc, [])
                    # Windows of an item follow each other: stretches grow instead of piling up.
                    if known and known[-1][0] <= first <= known[-1][1]:
                        known[-1] = (known[-1][0], max(known[-1][1], first + len(terms)))
                    else:
                        known.append((first, first + len(terms)))
                    names.setdefault(doc, set()).add("" if item is None else str(item))
            n = len(segment.ends)
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array([row["segment"].as_py()] * n, pa.int64()), "place": pa.array(np.arange(n, dtype=np.int32)),
                "doc_id": row["doc_ids"].values, "n_words": pa.array(segment.ends - segment.starts),
                "spans": pa.array([[{"first": a, "end": b} for a, b in spans.get(i, ())] for i in range(n)], spans_type),
                "items": pa.array([sorted(names.get(i, ())) for i in range(n)], pa.list_(pa.string()))})

    def add(block):
        shared = index.sparkSession.sparkContext.broadcast(_asked(block, window))
        out.add(index.mapInArrow(lambda batches: task(batches, shared), schema))

    none = True
    for block in item_blocks(items, block_chars):
        add(block)
        none = False
    if none:
        add([])
    # A document has one row per block of items.
    return out.read(schema).groupBy("segment", "place").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def proximity(
    index: DataFrame, items: DataFrame, within: int = NEAR, window: int = WINDOW, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """doc_id, item_id, offset of the window in the item, and the stretch (first, end; words from 0) of
    a document that holds all terms of the window, in any order, in at most ``within`` words."""
    out = Parts(index.sparkSession, "near")
    schema = "doc_id long, item_id long, window_offset int, first long, end long"

    def task(batches, shared):
        import pyarrow as pa

        kinds = {"doc_id": pa.int64(), "item_id": pa.int64(), "window_offset": pa.int32(), "first": pa.int64(), "end": pa.int64()}
        for row, segment, windows in _segments(batches, shared):
            doc_ids, found = row["doc_ids"].as_py(), []
            for item, at, terms in windows:
                for first, end in sorted(segment.near(terms, within)):
                    doc = int(segment.documents(first))
                    base = int(segment.starts[doc])
                    found.append((doc_ids[doc], item, at, first - base, end - base))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds.values())], list(kinds))

    for block in item_blocks(items, block_chars):
        shared = index.sparkSession.sparkContext.broadcast(_asked(block, window))
        out.add(index.mapInArrow(lambda batches, shared=shared: task(batches, shared), schema))
    return out.read(schema)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (sorted ids) and contaminated."""
    found = phrases(build(docs), items, window)
    nothing = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("hit"))
    union = F.aggregate("spans", nothing, lambda known, span: F.struct(
        F.greatest(known["end"], span["end"]).alias("end"),
        (known["hit"] + F.greatest(F.lit(0).cast("long"), span["end"] - F.greatest(known["end"], span["first"]))).alias("hit")))
    n_hit = union["hit"]
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items",
        (n_hit > 0).alias("contaminated"))
