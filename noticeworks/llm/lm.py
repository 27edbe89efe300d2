"""Stupid-backoff language-model scores from n-gram counts of the corpus itself.

Documents are gathered into blocks with a word list each. A block brings rows of (hash range, its
distinct n-grams, how often it has them); the counts of an n-gram from all blocks meet in its hash
range and are summed there, and the sums are joined back to the blocks that asked, which add up
the scores of their documents. Rows hold the n-grams of one block in one range, as differences of
sorted hashes, because one row per n-gram would take many times the input in shuffles. Empty
ranges have no row, so there are never more rows than n-grams. An n-gram appears at most once
per block, however frequent it is, and no range is hot. All n-grams count, single ones too.

The score of a word is count(n-gram) / count(history) for the longest n-gram that is counted
``min_count`` times or more, times 0.4 for every word of history that was dropped; single words
are divided by the number of all words, an unknown word counts as one, and sentences have no
padding. A document's own words do not count for it (``own=False``): with them every n-gram of
every document would be known and nothing would ever back off. ``own=True`` counts them.

Hashes are as long as the corpus needs, 24 bits more than its number of n-grams has, 64 at most.

Defined results: null, empty and blank texts have no words and score 0; repeated rows are counted
and scored one by one, each by the others; ties do not matter; an empty table gives an empty table.
"""

from __future__ import annotations

import functools

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import columns, stored, stored_alone

ORDER = 3
MIN_COUNT = 1                # of n-grams of two words or more
BACKOFF = 0.4
BLOCK_WORDS = 1_000_000      # words of a block, about; a longer text is a block of its own
RANGE = 2_000_000            # n-grams of all blocks in a range of hashes, about
CACHED_WORDS = 500_000

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


@functools.cache
def _zstd():
    import zstandard

    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _small(numbers) -> bytes:
    """Numbers whose high bytes are mostly equal, byte by byte, compressed before they are shuffled."""
    import numpy as np

    planes = numbers.view(np.uint8).reshape(-1, numbers.itemsize).T
    return _zstd()[0].compress(planes.tobytes())


def _numbers(small: bytes, kind):
    import numpy as np

    planes = np.frombuffer(_zstd()[1].decompress(small), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _blocks(docs: DataFrame) -> DataFrame:
    """block, doc_ids, lengths, word hashes and places in them, n_words; words in small letters."""
    schema = f"block long, doc_ids array<{docs.schema['doc_id'].dataType.simpleString()}>, lengths binary, words binary, places binary, n_words long"

    def task(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        class Words(dict):
            def __missing__(self, word):
                if len(self) >= CACHED_WORDS:
                    self.clear()
                self[word] = h = xxhash.xxh3_64_intdigest(word)
                return h

        known, number = Words(), TaskContext.get().partitionId() << 32
        ids, texts, n, kind = [], [], 0, None

        def out():
            words, places, times = np.unique(np.concatenate(texts), return_inverse=True, return_counts=True)
            frequent = np.argsort(-times, kind="stable")  # frequent words have small numbers
            number_of = np.empty(len(words), np.int32)
            number_of[frequent] = np.arange(len(words))
            words, places = words[frequent], number_of[places]
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([ids], pa.list_(kind)),
                pa.array([np.array([len(t) for t in texts], np.int32).tobytes()], pa.binary()),
                pa.array([words.tobytes()], pa.binary()), pa.array([_small(places)], pa.binary()),
                pa.array([n], pa.int64())], ["block", "doc_ids", "lengths", "words", "places", "n_words"])

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = (text.as_py() or "").encode().translate(_LOWER).split()
                ids.append(doc_id)
                texts.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
                n += len(words)
                if n >= BLOCK_WORDS:
                    yield out()
                    ids, texts, n, number = [], [], 0, number + 1
        if ids:
            yield out()

    return docs.select("doc_id", "text").mapInArrow(task, schema)


def _grams(words, lengths, order: int):
    """For n = 1 to ``order``: hashes of the n-grams that end at each word; 0 where there is none."""
    import numpy as np

    place = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out, value = [], np.zeros(len(words), np.uint64)
    for n in range(1, order + 1):
        shifted = np.zeros(len(words), np.uint64)
        shifted[n - 1:] = words[: len(words) - n + 1]
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + shifted * np.uint64(2 * n + 1) + np.uint64(n)
        mixed = (value ^ (value >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(31)
        out.append(np.where(place >= n - 1, np.maximum(mixed, np.uint64(1)), np.uint64(0)))
    return out


def _asked(block: dict, order: int, bits: int):
    """Lengths of the texts, n-grams position by position for n = 1 to ``order``; 0 where there is none."""
    import numpy as np

    lengths = np.frombuffer(block["lengths"], np.int32)
    words = np.frombuffer(block["words"], np.uint64)[_numbers(block["places"], np.int32)]
    cut = np.uint64(64 - bits)
    return lengths, np.concatenate([np.where(g > 0, np.maximum(g >> cut, np.uint64(1)), g) for g in _grams(words, lengths, order)])


def _requests(blocks: DataFrame, order: int, bits: int, ranges: int) -> DataFrame:
    """One row per block and range that has any: differences of sorted n-grams and the block's counts."""

    def task(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for block in batch.to_pylist():
                grams, count = np.unique(_asked(block, order, bits)[1], return_counts=True)
                if len(grams) and grams[0] == 0:
                    grams, count = grams[1:], count[1:]
                high = grams >> np.uint64(bits - 32)
                range_ = (high * np.uint64(ranges)) >> np.uint64(32)
                cuts = np.flatnonzero(np.diff(range_, prepend=-1, append=-1)) if len(grams) else np.zeros(1, int)
                for at in range(0, len(cuts) - 1, 1024):
                    spans = list(zip(cuts[at:at + 1024], cuts[at + 1:at + 1025]))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([int(range_[a]) for a, _ in spans], pa.int64()), pa.array([block["block"]] * len(spans), pa.int64()),
                        pa.array([_small(np.diff(grams[a:b], prepend=np.uint64(0))) for a, b in spans], pa.binary()),
                        pa.array([_small(count[a:b].astype(np.uint32)) for a, b in spans], pa.binary()),
                    ], ["range", "block", "grams", "counts"])

    return blocks.mapInArrow(task, "range long, block long, grams binary, counts binary")


def _answers(requests: DataFrame) -> DataFrame:
    """The counts of the corpus for every request, in its order."""

    def sums(table):
        import numpy as np
        import pyarrow as pa

        grams = [np.cumsum(_numbers(x, np.uint64), dtype=np.uint64) for x in table.column("grams").to_pylist()]
        counts = np.concatenate([_numbers(x, np.uint32) for x in table.column("counts").to_pylist()])
        cuts = np.cumsum([0, *map(len, grams)])
        _, place = np.unique(np.concatenate(grams), return_inverse=True)
        totals = np.bincount(place, weights=counts.astype(float)).astype(np.uint64)
        return pa.table({
            "block": table.column("block"), "range": table.column("range"),
            "totals": pa.array([_small(totals[place[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())})

    return requests.groupBy("range").applyInArrow(sums, "block long, range long, totals binary")


def lm_scores(docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, own: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_full (words scored with a full n-gram), score, mean_score.

    ``score`` is the sum of natural logarithms over the words, ``mean_score`` that per word.
    """
    texts = columns(docs, "doc_id", "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    blocks = stored(_blocks(texts), "word_blocks")
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    bits = min(64, 24 + max(12, (total * order).bit_length()))
    ranges = max(12, total * order // RANGE)
    answers = stored_alone(_answers(_requests(blocks, order, bits, ranges)), "ngram_counts")

    def score(left, right):
        import numpy as np
        import pyarrow as pa

        block = left.to_pylist()[0]
        lengths, grams = _asked(block, order, bits)
        rows = sorted(zip(right.column("range").to_pylist(), right.column("totals").to_pylist()))
        # Ranges and the n-grams in them are sorted, so together they are the distinct n-grams in order.
        counts = np.concatenate([np.zeros(0), *[_numbers(t, np.uint64) for _, t in rows]]).astype(float)
        distinct, place = np.unique(grams, return_inverse=True)
        if len(distinct) and distinct[0] == 0:
            counts = np.r_[0.0, counts]
        found = counts[place]
        n_words, n_texts = int(lengths.sum()), len(lengths)
        if not own:
            text = np.tile(np.repeat(np.arange(n_texts), lengths), order)
            _, same, times = np.unique(place * n_texts + text, return_inverse=True, return_counts=True)
            found = np.maximum(found - times[same], 0.0)
        found = found.reshape(order, n_words)
        position = np.arange(n_words) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        value = np.log(np.maximum(found[0], 1) / max(1, total))
        full = np.zeros(n_words, bool) if order > 1 else np.ones(n_words, bool)
        for n in range(2, order + 1):
            history = np.r_[1.0, found[n - 2][:-1]] if n_words else found[n - 2]
            seen = found[n - 1] >= min_count
            longer = np.log(np.where(seen, found[n - 1] / np.maximum(history, 1), 1.0))
            # The first words of a text have no longer history; nothing is dropped there.
            value = np.where(seen, longer, value + np.where(position >= n - 1, np.log(BACKOFF), 0.0))
            full = seen
        ends = np.cumsum(lengths)
        sums = np.r_[0.0, np.cumsum(value)]
        fulls = np.r_[0, np.cumsum(full)]
        score_ = np.where(lengths > 0, sums[ends] - sums[ends - lengths], 0.0)
        return pa.table([
            pa.array(block["doc_ids"], left.schema.field("doc_ids").type.value_type), pa.array(lengths.astype(np.int64)),
            pa.array((fulls[ends] - fulls[ends - lengths]).astype(np.int64)), pa.array(score_),
            pa.array(score_ / np.maximum(lengths, 1))], ["doc_id", "n_words", "n_full", "score", "mean_score"])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, f"doc_id {kind}, n_words long, n_full long, score double, mean_score double")
