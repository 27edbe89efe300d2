"""Ranked lexical search, term at a time, with a limit on accumulators.

A first pass over the documents writes, for each of them, its number of terms and its occurrences
of query terms. Document frequencies, the number of documents and that of all terms are counted
from that table, over all documents. A second pass ranks: a task turns a block of documents into
posting lists and takes the terms of an item rarest first. A term adds to accumulators of its
documents and creates the missing ones, until the bounds of the terms that are left (weight by
highest impact in the block) cannot reach the k-th partial score any more. From then on no
accumulator is created; the existing ones are updated exactly, and leave when they cannot reach the
k-th score with all that is left. The k-th score found in one block starts the next block of the
task. Scores are whole numbers, and only documents strictly below the k-th score are given up, so
the answer is exact, ties included.

Items go to the tasks in blocks of bounded size, documents stay where they are read, and each task
hands on k rows an item.

Defined results: null, empty and termless texts score nothing and are no documents in the counts;
a termless item has no rows; repeated documents rank one by one; a null doc_id comes before other
ids among equal scores; repeated items and items with a null id are answered one by one, each by
its own text; empty tables give an empty table; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import columns, stored
from noticeworks.llm.terms import BLOCK_CHARS, Parts, best, item_blocks, terms_of, texts_of

POSTINGS = 4_000_000   # postings that a task holds at once, about
DOCUMENTS = 1 << 16    # documents of a block, at most
SCHEMA = "item_id long, rank int, doc_id long, score long"


def occurrences(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (terms with repeats) and the query terms of each document with their counts."""
    places = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def task(batches):
        import numpy as np
        import pyarrow as pa

        place = {t: i for i, t in enumerate(places.value)}
        width = len(place)
        for batch in batches:
            n, keys = [], []
            for row, text in enumerate(texts_of(batch)):
                found = terms_of(text)
                n.append(len(found))
                own = [i for i in map(place.get, found) if i is not None]
                if own:
                    keys.append(np.array(own, np.int64) + row * width)
            key, times = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.empty(0, np.int64),) * 2
            offsets = pa.array(np.searchsorted(key, np.arange(len(n) + 1) * width), pa.int32())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n": pa.array(n, pa.int64()),
                "terms": pa.ListArray.from_arrays(offsets, pa.array((key % max(width, 1)).astype(np.int32))),
                "times": pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))})

    return docs.mapInArrow(task, "doc_id long, n long, terms array<int>, times array<int>")


class Block:
    """Posting lists of some documents: by term, the documents in their order and their impacts."""

    def __init__(self, n, terms, times, lengths, width: int, documents: int, words: int):
        import numpy as np

        m = 75 + (25 * n * documents) // words
        doc = np.repeat(np.arange(len(n)), lengths)
        times = times.astype(np.int64)
        impact = (1_000_000_000 * times) // (1000 * times + 12 * m[doc])
        order = np.argsort(terms, kind="stable")
        self.size, self.doc, self.impact = len(n), doc[order], impact[order]
        self.start = np.searchsorted(terms[order], np.arange(width + 1))
        self.highest = np.zeros(width, np.int64)
        some = np.flatnonzero(np.diff(self.start))
        if len(some):
            self.highest[some] = np.maximum.reduceat(self.impact, self.start[some])

    def rank(self, own, weight, k: int, floor: int):
        """Documents of the block that may be among the first k, and their scores.

        ``own`` are an item's terms, rarest first; ``floor`` is a score that k documents reach.
        """
        import numpy as np

        here = self.start[own + 1] > self.start[own]
        own, weight = own[here], weight[here]
        left = np.append(np.cumsum((weight * self.highest[own])[::-1])[::-1], 0)
        sums = np.zeros(self.size, np.int64)
        held, at = None, 0
        for at in range(len(own) + 1):
            if at == len(own) or left[at] < floor:
                break
            a, b = self.start[own[at]], self.start[own[at] + 1]
            sums[self.doc[a:b]] += weight[at] * self.impact[a:b]
            if left[at + 1] < left[0] - left[at + 1]:  # else no partial score can stop the creation yet
                held = np.flatnonzero(sums)
                if len(held) >= k:
                    floor = max(floor, int(np.partition(sums[held], -k)[-k]))
        held = np.flatnonzero(sums)
        part = sums[held]
        for j in range(at, len(own)):
            stay = part + left[j] >= floor
            held, part = held[stay], part[stay]
            if not len(held):
                break
            a, b = self.start[own[j]], self.start[own[j] + 1]
            docs = self.doc[a:b]
            place = np.minimum(np.searchsorted(docs, held), len(docs) - 1)
            part += np.where(docs[place] == held, weight[j] * self.impact[a:b][place], 0)
        return held, part


def _ranked(table: DataFrame, asked: list, width: int, documents: int, words: int, k: int) -> DataFrame:
    """The first k documents of each task for the items of a block."""
    shared = table.sparkSession.sparkContext.broadcast(asked)

    def blocks(batches):
        import numpy as np

        for batch in batches:
            ids = batch.column("doc_id")
            there = np.array(ids.is_valid())
            ids = np.where(there, ids.fill_null(0).to_numpy(zero_copy_only=False), 0)
            n, column = batch.column("n").to_numpy(), batch.column("terms")
            offsets = column.offsets.to_numpy().astype(np.int64)
            terms, times = column.values.to_numpy(), batch.column("times").values.to_numpy()
            a = 0
            while a < len(n):
                b = min(int(np.searchsorted(offsets, offsets[a] + POSTINGS)), a + DOCUMENTS, len(n))
                b = max(b, a + 1)
                x, y = offsets[a], offsets[b]
                yield there[a:b], ids[a:b], Block(
                    n[a:b], terms[x:y], times[x:y], np.diff(offsets[a:b + 1]), width, documents, words)
                a = b

    def task(batches):
        import numpy as np
        import pyarrow as pa

        items = [(item, np.array(own, np.int64), np.array(weight, np.int64)) for item, own, weight in shared.value]
        found = [(np.empty(0, bool), np.empty(0, np.int64), np.empty(0, np.int64))] * len(items)
        for there, ids, block in blocks(batches):
            for i, (_, own, weight) in enumerate(items):
                known = found[i][2]
                held, score = block.rank(own, weight, k, int(known[k - 1]) if len(known) >= k else 1)
                if len(held):
                    parts = [np.concatenate(x) for x in zip(found[i], (there[held], ids[held], score))]
                    first = np.lexsort((parts[1], parts[0], -parts[2]))[:k]
                    found[i] = tuple(x[first] for x in parts)
        number = TaskContext.get().partitionId()
        for i, (there, ids, score) in enumerate(found):
            if len(ids):
                yield pa.RecordBatch.from_pydict({
                    "item": pa.array(np.full(len(ids), i, np.int32)),
                    "item_id": pa.array([items[i][0]] * len(ids), pa.int64()),
                    "doc_id": pa.array(ids, mask=~there), "score": pa.array(score),
                    "task": pa.array(np.full(len(ids), number, np.int32))})

    return table.where(F.size("terms") > 0).mapInArrow(
        task, "item int, item_id long, doc_id long, score long, task int")


def search(docs: DataFrame, items: DataFrame, k: int = 20, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents for each item."""
    spark = docs.sparkSession
    own = columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = Parts(spark, "ranked")
    for block in item_blocks(items, block_chars):
        vocabulary = sorted({t for _, terms in block for t in terms})
        place = {t: i for i, t in enumerate(vocabulary)}
        table = stored(occurrences(own, vocabulary), "occurrences")
        total = table.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("words")).first()
        if not total.documents:
            continue
        # One row per query term of the block.
        frequency = dict(table.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weight = {
            t: math.floor(1000 * math.log((2 * total.documents + 2) / (2 * df + 1))) for t, df in frequency.items()}
        asked = []
        for item, terms in block:
            times: dict[int, int] = {}
            for t in terms:
                times[place[t]] = times.get(place[t], 0) + 1
            rarest = sorted((t for t in times if t in frequency), key=lambda t: (frequency[t], t))
            asked.append((item, rarest, [weight[t] * times[t] for t in rarest]))
        rows = _ranked(table, asked, len(vocabulary), total.documents, total.words, k)
        order = [F.desc("score"), F.col("doc_id").asc_nulls_first()]
        out.add(best(rows, ["item", "item_id"], order, k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out.read(SCHEMA)
