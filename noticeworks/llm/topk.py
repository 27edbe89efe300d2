"""Exact top-k search by inner product in three phases with a uniform threshold.

Vectors are cut into two halves of their dimensions; a block of candidates gives, for every query,
one list of partial scores per half, and a score is the sum of its two entries. Phase 1 gathers
the head of every local list: the k best of each list, with full scores. The k-th best of all
gathered entries of a query, by score and then by smaller id, is a cutoff that no entry of the
answer can miss. Phase 2 hands the cutoff back; a score that reaches it has half of it, or more,
in at least one list, so only entries that reach half the cutoff in some list are collected.
Phase 3 adds the entry of the other list and keeps what reaches the cutoff.

Queries are taken in blocks of bounded size, and each block goes to all tasks; candidates stay
where they are read, and per block and query at most the gathered entries are shuffled.

Defined results: rows with a null id, or with a vector that is null, empty or holds a null or
non-finite component, take no part; components missing at the end of a shorter vector count as 0;
rows that share the query's id are its own; equal rows among the queries are one query, while equal
candidates rank one by one; an empty table gives an empty table. Products must stay below 2^53.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticeworks.llm.common import columns, stored

SCALE = 64       # components become floor(SCALE * x)
BLOCK = 4096     # queries that go to the tasks at once, about
ROWS = 256       # queries of a matrix product


def whole_numbers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and the vector in whole numbers, for the rows that take part."""
    own = columns(vectors, "vec_id", "embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = own.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite)
    numbers = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return some.select(F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("numbers"))


def _halves(queries, batch):
    """ids of a batch and, for slices of queries, the two matrices of partial scores."""
    import numpy as np

    ids = batch.column("vec_id").to_numpy()
    column = batch.column("numbers")
    width = queries.shape[1]
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy()[column.offsets[0].as_py():]
    if (lengths == width).all():
        x = flat[: len(ids) * width].reshape(-1, width).astype(float)
    else:
        x = np.zeros((len(ids), width))
        at = 0
        for i, n in enumerate(lengths.tolist()):
            x[i, : min(n, width)] = flat[at:at + min(n, width)]
            at += n
    half = (width + 1) // 2
    for a in range(0, len(queries), ROWS):
        q = queries[a:a + ROWS]
        yield a, ids, q[:, :half] @ x[:, :half].T, q[:, half:] @ x[:, half:].T


def _block_top_k(vectors: DataFrame, block: DataFrame, k: int) -> DataFrame | None:
    import numpy as np

    spark = vectors.sparkSession
    rows = sorted((r.vec_id, r.numbers) for r in block.distinct().collect())
    if not rows:
        return None
    width = max(len(v) for _, v in rows)
    matrix = np.array([v + [0] * (width - len(v)) for _, v in rows], float)
    shared = spark.sparkContext.broadcast((np.array([i for i, _ in rows]), matrix))
    schema = "query int, vec_id long, score long"

    def out(query, ids, score):
        import pyarrow as pa

        return pa.RecordBatch.from_pydict({
            "query": pa.array(query.astype(np.int32)), "vec_id": pa.array(ids), "score": pa.array(score.astype(np.int64))})

    def gather(batches):
        own, queries = shared.value
        for batch in batches:
            for a, ids, p, q in _halves(queries, batch) if batch.num_rows else ():
                other = ids[None, :] != own[a:a + len(p), None]
                heads = [np.argpartition(-np.where(other, x, -np.inf), min(k, len(ids)) - 1, axis=1)[:, :k] for x in (p, q)]
                at = np.concatenate(heads, axis=1)
                at.sort(axis=1)
                new = np.concatenate([np.ones((len(at), 1), bool), at[:, 1:] != at[:, :-1]], axis=1)
                i, j = np.nonzero(new & np.take_along_axis(other, at, 1))
                j = at[i, j]
                score = p[i, j] + q[i, j]
                order = np.lexsort((ids[j], -score, i))
                i, j, score = i[order], j[order], score[order]
                start = np.searchsorted(i, np.arange(len(p)))
                best = np.arange(len(i)) - start[i] < k
                yield out(i[best] + a, ids[j[best]], score[best])

    ranks = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    heads = vectors.mapInArrow(gather, schema)
    last = heads.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") == k).collect()
    cutoffs = np.full(len(rows), -np.inf), np.full(len(rows), np.iinfo(np.int64).max)
    for r in last:  # one row per query of the block
        cutoffs[0][r["query"]], cutoffs[1][r["query"]] = r["score"], r["vec_id"]
    limit = spark.sparkContext.broadcast(cutoffs)

    def collect(batches):
        own, queries = shared.value
        least, least_id = limit.value
        for batch in batches:
            for a, ids, p, q in _halves(queries, batch) if batch.num_rows else ():
                floor = least[a:a + len(p), None]
                i, j = np.nonzero((2 * p >= floor) | (2 * q >= floor))
                score = p[i, j] + q[i, j]
                need = least[a + i]
                keep = ((score > need) | ((score == need) & (ids[j] <= least_id[a + i]))) & (ids[j] != own[a + i])
                yield out(i[keep] + a, ids[j[keep]], score[keep])

    found = vectors.mapInArrow(collect, schema).withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "query int, query_id long")
    return stored(found.join(names, "query").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "top_k")


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score: the k best other rows for each row where ``is_query`` holds."""
    spark = vectors.sparkSession
    table = stored(whole_numbers(vectors, scale), "vectors")
    queries = table.where(is_query)
    count = queries.count()
    blocks = max(1, -(-count // block))
    parts = [
        _block_top_k(table, queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b), k) for b in range(blocks)]
    parts = [p for p in parts if p is not None]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return reduce(DataFrame.union, parts)
