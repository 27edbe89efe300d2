"""Best notices per user by cosine similarity: exact top-k over a clustered index.

Items are put into clusters by k-means, fitted on a bounded sample of them; every item is indexed,
once, with its angle to the centre of its cluster. Users come in blocks of bounded size, users of one
cluster together, and a block goes to the tasks that read items. First it meets the clusters nearest
to its users, enough to hold k items for each, which gives every user a k-th score. A cluster whose
nearest possible item, by the angle between user and centre less the widest angle in the cluster,
cannot reach that score is not read for the block; within the others the same bound, taken with each
item's own angle, leaves single items out. So the answer is exact for any clustering and any size, and
the index only decides how much is scored.
"""

from __future__ import annotations

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from noticeworks.session import shared_dir

SAMPLE = 4096                  # items that the clusters are fitted on
CLUSTERS = 128
ROUNDS = 5
BLOCK_ROWS = 4096              # users that go to the tasks at once, at most
BLOCK_BYTES = 64 * 1024 * 1024 # and the size of their vectors, at most
_ITEMS = 512                   # items that are scored against a block at once
_SLACK = 1e-6                  # radians, far beyond any rounding of an angle
_DIGITS = 12                   # scores that agree so far are equal: ties go to the smaller item id
_ROUNDING = 2 * 10.0 ** -_DIGITS  # scores that are this far below another are smaller when rounded, too
_GROUP = 256                   # tasks whose best rows meet first
_PARTIAL = "user_id bigint, item_id bigint, score double, task int"


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)


def _rows(column, width: int) -> np.ndarray:
    """The vectors of an Arrow column, all of one length, scaled to length one."""
    offsets = column.offsets.to_numpy()
    if (np.diff(offsets) != width).any():
        raise ValueError("vectors of one length expected")
    return _unit(column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]].astype(float).reshape(-1, width))


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _centres(items: DataFrame, clusters: int) -> np.ndarray:
    """Unit vectors of the cluster centres: a few k-means rounds over the ``SAMPLE`` items with the smallest hashes."""
    rows = items.select("vector", F.xxhash64("item_id").alias("h")).orderBy("h").limit(SAMPLE).select("vector").toArrow()
    vectors = np.stack(rows.column("vector").to_numpy())
    sample = np.unique(_unit(vectors.astype(float)), axis=0)
    sample = sample[sample.any(axis=1)]
    centres = sample[np.linspace(0, len(sample) - 1, min(clusters, len(sample))).astype(int)]
    for _ in range(ROUNDS if len(centres) else 0):
        nearest = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        filled = sums.any(axis=1)
        centres[filled] = _unit(sums[filled])
    return centres


def _placed(rows: DataFrame, key: str, centres: np.ndarray, width: int) -> DataFrame:
    """Rows with the cluster of the nearest centre and the angle to it, ordered by cluster within files."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)  # <= CLUSTERS rows

    def task(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _rows(batch.column("vector"), width)
            angles = _angles(unit, shared.value) if len(shared.value) else np.zeros((len(unit), 1))
            nearest = angles.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nearest.astype(np.int32)), pa.array(angles[np.arange(len(unit)), nearest])],
                [key, "vector", "cluster", "angle"])

    return rows.mapInArrow(task, f"{key} bigint, vector array<double>, cluster int, angle double").sortWithinPartitions("cluster")


class Index:
    """The clustered items: their table, and per cluster its centre, its widest angle and its size."""

    def __init__(self, items: DataFrame, clusters: int = CLUSTERS):
        own = items.where(F.col("vector").isNotNull()).select(
            F.col("item_id").cast("bigint").alias("item_id"), F.col("vector").cast("array<double>").alias("vector"))
        self.width = own.agg(F.max(F.size("vector"))).head()[0] or 0
        self.centres = _centres(own, clusters) if self.width else np.zeros((0, 0))
        self.table = _stored(_placed(own, "item_id", self.centres, self.width), "match_index")
        n = max(1, len(self.centres))
        self.widest, self.sizes = np.zeros(n), np.zeros(n, np.int64)
        for r in self.table.groupBy("cluster").agg(F.max("angle").alias("a"), F.count("*").alias("n")).collect():
            self.widest[r["cluster"]], self.sizes[r["cluster"]] = r["a"], r["n"]

    def angles(self, users: np.ndarray) -> np.ndarray:
        """Angles of users to all centres."""
        return _angles(users, self.centres) if len(self.centres) else np.zeros((len(users), 1))


def _bound(angle, spread):
    """The highest score of an item that is so far from a centre, for a user at an angle to it."""
    return np.cos(np.maximum(angle - spread - _SLACK, 0)) + _SLACK


def _widest(score):
    """The widest angle between user and item at which ``_bound`` still reaches a score."""
    return np.arccos(np.clip(score - _SLACK, -1, 1)) + _SLACK


class _Best:
    """Running best k items per user of a block; ``least`` is the score that an item must reach."""

    def __init__(self, least: np.ndarray, k: int):
        self.least, self.k = least.copy(), k
        self.user, self.item, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    def add(self, users: np.ndarray, scores: np.ndarray, items: np.ndarray) -> None:
        """``scores`` of some users, by place, with some items, not rounded."""
        least = self.least[users] - _ROUNDING
        able = scores >= least[:, None]
        if scores.shape[1] > self.k and np.count_nonzero(able) > self.k * len(users):
            kth = np.partition(scores, -self.k, axis=1)[:, -self.k] - _ROUNDING
            able = scores >= np.maximum(least, kth)[:, None]
        row, col = np.nonzero(able)
        if not len(row):
            return
        user, item = np.append(self.user, users[row]), np.append(self.item, items[col])
        score = np.append(self.score, np.round(scores[row, col], _DIGITS))
        order = np.lexsort((item, -score, user))
        user, item, score = user[order], item[order], score[order]
        rank = np.arange(len(user)) - np.searchsorted(user, user)
        kept = rank < self.k
        self.user, self.item, self.score = user[kept], item[kept], score[kept]
        last = rank == self.k - 1
        self.least[user[last]] = np.maximum(self.least[user[last]], score[last])


def _scored(index: Index, clusters, block, needed, angles, k: int) -> DataFrame:
    """The best k items of each task among some clusters, for a block of users.

    ``needed`` are scores that a user's items must reach, ``angles`` those of users to centres.
    """
    spark, width = index.table.sparkSession, index.width
    shared = spark.sparkContext.broadcast((*block, needed, angles))

    def task(batches):
        import pyarrow as pa

        users, matrix, least, to_centre = shared.value
        best = _Best(least, k)
        for batch in batches:
            for a in range(0, batch.num_rows, _ITEMS):
                part = batch.slice(a, _ITEMS)
                cluster = part.column("cluster").to_numpy()
                unit, spread = _rows(part.column("vector"), width), part.column("angle").to_numpy()
                ids = part.column("item_id").to_numpy()
                for c in np.unique(cluster):
                    # Items of a cluster lie around its centre: these ones at angles between two limits.
                    mine = np.flatnonzero(cluster == c)
                    widest = _widest(best.least)
                    gap = np.maximum(spread[mine].min() - to_centre[:, c], to_centre[:, c] - spread[mine].max())
                    able = np.flatnonzero(gap <= widest)
                    if len(able):
                        best.add(able, matrix[able] @ unit[mine].T, ids[mine])
        if len(best.user):
            number = np.full(len(best.user), TaskContext.get().partitionId(), np.int32)
            yield pa.RecordBatch.from_pydict({
                "user_id": pa.array(users[best.user]), "item_id": pa.array(best.item), "score": pa.array(best.score),
                "task": pa.array(number)})

    chosen = index.table.where(F.col("cluster").isin([int(c) for c in clusters]))
    return chosen.mapInArrow(task, _PARTIAL)


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    """The best k per user: those of neighbouring tasks meet first, so no task gets all rows of a user."""
    order = [F.desc("score"), F.col("item_id")]
    near = Window.partitionBy("user_id", "group").orderBy(*order)
    best = Window.partitionBy("user_id").orderBy(*order)
    first = rows.withColumn("group", F.floor(F.col("task") / _GROUP)).withColumn("rank", F.row_number().over(near)).where(
        F.col("rank") <= k)
    return first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "user_id", "item_id", "score", "rank")


def match_topk(
    users: DataFrame, items: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS, clusters: int = CLUSTERS,
) -> DataFrame:
    """The k most similar items per user: user_id, item_id, score, rank.

    ``users`` has (user_id bigint, vector), ``items`` (item_id bigint, vector); vectors have one
    common length, null ones take no part. A zero vector has similarity 0 with all. Ties go to the
    smaller item id. Users are taken in blocks; an item is stored once.
    """
    spark = users.sparkSession
    none = spark.createDataFrame([], "user_id bigint, item_id bigint, score double, rank int")
    index = Index(items, clusters)
    if not index.width or not index.sizes.sum():
        return none
    own = users.where(F.col("vector").isNotNull()).select(
        F.col("user_id").cast("bigint").alias("user_id"), F.col("vector").cast("array<double>").alias("vector"))
    count = own.count()
    most = max(1, min(block_rows, BLOCK_BYTES // (8 * index.width)))
    blocks = max(1, -(-count // most))
    placed = _placed(own, "user_id", index.centres, index.width).select("user_id", "vector", "cluster")
    dealt = _stored(placed.repartitionByRange(blocks, "cluster", "user_id").withColumn(
        "block", F.spark_partition_id()), "match_users")
    out = shared_dir(spark, "matches")
    for b in sorted(r["block"] for r in dealt.select("block").distinct().collect()):
        rows = dealt.where(F.col("block") == b).select("user_id", "vector").toArrow()  # about one block
        for a in range(0, rows.num_rows, most):
            part = rows.slice(a, most)
            _block(index, part.column("user_id").to_numpy(), _rows(part.column("vector").combine_chunks(), index.width), k, out)
    return spark.read.schema(none.schema).parquet(out) if count else none


def _block(index: Index, ids: np.ndarray, users: np.ndarray, k: int, out: str) -> None:
    """Find and write the answers of one block of users."""
    angles = index.angles(users)
    # The nearest clusters of each user, as many as hold k items.
    order = np.argsort(angles, axis=1, kind="stable")
    before = np.cumsum(index.sizes[order], axis=1) - index.sizes[order]
    near = np.unique(order[before < k])
    first = _stored(_ranked(_scored(index, near, (ids, users), np.full(len(ids), -2.0), angles, k), k), "near")
    place = {u: i for i, u in enumerate(ids.tolist())}
    needed = np.full(len(ids), -2.0)
    for r in first.where(F.col("rank") == k).select("user_id", "score").collect():  # one row per user of the block
        needed[place[r["user_id"]]] = r["score"]
    able = _bound(angles, index.widest[None, :]) >= needed[:, None]
    rest = np.setdiff1d(np.flatnonzero(able.any(axis=0) & (index.sizes > 0)), near)
    if len(rest):
        more = _scored(index, rest, (ids, users), needed, angles, k)
        both = first.select("user_id", "item_id", "score", F.lit(0).alias("task")).unionByName(more)
        _ranked(both, k).write.mode("append").parquet(out)
    else:
        first.write.mode("append").parquet(out)
