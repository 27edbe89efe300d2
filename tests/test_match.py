import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from noticeworks.operators import match, vectors


def unit(m):
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def frame(spark, m, name):
    offsets = pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32())
    vectors = pa.ListArray.from_arrays(offsets, pa.array(m.ravel()))
    return spark.createDataFrame(pa.table({name: pa.array(np.arange(len(m))), "vector": vectors}))


def check_match(got, users, items, k):
    """All ranks, with ties by item id: the scores agree to 12 digits where they are equal."""
    score = np.round(unit(users) @ unit(items).T, 12)
    rows = {(r["user_id"], r["rank"]): (r["item_id"], r["score"]) for r in got.collect()}
    assert len(rows) == len(users) * min(k, len(items))
    for u in range(len(users)):
        best = np.lexsort((np.arange(len(items)), -score[u]))[:k]
        mine = [rows[u, n + 1] for n in range(len(best))]
        assert np.allclose([s for _, s in mine], score[u][best], atol=1e-9) and len({i for i, _ in mine}) == len(best)
        assert np.allclose([score[u, i] for i, _ in mine], score[u][best], atol=1e-9)


@pytest.mark.parametrize("block_rows, clusters", [(4096, 128), (13, 4), (7, 1)])
def test_match_is_exact(spark, block_rows, clusters):
    """One path for all sizes agrees with brute force: ties, repeated and zero vectors included."""
    rng = np.random.default_rng(1)
    users = rng.integers(-2, 3, (30, 4)).astype(float)
    items = rng.integers(-2, 3, (200, 4)).astype(float)
    users[3], items[5], items[170] = 0, 0, 0
    got = match.match_topk(frame(spark, users, "user_id"), frame(spark, items, "item_id").repartition(5), 7, block_rows, clusters)
    check_match(got, users, items, 7)


def test_match_is_exact_beyond_one_block_of_bytes(spark):
    """More than 64 MiB of users: several blocks, clustered items, of which most are never scored."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 1024))
    users = centres[rng.integers(8, size=9000)] + rng.normal(size=(9000, 1024)) * 0.2
    items = centres[rng.integers(8, size=400)] + rng.normal(size=(400, 1024)) * 0.2
    assert users.nbytes > match.BLOCK_BYTES
    check_match(match.match_topk(frame(spark, users, "user_id"), frame(spark, items, "item_id"), 3, clusters=8), users, items, 3)


def test_match_reads_only_clusters_that_can_win(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = np.eye(16) * 10
    items = np.repeat(centres, 20, axis=0) + rng.normal(size=(320, 16)) * 0.1
    users = centres[[3]] + rng.normal(size=(5, 16)) * 0.1
    read, scored = [], match._scored
    monkeypatch.setattr(match, "_scored", lambda index, clusters, *rest: read.append(list(clusters)) or scored(index, clusters, *rest))
    check_match(match.match_topk(frame(spark, users, "user_id"), frame(spark, items, "item_id"), 4, clusters=16), users, items, 4)
    assert sum(map(len, read)) < 8


def test_best_items_of_some_users():
    """Raw scores of the users in reach only; ties after rounding go to the smaller item."""
    best = match._Best(np.full(3, -2.0), 2)
    best.add(np.array([0, 2]), np.array([[0.5, 0.5 + 1e-14, 0.1, 0.2], [0.9, 0.1, 0.3, 0.2]]), np.array([7, 3, 1, 4]))
    best.add(np.array([2]), np.array([[0.3 - 1e-14, 0.2]]), np.array([0, 5]))
    got = list(zip(best.user.tolist(), best.item.tolist(), best.score.tolist()))
    assert got == [(0, 3, 0.5), (0, 7, 0.5), (2, 7, 0.9), (2, 0, 0.3)]
    assert best.least.tolist() == [0.5, -2.0, 0.3]


def test_widest_angle_agrees_with_the_bound():
    score = np.append(np.linspace(-1, 1, 501), -2.0)
    wide = match._widest(score)
    assert (match._bound(wide - 1e-9, 0) >= score).all() and (match._bound(wide + 1e-5, 0) < score)[(wide < 3.1) & (score > -1)].all()


def test_match_without_users_or_items(spark):
    none = spark.createDataFrame([], "user_id bigint, vector array<float>")
    items = spark.createDataFrame([(1, [1.0])], "item_id bigint, vector array<float>")
    assert match.match_topk(none, items).count() == 0
    user = spark.createDataFrame([(1, [1.0])], "user_id bigint, vector array<float>")
    assert match.match_topk(user, items.where("item_id > 1")).count() == 0


def test_embed_isolates_failures(spark):
    def fragile(texts):
        if any("bad" in t for t in texts):
            raise ValueError("refused")
        return [[float(len(t))] for t in texts]

    df = spark.createDataFrame([("abc",), ("bad",), ("  ",), (None,), ("x" * 40_000,)], "text string")
    got = {str(r["text"])[:5]: r["embedding"] for r in vectors.embed(df, fragile).collect()}
    assert got == {"abc": [3.0], "bad": None, "  ": None, "None": None, "xxxxx": [40_000.0]}


def test_hash_vectors(spark):
    df = spark.createDataFrame([("Pump pump, road",), (" .. ",), (None,)], "text string")
    got = [r["embedding"] for r in vectors.hash_vectors(df, dim=64).collect()]
    assert got[1] is None and got[2] is None
    assert len(got[0]) == 64 and sorted(x for x in got[0] if x)[-1] == pytest.approx(2 / 5 ** 0.5)
