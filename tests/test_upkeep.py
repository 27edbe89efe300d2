import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from noticeworks import model as M
from noticeworks.operators import backfill, calllog, dedup, merge, metrics, search, vectors
from noticeworks.plans import runs
from noticeworks.sources import clustered, export, pages as P, snapshots
from noticeworks.sources.store import JobTable, NoticeTable, write_back
from noticeworks.streaming import incremental, logs

AT = dt.datetime(2026, 3, 1)
ORD = M.ORDER_TYPE


def items(spark, rows, columns):
    return spark.createDataFrame([(*r, (1, None, None, 1, 1, i)) for i, r in enumerate(rows)], f"{columns}, ingest_ord {ORD}")


def test_first_and_last_wins(spark):
    df = items(spark, [("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert {tuple(r)[:2] for r in dedup.first_wins(df, ["k"]).collect()} == {("a", 1), ("b", 3)}
    assert {tuple(r)[:2] for r in dedup.last_wins(df, ["k"]).collect()} == {("a", 2), ("b", 3)}


def test_unique_orders_need_no_sorted_aggregate(spark):
    """Nulls in keys and orders, extra aggregates and a hot key, beside the aggregate of whole rows."""
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]) if i % 3 else "hot", i if i % 7 else -i, f"v{i}") for i in range(300)]
    rows += [(None, None, "x")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    for wins in (dedup.first_wins, dedup.last_wins):
        fast = wins(df, ["k"], "o", F.count("*").alias("n"), unique=True)
        assert sorted(map(str, fast.collect())) == sorted(map(str, wins(df, ["k"], "o", F.count("*").alias("n")).collect()))
        assert "SortAggregate" not in plan(fast) and "SortAggregate" in plan(wins(df, ["k"], "o"))
    narrow = df.where("o is not null").select("k", "o", (F.col("o") * 2).alias("w"))
    assert sorted(map(str, dedup.last_wins(narrow, ["k"], "o", unique=True).collect())) == sorted(map(str, dedup.last_wins(narrow, ["k"], "o").collect()))
    text = plan(dedup.last_wins(narrow, ["k"], "o", unique=True))
    assert "SortAggregate" not in text and "Join" not in text
    nothing = spark.createDataFrame([("only", None, "null order")], df.schema)
    assert dedup.last_wins(nothing, ["k"], "o", unique=True).head()["v"] == "null order"
    # Equal orders: without the statement one row stays.
    assert dedup.last_wins(spark.createDataFrame([("a", 1, "x"), ("a", 1, "y")], "k string, o int, v string"), ["k"], "o").count() == 1


def test_packed_order_sorts_like_its_parts(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 9), rng.randint(0, 999), rng.randint(0, 10**14 - 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a int, b int, c bigint").withColumn(
        "o", dedup.packed_order((F.col("a"), 1), (F.col("b"), 3), (F.col("c"), 14)))
    assert [tuple(r)[:3] for r in df.orderBy("o").collect()] == sorted(rows)
    with pytest.raises(Exception, match="an order of 2 digits expected"):
        df.select(dedup.packed_order((F.col("b") + 100, 2))).collect()


def scan_metrics(spark, df):
    """Files and rows that the scan of a frame has read, without adaptive execution."""
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        n = len(df.collect())
        leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return n, leaf.metrics().apply("numFiles").value(), leaf.metrics().apply("numOutputRows").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)


def test_search_copy_reads_fewer_files(spark, tmp_path):
    base = dt.datetime(2025, 1, 1)
    rows = [(f"R{i}", "cppp" if i % 2 else "eprocure", f"Org {i % 50}", None if i % 97 == 0 else base + dt.timedelta(hours=9 * i), float(i))
            for i in range(2000)]
    notices = spark.createDataFrame(rows, "ref_no string, source string, organisation string, published_date timestamp_ntz, tender_value double")
    path = str(tmp_path / "copy")
    clustered.write_search_copy(notices, path)
    everything = scan_metrics(spark, clustered.search_copy(spark, path))
    assert everything[0] == 2000

    def check(**how):
        want = search.search_notices(notices, **{k: v for k, v in how.items() if k != "source"})
        want = want.where(F.col("source") == how["source"]) if "source" in how else want
        got = clustered.search_copy(spark, path, **how)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        return scan_metrics(spark, clustered.search_copy(spark, path, **how))

    n, files, read = check(published_from="2025-03-10", published_to="2025-04-02", organisation="Org 7")
    assert 0 < n and files <= everything[1] / 5 and read < 200
    assert check(published_from="2025-03-10", published_to="2025-04-02", source="cppp")[1] <= files
    assert check(published_to="2025-01-01")[0] == 0 and check(published_from="2026-06-01", min_value=1500.0)[0] > 0
    assert check(organisation="nobody")[0] == 0


def test_merge_detail(spark):
    listing = items(spark, [("t1", "u1"), ("t2", "u1"), ("t3", None), ("t4", ""), ("t5", "u2")], "title string, url string")
    detail = items(spark, [("u1", "Pune", ""), ("u2", None, None), ("", "no", "no")], "url string, location string, title string")
    got = {r["url"]: r for r in merge.merge_detail(listing, detail).collect()}
    assert len(got) == 4 and got["u1"]["location"] == "Pune" and got["u1"]["title"] == ""
    assert got["u2"]["title"] == "t5" and got["u2"]["detail_merged"] is False
    assert got[None]["location"] is None and got[""]["location"] is None


def test_merge_detail_never_multiplies_rows(spark):
    listing = items(spark, [("t1", "u1")], "title string, url string")
    detail = items(spark, [("u1", "Pune"), ("u1", "Goa")], "url string, location string")
    assert [r["location"] for r in merge.merge_detail(listing, detail).collect()] == ["Goa"]
    with pytest.raises(ValueError, match="ingest_ord"):
        merge.merge_detail(listing, detail.drop("ingest_ord"))


def test_merge_detail_does_not_hold_the_rows_of_a_hot_url(spark):
    """The listing side of the join is not sorted, so no task holds all rows of a URL."""
    listing = spark.range(2_000).select(
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 5 != 0, F.concat(F.lit("u"), "id")).alias("url"), F.col("id").alias("title"))
    detail = spark.createDataFrame([("hot", "a", 0), ("u1", "b", 0), ("u1", "c", 1)], "url string, location string, ingest_ord int")
    out = merge.merge_detail(listing, detail)
    assert {(r["location"], r["n"]) for r in out.groupBy("location").agg(F.count("*").alias("n")).collect()} == {
        ("a", 1000), ("c", 1), (None, 999)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_merge_detail_splits_a_hot_url(spark):
    """Half of all rows share one URL: the join splits that partition instead of one task taking it."""
    listing = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 500)).alias("url"),
        F.sha2(F.col("id").cast("string"), 256).alias("title"),
    )
    detail = spark.range(500).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("u"), "id")).alias("url"), F.lit("x").alias("location"),
        F.lit(0).alias("ingest_ord"),
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k", "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = merge.merge_detail(listing, detail)
        assert out.agg(F.count("*"), F.count("location")).head() == out.agg(F.count("*"), F.count("location")).head()
        plan = out.select("title", "location")
        plan.collect()
        assert "skew=true" in plan._jdf.queryExecution().executedPlan().toString()
        assert plan.count() == 40_000 and plan.where("location is null").count() == 0 + listing.where("url = 'u0'").count()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def notice(spark, rows):
    cols = "ref_no string, source string, title string, url string, tender_value double, tender_type string"
    return merge.notice_rows(items(spark, rows, cols))


def test_notice_rows(spark):
    rows = notice(spark, [(" ", "cppp", " t ", None, None, ""), ("r", None, None, " u ", 0.0, None), ("s", "cppp", "x", "u", 5.0, None)])
    got = {r["ref_no"]: r for r in rows.collect()}
    assert got["UNKNOWN"]["title"] == "t" and got["UNKNOWN"]["url"] == "" and not got["UNKNOWN"]["detail_scraped"]
    assert got["r"]["source"] == "eprocure" and got["r"]["url"] == "u" and not got["r"]["detail_scraped"]
    assert got["s"]["detail_scraped"] and got["s"]["is_active"]
    same = merge.notice_rows(items(spark, [("r", "cppp")], "ref_no string, source string"), compat_source=True)
    assert same.head()["source"] == "eprocure"


@pytest.fixture
def table(spark, tmp_path):
    return NoticeTable(spark, str(tmp_path / "notices"), buckets=4)


def state(table):
    return {(r["ref_no"], r["source"]): r.asDict() for r in table.read().collect()}


def test_upsert_rule(spark, table):
    table.upsert(notice(spark, [("k", "e", "old", "u", 5.0, "Open"), ("only", "e", "o", "u", 1.0, None)]), AT)
    batch = notice(spark, [("k", "e", "early", "x", 9.0, None), ("k", "e", "new", None, None, None), ("n", "e", "n", "u", None, None), ("k", "other", "z", "u", None, None)])
    table.upsert(batch, AT + dt.timedelta(days=1))
    got = state(table)
    assert set(got) == {("k", "e"), ("only", "e"), ("n", "e"), ("k", "other")}
    k = got["k", "e"]
    assert (k["title"], k["url"], k["tender_value"], k["tender_type"], k["detail_scraped"]) == ("new", "", 5.0, "Open", False)
    assert got["only", "e"]["updated_at"] == AT and k["updated_at"] == AT + dt.timedelta(days=1)
    table.upsert(batch, AT + dt.timedelta(days=1))
    assert state(table) == got


def test_upsert_rewrites_touched_buckets_only(spark, table):
    table.upsert(notice(spark, [(f"k{i}", "e", "t", "u", None, None) for i in range(50)]), AT)
    folders = lambda: {b: p["folder"] for b, p in table._load()["notices"].items()}
    before = folders()
    table.upsert(notice(spark, [("k1", "e", "t2", "u", None, None)]), AT)
    after = folders()
    assert len(before) == 4 and sum(before[b] != after[b] for b in after) == 1
    assert len(state(table)) == 50


def test_batches_are_applied_once(spark, table):
    table.upsert(notice(spark, [("k", "e", "one", "u", None, None)]), AT, batch="b1")
    table.upsert(notice(spark, [("k", "e", "two", "u", None, None)]), AT, batch="b1")
    assert state(table)["k", "e"]["title"] == "one"
    # Names stay known after other batches, and the pointer keeps its own name only.
    for name in ("b2", "b3"):
        table.upsert(notice(spark, [("k", "e", name, "u", None, None)]), AT, batch=name)
    for name in ("b1", "b2", "b3"):
        table.upsert(notice(spark, [("k", "e", "again", "u", None, None)]), AT, batch=name)
    assert state(table)["k", "e"]["title"] == "b3" and table._load()["batch"] == "b3"
    assert [table.batch_rows(b) for b in ("b1", "b3", "none")] == [1, 1, 0]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("shuffle_partitions", ["4", "200"])
def test_stored_rows_are_neither_shuffled_nor_sorted(spark, table, tmp_path, shuffle_partitions):
    rows = notice(spark, [(f"k{i}", "e", "t", "u", None, None) for i in range(50)])
    table.upsert(rows, AT)
    table.set_embeddings(spark.createDataFrame([("k1", "e", [1.0]), ("k2", "e", [2.0])], M.VECTOR_SCHEMA))
    merge.latest_per_key(rows).drop("ingest_ord").write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": shuffle_partitions}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        both, whole, left = plan(merge.merge_notices(table.notices(), batch)), plan(table.read()), plan(table.pending())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # One exchange and one sort in the merge, both of the batch; none where stored tables meet.
    assert both.count("Exchange hashpartitioning") == 1 and both.count("+- Sort [") == 1 and "Bucketed: true" in both
    assert both.index("Bucketed: true") < both.index("Exchange hashpartitioning")
    assert "Exchange" not in whole and "Sort [" not in whole and "Exchange" not in left and "Sort [" not in left
    assert "embedding" not in left.split("ReadSchema")[-1]


def test_commit_never_replaces_a_pointer_that_appears_meanwhile(spark, table, monkeypatch):
    """The target appears when the draft has been written: just before the one step that claims it."""
    table.upsert(notice(spark, [("k", "e", "t", "u", None, None)]), AT)
    draft, theirs = table._draft, {"buckets": 4, "notices": {}, "vectors": {}, "batch": "theirs", "batch_rows": 0}

    def late(state):
        made = draft(state)
        if not other:
            other.append(NoticeTable(spark, table.path)._save(theirs, 2))
        return made

    other = []
    monkeypatch.setattr(table, "_draft", late)
    assert table._save({"buckets": 4, "notices": {}, "vectors": {}, "batch": "mine", "batch_rows": 0}, 2) is False
    assert other == [True] and table._at(2) == theirs and table._versions() == [1, 2]
    fs, folder = table._place("")
    assert not [f for f in fs.listStatus(folder) if f.getPath().getName().startswith("_draft")]


def test_status_comes_from_the_pointer(spark, table):
    rows = [(f"k{i}", "e", "t", "u", None, "Open" if i % 3 == 0 else None) for i in range(40)]

    def same():
        assert table.status().collect() == metrics.status_metrics(table.read()).collect()
        assert "FileScan" not in plan(table.status())

    same()
    table.upsert(notice(spark, rows), AT)
    same()
    table.set_embeddings(spark.createDataFrame(
        [("k1", "e", [1.0]), ("k2", "e", None), ("k3", "e", [3.0]), ("gone", "e", [4.0])], M.VECTOR_SCHEMA))
    same()
    table.upsert(notice(spark, rows[:5] + [("new", "e", "n", "u", 1.0, "Open")]), AT + dt.timedelta(days=1))
    table.set_embeddings(spark.createDataFrame([("k1", "e", [9.0]), ("new", "e", [5.0])], M.VECTOR_SCHEMA))
    same()
    got = table.status().head()
    assert (got["tender_count"], got["embedding_pending_count"], table.pending().count()) == (41, 38, 38)
    assert {k[0]: v["embedding"] for k, v in state(table).items() if v["embedding"]} == {"k1": [9.0], "k3": [3.0], "new": [5.0]}


def test_two_interleaved_writers_keep_both_updates(spark, table, monkeypatch):
    table.upsert(notice(spark, [("k0", "e", "t", "u", None, None)]), AT)
    other, save = NoticeTable(spark, table.path), table._save

    def late(state, version):
        if not other._holds(other._load(), "second"):
            other.upsert(notice(spark, [("k0", "e", "theirs", "u", None, None), ("kB", "e", "b", "u", None, None)]), AT, batch="second")
        return save(state, version)

    monkeypatch.setattr(table, "_save", late)
    table.upsert(notice(spark, [("kA", "e", "a", "u", None, None)]), AT, batch="first")
    assert {k[0]: r["title"] for k, r in state(table).items()} == {"k0": "theirs", "kA": "a", "kB": "b"}
    assert table._holds(table._load(), "first") and table._holds(table._load(), "second")


def test_clean_up_spares_what_kept_versions_use(spark, table):
    rows = notice(spark, [(f"k{i}", "e", "t", "u", None, None) for i in range(50)])
    for _ in range(4):
        table.upsert(rows, AT)
    before = state(table)
    assert table.clean_up(keep=2) == 2 and state(table) == before and table.clean_up() == 0


def test_streams_with_like_named_or_reset_checkpoints_are_told_apart(spark, table, tmp_path):
    def run(name, checkpoint, html_rows):
        spark.createDataFrame(html_rows, M.PAGE_SCHEMA).write.mode("append").parquet(str(tmp_path / name))
        incremental.upsert_new_pages(spark, str(tmp_path / name), table, str(tmp_path / checkpoint), AT)

    def page(n):
        row = "".join(f"<td>{x}</td>" for x in ("1.", "01-Mar-2026", "09-Mar-2026", "10-Mar-2026", f'<a href="/n?id={n}">[Supply of pumps and pipes {n}][REF-{n}][{n}]</a>', "Water Board"))
        return [(n, "eprocure", "u", 1, f'<html><table class="list_table"><tr>{row}</tr></table></html>')]

    run("a", "a1/checkpoint", page(1))
    run("b", "b1/checkpoint", page(2))
    run("b", "b2/checkpoint", page(3))  # a new checkpoint counts from 0 again
    run("b", "b2/checkpoint", [])
    assert len(table._load()["streams"]) == 3 and len(state(table)) == 3


def test_vectors_survive_later_upserts(spark, table):
    rows = notice(spark, [("a", "e", "pump", "u", None, "Open"), ("b", "e", "road", "u", None, None)])
    table.upsert(rows, AT)
    runs.embed_pending(table, 10, lambda df: vectors.hash_vectors(df, dim=8))
    # Only the notice with detail is chosen while it is pending.
    assert [k[0] for k, v in state(table).items() if v["embedding"]] == ["a"]
    runs.embed_pending(table, 10, lambda df: vectors.hash_vectors(df, dim=8))
    table.upsert(rows, AT)
    assert all(v["embedding"] and len(v["embedding"]) == 8 for v in state(table).values())


def test_all_pending_notices_get_vectors_without_a_limit(spark, table):
    table.upsert(notice(spark, [(f"k{i}", "e", "pump " * 9000 + "end", "u", None, "Open" if i % 2 else None) for i in range(5)]), AT)
    runs.embed_pending(table, embed=lambda df: vectors.hash_vectors(df, dim=64))
    assert all(r["embedding"] for r in state(table).values())
    # The last word of a long text counts.
    texts = spark.createDataFrame([("pump " * 9000,), ("pump " * 9000 + "end",)], "text string")
    a, b = [r[0] for r in vectors.hash_vectors(texts).select("embedding").collect()]
    assert a != b


def test_vectors_are_written_once_and_never_staged(spark, table, monkeypatch):
    """Of the vectors of a run no copy is written but that of the table, one file for each bucket; another writer's are kept."""
    from pyspark.sql import DataFrameWriter

    staged, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (staged.append(self._df.columns), parquet(self, *a, **b))[1])
    files = lambda: {b: len(list(pathlib.Path(table.path, p["folder"], f"bucket={b}").glob("part-*"))) for b, p in table._load()["vectors"].items()}
    rows = [(f"k{i:03}", "e", f"pump {i}", "u", None, None) for i in range(300)] + [("blank", "e", "", "", None, None)]
    table.upsert(notice(spark, rows[:200]), AT)
    split = "spark.sql.files.maxPartitionBytes"
    was = spark.conf.get(split)
    spark.conf.set(split, "2k")  # the files of the notices are read in pieces
    try:
        runs.embed_pending(table, embed=lambda df: vectors.hash_vectors(df, dim=8), batch="first")
    finally:
        spark.conf.set(split, was)
    assert table.batch_rows("first") == 200 and set(files().values()) == {1}
    table.upsert(notice(spark, rows), AT)
    other, save = NoticeTable(spark, table.path), table._save

    def late(state, version):
        if not other._holds(other._load(), "theirs"):
            other.set_embeddings(spark.createDataFrame([("k250", "e", [9.0])], M.VECTOR_SCHEMA), "theirs")
        return save(state, version)

    monkeypatch.setattr(table, "_save", late)
    runs.embed_pending(table, embed=lambda df: vectors.hash_vectors(df, dim=8), batch="second")
    got = {k[0]: r["embedding"] for k, r in state(table).items()}
    assert got.pop("k250") == [9.0] and got.pop("blank") is None and {len(v) for v in got.values()} == {8} and len(got) == 299
    assert table.batch_rows("second") == 99 and set(files().values()) == {1}
    # Nothing is left to do: no version, and no folder without one.
    before = table._versions()
    runs.embed_pending(table, embed=lambda df: vectors.hash_vectors(df, dim=8), batch="third")
    used = {p["folder"] for v in before for kind in table.schemas for p in table._at(v)[kind].values()}
    assert table._versions() == before and {f"data/{p.name}" for p in pathlib.Path(table.path, "data").iterdir()} == used
    assert [c for c in staged if "embedding" in c] == [["ref_no", "source", "embedding"]]  # the other writer's one


def test_vectors_of_new_buckets_are_not_sorted(spark, table, monkeypatch):
    """The notices are, before they get their vectors; the files are in the order of their keys all the same."""
    import pyarrow.orc as orc
    from pyspark.sql import DataFrameWriter

    sort, sorted_rows = DataFrameWriter.sortBy, []
    monkeypatch.setattr(DataFrameWriter, "sortBy", lambda self, *a: (sorted_rows.append(self._df.columns), sort(self, *a))[1])

    def check(path, n):
        files = list(pathlib.Path(path, "data").glob("*/bucket=*/part-*.orc"))
        keys = [orc.read_table(f, columns=["ref_no", "source"]).to_pylist() for f in files]
        assert sum(map(len, keys)) == n and len({f.parent for f in files}) == len(files) == 4
        for k in ([(r["ref_no"], r["source"]) for r in rows] for rows in keys):
            assert len(k) > 9 and k == sorted(k)

    rows = notice(spark, [(f"k{i * 7919 % 1000}", s, f"pump {i}", "u", None, None) for i in range(200) for s in ("b", "a")]).repartition(5)
    table.upsert(rows, AT)
    runs.embed_pending(table)
    assert not [c for c in sorted_rows if "embedding" in c]
    check(table.path, 400)
    assert {len(r["embedding"]) for r in state(table).values()} == {M.EMBED_DIM}
    # Where Spark would sort by bucket alone, and for a function that may move rows, the key is named.
    for name, conf, embed in (("one", "0", vectors.hash_vectors), ("moved", "16", lambda df: vectors.hash_vectors(df.repartition(3)))):
        again = NoticeTable(spark, f"{table.path}-{name}", buckets=4)
        again.upsert(rows, AT)
        was = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", conf)
        try:
            runs.embed_pending(again, embed=embed)
        finally:
            spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", was)
        assert [c for c in sorted_rows if "embedding" in c]
        assert state(again) == state(table)
        sorted_rows.clear()
        if name == "one":
            check(again.path, 400)


def test_a_table_keeps_the_format_it_was_made_with(spark, table):
    rows = notice(spark, [("a", "e", "pump", "u", None, None)])
    made = spark.createDataFrame([("a", "e", [1.0])], M.VECTOR_SCHEMA)
    table.formats = {}  # as it was before vectors had one
    table.upsert(rows, AT)
    table.set_embeddings(made)
    again = NoticeTable(spark, table.path)
    again.set_embeddings(spark.createDataFrame([("a", "e", [2.0])], M.VECTOR_SCHEMA))
    assert again.formats == {} and [r["embedding"] for r in state(again).values()] == [[2.0]]


def test_write_back(spark):
    t = spark.createDataFrame([(1, [1.0]), (2, None), (3, None)], "id int, embedding array<float>")
    v = spark.createDataFrame([(1, None), (2, [2.0]), (9, [9.0])], "id int, embedding array<float>")
    assert {tuple(map(str, r)) for r in write_back(t, v, ["id"]).collect()} == {("1", "[1.0]"), ("2", "[2.0]"), ("3", "None")}


def test_pending(spark):
    def chosen(rows, n=2):
        df = spark.createDataFrame(rows, "id int, detail_scraped boolean, embedding array<float>")
        return sorted(r["id"] for r in vectors.pending(df, n).collect())

    assert chosen([(1, True, None), (2, False, None), (3, False, None)]) == [1]
    assert chosen([(2, False, None), (3, None, None), (4, False, None)]) == [2, 3]
    assert chosen([(1, True, [1.0])]) == []


def test_status_metrics(spark):
    df = spark.createDataFrame(
        [(True, None, AT), (False, [1.0], None), (None, None, AT + dt.timedelta(1))], "detail_scraped boolean, embedding array<float>, updated_at timestamp_ntz"
    )
    got = metrics.status_metrics(df).head()
    assert tuple(got) == (3, 1, 1, 2, True, AT + dt.timedelta(1))
    assert metrics.status_metrics(df.where("false")).head()["tender_count"] == 0
    assert metrics.last_updated(df).head()[0] == AT + dt.timedelta(1)


def test_backfill_rejects_in_order(spark):
    rows = [("A", "t", "u"), ("A", "t2", "u"), ("B", "", "u"), ("C", "t", None), ("K", "t", "u"), ("K", "", "u"), ("", "x", "u"), (None, "y", "u")]
    df = items(spark, rows, "ref_no string, title string, url string").withColumns(
        {c: F.lit(None).cast("string") for c in ("organisation", *M.DATE_FIELDS)}
    )
    stored = spark.createDataFrame([("K",), ("K",)], "ref_no string")
    got = backfill.backfill_counters(df, stored).head().asDict()
    assert got == {"total": 8, "skipped_bad": 3, "skipped_existing": 1, "skipped_duplicate": 2, "inserted": 2}
    assert got["total"] == sum(v for k, v in got.items() if k != "total")
    assert {(r["ref_no"], r["title"]) for r in backfill.backfill_inserts(df, stored).collect()} == {("A", "t2"), ("UNKNOWN", "y")}
    assert {r[0] for r in merge.new_keys(df, stored).collect()} == {"A", "B", "C", "", None}


def test_snapshots(spark, tmp_path):
    store = snapshots.SnapshotStore(spark, str(tmp_path))
    rows = items(spark, [("a", 1), ("b", 2)], "ref_no string, v int")
    store.append(rows, "r1", AT, "s")
    store.append(rows.where("v = 2"), "r2", AT + dt.timedelta(1), "s")
    store.append(rows, "r2", AT + dt.timedelta(2), "s")  # complete already
    assert [tuple(r)[:1] for r in store.latest_items().collect()] == [("b",)]
    latest = store.latest().collect()
    assert len(latest) == 1 and latest[0]["id"] == 1 and latest[0]["count"] == 1 and latest[0]["updated_at"] == AT + dt.timedelta(1)
    assert [r["snapshot_id"] for r in snapshots.history(store.headers(), 1).collect()] == ["r2"]
    packed = snapshots.payload_chunks(rows.withColumn("s", F.lit("x")), ["s"], ["ref_no", "v"])
    assert packed.count() == 1 and [tuple(r) for r in snapshots.unpack(packed).select("ref_no", "v").collect()] == [("a", 1), ("b", 2)]


def test_diff_is_null_safe(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (3, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, None), (4, "x")], "k int, v string")
    assert {(r["k"], r["change"]) for r in snapshots.diff(a, b, ["k"], ["v"]).collect()} == {(2, "changed"), (3, "gone"), (4, "new")}


def test_call_budget_boundary_and_brute_force(spark):
    base = dt.datetime(2026, 1, 1, 0, 0, 59, 500000)
    offsets = [0, 0, 1, 30, 59.999999, 60, 60.000001, 61, 119, 120, 121, 181]
    rows = [(i, "k" if i % 4 else None, base + dt.timedelta(seconds=o)) for i, o in enumerate(offsets)]
    df = spark.createDataFrame(rows, "i int, key string, ts timestamp_ntz")
    got = {r["i"]: (r["calls_in_window"], r["over_budget"]) for r in calllog.call_budget(df, budget=3).collect()}
    for i, key, at in rows:
        n = sum(k == key and at - dt.timedelta(seconds=60) <= t <= at for _, k, t in rows)
        assert got[i] == (n, n > 3)


def test_call_without_time_stamp_is_kept(spark):
    df = spark.createDataFrame([(1, "k", AT), (2, "k", None)], "i int, key string, ts timestamp_ntz")
    assert {r["i"]: r["calls_in_window"] for r in calllog.call_budget(df).collect()} == {1: 1, 2: None}


def test_call_budget_reads_and_shuffles_the_log_once(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 3 AS key", "timestamp_seconds(id) AS ts", "'x' AS KEYS").write.parquet(str(tmp_path / "log"))
    text = plan(calllog.call_budget(spark.read.parquet(str(tmp_path / "log"))))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "Join" not in text


def calls_of(rng, n, keys=3, seconds=600):
    base = dt.datetime(2026, 1, 1)
    return [(i, rng.choice([f"k{j}" for j in range(keys)] + [None]), base + dt.timedelta(microseconds=rng.randint(0, seconds * 10**6))) for i in range(n)]


def streamed(spark, tmp_path, files, schema, run):
    """Feed files one by one to a stream; ``run`` gets the streaming frame and a checkpoint."""
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "checkpoint"))


def test_call_budget_stream_equals_the_batch(spark, tmp_path):
    """Calls out of order within the allowed lateness, over several triggers; one without a stamp."""
    rng = random.Random(4)
    rows = sorted(calls_of(rng, 300), key=lambda r: r[2] + dt.timedelta(seconds=rng.uniform(0, 50)))
    rows += [(999, "k0", None)]
    files = [rows[i::1][a:a + 80] for i in (0,) for a in range(0, len(rows), 80)]
    files.append([(-1, "beat", dt.datetime(2026, 1, 2))])
    schema = "i int, key string, ts timestamp"

    def run(calls, checkpoint):
        q = logs.call_budget_stream(calls, late="60 seconds", budget=3).writeStream.trigger(availableNow=True).option(
            "checkpointLocation", checkpoint).format("parquet").start(str(tmp_path / "out"))
        q.awaitTermination()
        held.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])

    held = []
    streamed(spark, tmp_path, files, schema, run)
    got = {r["i"]: tuple(r)[3:] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r["i"]: tuple(r)[3:] for r in calllog.call_budget(spark.createDataFrame(rows, schema), budget=3).collect()}
    assert got == want and len(got) == len(rows)
    assert held[-1] <= 2  # the windows of the heartbeat


def test_calls_behind_the_watermark_are_left_out(spark, tmp_path):
    base = dt.datetime(2026, 1, 1)
    files = [[(1, "k", base)], [(2, "k", base + dt.timedelta(hours=1))], [(3, "k", base)], [(4, "k", base + dt.timedelta(days=1))]]

    def run(calls, checkpoint):
        logs.call_budget_stream(calls, late="10 seconds").writeStream.trigger(availableNow=True).option(
            "checkpointLocation", checkpoint).format("parquet").start(str(tmp_path / "out")).awaitTermination()

    streamed(spark, tmp_path, files, "i int, key string, ts timestamp", run)
    assert {r["i"]: r["calls_in_window"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {1: 1, 2: 1}


def test_job_state_stream_is_bounded(spark, tmp_path):
    """Ten triggers: the states equal those of the batch, only open jobs have state, one folder stays."""
    base = dt.datetime(2026, 1, 1)
    schema = "job_id string, ts timestamp, seq int, status string"
    rng = random.Random(2)
    files, seq = [], 0
    for trigger in range(10):
        rows = []
        for job in range(12):
            for _ in range(2):
                seq += 1
                ended = (trigger + job) % 5 == 0
                rows.append((f"j{job}-{trigger // 2}", base + dt.timedelta(seconds=trigger * 100 + rng.randint(0, 90)), seq,
                             rng.choice(["completed", "error"]) if ended else rng.choice(["running", "pending"])))
        files.append(rows)
    table = JobTable(spark, str(tmp_path / "jobs"), buckets=1)
    out = {}

    def run(events, checkpoint):
        out["query"], out["states"] = logs.job_states(spark, events, table, checkpoint, late="0 seconds")

    streamed(spark, tmp_path, files, schema, run)
    every = [r for f in files for r in f]
    want = calllog.job_state(spark.createDataFrame(every, schema.replace("ts timestamp", "ts timestamp_ntz")))
    rows = lambda df: sorted(map(str, df.select(*sorted(want.columns)).collect()))
    assert rows(out["states"]) == rows(want)
    assert table.clean_up(keep=1) <= 1 and len(list((tmp_path / "jobs" / "data").iterdir())) == 1
    # A last event far ahead: the time of all open jobs is up, and only its own job has state.
    streamed(spark, tmp_path, [[("late", base + dt.timedelta(days=1), 10**6, "running")]], schema, run)
    assert out["query"].lastProgress["stateOperators"][0]["numRowsTotal"] <= 3
    assert {r["job_id"] for r in out["states"].collect()} == {r[0] for r in every} | {"late"}


def test_job_state(spark):
    rows = [("a", AT, 1, "running"), ("a", AT, 2, "complete"), ("b", AT, 1, "pending"), ("b", AT + dt.timedelta(seconds=300), 2, "running"),
            ("c", AT, 1, "running"), ("c", AT + dt.timedelta(seconds=299), 1, "odd"), ("d", AT, 1, "error"), ("d", AT + dt.timedelta(seconds=999), 2, "error")]
    got = {r["job_id"]: (r["state"], r["timed_out"]) for r in calllog.job_state(spark.createDataFrame(rows, "job_id string, ts timestamp_ntz, seq int, status string")).collect()}
    assert got == {"a": ("done", False), "b": ("running", True), "c": ("running", False), "d": ("failed", False)}


def test_export_and_page_files(spark, tmp_path):
    rows = items(spark, [("t", None), ("u", "r")], "title string, ref_no string").withColumns(
        {c: F.lit(None).cast("string") for c in M.LISTING_FIELDS if c not in ("title", "ref_no")}
    )
    export.write_response(rows, str(tmp_path / "out"))
    back = spark.read.schema(", ".join(f"{f} string" for f in M.LISTING_FIELDS)).json(str(tmp_path / "out"))
    assert {r["title"] for r in back.collect()} == {"t", "u"} and back.columns == M.LISTING_FIELDS
    (tmp_path / "p-12.html").write_text("<p>\nx</p>")
    got = P.read_page_files(spark, str(tmp_path / "p-12.html")).head()
    assert got["page_no"] == 12 and got["html"] == "<p>\nx</p>"


def test_envelope_of_a_challenged_source(spark):
    pages = spark.createDataFrame(
        [(1, "a", "u", 1, "<img id=captcha>"), (2, "b", "u", 1, "<p></p>"), (3, "b", "u", 2, "<img id=captcha>")], M.PAGE_SCHEMA
    )
    rows = spark.createDataFrame([("b",), ("b",)], "source string")
    got = {r["source"]: r.asDict() for r in export.response_envelope(rows, pages).collect()}
    assert (got["a"]["success"], got["a"]["count"], got["a"]["error"]) == (False, 0, "CAPTCHA solving failed")
    assert (got["b"]["success"], got["b"]["count"], got["b"]["total_pages"], got["b"]["error"]) == (True, 2, 2, None)


def test_sample_and_search(spark):
    rows = items(spark, [("t" * 100, "o" * 60, "c", "r")] * 5, "title string, organisation string, closing_date string, ref_no string")
    got = search.sample_rows(rows).collect()
    assert len(got) == 3 and len(got[0]["title"]) == 80 and len(got[0]["organisation"]) == 50
    df = spark.createDataFrame([(AT, "o", 5.0), (AT, "p", 5.0), (AT, "o", 50.0)], "published_date timestamp_ntz, organisation string, tender_value double")
    assert search.search_notices(df, published_from="2026-03-01", published_to="2026-03-02", organisation="o", max_value=9.0).count() == 1
    assert search.search_notices(df, published_to="2026-03-01").count() == 0
