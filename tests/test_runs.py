import datetime as dt

from pyspark.sql import functions as F

from noticeworks import model as M
from noticeworks.catalog import carriers as K
from noticeworks.operators import detail as D, listing as L, merge
from noticeworks.plans import runs
from noticeworks.sources.snapshots import SnapshotStore
from noticeworks.sources.store import NoticeTable
from noticeworks.streaming import incremental

from conftest import SF_DIR

AT = dt.datetime(2026, 3, 1)


def rows(df):
    return sorted(map(str, df.drop("updated_at").collect()))


def test_stream_equals_batch(spark, tmp_path):
    pages = K.listing_pages(spark, SF_DIR).select("page_id", "source", "url", "page_no", "html")
    pages.where("page_no % 2 = 0").write.parquet(str(tmp_path / "pages"))
    streamed = NoticeTable(spark, str(tmp_path / "streamed"), buckets=4)
    go = lambda: incremental.upsert_new_pages(
        spark, str(tmp_path / "pages"), streamed, str(tmp_path / "checkpoint"), AT, files_per_batch=2
    )
    go()
    first = streamed.read().count()
    pages.where("page_no % 2 = 1").write.mode("append").parquet(str(tmp_path / "pages"))
    go()
    batch = NoticeTable(spark, str(tmp_path / "batch"), buckets=4)
    batch.upsert(merge.notice_rows(L.extract_listing(pages)), AT)
    assert 0 < first < streamed.read().count()
    assert rows(streamed.read()) == rows(batch.read())


def test_scheduled_run_repeats_without_change(spark, tmp_path):
    table = NoticeTable(spark, str(tmp_path / "t"), buckets=4)
    store = SnapshotStore(spark, str(tmp_path / "s"))
    pages, jobs = K.listing_pages(spark, SF_DIR), K.listing_jobs(spark, SF_DIR)
    run = lambda name: runs.scheduled_run(spark, name, AT, jobs, pages, None, table, store, page_cap=50, embed_limit=5).collect()
    counters = run("r1")
    before = rows(table.read())
    assert sorted(map(str, run("r1"))) == sorted(map(str, counters)) and rows(table.read()) == before
    run("r2")
    assert len(rows(table.read())) == len(before)
    assert table.read().where("embedding is not null").count() == 10
    header = store.header("r1").head()
    assert header["total_pages"] == 50 and header["count"] == sum(r["scraped"] for r in counters)


def test_a_run_merges_detail_and_puts_challenge_pages_aside(spark, tmp_path):
    table = NoticeTable(spark, str(tmp_path / "t"), buckets=4)
    store = SnapshotStore(spark, str(tmp_path / "s"))
    row = lambda n: "".join(f"<td>{x}</td>" for x in (
        f"{n}.", "01-Mar-2026", "09-Mar-2026", "10-Mar-2026", f'<a href="http://h/{n}">[Supply of pumps and pipes {n}][REF-{n}][{n}]</a>', "Board"))
    page = lambda n, extra="": (n, "eprocure", f"u{n}", n, f'<table class="list_table"><tr>{row(n)}</tr></table>{extra}')
    pages = spark.createDataFrame(
        [page(1), page(2), page(3), page(4), page(5, "<img id=captcha>"), (6, "cppp", "u6", 1, "<img id=captcha>")], M.PAGE_SCHEMA)
    body = "<table class=tablebg><tr><td class=td_caption>Tender Type</td><td>{}</td></tr></table>"
    rec = lambda js, html=None, status="completed": [("u", status, js, html)]
    jobs = spark.createDataFrame(
        [("J1", "completed", 1, rec('{"tender_type": "json"}')), ("J2", "completed", 1, rec("{}", body.format("html"))),
         ("J3", "completed", 1, rec(None, status="errored")), ("J9", "completed", 1, rec('{"tender_type": "other"}'))], M.CRAWL_JOB_SCHEMA)
    sent = spark.createDataFrame([("J1", "http://h/1"), ("J2", "http://h/2"), ("J3", "http://h/3"), (None, "http://h/4"), ("J9", "http://h/9")], "job_id string, url string")
    direct = spark.createDataFrame([(f"http://h/{n}", body.format("direct")) for n in (1, 2, 3, 5)], "url string, html string")
    run = lambda: runs.scheduled_run(
        spark, "r1", AT, None, pages, runs.DetailSources(sent, jobs, direct), table, store)
    got = {r["source"]: r.asDict() for r in run().collect()}
    assert {r["ref_no"]: r["tender_type"] for r in table.read().collect()} == {"REF-1": "json", "REF-2": "html", "REF-3": "direct", "REF-4": None}
    assert (got["eprocure"]["scraped"], got["eprocure"]["merged"], got["eprocure"]["quarantined"]) == (4, 3, 1)
    assert (got["cppp"]["scraped"], got["cppp"]["quarantined"]) == (0, 1)
    assert {(r["embedded"], r["outcome"]) for r in got.values()} == {(4, "ok")}
    aside = {r["page_id"]: (r["source"], r["page_no"], r["page_url"], r["reason"]) for r in runs.quarantine(spark, store, "r1").collect()}
    assert aside == {5: ("eprocure", 5, "u5", M.CHALLENGE_ERROR), 6: ("cppp", 1, "u6", M.CHALLENGE_ERROR)}
    assert store.header("r1").head()["live_tenders"] == 5
    assert {r["source"]: r.asDict() for r in run().collect()} == got
    # Of the direct pages only that of the one requested URL without an answer is parsed.
    asked = spark.createDataFrame([(f"http://h/{n}",) for n in (1, 2, 3, 4)], "url string")
    answers = spark.createDataFrame([("http://h/1",), ("http://h/2",)], "url string")
    assert [r["url"] for r in merge.unanswered_pages(asked, answers, direct).collect()] == ["http://h/3"]
    parsed = D.extract_detail(merge.unanswered_pages(asked, answers, direct))._jdf.queryExecution().optimizedPlan().toString()
    assert parsed.index("strict_rows(") < parsed.index("LeftSemi")  # the tokenizer stands above the join


def test_a_run_without_notices_fails(spark, tmp_path):
    table, store = NoticeTable(spark, str(tmp_path / "t"), buckets=4), SnapshotStore(spark, str(tmp_path / "s"))
    pages = spark.createDataFrame([(1, "eprocure", "u", 1, "<img id=captcha>")], M.PAGE_SCHEMA)
    got = runs.scheduled_run(spark, "r1", AT, None, pages, None, table, store).collect()
    assert [(r["source"], r["quarantined"], r["embedded"], r["outcome"]) for r in got] == [("eprocure", 1, 0, "failed")]
    assert table.read().count() == 0


def test_live_count_of_nested_tables_and_last_pages(spark):
    row = "<tr><td>{}</td><td>a</td><td>b</td><td><table><tr><td>n</td></tr></table></td><td>c</td></tr>"
    pages = spark.createDataFrame(
        [(1, "a", "u", 1, f"<table>{row.format('99.')}</table>"), (2, "a", "u", 2, f"<table>{row.format('6.')}{row.format('7.')}{row.format('x')}</table>"),
         (3, "b", "u", 1, "<p>nothing</p>"), (4, "c", "u", None, f"<table>{row.format('3')}</table>"), (5, "d", "u", 1, None)], M.PAGE_SCHEMA)
    got = {r["source"]: (r["total_pages"], r["live_tenders"]) for r in L.live_counts(pages).collect()}
    assert got == {"a": (2, 7), "b": (1, None), "c": (None, None), "d": (1, None)}


def test_no_two_crawled_rows_share_their_order(spark):
    from noticeworks.operators import crawljson as J

    rows = J.listing_rows(K.listing_jobs(spark, SF_DIR)).unionByName(
        L.extract_listing(K.listing_pages(spark, SF_DIR)).drop("_"), allowMissingColumns=True)
    assert rows.count() == rows.select("ingest_ord").distinct().count()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_extraction_is_one_narrow_scan(spark, tmp_path):
    K.listing_pages(spark, SF_DIR).write.parquet(str(tmp_path / "p"))
    text = plan(L.extract_listing(spark.read.parquet(str(tmp_path / "p")), page_cap=20))
    assert "Exchange" not in text and text.count("ArrowEvalPython") == 1
    assert "LessThanOrEqual(page_no,20)" in text
    assert "ReadSchema: struct<page_id:bigint,source:string,page_no:bigint,html:string>" in text


def test_no_page_body_is_shuffled(spark):
    from noticeworks.operators import crawljson as J

    jobs = spark.createDataFrame([], M.CRAWL_JOB_SCHEMA)
    text = J.first_usable(jobs)._jdf.queryExecution().optimizedPlan().toString()
    aggregate = text.split("Aggregate [job_id")[1].split("\n")[0]
    assert "html" not in aggregate.replace("ELSE html END", "")


def test_filters_and_columns_reach_the_scan(spark):
    import __spark_entry__ as entry

    text = plan(entry.queries()["search_filter"](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThanOrEqual(o_totalprice,200000.0)" in text
    assert "o_orderstatus" not in text


def test_a_stream_of_many_batches_writes_the_table_once_a_run(spark, tmp_path):
    """Eight files, one batch each: one version; what the batches bring is folded as one upsert after the other."""
    def page(n, text, organisation):
        cells = "".join(f"<td>{x}</td>" for x in ("1.", "01-Mar-2026", "09-Mar-2026", "10-Mar-2026", f"[Supply of pumps and pipes {text}][REF-{n}][{n}]", organisation))
        return [(n, "eprocure", "u", n, f'<html><table class="list_table"><tr>{cells}</tr></table></html>')]

    for i, given in enumerate([(1, "a", "Water Board"), (2, "a", ""), (1, "b", ""), (2, "b", "Roads"), (1, "c", ""), (3, "a", ""), (4, "a", "x"), (5, "a", "y")]):
        spark.createDataFrame(page(*given), M.PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "pages"))
    table = NoticeTable(spark, str(tmp_path / "t"), buckets=2)
    go = lambda: incremental.upsert_new_pages(spark, str(tmp_path / "pages"), table, str(tmp_path / "c"), AT, files_per_batch=1)
    go()
    assert table._versions() == [1]
    got = {r["ref_no"]: (r["title"][-1], r["organisation"]) for r in table.read().collect()}
    assert got == {"REF-1": ("c", "Water Board"), "REF-2": ("b", "Roads"), "REF-3": ("a", None), "REF-4": ("a", "x"), "REF-5": ("a", "y")}
    go()
    assert table._versions() == [1]
    # What a failed run has left is taken by the next one, and a replayed batch is not.
    stream = next(iter(table._load()["streams"]))
    rows = merge.notice_rows(L.extract_listing(spark.createDataFrame(page(9, "z", "Late"), M.PAGE_SCHEMA)))
    table.hold(rows, stream, 3)
    table.hold(rows, stream, 99)
    go()
    assert table._versions() == [1, 2] and table.read().count() == 6 and not list((tmp_path / "t" / "held").iterdir())
