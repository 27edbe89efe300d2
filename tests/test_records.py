import json

from pyspark.sql import functions as F

from noticeworks import model as M
from noticeworks.operators import crawljson as J, merge
from noticeworks.sources import crawl

HTML = "<table class=tablebg><tr><td class=td_caption>Location</td><td>Goa</td></tr></table>"


def jobs(spark, tmp_path, *results):
    path = tmp_path / "jobs.json"
    path.write_text("\n".join(json.dumps(r) for r in results))
    return crawl.read_crawl_results(spark, str(path))


def rec(json_value=None, html=None, status="completed"):
    return {"url": "u", "status": status, "json": json_value, "html": html}


def test_listing_rows_first_wins_over_pages(spark, tmp_path):
    page1 = {"tenders": [{"tender_id": " A ", "title": "first", "detail_path": "/x", "serial_no": 3}, "junk", 4, None, [1],
                         {"tender_id": "", "title": " "}, {"title": "only title"}], "page_number": 1, "total_records": "12"}
    page2 = {"tenders": [{"tender_id": "A", "title": "second"}, {"title": "only title", "organisation": "late"},
                         {"tender_id": "B", "title": "", "closing_date": " ", "detail_path": "http://h"}]}
    df = jobs(spark, tmp_path, {"job_id": "j", "records": [rec(page1), rec(page2), rec(page1, status="errored")]})
    got = {r["title"]: r.asDict() for r in J.extract_listing_json(df).collect()}
    assert set(got) == {"first", "only title", ""}
    assert got["first"]["ref_no"] == "A" and got["first"]["url"] == "https://eprocure.gov.in/x"
    assert got["first"]["serial_no"] == "3"
    assert got["only title"]["ref_no"] == "UNKNOWN" and got["only title"]["organisation"] is None
    assert got[""]["url"] == "http://h" and got[""]["closing_date"] is None
    done = J.page_completeness(df).head().asDict()
    assert done == {"job_id": "j", "pages": 2, "extracted_rows": 6, "last_page": 1, "claimed_total": 12,
                    "unique_rows": 3, "gap": 9, "complete": False}
    few = jobs(spark, tmp_path, {"job_id": "j", "records": [rec(page1 | {"total_records": 2})]}, {"job_id": "n", "records": [rec(page2)]})
    verdicts = {r["job_id"]: (r["unique_rows"], r["gap"], r["complete"]) for r in J.page_completeness(few).collect()}
    assert verdicts == {"j": (2, 0, True), "n": (3, None, None)}


def test_records_are_parsed_once_and_kept_whole(spark, tmp_path):
    page = {"tenders": [{"tender_id": "A", "title": "t", "odd": {"deep": [1, 2]}}], "page_number": 1, "more": "kept"}
    text = json.dumps({"job_id": "j", "records": [rec(page), rec("just text"), rec(None)]})
    (tmp_path / "jobs.json").write_text(text + "\n{broken\n")
    df = crawl.read_crawl_results(spark, str(tmp_path / "jobs.json"))
    rows = {r["job_id"]: r for r in df.select("job_id", "corrupt", F.to_json(F.col("records")[0]["json"]).alias("j")).collect()}
    assert json.loads(rows["j"]["j"]) == page and rows["j"]["corrupt"] is None and rows[None]["corrupt"] == "{broken"
    assert [r["ref_no"] for r in J.listing_rows(df).collect()] == ["A"]
    twice = spark.range(1).select(J.detail_json(J.parsed(F.lit('{"location": "a", "location": "b"}'))).alias("d")).head()["d"]
    assert twice["location"] == "b"
    # The same jobs with their JSON as text: parsed in one place of the plan.
    texts = spark.createDataFrame([("j", "completed", 1, [("u", "completed", json.dumps(page), None)])], M.CRAWL_JOB_SCHEMA)
    listing = J.listing_rows(texts)
    assert [r["ref_no"] for r in listing.collect()] == ["A"]
    for frame in (listing, J.first_usable(texts)):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("parseJson(") == 1


def test_detail_json_types(spark):
    text = json.dumps({"tender_value": "3,86,15,626", "emd_amount": 5, "bid_validity_days": "7", "period_of_work_days": 9.0, "pincode": 411001, "odd": 1})
    got = spark.createDataFrame([(text,)], "j string").select(J.detail_json(J.parsed(F.col("j"))).alias("d")).head()["d"]
    assert (got["tender_value"], got["emd_amount"], got["bid_validity_days"], got["period_of_work_days"], got["pincode"]) == (38615626.0, 5.0, 7, 9, "411001")
    assert got["pre_bid_meeting_date"] is None


def test_first_usable_record(spark, tmp_path):
    fields = {"location": "Pune", "tender_value": None}
    df = jobs(
        spark, tmp_path,
        {"job_id": "json", "records": [rec({"location": None}), rec(fields), rec({"location": "late"})]},
        {"job_id": "html", "records": [rec({}, HTML), rec(fields)]},
        {"job_id": "expired", "records": [rec(None, HTML + "Your Session"), rec(fields)]},
        {"job_id": "failed", "records": [rec(fields, status="errored")]},
        {"job_id": "nothing", "records": [rec({}, "<p></p>")]},
        {"job_id": "unknown", "records": [rec({"odd": 1}, HTML)]},
        {"job_id": "empty"},
    )
    got = {r["job_id"]: (r["route"], r["location"]) for r in J.first_usable(df).collect()}
    assert got == {"json": ("json", "Pune"), "html": ("html", "Goa"), "expired": ("json", "Pune"), "unknown": ("json", None)}


def test_fallback_chain_and_coverage(spark):
    urls = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("d",), (None,)], "url string")
    sent = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "x"), (None, "c")], "job_id string, url string")
    none = ", ".join(f"{f} {M.detail_type(f)}" for f in M.DETAIL_FIELDS)

    def fields(location):
        return tuple(location if f == "location" else None for f in M.DETAIL_FIELDS)

    won = spark.createDataFrame([("1", "json", *fields("J")), ("3", "json", *fields("X"))], f"job_id string, route string, {none}")
    direct = spark.createDataFrame([("a", *fields("D")), ("b", *fields("D")), ("d", *fields(None))], f"url string, {none}")
    got = {r["url"]: (r["route"], r["location"]) for r in merge.fallback_chain(urls, sent, won, direct).collect()}
    assert got == {"a": ("job_json", "J"), "b": ("direct", "D"), "c": ("none", None), "d": ("none", None)}
    routes = {r["url"]: r["route"] for r in merge.split_routes(urls, sent).collect()}
    assert routes == {"a": "job", "b": "job", "c": "direct", "d": "direct"}
    covered = merge.cover_urls(urls, direct.select("url", "location"))
    assert {r["url"]: r["location"] for r in covered.collect()} == {"a": "D", "b": "D", "c": None, "d": None}


def test_maps_and_compact_json(spark):
    df = spark.createDataFrame([('{"title": "t", "a": 1, "b": null}', "x", None)], "j string, p string, q string")
    rest = J.unknown_fields(J.json_fields(F.col("j")), M.LISTING_FIELDS)
    got = df.select(rest.alias("r"), J.compact_json(["p", "q"]).alias("c"), J.packed_fields(["p", "q"]).alias("m")).head()
    assert df.select(J.fields_of(J.parsed(F.col("j")))).head()[0] == {"title": "t", "a": "1"}
    assert got["r"] == {"a": "1"} and got["c"] == '{"p":"x"}' and got["m"] == {"p": "x", "q": None}
    usable = spark.createDataFrame([("{}",), ('{"a": null}',), ('{"a": 1}',), (None,), ("not json",)], "j string")
    assert [r[0] for r in usable.select(J.json_usable(J.parsed(F.col("j")))).collect()] == [False, False, True, False, False]
