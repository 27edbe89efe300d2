"""Queries over crawl results and over merging what was extracted."""

from __future__ import annotations

from pyspark.sql import functions as F

from noticeworks import model as M
from noticeworks.catalog import carriers as K
from noticeworks.catalog.extraction import GOOD, ITEMS
from noticeworks.functions import text as X
from noticeworks.operators import crawljson as J, merge, metrics
from noticeworks.plans import runs
from noticeworks.session import shared_dir
from noticeworks.sources import crawl, snapshots

# The crawled listing computed from the relational tables: both copies of every eighth item.
CRAWLED = f"""
SELECT i.*, copy, CASE WHEN k % 21 = 0 THEN NULL ELSE 'CP-' || k END AS tender_id,
  CASE WHEN k % 42 = 0 THEN '' ELSE title END || CASE WHEN copy = 1 AND k % 42 <> 0 THEN ' again' ELSE '' END AS name
FROM ({ITEMS}) i, (VALUES (0), (1)) c(copy)
WHERE (copy = 0 OR k % 8 = 0) AND page_no % 9 <> 0 AND (k % 42 <> 0)"""


def crawl_scan(spark, sf):
    """Nested crawl results, written as whole JSON documents and read back: their listing rows."""
    path = shared_dir(spark, "crawl")
    records = F.transform("records", lambda r: r.withField("json", J.parsed(r["json"])))
    K.listing_jobs(spark, sf).select("job_id", "status", "total", records.alias("records")).write.json(path)
    return _listing_columns(J.listing_rows(crawl.read_crawl_results(spark, path)))


def _listing_columns(rows):
    return rows.select(
        "source", "ref_no", "title", "organisation", "url", "tender_id", "serial_no", "corrigendum",
        *[X.notice_date(F.col(d)).alias(d) for d in M.DATE_FIELDS],
    )


def json_listing(spark, sf):
    return _listing_columns(J.listing_rows(K.listing_jobs(spark, sf)))


def json_listing_dedup(spark, sf):
    return _listing_columns(J.extract_listing_json(K.listing_jobs(spark, sf)))


def _json_sql(where="true"):
    return f"""
SELECT 'cppp' AS source, coalesce(tender_id, 'UNKNOWN') AS ref_no, name AS title,
  CASE WHEN k % 5 = 0 THEN NULL ELSE replace(org, 'note', '') END AS organisation,
  CASE WHEN k % 7 = 0 THEN NULL ELSE 'https://eprocure.gov.in/cppp/tendersfullview/' || k END AS url,
  tender_id, CAST(k % 10 + 1 AS VARCHAR) AS serial_no, '--' AS corrigendum,
  published_date, closing_date, opening_date
FROM ({CRAWLED}) WHERE {where}"""


def page_completeness(spark, sf):
    return J.page_completeness(K.listing_jobs(spark, sf))


# Rows with neither id nor title still count as extracted objects of their page.
COMPLETENESS_SQL = """
WITH r AS (SELECT o_orderkey // 10 + 1 AS page_no, CASE WHEN o_orderkey % 8 = 0 THEN 2 ELSE 1 END AS n FROM orders),
p AS (SELECT page_no, sum(n) AS n FROM r WHERE page_no % 9 <> 0 GROUP BY page_no),
u AS (SELECT (page_no - 1) // 20 AS job, count(*) AS n FROM (%s) WHERE copy = 0 OR tender_id IS NULL GROUP BY 1),
j AS (SELECT (page_no - 1) // 20 AS job, count(*) AS pages, CAST(sum(n) AS BIGINT) AS extracted_rows,
  max(page_no) AS last_page, max(page_no) * 10 AS claimed_total FROM p GROUP BY 1)
SELECT 'job-' || job AS job_id, pages, extracted_rows, last_page, claimed_total, coalesce(u.n, 0) AS unique_rows,
  greatest(claimed_total - coalesce(u.n, 0), 0) AS gap, claimed_total <= coalesce(u.n, 0) AS complete
FROM j LEFT JOIN u USING (job)""".replace("%s", CRAWLED)


def json_detail(spark, sf):
    values = K.part_details(spark, sf)
    text = K.detail_json_text(M.DETAIL_JSON_FIELDS)
    return values.select("k", K.built("j", J.parsed(text))).select(
        "k", F.inline(F.array(J.detail_json(F.col("j"))))
    )


DETAIL_FIELDS_SQL = """
SELECT p_partkey AS k, 'T-' || p_partkey AS tender_id, p_type AS tender_type,
  CASE WHEN p_partkey % 3 <> 0 THEN 'Works' END AS tender_category,
  CASE WHEN p_partkey % 4 <> 0 THEN 'Item Rate' END AS contract_type,
  CASE WHEN p_partkey % 7 = 0 THEN 'functional testing' WHEN p_partkey % 50 = 1 THEN repeat('x', 601)
       ELSE p_name || ' & fittings' END AS work_description,
  p_brand AS product_category, CASE WHEN p_partkey % 2 <> 0 THEN 'Spare' END AS sub_category,
  n_name AS location, lpad(CAST(p_partkey AS VARCHAR), 6, '1') AS pincode,
  CASE WHEN p_partkey % 9 <> 0 THEN round(p_retailprice * 1000) END AS tender_value,
  CASE WHEN p_partkey % 5 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(p_size * 1000 AS DOUBLE) END AS emd_amount,
  CAST(p_size AS BIGINT) AS period_of_work_days, CASE WHEN p_partkey % 6 <> 0 THEN CAST(1200 AS BIGINT) END AS bid_validity_days,
  CAST(NULL AS VARCHAR) AS pre_bid_meeting_date,
  'Officer ' || p_partkey % 25 AS inviting_authority_name,
  'Block ' || p_partkey % 10 || ', ' || n_name AS inviting_authority_address
FROM part JOIN nation ON p_partkey % 25 = n_nationkey"""


def json_usable(spark, sf):
    """Event properties as JSON objects: whether any field is set, and how many."""
    e = K.table(spark, sf, "events")
    i = F.col("event_id")
    text = (
        F.when(i % 4 == 0, '{"k": null}').when(i % 4 == 1, "{}").when(i % 4 == 2, F.lit(None))
        .otherwise(F.col("props"))
    )
    return e.select("event_id", K.built("j", J.parsed(text))).select(
        "event_id", J.json_usable(F.col("j")).alias("usable"),
        F.coalesce(F.size(J.fields_of(F.col("j"))), F.lit(-1)).alias("n_fields"),
    )


def unknown_fields(spark, sf):
    """Customer rows as JSON: listing fields have columns, everything else is caught in a map."""
    c = K.table(spark, sf, "customer")
    item = F.to_json(
        F.struct(
            F.col("c_name").alias("title"), F.lit("u").alias("url"),
            F.col("c_mktsegment").alias("segment"),
            F.when(F.col("c_custkey") % 3 == 0, F.lit(None)).otherwise(F.col("c_nationkey")).alias("nation"),
        )
    )
    rest = J.unknown_fields(J.json_fields(F.col("j")), M.LISTING_FIELDS)
    return c.select("c_custkey", K.built("j", item)).select(
        "c_custkey", F.to_json(rest).alias("raw_data")
    )


def compact_json(spark, sf):
    o = K.table(spark, sf, "orders")
    named = o.select(
        F.col("o_orderkey").alias("k"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey")).alias("customer"),
    )
    return named.select("k", J.compact_json(["k", "priority", "customer"]).alias("row"))


def payload_roundtrip(spark, sf):
    """Listing rows packed into one array per page and unpacked again."""
    items = K.order_items(spark, sf).select(
        F.lit("run-1").alias("snapshot_id"), "title", "ref_no",
        F.struct(F.lit(1).alias("source_rank"), "page_no", (F.col("k") % 10).cast("int").alias("row_ord")).alias("ingest_ord"),
    )
    chunks = snapshots.payload_chunks(items, ["snapshot_id"], ["title", "ref_no"])
    counted = chunks.withColumn("n", F.size("payload"))
    return snapshots.unpack(counted)


def first_usable_record(spark, sf):
    return J.first_usable(K.detail_jobs(spark, sf)).select("job_id", "route", *M.DETAIL_FIELDS)


def _route_sql(html_date="NULL"):
    # HTML cleans script-like and over-long values and keeps the meeting date.
    return f"""
SELECT *, CASE WHEN k % 6 IN (0, 3) THEN 'json' WHEN k % 6 IN (1, 4) THEN 'html' END AS way FROM ({DETAIL_FIELDS_SQL})"""


USABLE_SQL = f"""
SELECT 'D-' || k AS job_id, way AS route, tender_id, tender_type, tender_category, contract_type,
  CASE WHEN way = 'html' AND (k % 7 = 0 OR k % 50 = 1) THEN NULL ELSE work_description END AS work_description,
  product_category, sub_category, location, pincode, tender_value, emd_amount, period_of_work_days,
  CASE WHEN way = 'html' AND k % 6 <> 0 THEN 1 ELSE bid_validity_days END AS bid_validity_days,
  CASE WHEN way = 'html' AND k % 8 <> 0 THEN '26-Feb-2026 10:00 AM' END AS pre_bid_meeting_date,
  inviting_authority_name, inviting_authority_address
FROM ({_route_sql()}) WHERE way IS NOT NULL"""


def _chain(spark, sf):
    jobs = K.detail_jobs(spark, sf)
    # Every URL is asked for twice; a seventh of the jobs were never submitted.
    parts = K.part_details(spark, sf).select("k", "url")
    sent = parts.where("k % 7 <> 3").select(F.concat(F.lit("D-"), "k").alias("job_id"), "url")
    pages = K.detail_pages(spark, sf).where("k % 3 <> 2 or k % 4 = 0")
    return merge.detail_records(
        parts.unionByName(parts), sent, jobs.select("job_id", "records"), pages, lambda df: runs._written(df, "answers"))


def fallback_chain(spark, sf):
    return _chain(spark, sf).select("url", "route", "tender_id", "tender_value", "bid_validity_days", "pre_bid_meeting_date")


CHAIN_SQL = f"""
WITH f AS ({_route_sql()}),
r AS (SELECT *, CASE WHEN k % 7 <> 3 AND way IS NOT NULL THEN 'job_' || way
    WHEN k % 3 <> 2 OR k % 4 = 0 THEN 'direct' ELSE 'none' END AS route FROM f)
SELECT '/detail/' || k AS url, route, CASE WHEN route <> 'none' THEN tender_id END AS tender_id,
  CASE WHEN route <> 'none' THEN tender_value END AS tender_value,
  CASE WHEN route = 'job_json' THEN bid_validity_days WHEN route <> 'none' AND k % 6 <> 0 THEN 1 END AS bid_validity_days,
  CASE WHEN route IN ('job_html', 'direct') AND k % 8 <> 0 THEN '26-Feb-2026 10:00 AM' END AS pre_bid_meeting_date
FROM r"""


def extractable_urls(spark, sf):
    return metrics.extractable_urls(_chain(spark, sf))


def route_split(spark, sf):
    jobs = K.part_details(spark, sf).select("k", "url")
    sent = jobs.select("url", F.when(F.col("k") % 7 != 3, F.concat(F.lit("D-"), "k")).alias("job_id"))
    return merge.split_routes(jobs.unionByName(jobs), sent)


def url_coverage(spark, sf):
    """Requested document URLs with the labels that exist for some of them."""
    docs = K.table(spark, sf, "documents").select(F.concat(F.lit("/d/"), "doc_id").alias("url"))
    found = K.table(spark, sf, "labels").select(F.concat(F.lit("/d/"), "doc_id").alias("url"), "quality", "toxic")
    return merge.cover_urls(docs.unionByName(docs), found)


def detail_merge(spark, sf):
    """Order items with details for some links: a third of all rows has no link, a third shares one."""
    k = F.col("k")
    items = K.order_items(spark, sf).select(
        k, F.lit("eprocure").alias("source"), "title", "ref_no",
        F.when(k % 3 == 1, "/x/2").when(k % 3 == 2, F.concat(F.lit("/x/"), k)).alias("url"),
        F.when(k % 2 == 0, "old type").alias("tender_type"),
    )
    detail = K.part_details(spark, sf).select(
        F.concat(F.lit("/x/"), k).alias("url"),
        F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, "").otherwise(F.col("tender_type")).alias("tender_type"),
        F.col("location"), F.lit(0).alias("ingest_ord"),
    )
    return merge.merge_detail(items, detail)


DETAIL_MERGE_SQL = f"""
WITH i AS (SELECT *, CASE k % 3 WHEN 1 THEN '/x/2' WHEN 2 THEN '/x/' || k END AS u FROM ({ITEMS})),
d AS (SELECT '/x/' || p_partkey AS u, CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE p_type END AS t, n_name
  FROM part JOIN nation ON p_partkey % 25 = n_nationkey)
SELECT k, 'eprocure' AS source, title, ref_no, i.u AS url,
  coalesce(t, CASE WHEN k % 2 = 0 THEN 'old type' END) AS tender_type, n_name AS location, d.u IS NOT NULL AS detail_merged
FROM i LEFT JOIN d ON i.u = d.u"""


def union_sources(spark, sf):
    """Two sources with different columns, normalised to notice rows."""
    c = K.table(spark, sf, "customer").select(
        F.lit(M.CENTRAL_SOURCE).alias("source"),
        F.when(F.col("c_custkey") % 4 == 0, "  ").otherwise(F.concat(F.lit(" C"), "c_custkey")).alias("ref_no"),
        F.concat(F.lit("  "), "c_name").alias("title"),
        F.when(F.col("c_custkey") % 3 == 0, " ").otherwise(F.col("c_mktsegment")).alias("organisation"),
        F.struct(F.lit(0).alias("source_rank"), F.col("c_custkey").alias("page_no"), F.lit(0).alias("row_ord")).alias("ingest_ord"),
    )
    s = K.table(spark, sf, "supplier").select(
        F.lit(M.PRIMARY_SOURCE).alias("source"), F.concat(F.lit("S"), "s_suppkey").alias("ref_no"),
        F.col("s_name").alias("title"), F.lit("26-Feb-2026 10:00 PM").alias("closing_date"),
        F.lit(" /s ").alias("url"),
        F.when(F.col("s_suppkey") % 2 == 0, F.lit(0.0)).otherwise(F.col("s_acctbal")).alias("tender_value"),
        F.struct(F.lit(1).alias("source_rank"), F.col("s_suppkey").alias("page_no"), F.lit(0).alias("row_ord")).alias("ingest_ord"),
    )
    rows = merge.notice_rows(merge.union_sources(c, s))
    return rows.select(
        "ref_no", "source", "title", "organisation", "url", "closing_date", "is_active",
        "tender_value", "detail_scraped",
    )


UNION_SQL = """
SELECT CASE WHEN c_custkey % 4 = 0 THEN 'UNKNOWN' ELSE 'C' || c_custkey END AS ref_no, 'cppp' AS source,
  c_name AS title, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS organisation, '' AS url,
  CAST(NULL AS TIMESTAMP) AS closing_date, true AS is_active, CAST(NULL AS DOUBLE) AS tender_value,
  false AS detail_scraped FROM customer
UNION ALL
SELECT 'S' || s_suppkey, 'eprocure', s_name, NULL, '/s', TIMESTAMP '2026-02-26 22:00:00', true,
  CASE WHEN s_suppkey % 2 = 0 THEN 0.0 ELSE s_acctbal END, s_suppkey % 2 <> 0 AND s_acctbal <> 0 FROM supplier"""

QUERIES = {
    "crawl_scan": crawl_scan,
    "json_listing": json_listing,
    "json_listing_dedup": json_listing_dedup,
    "page_completeness": page_completeness,
    "json_detail": json_detail,
    "json_usable": json_usable,
    "unknown_fields": unknown_fields,
    "compact_json": compact_json,
    "payload_roundtrip": payload_roundtrip,
    "first_usable_record": first_usable_record,
    "fallback_chain": fallback_chain,
    "extractable_urls": extractable_urls,
    "route_split": route_split,
    "url_coverage": url_coverage,
    "detail_merge": detail_merge,
    "union_sources": union_sources,
}

SQL = {
    "crawl_scan": _json_sql(),
    "json_listing": _json_sql(),
    "json_listing_dedup": _json_sql("copy = 0 OR tender_id IS NULL"),
    "page_completeness": COMPLETENESS_SQL,
    "json_detail": DETAIL_FIELDS_SQL,
    "json_usable": """
SELECT event_id, event_id % 4 = 3 AS usable,
  CAST(CASE event_id % 4 WHEN 2 THEN -1 WHEN 3 THEN 1 ELSE 0 END AS INTEGER) AS n_fields FROM events""",
    "unknown_fields": """
SELECT c_custkey, '{"segment":"' || c_mktsegment || '"' ||
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ',"nation":"' || c_nationkey || '"' END || '}' AS raw_data FROM customer""",
    "compact_json": """
SELECT o_orderkey AS k, '{"k":' || o_orderkey ||
  CASE WHEN o_orderkey % 2 = 0 THEN ',"priority":"' || o_orderpriority || '"' ELSE '' END ||
  CASE WHEN o_orderkey % 3 = 0 THEN ',"customer":' || o_custkey ELSE '' END || '}' AS row FROM orders""",
    "payload_roundtrip": f"""
SELECT 'run-1' AS snapshot_id, page_no AS chunk_no, CAST(count(*) OVER (PARTITION BY page_no) AS INTEGER) AS n,
  title, ref_no FROM ({ITEMS})""",
    "first_usable_record": USABLE_SQL,
    "fallback_chain": CHAIN_SQL,
    "extractable_urls": f"SELECT count(*) FILTER (route <> 'none') AS extractable, count(*) AS total FROM ({CHAIN_SQL})",
    "route_split": """
SELECT '/detail/' || p_partkey AS url, CASE WHEN p_partkey % 7 <> 3 THEN 'job' ELSE 'direct' END AS route FROM part""",
    "url_coverage": """
SELECT DISTINCT '/d/' || d.doc_id AS url, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "detail_merge": DETAIL_MERGE_SQL,
    "union_sources": UNION_SQL,
}
