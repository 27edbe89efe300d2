"""Queries over notice upkeep: dedup, upsert, snapshots, backfill, metrics, streaming, whole runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from noticeworks import model as M
from noticeworks.catalog import carriers as K
from noticeworks.catalog.extraction import GOOD, ITEMS, challenged
from noticeworks.catalog.records import CHAIN_SQL, CRAWLED
from noticeworks.operators import (
    backfill, calllog, dedup, listing as L, merge, metrics, search, vectors,
)
from noticeworks.plans import runs
from noticeworks.session import shared_dir
from noticeworks.sources import clustered, snapshots
from noticeworks.sources.store import JobTable, NoticeTable
from noticeworks.streaming import incremental, logs

RUN_AT = dt.datetime(2026, 3, 1, 6, 0)


def _beside(rows, *one_row):
    """Columns of one-row frames added to every row, as scalar subqueries."""
    for n, frame in enumerate(one_row):
        name = f"_one{n}"
        value = frame.select(F.struct("*")).scalar()
        rows = rows.withColumn(name, value).select(*rows.columns, f"{name}.*")
    return rows


# --- Dedup ---------------------------------------------------------------------------------


def dedup_first(spark, sf):
    """First document of every exact text."""
    d = K.table(spark, sf, "documents").select(
        F.sha2("text", 256).alias("text_key"), "doc_id", "lang", "n_chars"
    )
    return dedup.first_wins(d, ["text_key"], "doc_id", F.count("*").alias("copies"), unique=True).drop("text_key")


def dedup_last(spark, sf):
    """Last line of every order, by line number, part and supplier."""
    lines = K.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        # No two lines of an order agree in all four; together they are too wide for one number.
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("o"),
    )
    return dedup.last_wins(lines, ["l_orderkey"], "o").drop("o")


# --- Upsert --------------------------------------------------------------------------------


def _halves(spark, sf):
    """Orders as stored rows (keys 0-6 of ten) and as incoming rows (4-9), some values null."""
    n = K.order_notices(spark, sf)
    i = F.col("id")
    base = n.select(
        "ref_no", "source", "title", F.concat(F.lit("/u/"), "id").alias("url"),
        "published_date", F.lit(True).alias("is_active"), "tender_value",
        F.coalesce("detail_scraped", F.lit(False)).alias("detail_scraped"),
        F.create_map(F.lit("run"), F.lit("old")).alias("raw_data"), "id",
    )
    old = base.where(i % 10 < 7).drop("id")
    new = base.where(i % 10 >= 4).select(
        "ref_no", "source",
        F.concat("title", F.lit(" v2")).alias("title"),
        F.when(i % 5 == 0, "").otherwise(F.col("url")).alias("url"),
        F.when(i % 2 == 0, F.col("published_date")).alias("published_date"),
        "is_active",
        F.when(i % 3 != 0, F.col("tender_value") + 1).alias("tender_value"),
        F.lit(False).alias("detail_scraped"),
        F.create_map(F.lit("run"), F.lit("new")).alias("raw_data"),
    )
    return old, new


def _flat(rows):
    return rows.select(
        "ref_no", "source", "title", "url", "published_date", "is_active", "tender_value",
        "detail_scraped", F.col("raw_data")["run"].alias("run"),
    )


def upsert_merge(spark, sf):
    return _flat(merge.merge_notices(*_halves(spark, sf)))


UPSERT_SQL = """
WITH b AS (SELECT o_orderkey AS k, 'REF-' || o_orderkey AS ref_no,
    CASE WHEN o_orderkey % 3 = 0 THEN 'cppp' ELSE 'eprocure' END AS source,
    'Order ' || o_orderkey || ' ' || o_orderpriority AS title, '/u/' || o_orderkey AS url,
    o_orderdate, o_totalprice, coalesce(o_orderstatus = 'F', false) AS f FROM orders),
o AS (SELECT * FROM b WHERE k % 10 < 7), n AS (SELECT * FROM b WHERE k % 10 >= 4)
SELECT coalesce(n.ref_no, o.ref_no) AS ref_no, coalesce(n.source, o.source) AS source,
  CASE WHEN n.k IS NULL THEN o.title ELSE n.title || ' v2' END AS title,
  CASE WHEN n.k IS NULL THEN o.url WHEN n.k % 5 = 0 THEN '' ELSE n.url END AS url,
  coalesce(CASE WHEN n.k % 2 = 0 THEN n.o_orderdate END, o.o_orderdate) AS published_date, true AS is_active,
  coalesce(CASE WHEN n.k % 3 <> 0 THEN n.o_totalprice + 1 END, o.o_totalprice) AS tender_value,
  CASE WHEN n.k IS NULL THEN o.f ELSE false END AS detail_scraped,
  CASE WHEN n.k IS NULL THEN 'old' ELSE 'new' END AS run
FROM o FULL OUTER JOIN n ON o.k = n.k"""


def upsert_table(spark, sf):
    """The same upsert through the stored table, the second batch sent twice."""
    old, new = _halves(spark, sf)
    store = NoticeTable(spark, shared_dir(spark, "notices"), buckets=8)
    store.upsert(old.withColumn("ingest_ord", F.lit(0)), RUN_AT)
    for _ in range(2):
        store.upsert(new.withColumn("ingest_ord", F.lit(0)), RUN_AT)
    return _flat(store.read())


def embedding_writeback(spark, sf):
    """Stored notices with vectors; then new ones for every third key, some of them null, are written back."""
    n = K.order_notices(spark, sf)
    store = _stored_notices(spark, n)
    store.set_embeddings(n.where("id % 3 = 0").select(
        "ref_no", "source",
        F.when(F.col("id") % 5 != 0, F.array(F.lit(2.0).cast("float"))).alias("embedding"),
    ))
    number = F.regexp_extract("ref_no", r"(\d+)", 1).cast("bigint")
    return store.read().select(number.alias("id"), F.get("embedding", F.lit(0)).cast("double").alias("v0"))


def _stored_notices(spark, n):
    """Order notices in a stored table, those with a vector with it."""
    store = NoticeTable(spark, shared_dir(spark, "notices"), buckets=8)
    rows = n.select(
        "ref_no", "source", "title", "organisation", F.lit("/o").alias("url"), "published_date", "tender_value",
        F.lit(True).alias("is_active"), "detail_scraped", F.lit(0).alias("ingest_ord"))
    store.upsert(rows, RUN_AT)
    store.set_embeddings(n.select("ref_no", "source", "embedding"))
    return store


def status_stored(spark, sf):
    """The status of a stored table, from the counts that its commits keep."""
    return _stored_notices(spark, K.order_notices(spark, sf)).status()


def pending_stored(spark, sf):
    """The pending notices of a stored table: only the keys of the vectors are read."""
    store = _stored_notices(spark, K.order_notices(spark, sf))
    number = F.regexp_extract("ref_no", r"(\d+)", 1).cast("bigint")
    return vectors.pending(store.pending().withColumn("id", number)).select("id", "detail_scraped")


# --- Snapshots -----------------------------------------------------------------------------


def _monthly(spark, sf):
    """Orders as snapshot items: one run per month."""
    o = K.table(spark, sf, "orders")
    month = F.date_trunc("month", F.col("o_orderdate").cast("timestamp")).cast("timestamp_ntz")
    return o.select(
        F.date_format("o_orderdate", "yyyy-MM").alias("snapshot_id"), F.lit("orders").alias("source"),
        month.alias("scraped_at"), F.lit(None).cast("int").alias("live_tenders"), "o_orderkey",
    )


def snapshot_history(spark, sf):
    return snapshots.history(snapshots.run_header(_monthly(spark, sf)))


def snapshot_latest(spark, sf):
    return snapshots.latest_header(snapshots.run_header(_monthly(spark, sf)))


HEADER_SQL = """
SELECT strftime(o_orderdate, '%Y-%m') AS snapshot_id, 'orders' AS source,
  CAST(date_trunc('month', max(o_orderdate)) AS TIMESTAMP) AS scraped_at, CAST(NULL AS INTEGER) AS live_tenders,
  count(*) AS count FROM orders GROUP BY 1"""


def snapshot_append(spark, sf):
    """Two runs stored, the second written twice; the newest one is read back."""
    items = K.order_notices(spark, sf).select("ref_no", "title", "id")
    store = snapshots.SnapshotStore(spark, shared_dir(spark, "snapshots"))
    store.append(items.where("id % 2 = 0"), "r1", RUN_AT, "s")
    for _ in range(2):
        store.append(items, "r2", RUN_AT + dt.timedelta(days=1), "s")
    return _beside(
        store.latest_items().select("ref_no", "title"),
        store.latest().select("id", "snapshot_id", "count"),
    )


def latest_payload(spark, sf):
    """Items of the one latest snapshot, unpacked from its payload arrays (one per page)."""
    items = K.order_items(spark, sf).select(
        F.when(F.col("k") % 2 == 0, "r1").otherwise("r2").alias("snapshot_id"), "title", "ref_no",
        F.struct(F.lit(1).alias("source_rank"), "page_no", (F.col("k") % 10).cast("int").alias("row_ord")).alias("ingest_ord"),
    )
    chunks = snapshots.payload_chunks(items, ["snapshot_id"], ["title", "ref_no"])
    last = chunks.agg(F.max("snapshot_id")).scalar()
    return snapshots.unpack(chunks.where(F.col("snapshot_id") == last)).drop("chunk_no")


def snapshot_diff(spark, sf):
    """Two snapshots of customers: some gone, some new, some with another segment or balance."""
    c = K.table(spark, sf, "customer")
    k = F.col("c_custkey")
    before = c.where(k % 10 != 0).select("c_custkey", "c_mktsegment", F.when(k % 4 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("c_acctbal"))
    after = c.where(k % 10 != 1).select(
        "c_custkey", F.when(k % 7 == 0, "OTHER").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(k % 8 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
    )
    d = snapshots.diff(before, after, ["c_custkey"], ["c_mktsegment", "c_acctbal"])
    return d.select("c_custkey", "change", F.col("before.c_mktsegment").alias("old_segment"), F.col("after.c_mktsegment").alias("new_segment"))


DIFF_SQL = """
WITH b AS (SELECT c_custkey, c_mktsegment AS s, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS a FROM customer WHERE c_custkey % 10 <> 0),
n AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'OTHER' ELSE c_mktsegment END AS s,
  CASE WHEN c_custkey % 8 <> 0 THEN c_acctbal END AS a FROM customer WHERE c_custkey % 10 <> 1)
SELECT coalesce(b.c_custkey, n.c_custkey) AS c_custkey,
  CASE WHEN b.c_custkey IS NULL THEN 'new' WHEN n.c_custkey IS NULL THEN 'gone' ELSE 'changed' END AS change,
  b.s AS old_segment, n.s AS new_segment
FROM b FULL OUTER JOIN n ON b.c_custkey = n.c_custkey
WHERE b.c_custkey IS NULL OR n.c_custkey IS NULL OR b.s IS DISTINCT FROM n.s OR b.a IS DISTINCT FROM n.a"""


# --- Backfill ------------------------------------------------------------------------------


def _payload(spark, sf):
    """Lineitems as payload items: one reference per order, many duplicates, some blank fields."""
    li = K.table(spark, sf, "lineitem")
    o = F.col("l_orderkey")
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return li.select(
        F.when(o % 9 == 0, "  ").otherwise(F.concat(F.lit("REF-"), o)).alias("ref_no"),
        F.when(F.col("l_linenumber") == 2, " ").otherwise(F.concat(F.lit("Part "), "l_partkey")).alias("title"),
        F.when(F.col("l_suppkey") % 10 == 3, F.lit(None)).otherwise(F.concat(F.lit("/s/"), "l_suppkey")).alias("url"),
        F.col("l_returnflag").alias("organisation"),
        K.text_date(F.col("l_shipdate"), "dd-MMM-yyyy").alias("closing_date"),
        F.lit("").alias("opening_date"), F.lit(None).cast("string").alias("published_date"),
        F.create_map(F.lit("url"), F.lit("x"), F.lit("line"), F.col("l_linenumber").cast("string")).alias("fields"),
        F.struct(o.alias("o"), order.alias("r")).alias("ingest_ord"),
    )


def _stored_keys(spark, sf):
    return K.table(spark, sf, "orders").where("o_orderkey % 4 = 1").select(
        F.concat(F.lit("REF-"), "o_orderkey").alias("ref_no")
    )


def backfill_insert(spark, sf):
    rows = backfill.backfill_inserts(_payload(spark, sf), _stored_keys(spark, sf))
    return rows.select(
        "ref_no", "source", "title", "organisation", "url", "closing_date", "opening_date",
        "detail_scraped", "is_active", F.to_json("raw_data").alias("raw_data"),
    )


def backfill_counters(spark, sf):
    return backfill.backfill_counters(_payload(spark, sf), _stored_keys(spark, sf))


def new_keys(spark, sf):
    items = _payload(spark, sf).select("ref_no", F.col("ingest_ord.r.l_linenumber").alias("line"))
    return merge.new_keys(items, _stored_keys(spark, sf))


def existing_keys(spark, sf):
    return _payload(spark, sf).select("ref_no").distinct()


PAYLOAD_SQL = """
SELECT *, CASE WHEN l_orderkey % 9 = 0 THEN 'UNKNOWN' ELSE 'REF-' || l_orderkey END AS ref_no,
  CASE WHEN l_linenumber = 2 OR l_suppkey % 10 = 3 THEN 'bad'
       WHEN l_orderkey % 9 <> 0 AND l_orderkey % 4 = 1 AND l_orderkey IN (SELECT o_orderkey FROM orders) THEN 'existing' END AS reason
FROM lineitem"""


# --- Scans and metrics ---------------------------------------------------------------------


def tender_scan(spark, sf):
    return search.scan_notices(
        K.order_notices(spark, sf), ["id", "ref_no", "title", "organisation"],
        null_column="embedding", equals={"detail_scraped": True}, limit=M.EMBED_BATCH,
    )


def status_metrics(spark, sf):
    return metrics.status_metrics(K.order_notices(spark, sf))


def last_updated(spark, sf):
    return metrics.last_updated(K.order_notices(spark, sf))


def search_filter(spark, sf):
    n = K.order_notices(spark, sf)
    return search.search_notices(
        n, published_from="1996-01-01", published_to="1997-01-01", min_value=50000.0, max_value=200000.0
    ).select("id", "title", "organisation", "tender_value")


def search_stored(spark, sf):
    """A range, an organisation and a value range over the search copy of all notices."""
    path = shared_dir(spark, "search")
    clustered.write_search_copy(K.order_notices(spark, sf), path)
    return clustered.search_copy(
        spark, path, published_from="1994-06-15", published_to="1997-01-10", organisation="Customer 29", min_value=1000.0,
    ).select("id", "source", "title", "organisation", "published_date", "tender_value")


def pending_select(spark, sf):
    return vectors.pending(K.order_notices(spark, sf)).select("id", "detail_scraped")


def pending_fallback(spark, sf):
    """No detailed notice is pending here, so others are chosen."""
    n = K.order_notices(spark, sf).where("detail_scraped is null or not detail_scraped")
    return vectors.pending(n).select("id", "detail_scraped")


def run_counters(spark, sf):
    k = F.col("k")
    items = K.order_items(spark, sf).select(
        F.when(k % 3 == 0, "cppp").otherwise("eprocure").alias("source"),
        F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("R"), (k / 2).cast("bigint"))).alias("ref_no"),
        F.when(k % 7 != 0, F.concat(F.lit("/x/"), k)).alias("url"),
        ((k % 7 != 0) & (k % 2 == 0)).alias("detail_merged"),
    )
    return metrics.run_counters(items)


COUNTERS_SQL = """
WITH i AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'cppp' ELSE 'eprocure' END AS source,
  CASE WHEN o_orderkey % 5 = 0 THEN 'UNKNOWN' ELSE 'R' || o_orderkey // 2 END AS ref_no, o_orderkey AS k FROM orders)
SELECT source, count(*) AS scraped, count(*) FILTER (k % 7 <> 0) AS with_url,
  count(*) FILTER (k % 7 <> 0 AND k % 2 = 0) AS merged, count(DISTINCT ref_no) AS upserted,
  greatest(count(*) FILTER (ref_no = 'UNKNOWN') - 1, 0) AS lost_to_missing_key
FROM i GROUP BY source"""


# --- Logs ----------------------------------------------------------------------------------


def _calls(events):
    """Events as calls of few clients, of whom one makes a third of all."""
    return events.select(
        "event_id", F.when(F.col("user_id") % 3 == 0, "hot").otherwise(F.col("event_type")).alias("key"), "ts"
    )


def call_budget(spark, sf):
    """At most six calls of a client within an hour."""
    return calllog.call_budget(_calls(K.table(spark, sf, "events")), window_seconds=3600)


def call_budget_stream(spark, sf):
    """The same from a stream of the events; a heartbeat a day later closes its last windows."""
    base = shared_dir(spark, "calls")
    calls = _calls(K.table(spark, sf, "events"))
    calls.write.parquet(f"{base}/in")
    calls.agg((F.max("ts") + F.expr("interval 1 day")).alias("ts")).select(
        F.lit(None).cast(calls.schema["event_id"].dataType).alias("event_id"), F.lit("heartbeat").alias("key"), "ts"
    ).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(calls.schema).parquet(f"{base}/in")
    query = logs.call_budget_stream(stream, window_seconds=3600, late="1 hour").writeStream.trigger(availableNow=True).option(
        "checkpointLocation", f"{base}/checkpoint").format("parquet").start(f"{base}/out")
    query.awaitTermination()
    return spark.read.parquet(f"{base}/out")


BUDGET_SQL = """
SELECT event_id, key, ts, CAST(count(*) OVER w AS BIGINT) AS calls_in_window, count(*) OVER w > 6 AS over_budget
FROM (SELECT event_id, ts, CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE event_type END AS key FROM events)
WINDOW w AS (PARTITION BY key ORDER BY ts RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW)"""

_STATUS = "CASE event_type WHEN 'view' THEN 'running' WHEN 'click' THEN 'pending' WHEN 'error' THEN 'error' WHEN 'signup' THEN 'completed' ELSE 'complete' END"


def _polls(events):
    return events.select(
        F.concat(F.lit("J"), F.expr("event_id div 5")).alias("job_id"), "ts",
        F.col("event_id").alias("seq"), F.expr(_STATUS).alias("status"),
    )


def job_state(spark, sf):
    return calllog.job_state(_polls(K.table(spark, sf, "events")))


def job_state_stream(spark, sf):
    """The same states from a stream over the stored events."""
    schema = K.table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf}/events*.parquet")
    base = shared_dir(spark, "jobs")
    return logs.job_states(spark, _polls(events), JobTable(spark, f"{base}/out", buckets=8), f"{base}/checkpoint")[1]


JOB_SQL = f"""
WITH p AS (SELECT 'J' || event_id // 5 AS job_id, ts, event_id AS seq, {_STATUS} AS status FROM events),
g AS (SELECT job_id, arg_max(status, seq) AS status, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS polls FROM p GROUP BY job_id)
SELECT *, CASE WHEN status IN ('completed', 'complete') THEN 'done' WHEN status = 'error' THEN 'failed' ELSE 'running' END AS state,
  status IN ('running', 'pending') AND last_ts - first_ts >= INTERVAL 300 SECOND AS timed_out FROM g"""


def fetch_outcomes(spark, sf):
    codes = F.array(*[F.lit(c) for c in (200, 404, 429, 500, 503, 301, 400)])
    e = K.table(spark, sf, "events").select(
        "event_id", F.get(codes, (F.col("event_id") % 7).cast("int")).alias("http_status")
    )
    return calllog.fetch_outcomes(e)


OUTCOME_SQL = """
SELECT event_id, http_status,
  CASE WHEN http_status = 200 THEN 'ok' WHEN http_status IN (429, 500, 503) THEN 'retryable' ELSE 'permanent' END AS submit_outcome,
  CASE WHEN http_status = 200 THEN 'ok' WHEN http_status = 404 THEN 'gone' ELSE 'retryable' END AS poll_outcome
FROM (SELECT event_id, CAST([200, 404, 429, 500, 503, 301, 400][event_id % 7 + 1] AS INTEGER) AS http_status FROM events)"""


# --- Streaming and whole runs --------------------------------------------------------------


def incremental_upsert(spark, sf):
    """Listing pages arriving as files, upserted by a stream that is started twice."""
    base = shared_dir(spark, "stream")
    K.listing_pages(spark, sf).select(
        "page_id", "source", "url", "page_no", "html"
    ).write.parquet(f"{base}/pages")
    store = NoticeTable(spark, f"{base}/table", buckets=8)
    for _ in range(2):
        incremental.upsert_new_pages(
            spark, f"{base}/pages", store, f"{base}/checkpoint", RUN_AT, files_per_batch=4
        )
    return store.read().select("ref_no", "source", "title", "url", "published_date", "detail_scraped")


INCREMENTAL_SQL = f"""
SELECT ref_no, 'eprocure' AS source, title, coalesce(url, '') AS url, published_date, false AS detail_scraped
FROM ({ITEMS}) WHERE {GOOD}"""


def _whole_run(spark, sf, times=1):
    """Crawled jobs, scraped pages (every sixth a challenge page), detail jobs and direct detail pages:
    collect, fetch detail, snapshot, upsert, embed, counters."""
    base = shared_dir(spark, "run")
    store = NoticeTable(spark, f"{base}/table", buckets=8)
    kept = snapshots.SnapshotStore(spark, f"{base}/snapshots")
    link = F.concat(F.lit("https://eprocure.gov.in/eprocure/app?id="), "k", F.lit("&s=1")).alias("url")
    # A seventh of the jobs were never submitted, and some pages were never stored.
    detail = runs.DetailSources(
        K.part_details(spark, sf).where("k % 7 <> 3").select(F.concat(F.lit("D-"), "k").alias("job_id"), link),
        K.detail_jobs(spark, sf).select("job_id", "records"),
        K.detail_pages(spark, sf).where("k % 3 <> 2 or k % 4 = 0").select(link, "html"),
    )
    for _ in range(times):
        counters = runs.scheduled_run(
            spark, "r1", RUN_AT, K.listing_jobs(spark, sf), challenged(spark, sf), detail, store, kept)
    return counters, store, kept


def run_notices(spark, sf):
    """The notices that a whole run stores, with their merged detail."""
    _, store, _ = _whole_run(spark, sf)
    return store.notices().select(
        "ref_no", "source", "title", "tender_id", "tender_type", "tender_value", "bid_validity_days", "detail_scraped",
        F.col("raw_data")["pre_bid_meeting_date"].alias("pre_bid_meeting_date"))


def scheduled_run(spark, sf):
    """The counters of a whole run that is sent twice, with the state it leaves."""
    counters, store, kept = _whole_run(spark, sf, times=2)
    state = runs.status(store).drop("last_updated_at", "cloudflare_enabled")
    live = kept.latest().select("live_tenders", F.col("count").alias("snapshot_count"))
    return _beside(counters, state, live)


# Each part's best detail record; the run asks for it by the link of the order with the same key.
_DETAIL = CHAIN_SQL.replace("'/detail/' || k AS url", "k, tender_type")
RUN_NOTICES_SQL = f"""
WITH f AS (SELECT * FROM ({_DETAIL}) WHERE route <> 'none'),
e AS (SELECT i.ref_no, 'eprocure' AS source, i.title, f.tender_id, f.tender_type, f.tender_value, f.bid_validity_days,
    f.k IS NOT NULL AS detail_scraped, f.pre_bid_meeting_date
  FROM ({ITEMS}) i LEFT JOIN f ON i.k = f.k AND i.k % 7 <> 0 AND i.k % 11 <> 0
  WHERE page_no % 6 <> 0 AND {GOOD.replace("k %", "i.k %")}),
c AS (SELECT coalesce(tender_id, 'UNKNOWN') AS ref_no, name, tender_id FROM ({CRAWLED}) WHERE copy = 0 OR tender_id IS NULL
  QUALIFY row_number() OVER (PARTITION BY tender_id ORDER BY 'job-' || (page_no - 1) // 20 DESC, page_no DESC, k DESC, copy DESC) = 1)
SELECT * FROM e UNION ALL SELECT ref_no, 'cppp', name, tender_id, NULL, NULL, NULL, false, NULL FROM c"""

RUN_SQL = f"""
WITH c AS (SELECT 'cppp' AS source, coalesce(tender_id, 'UNKNOWN') AS ref_no, k % 7 <> 0 AS has_url, false AS det
    FROM ({CRAWLED}) WHERE copy = 0 OR tender_id IS NULL),
e AS (SELECT 'eprocure' AS source, ref_no, url IS NOT NULL AS has_url,
    k % 7 <> 0 AND k % 11 <> 0 AND k IN (SELECT k FROM ({_DETAIL}) WHERE route <> 'none') AS det
  FROM ({ITEMS}) WHERE {GOOD} AND page_no % 6 <> 0),
a AS (SELECT * FROM c UNION ALL SELECT * FROM e),
s AS (SELECT source, count(*) AS scraped, count(*) FILTER (has_url) AS with_url, count(*) FILTER (det) AS merged,
  count(DISTINCT ref_no) AS upserted, greatest(count(*) FILTER (ref_no = 'UNKNOWN') - 1, 0) AS lost_to_missing_key
  FROM a GROUP BY source),
n AS (SELECT source, ref_no, bool_or(det) AS det FROM a GROUP BY source, ref_no)
SELECT s.*, CASE WHEN source = 'cppp' THEN 0 ELSE (SELECT count(DISTINCT o_orderkey // 10 + 1) FROM orders
    WHERE (o_orderkey // 10 + 1) % 6 = 0) END AS quarantined, (SELECT count(*) FROM n) AS embedded, 'ok' AS outcome,
  (SELECT count(*) FROM n) AS tender_count, (SELECT count(*) FILTER (det) FROM n) AS detail_scraped_count,
  (SELECT count(*) FILTER (NOT det) FROM n) AS pending_detail_count, CAST(0 AS BIGINT) AS embedding_pending_count,
  CAST((SELECT max(o_orderkey) + 1 FROM orders) AS INTEGER) AS live_tenders, (SELECT count(*) FROM a) AS snapshot_count
FROM s"""


def listing_run(spark, sf):
    kept = snapshots.SnapshotStore(spark, shared_dir(spark, "listing"))
    _, envelope = runs.listing_run("l1", RUN_AT, K.listing_pages(spark, sf), kept)
    return envelope


LISTING_RUN_SQL = f"""
WITH i AS (SELECT * FROM ({ITEMS}))
SELECT 'eprocure.gov.in/AdvancedSearch' AS source, (SELECT count(*) FROM i WHERE {GOOD}) AS count,
  (SELECT max(page_no) FROM i) AS total_pages,
  CAST((SELECT CASE WHEN k % 23 = 0 THEN 1 ELSE k + 1 END FROM i WHERE page_no = (SELECT max(page_no) FROM i)
    AND k % 17 <> 0 ORDER BY k DESC LIMIT 1) AS INTEGER) AS live_tenders"""


def backfill_run(spark, sf):
    store = NoticeTable(spark, shared_dir(spark, "backfill"), buckets=8)
    old = K.order_notices(spark, sf).where("id % 4 = 1").select(
        "ref_no", F.lit("cppp").alias("source"), "title", F.lit("/o").alias("url"),
        F.lit(0).alias("ingest_ord"),
    )
    store.upsert(old, RUN_AT)
    counters = runs.backfill_run(_payload(spark, sf), store, RUN_AT)
    return _beside(counters, store.read().agg(F.count("*").alias("stored")))


QUERIES = {
    "dedup_first": dedup_first,
    "dedup_last": dedup_last,
    "upsert_merge": upsert_merge,
    "upsert_table": upsert_table,
    "embedding_writeback": embedding_writeback,
    "snapshot_append": snapshot_append,
    "snapshot_latest": snapshot_latest,
    "snapshot_history": snapshot_history,
    "latest_payload": latest_payload,
    "snapshot_diff": snapshot_diff,
    "backfill_insert": backfill_insert,
    "backfill_counters": backfill_counters,
    "backfill_run": backfill_run,
    "new_keys": new_keys,
    "existing_keys": existing_keys,
    "tender_scan": tender_scan,
    "status_metrics": status_metrics,
    "status_stored": status_stored,
    "pending_stored": pending_stored,
    "last_updated": last_updated,
    "search_filter": search_filter,
    "search_stored": search_stored,
    "pending_select": pending_select,
    "pending_fallback": pending_fallback,
    "run_counters": run_counters,
    "call_budget": call_budget,
    "call_budget_stream": call_budget_stream,
    "job_state": job_state,
    "job_state_stream": job_state_stream,
    "fetch_outcomes": fetch_outcomes,
    "incremental_upsert": incremental_upsert,
    "listing_run": listing_run,
    "scheduled_run": scheduled_run,
    "run_notices": run_notices,
}

SQL = {
    "dedup_first": """
SELECT min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, arg_min(n_chars, doc_id) AS n_chars, count(*) AS copies
FROM documents GROUP BY text""",
    "dedup_last": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS r FROM lineitem) WHERE r = 1""",
    "upsert_merge": UPSERT_SQL,
    "upsert_table": UPSERT_SQL,
    "embedding_writeback": """
SELECT o_orderkey AS id, CAST(CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0 THEN 2 WHEN o_orderkey % 4 <> 0 THEN 1 END AS DOUBLE) AS v0
FROM orders""",
    "snapshot_append": """
SELECT 'REF-' || o_orderkey AS ref_no, 'Order ' || o_orderkey || ' ' || o_orderpriority AS title,
  CAST(1 AS INTEGER) AS id, 'r2' AS snapshot_id, (SELECT count(*) FROM orders) AS count FROM orders""",
    "snapshot_latest": f"SELECT CAST(1 AS INTEGER) AS id, *, scraped_at AS updated_at FROM ({HEADER_SQL}) ORDER BY scraped_at DESC LIMIT 1",
    "snapshot_history": f"SELECT * FROM ({HEADER_SQL}) ORDER BY scraped_at DESC LIMIT 10",
    "latest_payload": f"SELECT 'r2' AS snapshot_id, title, ref_no FROM ({ITEMS}) WHERE k % 2 = 1",
    "snapshot_diff": DIFF_SQL,
    "backfill_insert": f"""
SELECT ref_no, 'eprocure' AS source, 'Part ' || l_partkey AS title, l_returnflag AS organisation, '/s/' || l_suppkey AS url,
  l_shipdate AS closing_date, CAST(NULL AS TIMESTAMP) AS opening_date, false AS detail_scraped, true AS is_active,
  '{{"line":"' || l_linenumber || '"}}' AS raw_data
FROM (SELECT *, row_number() OVER (PARTITION BY ref_no ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC,
  l_suppkey DESC, l_quantity DESC) AS r FROM ({PAYLOAD_SQL}) WHERE reason IS NULL) WHERE r = 1""",
    "backfill_counters": f"""
SELECT count(*) AS total, count(*) FILTER (reason = 'bad') AS skipped_bad, count(*) FILTER (reason = 'existing') AS skipped_existing,
  count(*) FILTER (reason IS NULL) - count(DISTINCT ref_no) FILTER (reason IS NULL) AS skipped_duplicate,
  count(DISTINCT ref_no) FILTER (reason IS NULL) AS inserted FROM ({PAYLOAD_SQL})""",
    "backfill_run": f"""
SELECT count(*) AS total, count(*) FILTER (reason = 'bad') AS skipped_bad, count(*) FILTER (reason = 'existing') AS skipped_existing,
  count(*) FILTER (reason IS NULL) - count(DISTINCT ref_no) FILTER (reason IS NULL) AS skipped_duplicate,
  count(DISTINCT ref_no) FILTER (reason IS NULL) AS inserted,
  count(DISTINCT ref_no) FILTER (reason IS NULL) + (SELECT count(*) FROM orders WHERE o_orderkey % 4 = 1) AS stored FROM ({PAYLOAD_SQL})""",
    "new_keys": """
SELECT CASE WHEN l_orderkey % 9 = 0 THEN '  ' ELSE 'REF-' || l_orderkey END AS ref_no, l_linenumber AS line FROM lineitem
WHERE l_orderkey % 9 = 0 OR l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 4 = 1)""",
    "existing_keys": "SELECT DISTINCT CASE WHEN l_orderkey % 9 = 0 THEN '  ' ELSE 'REF-' || l_orderkey END AS ref_no FROM lineitem",
    "tender_scan": """
SELECT o_orderkey AS id, 'REF-' || o_orderkey AS ref_no, 'Order ' || o_orderkey || ' ' || o_orderpriority AS title,
  'Customer ' || o_custkey AS organisation FROM orders WHERE o_orderkey % 4 = 0 AND o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 100""",
    "status_metrics": """
SELECT count(*) AS tender_count, count(*) FILTER (o_orderstatus = 'F') AS detail_scraped_count,
  count(*) FILTER (o_orderstatus = 'O') AS pending_detail_count, count(*) FILTER (o_orderkey % 4 = 0) AS embedding_pending_count,
  true AS cloudflare_enabled, max(o_orderdate) AS last_updated_at FROM orders""",
    "status_stored": """
SELECT count(*) AS tender_count, count(*) FILTER (o_orderstatus = 'F') AS detail_scraped_count,
  count(*) FILTER (o_orderstatus = 'O') AS pending_detail_count, count(*) FILTER (o_orderkey % 4 = 0) AS embedding_pending_count,
  true AS cloudflare_enabled, TIMESTAMP '2026-03-01 06:00:00' AS last_updated_at FROM orders""",
    "pending_stored": "SELECT o_orderkey AS id, true AS detail_scraped FROM orders WHERE o_orderkey % 4 = 0 AND o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 100",
    "last_updated": "SELECT max(o_orderdate) AS updated_at FROM orders",
    "search_filter": """
SELECT o_orderkey AS id, 'Order ' || o_orderkey || ' ' || o_orderpriority AS title, 'Customer ' || o_custkey AS organisation,
  o_totalprice AS tender_value FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
  AND o_totalprice BETWEEN 50000 AND 200000""",
    "search_stored": """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'cppp' ELSE 'eprocure' END AS source,
  'Order ' || o_orderkey || ' ' || o_orderpriority AS title, 'Customer ' || o_custkey AS organisation,
  o_orderdate AS published_date, o_totalprice AS tender_value FROM orders
WHERE o_orderdate >= TIMESTAMP '1994-06-15' AND o_orderdate < TIMESTAMP '1997-01-10' AND o_custkey = 29 AND o_totalprice >= 1000""",
    "pending_select": "SELECT o_orderkey AS id, true AS detail_scraped FROM orders WHERE o_orderkey % 4 = 0 AND o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 100",
    "pending_fallback": """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'O' THEN false END AS detail_scraped FROM orders
WHERE o_orderkey % 4 = 0 AND o_orderstatus <> 'F' ORDER BY o_orderkey LIMIT 100""",
    "run_counters": COUNTERS_SQL,
    "call_budget": BUDGET_SQL,
    "call_budget_stream": BUDGET_SQL,
    "job_state": JOB_SQL,
    "job_state_stream": JOB_SQL,
    "fetch_outcomes": OUTCOME_SQL,
    "incremental_upsert": INCREMENTAL_SQL,
    "listing_run": LISTING_RUN_SQL,
    "scheduled_run": RUN_SQL,
    "run_notices": RUN_NOTICES_SQL,
}
