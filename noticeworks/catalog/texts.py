"""Queries over scalar functions, embedding texts, vectors and matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from noticeworks import model as M
from noticeworks.catalog import carriers as K
from noticeworks.functions import compose as C, status as S, text as X
from noticeworks.operators import match, vectors

# Characters a Unicode-aware strip removes, as SQL.
_WS = " || ".join(f"chr({ord(c)})" for c in X.WHITESPACE)


def clean_value(spark, sf):
    """Whole document texts and short variants of them as detail values."""
    d = K.table(spark, sf, "documents")
    i = F.col("doc_id")
    raw = (
        F.when(i % 8 == 0, "NA").when(i % 8 == 1, " N/A ").when(i % 8 == 2, "na")
        .when(i % 8 == 3, F.repeat(F.lit("y"), 600)).when(i % 8 == 4, "a window.open b")
        .when(i % 8 == 5, F.concat(F.lit(" \t"), "source", F.lit(" x y　")))
        .otherwise(F.col("text"))
    )
    return d.select("doc_id", X.clean(raw).alias("value"))


CLEAN_SQL = f"""
SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'na' WHEN 3 THEN repeat('y', 600) WHEN 4 THEN NULL
  WHEN 5 THEN source || chr(8195) || 'x y'
  ELSE CASE WHEN t = '' OR length(t) > 600 OR contains(t, 'function') OR contains(t, 'window.open') OR t IN ('NA', 'N/A', '-') THEN NULL ELSE t END END AS value
FROM (SELECT *, trim(replace(text, chr(160), ' '), {_WS}) AS t FROM documents)"""


def amount_parse(spark, sf):
    o = K.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    shown = K.indian_commas(F.floor("o_totalprice"))
    raw = (
        F.when(k % 6 == 0, F.concat(F.lit("₹ "), shown)).when(k % 6 == 1, F.concat(shown, F.lit(".50 ")))
        .when(k % 6 == 2, F.concat(F.lit("Rs. "), shown)).when(k % 6 == 3, "1_000").when(k % 6 == 4, "nan")
        .otherwise(F.concat(F.lit("-"), shown, F.lit("e2")))
    )
    return o.select(k.alias("k"), X.amount(raw).alias("amount"))


def int_parse(spark, sf):
    p = K.table(spark, sf, "part")
    k = F.col("p_partkey")
    raw = (
        F.when(k % 4 == 0, F.concat("p_size", F.lit(" Days"))).when(k % 4 == 1, F.concat(F.lit("about "), "p_size", F.lit(",200")))
        .when(k % 4 == 2, "Days").otherwise("99999999999")
    )
    return p.select(k.alias("k"), X.first_int(raw).alias("days"))


def date_parse(spark, sf):
    o = K.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    ts = F.expr("o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 1440 as int), 0)")
    raw = (
        F.when(k % 10 == 0, K.text_date(ts)).when(k % 10 == 1, F.lower(K.text_date(ts, "d-MMM-yyyy  h:mm a")))
        .when(k % 10 == 2, K.text_date(ts, "dd-MMM-yyyy HH:mm")).when(k % 10 == 3, K.text_date(ts, "dd-MMM-yyyy"))
        .when(k % 10 == 4, K.text_date(ts, " d/M/yyyy ")).when(k % 10 == 5, K.text_date(ts, "dd-MMM-yyyy HH:mm 'PM'"))
        .when(k % 10 == 6, K.text_date(ts, "'31-Feb'-yyyy")).when(k % 10 == 7, K.text_date(ts, "dd-MMM-yy"))
        .when(k % 10 == 8, K.text_date(ts, "dd-MMM-yyyy hh:mm a 'IST'")).otherwise("")
    )
    return o.select(k.alias("k"), X.notice_date(raw).alias("at"))


DATE_SQL = """
SELECT k, CASE WHEN v IN (0, 1, 2) THEN ts WHEN v IN (3, 4) THEN CAST(o_orderdate AS TIMESTAMP)
  WHEN v = 5 AND extract('hour' FROM ts) BETWEEN 1 AND 12
    THEN ts + CASE WHEN extract('hour' FROM ts) = 12 THEN INTERVAL 0 HOUR ELSE INTERVAL 12 HOUR END END AS at
FROM (SELECT o_orderkey AS k, o_orderkey % 10 AS v, o_orderdate, o_orderdate + to_minutes(o_orderkey % 1440) AS ts FROM orders)"""


def job_status_class(spark, sf):
    names = F.array(*[F.lit(s) for s in (*M.DONE_STATUSES, *M.FAILED_STATUSES, "running", "pending")], F.lit(None))
    e = K.table(spark, sf, "events").select(
        "event_id", F.get(names, (F.col("event_id") % 10).cast("int")).alias("status")
    )
    return e.select("event_id", "status", S.job_class(F.col("status")).alias("state"))


JOB_CLASS_SQL = f"""
SELECT event_id, status, CASE WHEN v < 2 THEN 'done' WHEN v < 7 THEN 'failed' ELSE 'running' END AS state
FROM (SELECT event_id, event_id % 10 AS v,
  [{', '.join(repr(s) for s in (*M.DONE_STATUSES, *M.FAILED_STATUSES))}, 'running', 'pending', NULL][event_id % 10 + 1] AS status FROM events)"""


def tender_text(spark, sf):
    p = K.table(spark, sf, "part")
    k = F.col("p_partkey")
    rows = p.select(
        k.alias("k"),
        F.when(k % 6 != 0, F.col("p_name")).alias("title"),
        F.when(k % 3 == 0, "").otherwise(F.col("p_brand")).alias("organisation"),
        F.when(k % 2 == 0, F.col("p_type")).alias("product_category"),
        F.when(k % 5 == 0, F.concat("p_name", F.lit(" works"))).alias("work_description"),
        F.when(k % 4 == 0, "Pune").alias("location"),
        F.when(k % 7 == 0, "Open").alias("tender_type"),
        F.when(k % 9 == 0, "Works").alias("tender_category"),
    )
    return rows.select("k", C.notice_text().alias("text"))


TEXT_SQL = """
SELECT k, nullif(concat_ws('. ', CASE WHEN k % 6 <> 0 THEN p_name END, CASE WHEN k % 3 <> 0 THEN 'Organisation: ' || p_brand END,
  CASE WHEN k % 2 = 0 THEN 'Category: ' || p_type END, CASE WHEN k % 5 = 0 THEN 'Description: ' || p_name || ' works' END,
  CASE WHEN k % 4 = 0 THEN 'Location: Pune' END, CASE WHEN k % 7 = 0 THEN 'Type: Open' END,
  CASE WHEN k % 9 = 0 THEN 'Tender Category: Works' END), '') AS text FROM (SELECT *, p_partkey AS k FROM part)"""


def pref_text(spark, sf):
    """Customers as users; their nation and segment make the preference lists."""
    c = K.table(spark, sf, "customer")
    k = F.col("c_custkey")
    none = F.lit(None).cast("string")
    empty = F.array().cast("array<string>")
    rows = c.select(
        k.alias("k"),
        F.when(k % 4 == 0, "").when(k % 4 == 1, none).otherwise("win bids").alias("user_goal"),
        F.when(k % 3 == 0, F.array(F.col("c_mktsegment"), F.lit("pump"))).otherwise(empty).alias("keywords"),
        F.when(k % 5 == 0, F.array("c_mktsegment")).alias("categories"),
        F.when(k % 7 == 0, F.array(F.concat(F.lit("N"), "c_nationkey"))).alias("regions"),
        F.when(k % 2 == 0, F.array(F.lit("buyer"))).otherwise(empty).alias("roles"),
        F.when(k % 9 == 0, F.col("c_mktsegment")).alias("primary_industry"),
        F.when(k % 11 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("c"))).alias("secondary_industries"),
        F.when(k % 13 == 0, "LLP").otherwise("").alias("business_type"),
    )
    return rows.select("k", C.preference_text().alias("text"))


PREF_SQL = """
SELECT k, nullif(concat_ws('. ', CASE WHEN k % 4 > 1 THEN 'Goal: win bids' END,
  CASE WHEN k % 3 = 0 THEN 'Keywords: ' || c_mktsegment || ', pump' END, CASE WHEN k % 5 = 0 THEN 'Categories: ' || c_mktsegment END,
  CASE WHEN k % 7 = 0 THEN 'Regions: N' || c_nationkey END, CASE WHEN k % 2 = 0 THEN 'Roles: buyer' END,
  CASE WHEN k % 9 = 0 THEN 'Industry: ' || c_mktsegment END, CASE WHEN k % 11 = 0 THEN 'Also works in: a, b, c' END,
  CASE WHEN k % 13 = 0 THEN 'Business type: LLP' END), '') AS text FROM (SELECT *, c_custkey AS k FROM customer)"""


def embed_input(spark, sf):
    """What is sent for each document: the model takes the first 30,000 characters."""
    d = K.table(spark, sf, "documents")
    sent = C.embed_input(F.col("text"))
    return d.select("doc_id", F.char_length(sent).alias("n_sent"), F.md5(sent).alias("digest"))


def embed_text(spark, sf):
    """Default vectors of all documents: dimensions, length and distinct non-zero places."""
    d = vectors.hash_vectors(K.table(spark, sf, "documents").select("doc_id", "text"), dim=256)
    v = F.col("embedding")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return d.select("doc_id", F.size(v).alias("dims"), F.round(norm, 3).alias("norm"))


def _char_counts(texts):
    return [[float(len(t)), float(t.count(" ")), float(t.count("e"))] for t in texts]


def embed_batches(spark, sf):
    """Vectors from a caller's batch function over whole texts."""
    d = vectors.embed(K.table(spark, sf, "documents").select("doc_id", "text"), _char_counts)
    v = F.col("embedding")
    return d.select("doc_id", *[F.get(v, F.lit(i)).cast("bigint").alias(n) for i, n in enumerate(("chars", "blanks", "es"))])


def match_topk(spark, sf):
    """Every vector as a user, matched with all vectors, its own included."""
    e = K.table(spark, sf, "embeddings")
    users = e.select(F.col("vec_id").alias("user_id"), F.col("embedding").alias("vector"))
    items = e.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    return match.match_topk(users, items, k=5).select(
        "user_id", "item_id", F.round("score", 4).alias("score"), "rank"
    )


MATCH_SQL = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT u.vec_id AS user_id, i.vec_id AS item_id, list_cosine_similarity(u.v, i.v) AS score
  FROM e u, e i)
SELECT user_id, item_id, round(score, 4) AS score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY score DESC, item_id) AS rank FROM s) WHERE rank <= 5"""

QUERIES = {
    "clean_value": clean_value,
    "amount_parse": amount_parse,
    "int_parse": int_parse,
    "date_parse": date_parse,
    "job_status_class": job_status_class,
    "tender_text": tender_text,
    "pref_text": pref_text,
    "embed_input": embed_input,
    "embed_text": embed_text,
    "embed_batches": embed_batches,
    "match_topk": match_topk,
}

SQL = {
    "clean_value": CLEAN_SQL,
    "amount_parse": """
SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN floor(o_totalprice) WHEN 1 THEN floor(o_totalprice) + 0.5
  WHEN 5 THEN -100 * floor(o_totalprice) END AS amount FROM orders""",
    "int_parse": "SELECT p_partkey AS k, CASE WHEN p_partkey % 4 < 2 THEN CAST(p_size AS BIGINT) WHEN p_partkey % 4 = 3 THEN 99999999999 END AS days FROM part",
    "date_parse": DATE_SQL,
    "job_status_class": JOB_CLASS_SQL,
    "tender_text": TEXT_SQL,
    "pref_text": PREF_SQL,
    "embed_input": """
SELECT doc_id, CAST(length(substr(text, 1, 30000)) AS INTEGER) AS n_sent, md5(substr(text, 1, 30000)) AS digest FROM documents""",
    "embed_text": """
SELECT doc_id, CASE WHEN w THEN CAST(256 AS INTEGER) END AS dims, CASE WHEN w THEN CAST(1 AS DOUBLE) END AS norm
FROM (SELECT doc_id, regexp_matches(text, '[\\p{L}\\p{N}]') AS w FROM documents)""",
    "embed_batches": """
SELECT doc_id, CASE WHEN b THEN NULL ELSE length(t) END AS chars, CASE WHEN b THEN NULL ELSE length(t) - length(replace(t, ' ', '')) END AS blanks,
  CASE WHEN b THEN NULL ELSE length(t) - length(replace(t, 'e', '')) END AS es
FROM (SELECT doc_id, text AS t, trim(text) = '' AS b FROM documents)""",
    "match_topk": MATCH_SQL,
}
