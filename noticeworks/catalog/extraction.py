"""Queries over stored pages: listing, detail and page-level operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from noticeworks import model as M
from noticeworks.catalog import carriers as K
from noticeworks.functions import notice as N, status as S, text as X
from noticeworks.operators import detail as D, listing as L, tokenise as T
from noticeworks.session import shared_dir
from noticeworks.sources import export
from noticeworks.sources.pages import read_pages

# Listing items computed from the relational tables.
ITEMS = """
SELECT o_orderkey AS k, o_orderkey // 10 + 1 AS page_no, o_orderkey % 10 AS pos,
  'Supply contract ' || o_orderpriority || ' lot ' || o_orderkey AS title,
  'REF-' || o_orderkey AS ref_no,
  o_orderdate + to_minutes(o_orderkey % 1440) AS published_date,
  CASE WHEN o_orderkey % 4 = 1 THEN o_orderdate + to_minutes(o_orderkey % 1440)
       ELSE o_orderdate + INTERVAL 14 DAY END AS closing_date,
  o_orderdate + INTERVAL 15 DAY AS opening_date,
  c_name || ' & Sons' || CASE WHEN (o_orderkey // 10 + 1) % 5 = 0 THEN 'note' ELSE '' END AS org,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL
       WHEN o_orderkey % 11 = 0 THEN 'https://notices.example.org/' || o_orderkey
       ELSE 'https://eprocure.gov.in/eprocure/app?id=' || o_orderkey || '&s=1' END AS url
FROM orders JOIN customer ON o_custkey = c_custkey
"""
GOOD = "k % 17 <> 0 AND k % 23 <> 0 AND k % 19 <> 0"


def typed(rows):
    return rows.select(
        "source", "title", "ref_no",
        *[X.notice_date(F.col(d)).alias(d) for d in M.DATE_FIELDS],
        "organisation", "url",
        F.col("ingest_ord.page_no").alias("page_no"),
    )


def listing_extract(spark, sf):
    return typed(L.extract_listing(K.listing_pages(spark, sf)))


LISTING_SQL = f"""
SELECT 'eprocure' AS source, title, ref_no, published_date, closing_date, opening_date,
  CASE WHEN k % 13 = 0 THEN '' ELSE org END AS organisation, url, page_no
FROM ({ITEMS}) WHERE {GOOD}"""


def listing_headers(spark, sf):
    """Header prefix variants: two header rows, or none and a first data row that reads like one."""
    items = K.order_items(spark, sf).withColumn(
        "title",
        F.concat(F.when((F.col("page_no") % 4 == 0) & (F.col("k") % 10 < 7), "Opening ").otherwise(""), "title"),
    )
    p = F.col("page_no")
    header = F.when(p % 4 == 0, "").when(p % 4 == 1, K.HEADER + K.HEADER).otherwise(K.HEADER)
    pages = K.listing_pages(spark, sf, header, K.listing_rows_html(items), flat=True)
    return L.extract_listing(pages).select("title", "ref_no", p_no())


def p_no():
    return F.col("ingest_ord.page_no").alias("page_no")


# The scan stops at the first row without a header word and after five rows. Rows of pages
# divisible by four read "opening" down to position 6, unless the row is a short one.
HEADERS_SQL = f"""
WITH i AS ({ITEMS}),
s AS (SELECT page_no, min(pos) FILTER (pos >= 7 OR k % 23 = 0 OR k % 17 = 0) AS first_other FROM i GROUP BY page_no)
SELECT CASE WHEN page_no % 4 = 0 AND pos < 7 THEN 'Opening ' ELSE '' END || title AS title, ref_no, page_no
FROM i JOIN s USING (page_no)
WHERE {GOOD} AND (page_no % 4 <> 0 OR pos >= least(first_other, 5))"""


def row_selector(spark, sf):
    """Rows that each page's table selector finds, before any filter."""
    rows = T.with_rows(K.listing_pages(spark, sf), "listing")
    return rows.select("page_no", F.size("rows").alias("n_rows"), L.header_rows(F.col("rows")).alias("n_header"))


# Pages divisible by five have one nested row more for every row with a nested table.
SELECTOR_SQL = f"""
SELECT page_no, CAST(1 + count(*) + count(*) FILTER (page_no % 5 = 0 AND {GOOD.replace('k % 19 <> 0', 'k % 13 <> 0')}) AS INTEGER) AS n_rows,
  CAST(1 AS INTEGER) AS n_header FROM ({ITEMS}) GROUP BY page_no"""


def cells(spark, sf):
    return T.cells(K.listing_pages(spark, sf, flat=True)).where("row_ord > 0").select(
        "page_no", "row_ord", "cell_ord", "cls", "text", "node_text", "href", "next_text"
    )


CELLS_SQL = f"""
WITH i AS (SELECT *, replace(org, 'note', '') AS plain,
    CASE WHEN k % 19 = 0 THEN 'A | B ' ELSE '' END || title AS t FROM ({ITEMS})),
c AS (
  SELECT k, page_no, pos, CASE WHEN k % 23 = 0 THEN ['1', '-', '-', '-', '-']
    ELSE [(k + 1) || '.', strftime(published_date, '%d-%b-%Y %I:%M %p'),
      CASE WHEN k % 4 = 1 THEN strftime(closing_date, '%-d-%b-%Y %H:%M') ELSE strftime(closing_date, '%d-%b-%Y') END,
      strftime(opening_date, '%d/%m/%Y')]
      || CASE WHEN k % 17 = 0 THEN [] ELSE ['[' || t || '][' || ref_no || '][ID-' || k || ']'] END
      || CASE WHEN k % 13 = 0 OR k % 17 = 0 THEN [] ELSE [plain] END END AS a,
    CASE WHEN k % 23 <> 0 AND k % 17 <> 0 THEN
      CASE WHEN k % 7 = 0 THEN NULL WHEN k % 11 = 0 THEN url ELSE substr(url, 24) END END AS link
  FROM i),
n AS (SELECT k, page_no, pos, link, generate_subscripts(a, 1) - 1 AS cell_ord, unnest(a) AS text FROM c)
SELECT page_no, CAST(pos + 1 AS INTEGER) AS row_ord, CAST(cell_ord AS INTEGER) AS cell_ord, '' AS cls,
  text, text AS node_text, CASE WHEN cell_ord = 4 THEN link END AS href,
  nullif(lead(text) OVER (PARTITION BY k ORDER BY cell_ord), '-') AS next_text
FROM n"""


def next_cell(spark, sf):
    """Caption cells of detail pages with the value of the cell after them."""
    return (
        T.cells(K.detail_pages(spark, sf), "detail").where("cls = 'td_caption'")
        .select("k", "node_text", "next_text")
    )


def strict_cells(spark, sf):
    """All table rows with their cell counts; every fifth page needs the strict tokenizer."""
    rows = T.with_rows(K.listing_pages(spark, sf), "listing")
    return rows.select("page_no", F.posexplode("rows").alias("row_ord", "r")).select(
        "page_no", "row_ord", F.size(T.row_cells(F.col("r"))).alias("n_cells"),
        F.get(T.row_cells(F.col("r")), F.lit(5)).isNotNull().alias("has_sixth"),
    ).where("row_ord > 0")


STRICT_SQL = f"""
WITH i AS (SELECT *, page_no % 5 = 0 AND k % 23 <> 0 AND k % 13 <> 0 AND k % 17 <> 0 AS nested FROM ({ITEMS})),
r AS (SELECT page_no, k, 0 AS sub, CASE WHEN k % 23 = 0 THEN 5 WHEN k % 17 = 0 THEN 4 WHEN k % 13 = 0 THEN 5 WHEN nested THEN 7 ELSE 6 END AS n FROM i
  UNION ALL SELECT page_no, k, 1, 1 FROM i WHERE nested)
SELECT page_no, CAST(row_number() OVER (PARTITION BY page_no ORDER BY k, sub) AS INTEGER) AS row_ord,
  CAST(n AS INTEGER) AS n_cells, n > 5 AS has_sixth FROM r"""


def title_ref_split(spark, sf):
    o = K.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    raw = (
        F.when(k % 5 == 0, F.concat(F.lit("[T"), k, F.lit("] [R][I]")))
        .when(k % 5 == 1, F.concat(F.lit("[A["), k, F.lit("] repair of road][REF][ID]")))
        .when(k % 5 == 2, F.concat(F.lit("[T][R"), k))
        .when(k % 5 == 3, F.concat(F.lit("  Plain "), k, F.lit(" 　")))
        .otherwise(F.concat(F.lit("[[ T"), k, F.lit(" ][R ][I]")))
    )
    title, ref = N.split_title_ref(raw)
    return o.select(k.alias("k"), title.alias("title"), ref.alias("ref_no"))


TITLE_SQL = """
SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN 'T' || o_orderkey WHEN 1 THEN 'A[' || o_orderkey
    WHEN 2 THEN '[T][R' || o_orderkey WHEN 3 THEN 'Plain ' || o_orderkey ELSE 'T' || o_orderkey END AS title,
  CASE o_orderkey % 5 WHEN 0 THEN '[R' WHEN 1 THEN 'repair of road' WHEN 4 THEN 'R' ELSE '' END AS ref_no
FROM orders"""


def row_validity(spark, sf):
    """Whole conversation turns as titles, some with a header word in another field."""
    c = K.table(spark, sf, "conversations")
    n = F.col("conv_id") + F.col("turn")
    closing = F.when(n % 11 == 0, "Deadline").otherwise("1-Jan-2026")
    org = F.when(n % 13 == 0, "MINISTRY").otherwise("Roads Department")
    return c.select(
        "conv_id", "turn",
        N.is_notice(F.col("text"), closing, F.lit("x"), F.lit("y"), org).alias("is_valid"),
    )


def _sql_has(col, words):
    return " OR ".join(f"contains({col}, '{w}')" for w in words)


VALIDITY_SQL = f"""
SELECT conv_id, turn, NOT ({_sql_has('lower(text)', M.TITLE_REJECT_WORDS)})
  AND (conv_id + turn) % 11 <> 0 AND (conv_id + turn) % 13 <> 0
  AND length(text) > 20 AND regexp_matches(text, '\\p{{L}}')
  AND ({_sql_has('lower(text)', M.TITLE_KEYWORDS)}
       OR len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) > 5) AS is_valid
FROM conversations"""


def page_scan(spark, sf):
    """Raw pages: a two-column projection of the stored bodies."""
    return read_pages(spark, f"{sf}/pages.parquet").select(
        "page_id", F.char_length("html").alias("n_chars")
    )


def page_links(spark, sf):
    """All links of the raw pages as absolute URLs."""
    pages = read_pages(spark, f"{sf}/pages.parquet")
    hrefs = F.regexp_extract_all("html", F.lit(r'<a\s[^>]*?href="([^"]*)"'), 1)
    return pages.select("page_id", F.posexplode(hrefs).alias("ord", "href")).select(
        "page_id", "ord", X.link_url(F.col("href")).alias("url")
    )


LINKS_SQL = """
SELECT page_id, CAST(generate_subscripts(h, 1) - 1 AS INTEGER) AS ord, unnest(list_transform(h, lambda x:
  CASE WHEN x = '' THEN NULL WHEN starts_with(x, 'http') THEN x ELSE 'https://eprocure.gov.in' || x END)) AS url
FROM (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1) AS h FROM pages)"""


def live_count(spark, sf):
    return L.live_counts(K.listing_pages(spark, sf))


# Serial numbers are key + 1 in rows with five or more cells; short rows show 1.
LIVE_SQL = f"""
WITH i AS ({ITEMS}), p AS (SELECT max(page_no) AS last FROM i)
SELECT 'eprocure' AS source, (SELECT last FROM p) AS total_pages,
  CAST((SELECT CASE WHEN k % 23 = 0 THEN 1 ELSE k + 1 END FROM i, p
        WHERE page_no = last AND k % 17 <> 0 ORDER BY k DESC LIMIT 1) AS INTEGER) AS live_tenders"""


def live_count_nested(spark, sf):
    """Rows with a table inside their second cell: its cell counts as one more cell of the row."""
    rows = K.listing_rows_html(K.order_items(spark, sf)).withColumn(
        "row", F.regexp_replace("row", r"^(.*?</td><td>)", "$1<table><tr><td>7.</td></tr></table>"))
    return L.live_counts(K.listing_pages(spark, sf, rows=rows))


# Rows with four cells of their own count here, too.
LIVE_NESTED_SQL = f"""
WITH i AS ({ITEMS}), p AS (SELECT max(page_no) AS last FROM i)
SELECT 'eprocure' AS source, (SELECT last FROM p) AS total_pages,
  CAST((SELECT CASE WHEN k % 23 = 0 THEN 1 ELSE k + 1 END FROM i, p
        WHERE page_no = last ORDER BY k DESC LIMIT 1) AS INTEGER) AS live_tenders"""


def quarantine(spark, sf):
    """Pages of which every sixth is a challenge page: rows and quarantined pages, written apart in one pass."""
    path = shared_dir(spark, "outcomes")
    pages = challenged(spark, sf).withColumn(
        "source", F.when(F.col("page_no") % 4 == 0, "cppp").otherwise(F.col("source")))
    found = L.extract_outcomes(pages)
    found.write.partitionBy("outcome").parquet(path)
    aside = spark.read.schema(found.schema).parquet(path)
    ids = F.count_if(F.col("page_id") == F.col("ingest_ord.page_no")).alias("named")
    return L.quarantine_counts(aside).join(
        aside.where("outcome = 'quarantine' and reason is not null and page_url is not null").groupBy("source").agg(ids), "source")


QUARANTINE_SQL = f"""
WITH i AS (SELECT *, CASE WHEN page_no % 4 = 0 THEN 'cppp' ELSE 'eprocure' END AS source FROM ({ITEMS})),
q AS (SELECT source, count(DISTINCT page_no) AS n FROM i WHERE page_no % 6 = 0 GROUP BY source)
SELECT source, (SELECT count(*) FROM i WHERE i.source = q.source AND page_no % 6 <> 0 AND {GOOD}) AS n_rows,
  n AS quarantined, n AS named FROM q"""


def has_next(spark, sf):
    return K.listing_pages(spark, sf).select("page_no", S.has_next_page(F.col("html")).alias("has_next"))


def page_cap(spark, sf):
    return typed(L.extract_listing(K.listing_pages(spark, sf), page_cap=M.FREE_PAGE_CAP))


def page_flags(spark, sf):
    """Raw pages with marker text put in: challenge images and expired-session notes."""
    i = F.col("page_id")
    mark = (
        F.when(i % 7 == 0, '<IMG alt="Captcha code" src=x.png>')
        .when(i % 7 == 1, '<img src="/captcha.png">')
        .when(i % 7 == 2, '<img src="/CAPTCHA.png">')
        .when(i % 7 == 3, "<div id='captchaImage'></div>")
        .otherwise("")
    )
    note = F.when(i % 5 == 0, "<p>Your Session Has Expired</p>").otherwise("")
    pages = K.table(spark, sf, "pages").select(
        "page_id", F.concat("html", mark, note).alias("html")
    )
    return L.page_flags(pages)


FLAGS_SQL = """
SELECT page_id, page_id % 7 IN (0, 1, 3) AS is_challenge, page_id % 5 = 0 AS is_expired,
  len(list_filter(regexp_extract_all(html, '(?s)<a[\\s>][^>]*>(.*?)</a', 1),
      lambda x: trim(regexp_replace(x, '<[^>]*>', '', 'g')) IN ('>', '&gt;'))) > 0 AS has_next FROM pages"""


def without_challenges(spark, sf):
    """Listing pages of which every sixth is a challenge page: it yields no rows."""
    return typed(L.extract_listing(challenged(spark, sf)))


def challenged(spark, sf):
    return K.listing_pages(spark, sf).withColumn(
        "html", F.concat("html", F.when(F.col("page_no") % 6 == 0, "<img id=captchaPic>").otherwise(""))
    )


def detail_extract(spark, sf):
    out = D.extract_detail(K.detail_pages(spark, sf))
    return out.select("k", "url", *M.DETAIL_FIELDS)


DETAIL_SQL = """
SELECT p_partkey AS k, '/detail/' || p_partkey AS url, 'T-' || p_partkey AS tender_id, p_type AS tender_type,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'Works' END AS tender_category,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'Item Rate' END AS contract_type,
  CASE WHEN p_partkey % 7 = 0 OR p_partkey % 50 = 1 THEN NULL ELSE p_name || ' & fittings' END AS work_description,
  p_brand AS product_category,
  CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE 'Spare' END AS sub_category,
  n_name AS location, lpad(CAST(p_partkey AS VARCHAR), 6, '1') AS pincode,
  CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE round(p_retailprice * 1000) END AS tender_value,
  CASE WHEN p_partkey % 5 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(p_size * 1000 AS DOUBLE) END AS emd_amount,
  CAST(p_size AS BIGINT) AS period_of_work_days, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(1 AS BIGINT) END AS bid_validity_days,
  CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE '26-Feb-2026 10:00 AM' END AS pre_bid_meeting_date,
  'Officer ' || p_partkey % 25 AS inviting_authority_name,
  'Block ' || p_partkey % 10 || ', ' || n_name AS inviting_authority_address
FROM part JOIN nation ON p_partkey % 25 = n_nationkey"""

# Captions and values of the same pages, one row per caption; empty and NA values are null.
NEXT_SQL = """
WITH v AS (SELECT p_partkey AS k, p.*, n_name FROM part p JOIN nation ON p_partkey % 25 = n_nationkey)
SELECT k, unnest(['Tender ID', 'Tender Type', 'Tender Category', 'Form Of Contract', 'Work Description',
    'Tender Value in ₹', 'Product Category', 'Sub category', 'Bid Validity(Days)', 'Period Of Work(Days)',
    'Location', 'Pincode', 'Pre Bid Meeting Date', 'EMD Amount in ₹', 'Name', 'Address']) AS node_text,
  unnest(['T-' || k, p_type, CASE WHEN k % 3 = 0 THEN NULL ELSE 'Works' END,
    CASE WHEN k % 4 = 0 THEN NULL ELSE 'Item Rate' END,
    CASE WHEN k % 7 = 0 OR k % 50 = 1 THEN NULL ELSE p_name || ' & fittings' END,
    CASE WHEN k % 9 = 0 THEN 'Rs. 500' ELSE regexp_replace(CAST(CAST(round(p_retailprice * 1000) AS BIGINT) AS VARCHAR),
      '^(\\d+?)(\\d\\d)(\\d{3})$', '\\1,\\2,\\3') END,
    p_brand, CASE WHEN k % 2 = 0 THEN NULL ELSE 'Spare' END,
    CASE WHEN k % 6 = 0 THEN NULL ELSE '1,200 Days' END, p_size || ' Days', n_name,
    lpad(CAST(k AS VARCHAR), 6, '1'), CASE WHEN k % 8 = 0 THEN NULL ELSE '26-Feb-2026 10:00 AM' END,
    CASE WHEN k % 5 = 0 THEN '0.00' ELSE '₹ ' || p_size || ',000' END,
    'Officer ' || k % 25, 'Block ' || k % 10 || ', ' || n_name]) AS next_text FROM v"""


def response_items(spark, sf):
    return export.response_items(L.extract_listing(K.listing_pages(spark, sf)))


ITEMS_SQL = f"""
SELECT title, ref_no,
  CASE WHEN k % 4 = 1 THEN strftime(closing_date, '%-d-%b-%Y %H:%M') ELSE strftime(closing_date, '%d-%b-%Y') END AS closing_date,
  strftime(opening_date, '%d/%m/%Y') AS opening_date, strftime(published_date, '%d-%b-%Y %I:%M %p') AS published_date,
  CASE WHEN k % 13 = 0 THEN '' ELSE org END AS organisation, url
FROM ({ITEMS}) WHERE {GOOD}"""


def response_envelope(spark, sf):
    pages = K.listing_pages(spark, sf)
    return export.response_envelope(L.extract_listing(pages), pages)


ENVELOPE_SQL = f"""
SELECT true AS success, l.*, (SELECT count(*) FROM ({ITEMS}) WHERE {GOOD}) AS count, CAST(NULL AS VARCHAR) AS error
FROM ({LIVE_SQL}) l"""


def sample_rows(spark, sf):
    from noticeworks.operators.search import sample_rows as first_rows

    return first_rows(L.extract_listing(K.listing_pages(spark, sf)))


SAMPLE_SQL = f"""
SELECT substr(title, 1, 80) AS title, ref_no, closing_date, substr(organisation, 1, 50) AS organisation
FROM (SELECT * FROM ({ITEMS_SQL.replace('SELECT title', 'SELECT k, title')}) ORDER BY k LIMIT 3)"""

QUERIES = {
    "page_scan": page_scan,
    "row_selector": row_selector,
    "cells": cells,
    "strict_cells": strict_cells,
    "listing_headers": listing_headers,
    "listing_extract": listing_extract,
    "page_links": page_links,
    "title_ref_split": title_ref_split,
    "row_validity": row_validity,
    "live_count": live_count,
    "live_count_nested": live_count_nested,
    "quarantine": quarantine,
    "has_next": has_next,
    "page_cap": page_cap,
    "page_flags": page_flags,
    "without_challenges": without_challenges,
    "next_cell": next_cell,
    "detail_extract": detail_extract,
    "response_items": response_items,
    "response_envelope": response_envelope,
    "sample_rows": sample_rows,
}

SQL = {
    "page_scan": "SELECT page_id, CAST(length(html) AS INTEGER) AS n_chars FROM pages",
    "row_selector": SELECTOR_SQL,
    "cells": CELLS_SQL,
    "strict_cells": STRICT_SQL,
    "listing_headers": HEADERS_SQL,
    "listing_extract": LISTING_SQL,
    "page_links": LINKS_SQL,
    "title_ref_split": TITLE_SQL,
    "row_validity": VALIDITY_SQL,
    "live_count": LIVE_SQL,
    "live_count_nested": LIVE_NESTED_SQL,
    "quarantine": QUARANTINE_SQL,
    "has_next": "SELECT DISTINCT o_orderkey // 10 + 1 AS page_no, o_orderkey // 10 < (SELECT max(o_orderkey) // 10 FROM orders) AS has_next FROM orders",
    "page_cap": f"SELECT * FROM ({LISTING_SQL}) WHERE page_no <= 100",
    "page_flags": FLAGS_SQL,
    "without_challenges": f"SELECT * FROM ({LISTING_SQL}) WHERE page_no % 6 <> 0",
    "next_cell": NEXT_SQL,
    "detail_extract": DETAIL_SQL,
    "response_items": ITEMS_SQL,
    "response_envelope": ENVELOPE_SQL,
    "sample_rows": SAMPLE_SQL,
}
