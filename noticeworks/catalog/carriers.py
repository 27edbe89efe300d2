"""The given relational tables, rendered by Spark as stored pages, crawl results and logs.

There is no notice table among the given tables. Each carrier turns one of them, whole, into the
form an operator reads; the SQL beside each query computes the expected result straight from the
relational columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from noticeworks.functions import text as X
from noticeworks.session import spread

LONG = "dd-MMM-yyyy hh:mm a"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_date(c: Column, form: str = LONG) -> Column:
    return F.date_format(c.cast("timestamp"), form)


def indian_commas(n: Column) -> Column:
    """3861562 as 38,61,562."""
    return F.regexp_replace(n.cast("bigint").cast("string"), r"(\d)(?=(\d{2})*\d{3}$)", "$1,")


def built(name: str, value: Column) -> Column:
    """A computed body as a column of its own: readers of it never render it again."""
    return X.once(value.alias(name))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer as listing items: texts as a listing would show them."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = F.col("o_orderkey")
    published = F.expr("o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 1440 as int), 0)")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        k.alias("k"),
        F.expr("o_orderkey div 10 + 1").alias("page_no"),
        F.concat(F.lit("Supply contract "), "o_orderpriority", F.lit(" lot "), k).alias("title"),
        F.concat(F.lit("REF-"), k).alias("ref_no"),
        text_date(published).alias("published"),
        F.when(k % 4 == 1, text_date(published, "d-MMM-yyyy HH:mm"))
        .otherwise(text_date(F.expr("o_orderdate + interval 14 days"), "dd-MMM-yyyy"))
        .alias("closing"),
        text_date(F.expr("o_orderdate + interval 15 days"), "dd/MM/yyyy").alias("opening"),
        F.concat("c_name", F.lit(" & Sons")).alias("organisation"),
        F.when(k % 7 == 0, F.lit(None))
        .when(k % 11 == 0, F.concat(F.lit("https://notices.example.org/"), k))
        .otherwise(F.concat(F.lit("/eprocure/app?id="), k, F.lit("&s=1"))).alias("href"),
    )


def _escaped(c: Column) -> Column:
    return F.replace(c, F.lit("&"), F.lit("&amp;"))


def _td(*parts) -> Column:
    return F.concat(F.lit("<td>"), *parts, F.lit("</td>"))


HEADER = (
    "<tr class='list_header'><td>S.No</td><td>e-Published Date</td><td>Bid Submission Closing Date"
    "</td><td>Tender Opening Date</td><td>Title and Ref.No./Tender ID</td><td>Organisation Chain"
    "</td></tr>"
)


def listing_rows_html(items: DataFrame) -> DataFrame:
    """One table row per item. Some rows have no link, no organisation or too few cells, some
    are short or carry a bar in the title; every fifth page holds a nested table and a comment."""
    k, nested = F.col("k"), F.col("page_no") % 5 == 0
    title = F.concat(
        F.lit("["), F.when(k % 19 == 0, F.lit("A | B ")).otherwise(""), "title", F.lit("]["), "ref_no",
        F.lit("][ID-"), k, F.lit("]"),
    )
    link = F.when(F.col("href").isNull(), title).otherwise(
        F.concat(F.lit('<a class="l" href="'), _escaped(F.col("href")), F.lit('">'), title, F.lit("</a>"))
    )
    organisation = _td(
        _escaped(F.col("organisation")),
        F.when(nested, "<!-- <td>x</td> --><table><tr><td>note</td></tr></table>").otherwise(""),
    )
    full = F.concat(
        F.lit("\n<tr class='even'>"), _td(k + 1, F.lit(".")), _td("published"), _td("closing"),
        _td(F.lit("<b> "), "opening", F.lit(" </b>")),
        F.when(k % 17 == 0, "").otherwise(_td(link)),
        F.when((k % 13 == 0) | (k % 17 == 0), "").otherwise(organisation),
        F.lit("</tr>"),
    )
    row = F.when(k % 23 == 0, F.lit("\n<tr><td>1</td><td>-</td><td>-</td><td>-</td><td>-</td></tr>")).otherwise(full)
    return items.withColumn("row", row)


def listing_pages(
    spark: SparkSession, sf_dir: str, header: Column | None = None, rows: DataFrame | None = None,
    flat: bool = False,
) -> DataFrame:
    """Listing pages of ten rows; the three table forms alternate, the last page has no next link."""
    rows = listing_rows_html(order_items(spark, sf_dir)) if rows is None else rows
    if flat:
        rows = rows.withColumn("row", F.regexp_replace("row", r"<!--.*?--><table>.*?</table>", ""))
    p = F.col("page_no")
    opening = (
        F.when(p % 3 == 0, '<table id="table" class="x">')
        .when(p % 3 == 1, "<table border=1 class='a list_table'>")
        .otherwise("<table class=list><thead><tr><td>Head of the whole page table</td></tr></thead><tbody>")
    )
    last = table(spark, sf_dir, "orders").agg(F.expr("max(o_orderkey) div 10 + 1")).scalar()
    page = F.concat(
        F.lit("<html><head><script>var t = '<table id=x>';</script></head><body><table class='layout'><tr><td>"),
        opening,
        F.lit(HEADER) if header is None else header,
        F.array_join(F.transform(F.array_sort("_rows"), lambda r: r["row"]), ""),
        F.lit("</table></td></tr></table>"),
        F.when(p == last, "<a href='#'>&gt;&gt;</a>").otherwise("<a href='#'><b>&gt;</b></a>"),
        F.lit("</body></html>"),
    )
    # A page holds at most ten rows.
    return rows.groupBy("page_no").agg(F.collect_list(F.struct("k", "row")).alias("_rows")).select(
        p.alias("page_id"), F.lit("eprocure").alias("source"),
        F.concat(F.lit("https://eprocure.gov.in/eprocure/app?page="), p).alias("url"),
        p, built("html", page),
    )


def part_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with a nation (25 rows, fixed) as detail-page values, null where a page would say NA."""
    p = spread(table(spark, sf_dir, "part"))
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("p_partkey")
    return p.join(F.broadcast(n), F.expr("p_partkey % 25 = n_nationkey")).select(
        k.alias("k"),
        F.concat(F.lit("/detail/"), k).alias("url"),
        F.concat(F.lit("T-"), k).alias("tender_id"),
        F.col("p_type").alias("tender_type"),
        F.when(k % 3 == 0, "NA").otherwise("Works").alias("tender_category"),
        F.when(k % 4 == 0, "-").otherwise("Item Rate").alias("contract_type"),
        F.when(k % 7 == 0, "functional testing").when(k % 50 == 1, F.repeat(F.lit("x"), 601))
        .otherwise(F.concat("p_name", F.lit(" & fittings"))).alias("work_description"),
        F.col("p_brand").alias("product_category"),
        F.when(k % 2 == 0, "N/A").otherwise("Spare").alias("sub_category"),
        F.col("n_name").alias("location"),
        F.lpad(k.cast("string"), 6, "1").alias("pincode"),
        F.when(k % 9 == 0, "Rs. 500").otherwise(indian_commas(F.round(F.col("p_retailprice") * 1000))).alias("tender_value"),
        F.when(k % 5 == 0, "0.00").otherwise(F.concat(F.lit("₹ "), F.col("p_size").cast("string"), F.lit(",000"))).alias("emd_amount"),
        F.concat("p_size", F.lit(" Days")).alias("period_of_work_days"),
        F.when(k % 6 == 0, "NA").otherwise("1,200 Days").alias("bid_validity_days"),
        F.when(k % 8 == 0, "").otherwise("26-Feb-2026 10:00 AM").alias("pre_bid_meeting_date"),
        F.concat(F.lit("Officer "), k % 25).alias("inviting_authority_name"),
        F.concat(F.lit("Block "), k % 10, F.lit(", "), "n_name").alias("inviting_authority_address"),
    )


DETAIL_ROWS = [
    [("Tender ID", "tender_id"), ("Tender Type", "tender_type"), ("Tender Category", "tender_category")],
    [("Form Of Contract", "contract_type"), ("Work Description", "work_description")],
    [("Tender Value in &#8377; ", "tender_value"), ("Product Category", "product_category"), ("Sub category", "sub_category")],
    [("Bid Validity(Days)", "bid_validity_days"), ("Period Of Work(Days)", "period_of_work_days")],
    [("Location", "location"), ("Pincode", "pincode"), ("Pre Bid Meeting Date", "pre_bid_meeting_date")],
    [("EMD Amount in &#8377; ", "emd_amount")],
    [("Name", "inviting_authority_name"), ("Address", "inviting_authority_address")],
]


def detail_html(values: DataFrame) -> Column:
    """A detail page; every fifth one has a script and a nested table beside its values."""
    parts = [F.lit("<html><body><table><tr><td class='navigation'>Location<script>function f(){}</script></td><td>")]
    for n, row in enumerate(DETAIL_ROWS):
        parts.append(F.lit("<table class='tablebg'><tr>" if n % 2 == 0 else '<table width=1 class="x tablebg"><tr>'))
        for caption, name in row:
            parts.append(F.lit(f"<td class='td_caption'><b>{caption}</b></td><td class='td_field'>&nbsp;"))
            parts.append(_escaped(F.col(name)))
            parts.append(F.lit(" </td>"))
        if n == 4:
            parts.append(F.when(F.col("k") % 5 == 0, "<td><table><tr><td>Map &rarr;</td></tr></table></td>").otherwise(""))
        parts.append(F.lit("</tr></table>"))
    parts.append(F.lit("</td></tr></table></body></html>"))
    return F.concat(*parts)


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = part_details(spark, sf_dir)
    return values.select("k", "url", built("html", detail_html(values)))


def detail_json_text(names: list[str]) -> Column:
    """Detail values as JSON with plain numbers; values a page would call NA are absent."""
    k = F.col("k")
    typed = {
        "tender_value": F.when(k % 9 != 0, F.replace(F.col("tender_value"), F.lit(","), F.lit("")).cast("double")),
        "emd_amount": F.when(k % 5 == 0, F.lit(0.0)).otherwise(
            F.regexp_replace("emd_amount", "[^0-9]", "").cast("double")),
        "period_of_work_days": F.regexp_extract("period_of_work_days", r"(\d+)", 1).cast("int"),
        "bid_validity_days": F.when(k % 6 != 0, F.lit("1200")),
    }
    missing = ["NA", "N/A", "-", ""]
    cols = [
        typed[n].alias(n) if n in typed else F.when(~F.col(n).isin(missing), F.col(n)).alias(n)
        for n in names
    ]
    return F.to_json(F.struct(*cols))


def listing_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl jobs of twenty listing pages each, with JSON rows; the row of a key comes twice, and
    junk elements, unfinished records and rows without id occur."""
    k = F.col("k")
    item = F.to_json(
        F.struct(
            (k % 10 + 1).cast("int").alias("serial_no"),
            F.col("published").alias("published_date"),
            F.concat(F.lit(" "), "closing").alias("closing_date"),
            F.col("opening").alias("opening_date"),
            F.when(k % 21 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" CP-"), k)).alias("tender_id"),
            F.when(k % 42 == 0, F.lit("")).otherwise(F.col("title")).alias("title"),
            F.when(k % 5 == 0, F.lit(" ")).otherwise(F.col("organisation")).alias("organisation"),
            F.when(k % 7 != 0, F.concat(F.lit("/cppp/tendersfullview/"), k)).alias("detail_path"),
            F.lit("--").alias("corrigendum"),
        )
    )
    items = order_items(spark, sf_dir)
    # A second, changed copy of every eighth item follows on the same page.
    # The copy is not a retry: its title differs, so it shows which one wins.
    doubled = items.withColumn("_copy", F.explode(F.expr("if(k % 8 = 0, array(0, 1), array(0))"))).withColumn(
        "title", F.concat("title", F.when(F.col("_copy") == 1, " again").otherwise(""))
    ).withColumn("_json", item)
    page = F.col("page_no")
    pages = doubled.groupBy("page_no").agg(
        F.array_sort(F.collect_list(F.struct("k", "_copy", "_json"))).alias("_items")
    ).select(
        page,
        built("json", F.concat(
            F.lit('{"tenders": ["junk", 7, null, '),
            F.array_join(F.transform("_items", lambda i: i["_json"]), ", "),
            F.lit('], "page_number": '), page, F.lit(', "total_records": "'), page * 10, F.lit('"}'),
        )),
    )
    record = F.struct(
        F.concat(F.lit("https://eprocure.gov.in/cppp?page="), page).alias("url"),
        F.when(page % 9 == 0, "errored").otherwise("completed").alias("status"),
        "json", F.lit(None).cast("string").alias("html"),
    )
    return pages.groupBy(F.expr("(page_no - 1) div 20").alias("_job")).agg(
        F.array_sort(F.collect_list(F.struct(page, record.alias("r")))).alias("_recs")
    ).select(
        F.concat(F.lit("job-"), "_job").alias("job_id"), F.lit("completed").alias("status"),
        F.size("_recs").alias("total"), built("records", F.transform("_recs", lambda x: x["r"])),
    )


def detail_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One crawl job per part, by key modulo 6: JSON, empty JSON with HTML, expired HTML, failed
    record followed by JSON, HTML followed by JSON, nothing."""
    values = part_details(spark, sf_dir)
    names = [n for row in DETAIL_ROWS for _, n in row if n != "pre_bid_meeting_date"]
    v = values.select(
        "k", "url", X.once(detail_json_text(names).alias("_json"), detail_html(values).alias("_html"))
    )
    none = F.lit(None).cast("string")

    def rec(status, js, html):
        return F.struct(
            F.col("url"), F.lit(status).alias("status"), js.alias("json"), html.alias("html")
        )

    way = F.col("k") % 6
    records = (
        F.when(way == 0, F.array(rec("completed", F.col("_json"), none)))
        .when(way == 1, F.array(rec("completed", F.lit('{"tender_id": null}'), F.col("_html"))))
        .when(way == 2, F.array(rec("completed", none, F.concat(F.lit("<p>Your Session</p>"), "_html"))))
        .when(way == 3, F.array(rec("errored", F.lit('{"tender_id": "wrong"}'), none), rec("completed", F.col("_json"), none)))
        .when(way == 4, F.array(rec("completed", none, F.col("_html")), rec("completed", F.col("_json"), none)))
        .otherwise(F.array(rec("completed", F.lit("{}"), F.lit("<p>nothing here</p>"))))
    )
    return v.select(
        "k", "url", F.concat(F.lit("D-"), "k").alias("job_id"), F.lit("completed").alias("status"),
        F.when(way.isin(3, 4), 2).otherwise(1).alias("total"), built("records", records),
    )


def order_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as stored notices: the status letter is the detail flag (null for P)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("id"),
        F.concat(F.lit("REF-"), k).alias("ref_no"),
        F.when(k % 3 == 0, "cppp").otherwise("eprocure").alias("source"),
        F.concat(F.lit("Order "), k, F.lit(" "), "o_orderpriority").alias("title"),
        F.concat(F.lit("Customer "), "o_custkey").alias("organisation"),
        F.col("o_orderdate").alias("published_date"),
        F.col("o_totalprice").alias("tender_value"),
        F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
        .alias("detail_scraped"),
        F.when(k % 4 != 0, F.array(F.lit(1.0).cast("float"))).alias("embedding"),
        F.col("o_orderdate").alias("updated_at"),
    )
