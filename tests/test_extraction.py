import random

import pytest
from pyspark.sql import functions as F

from noticeworks import model as M
from noticeworks.operators import detail as D, listing as L, tokenise as T
from noticeworks.operators.flatrows import flatten_tables

HEADER = "<tr><th>S.No</th><th>Title and Ref.No.</th></tr>"


def row(*cells):
    return "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"


def page(body, opening='<table id="table">'):
    return f"<html><table><tr><td>{opening}{body}</table></td></tr></table></html>"


@pytest.fixture
def pages(spark):
    def make(*bodies):
        rows = [(i, "eprocure", "u", i + 1, h) for i, h in enumerate(bodies)]
        return spark.createDataFrame(rows, M.PAGE_SCHEMA)

    return make


def extract(df, **kw):
    return [r.asDict() for r in L.extract_listing(df, **kw).orderBy("ingest_ord").collect()]


KIT = "Supply of medical kit"
ROWS = (
    HEADER
    + row("1.", "p", "c", "o", f'<a href="/eprocure/app?x=1">[{KIT} A][R1][I]</a>', "Org")
    + row("2.", "p", "c", "o", f"<a href='http://h/x'>{KIT} five</a>")
    + row("3.", "p", "c", f"{KIT} only four cells")
    + row("4", "", "", "", "short")
    + row("5.", "p", "c", "o", f"{KIT} no link", " Org ")
)


def check_rows(rows):
    assert [(r["title"], r["ref_no"], r["organisation"], r["url"]) for r in rows] == [
        (f"{KIT} A", "R1", "Org", "https://eprocure.gov.in/eprocure/app?x=1"),
        (f"{KIT} five", "", "", "http://h/x"),
        (f"{KIT} no link", "", "Org", None),
    ]
    assert [r["ingest_ord"]["row_ord"] for r in rows] == [1, 2, 5]


def test_listing_page(pages):
    check_rows(extract(pages(page(ROWS)), strict=False))


def test_strict_path_reads_the_same(pages):
    # A comment inside a tag-like string and a script make the native path step aside.
    body = ROWS.replace("Org</td>", "Org<script></script></td>")
    check_rows(extract(pages(page(body))))


def test_implied_ends_and_upper_case(pages):
    body = ROWS.replace("</td>", "").replace("</tr>", "").replace("<td>", "<TD class=x>").replace("<tr>", "<TR>")
    check_rows(extract(pages(page(body)), strict=False))


@pytest.mark.parametrize("opening, found", [
    ('<table id="table">', True), ("<TABLE border=1 ID=table >", True), ('<table class="a list_table b">', True),
    ("<table class=list>", True), ('<table class="list">', True), ('<table id="table2">', False),
    ('<table class="list_tables">', False), ('<table class="my-list">', False), ("<table data-id='table'>", False),
])
def test_table_selectors(pages, opening, found):
    assert bool(extract(pages(page(ROWS, opening)), strict=False)) is found
    broken = page(ROWS + "<!-- x --><tr><td><script>1</script></td></tr>", opening)
    assert bool(extract(pages(broken))) is found


def test_first_selector_with_rows_wins(pages):
    empty = "<table id='table'></table>"
    second = "<table class='list_table'>" + ROWS + "</table>"
    third = "<table class='list'>" + ROWS.replace("medical", "surgical") + "</table>"
    check_rows(extract(pages(empty + third + second), strict=False))


def test_head_rows_of_list_tables_do_not_count(pages):
    html = "<table class=list><thead>" + row("1", "p", "c", "o", KIT + " in head") + "</thead><tbody>" + ROWS + "</tbody></table>"
    assert len(extract(pages(html), strict=False)) == 3
    assert len(extract(pages(html.replace("Org<", "Org<script></script><")))) == 3


def test_header_prefix_is_contiguous_and_at_most_five(pages):
    opening = row("1", "p", "c", "o", "Opening works and supply")
    plain = row("2", "p", "c", "o", KIT + " plain")
    assert len(extract(pages(page(opening * 3 + plain + opening)), strict=False)) == 2
    assert len(extract(pages(page(opening * 7)), strict=False)) == 2


def test_page_cap_and_challenge(pages):
    df = pages(page(ROWS), page(ROWS), page(ROWS) + "<img src=captcha.png>")
    assert {r["ingest_ord"]["page_no"] for r in extract(df, strict=False)} == {1, 2}
    assert {r["ingest_ord"]["page_no"] for r in extract(df, page_cap=1, strict=False)} == {1}


def test_nested_tables(pages):
    body = HEADER + row("1", "p", "c", "o", f"{KIT} <table><tr><td>deep</td></tr></table> end", "Org")
    got = extract(pages(page(body)))
    assert [(r["title"], r["organisation"]) for r in got] == [(f"{KIT} deep end", "deep")]


def test_entities_outside_the_native_set(pages):
    body = row("1", "p", "c", "o", "Supply of caf&eacute; &rarr; tables &amp; more", "AT&T&#160;Org")
    got = extract(pages(page(body)))
    assert [(r["title"], r["organisation"]) for r in got] == [("Supply of café → tables & more", "AT&T Org")]


def test_live_count_uses_the_last_page(pages):
    df = pages(page(row("41.", 1, 2, 3, 4) + row("x", 1, 2, 3, 4)), page(row("7..", 1, 2, 3, 4) + row("99", 1)))
    assert [r.asDict() for r in L.live_counts(df).collect()] == [{"source": "eprocure", "total_pages": 2, "live_tenders": 7}]
    none = pages(page(row("41.", 1, 2, 3, 4)), page(row("x", 1, 2, 3, 4)))
    assert L.live_counts(none).head()["live_tenders"] is None


DETAIL = """<td class="navigation">Product Category<script>function popup(){}</script></td>
<table class='tablebg'><tr><td class="td_caption"><b>Tender Value in &#8377; </b></td><td class="td_field">3,86,15,626</td>
<td class="td_caption">Product Category</td><td> Electrical <b> Works </b></td><td class=td_caption>Sub category</td><td>NA</td></tr></table>
<table class="x tablebg"><tr><td class='td_caption'>Location</td><td>&nbsp;Pune &amp; Goa</td><td class='td_caption'>Pincode</td></tr>
<tr><td class='td_caption'>Work Location</td><td>Elsewhere</td><td class='td_caption'>Bid Validity(Days)</td><td>1,200 Days</td></tr></table>"""


def test_detail_page(spark):
    df = spark.createDataFrame([("u", DETAIL)], "url string, html string")
    for strict in (False, True):
        got = {k: v for k, v in D.extract_detail(df, strict).head().asDict().items() if v is not None}
        assert got == {
            "url": "u", "tender_value": 38615626.0, "product_category": "ElectricalWorks", "location": "Pune & Goa",
            "bid_validity_days": 1,
        }


def test_first_caption_wins_even_without_value(spark):
    html = "<table class=tablebg>" + "".join(
        f"<tr><td class=td_caption>{c}</td><td>{v}</td></tr>" for c, v in
        [("Organisation Name", "NA"), ("Name", "Officer"), ("Email Address", "a@b"), ("Address", "Road 1")]
    ) + "</table>"
    got = D.extract_detail(spark.createDataFrame([(html,)], "html string"), strict=False).head()
    assert got["inviting_authority_name"] is None and got["inviting_authority_address"] == "a@b"


def test_captions_of_nested_tables(spark):
    inner = "<table class=tablebg><tr><td class=td_caption>Pincode</td></tr><tr><td class=td_caption>Location</td><td>Goa</td></tr></table>"
    html = f"<table class=tablebg><tr><td class=td_caption>Tender Type</td><td>Open {inner}</td></tr></table>"
    got = D.extract_detail(spark.createDataFrame([(html,)], "html string")).head()
    assert got["location"] == "Goa" and got["pincode"] is None


def test_flatten_tables_keeps_text_nodes_apart():
    html = "<table class=tablebg><tr><td class=td_caption> A <b> B </b></td><td><a href='?x=1&y=2'>L</a><script>if (a<b) {}</script></td></tr></table>"
    assert flatten_tables(html, "detail") == [
        '<td class="td_caption"> A <br> B </td><td class=""><a href="?x=1&amp;y=2"></a>L<br>if (a&lt;b) {}</td>'
    ]


def test_cells_and_neighbours(pages):
    got = T.cells(pages(page(row("a", "-", "<a href=/x>b</a>"))), strict=False).orderBy("cell_ord").collect()
    assert [(r["text"], r["href"], r["next_text"]) for r in got] == [("a", None, None), ("-", None, "b"), ("b", "/x", None)]


def test_the_code_of_typed_rows_is_short_enough_to_be_compiled(spark, pages):
    """The JVM never compiles methods of more than 8,000 bytes."""
    from noticeworks.catalog.extraction import typed

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = typed(L.extract_listing(pages(page(ROWS))))._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages, sizes = debug.codegenStringSeq(plan).iterator(), []
    while stages.hasNext():
        sizes.append(stages.next()._3().maxMethodCodeSize())
    assert sizes[-1] < 8000  # fields, validity and dates of a row


def test_header_prefix_stops_at_the_first_other_row(spark):
    head, other = "<td>Title</td>", "<td>road</td>"
    given = [[], [other], [head], [head, head, other, head], [head] * 7, [other, head], None, [head, None, other]]
    df = spark.createDataFrame(list(enumerate(given)), "i int, rows array<string>")
    assert [r[0] for r in df.orderBy("i").select(L.header_rows(F.col("rows"))).collect()] == [0, 0, 1, 2, 5, 0, None, 2]


def test_the_inside_of_a_cell_is_found_once(pages):
    plan = T.cells(pages(page(ROWS)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(T._CELL_EDGES) == 1
    body = row("a &lt; b", "x <b> y </b> &amp;", "a < b", "", "<br>", " - ")
    got = T.cells(pages(page(body)), strict=False).orderBy("cell_ord").collect()
    assert [(r["text"], r["node_text"], r["next_text"]) for r in got] == [
        ("a < b", "a < b", "xy&"), ("x  y  &", "xy&", "a < b"), ("a < b", "a < b", None),
        ("", "", None), ("", "", None), ("-", "-", None)]


def test_real_pages_have_no_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert T.with_rows(df, "listing", strict=False).where(F.size("rows") > 0).count() == 0


def test_both_tokenizers_agree_on_random_pages(spark):
    """A script in a last extra row sends the same page down the strict path."""
    rng = random.Random(7)
    bits = ["supply", " ", "\n", "<b>", "</b>", "<br>", "<a href='/x?a=1&amp;b=2'>", "</a>", "&amp;", "&nbsp;", "9", ".", "₹",
            "<img src=x>", "&lt;", "é", " [ref] ", "<!-- note -->", "<A HREF=http://h/1>"]

    def cell():
        end = rng.choice(["</td>", "</TD>", "", "</td >"])
        cls = rng.choice(["", " class=td_caption", " class='a td_caption b'", ' CLASS="td_field"'])
        return f"<td{cls}>" + "".join(rng.choice(bits) for _ in range(rng.randrange(8))) + end

    pages = []
    for i in range(120):
        rows = "".join("<tr>" + "".join(cell() for _ in range(rng.randrange(7))) + rng.choice(["</tr>", ""]) for _ in range(rng.randrange(6)))
        pages.append((i, rows))
    df = spark.createDataFrame(pages, "page_id int, rows string")
    body = lambda extra: F.concat(F.lit('<table class="tablebg" id="table">'), "rows", F.lit(extra + "</table>"))
    for kind in ("listing", "detail"):
        native = T.cells(df.select("page_id", body("<tr><td>x</td></tr>").alias("html")), kind, strict=False)
        strict = T.cells(df.select("page_id", body("<tr><td>x<script></script></td></tr>").alias("html")), kind)
        key = lambda r: (r["page_id"], r["row_ord"], r["cell_ord"])
        assert sorted(native.collect(), key=key) == sorted(strict.collect(), key=key)


def test_plain_markup_is_read_as_the_parser_reads_it():
    from noticeworks.operators import flatrows as R

    rng = random.Random(7)
    plain = ["<table id=table>", "<table class='a list'>", '<table class="tablebg">', "</table>", "<tr>", "</TR>", "<thead>", "</thead>",
             "<td class='td_caption x'>", "<td>", "</td>", "<a href='/x?a=1&amp;b=2'>", "<a href>", "</a>", "p &amp; q", "&#8377; 5", "&copy",
             "<br/>", "<!-- <td>c</td> -->", "<script>var t = '<table id=x>';</script>", "<td class='a' class=b>", " "]
    odd = ["a < b", "<!-- a -- b -->", "<!DOCTYPE html>", "<script>a</b></script>", "<td a='>'>", "<td class=a/>", "</ td>", "<title>x</title>", "&"]
    for n in range(3000):
        html = "".join(rng.choice(plain if n % 2 else plain + odd) for _ in range(rng.randint(1, 25)))
        for kind in ("listing", "detail", "any"):
            want = R._TableReader(kind)
            want.feed(html)
            want.close()
            assert R._read(html, kind).found == want.found, html
        assert n % 2 == 0 or R._TableReader("any").read(html), html


def test_header_text_is_computed_once_a_row(spark, pages):
    """One mention of each of the first rows in the plan, and none inside a lambda."""
    df = spark.range(1).select(F.array(F.lit("x")).alias("rows")).select(L.header_rows(F.col("rows")).alias("n"))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("lower(") == M.HEADER_SCAN_ROWS and "lambda" not in plan
    for rows, want in ((None, None), ([], 0), (["<td>S.No</td>"] * 2, 2), (["<td>Title</td>", "<td>a</td>", "<td>Title</td>"], 1), (["<td>Title</td>"] * 9, 5)):
        got = spark.createDataFrame([(rows,)], "rows array<string>").select(L.header_rows(F.col("rows"))).head()[0]
        assert got == want


def test_texts_of_rows_are_compiled(pages):
    """The step of the row texts holds no lambda, so Spark compiles it; a lambda beside it would have it interpreted."""
    plan = L.candidate_rows(pages(page(ROWS)))._jdf.queryExecution().executedPlan().toString()
    steps = [line for line in plan.splitlines() if "Generate inline" in line and "row_text" in line]
    assert steps and all("*(" in line for line in steps)


def test_tables_of_very_many_tags(pages):
    """Tables are read tag by tag up to their end, whatever their length, and all rows come out."""
    body = HEADER + row("1.", "<b>p</b>" * 30_000, "c", "o", f"[{KIT} A][R1][I]", "A &amp; B<br>&lt;C") * 2
    got = extract(pages(page(body) + "<table id=table></tr>", page(body).replace("</table>", "")), strict=False)
    assert [(r["title"], r["organisation"]) for r in got] == [(f"{KIT} A", "A & B<C")] * 4


def test_plain_reader_adds_no_breaks_and_agrees_with_the_parser(monkeypatch):
    """Markup in upper case, nested tables, links and raw text: read without a look at any break between nodes."""
    from noticeworks.operators import flatrows

    html = page("<TR><TD>a<b>b</b>&amp;c<table><tr><td><a href='/x?a&amp;b'>d</a></td></tr></table>e</TD>f"
                "<script>var x = '<td>';</script><td class=x>g</td></tr>")
    slow = flatrows._TableReader("listing")
    slow.feed(html)
    slow.close()
    monkeypatch.setattr(flatrows._TableReader, "_break_nodes", lambda self: 1 / 0)
    fast = flatrows._TableReader("listing")
    assert fast.read(html) and fast.rows() == slow.rows() and len(fast.rows()) == 2


def test_pages_without_the_challenge_word_are_searched_once(pages):
    forms = ["<img src='/captcha.png'>", "<IMG alt=CaPtcha>", "<div id=captchaImage>", "<img src='/CAPTCHA.png'>", "captcha", ""]
    df = pages(*forms, None)
    got = [r["is_challenge"] for r in L.page_flags(df).orderBy("page_id").collect()]
    assert got == [True, True, True, False, False, False, None]
    plan = L.without_challenges(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE (?i)captcha" in plan or "(?i)captcha)" in plan
