"""Listing pages to listing rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import IntegerType

from noticeworks import model as M
from noticeworks.functions import notice as N, status as S, text as X
from noticeworks.operators import tokenise as K
from noticeworks.operators.flatrows import last_number


def header_rows(rows: Column) -> Column:
    """Length of the contiguous header prefix among the first rows."""
    # Row after row, from the last that is looked at inwards: no text behind the prefix is computed.
    length = F.lit(M.HEADER_SCAN_ROWS)
    for i in reversed(range(M.HEADER_SCAN_ROWS)):
        text = F.lower(K.row_text(F.get(rows, F.lit(i))))
        other = (F.size(rows) <= i) | ~X.contains_any(text, M.HEADER_ROW_WORDS)
        length = F.when(other, F.lit(i)).otherwise(length)
    return F.when(rows.isNotNull(), length)


def candidate_rows(pages: DataFrame, strict: bool = True, kept: Column | None = None) -> DataFrame:
    """Table rows after the header prefix that are long enough and have enough cells.

    Narrow: explodes the rows of a page inside the task that read the page. Adds ``row_ord``
    (position in the table, header rows counted) and the ``cells`` fragments. A page without a body
    for which ``kept`` holds gives one row without cells.
    """
    keys = [c for c in pages.columns if c != "html"]
    kept = F.lit(False) if kept is None else kept
    rows = K.with_rows(pages, "listing", strict).withColumn("_skip", header_rows(F.col("rows")))
    # The outer form: for the inner one the optimizer would add a filter on the row count below
    # it and tokenise every page a second time for that.
    body = rows.select(*keys, "_skip", F.posexplode_outer("rows").alias("row_ord", "_row")).where(
        X.whole(kept | (F.col("row_ord") >= F.col("_skip")))
    )
    # Texts and cells apart: Spark compiles the step of the texts only if it holds no lambda.
    texts = body.select(*keys, "row_ord", "_row", X.once(K.row_text(F.col("_row")).alias("row_text")))
    long = texts.where(X.whole(kept | (F.char_length("row_text") >= M.MIN_ROW_CHARS)))
    split = long.select(*keys, "row_ord", X.once(K.row_cells(F.col("_row")).alias("cells")))
    return split.where(kept | (F.size("cells") >= M.MIN_ROW_CELLS))


def project_rows(candidates: DataFrame) -> DataFrame:
    """Positional projection of the cells to listing fields, with title and reference split."""
    # A page's own URL gives way to the URL of each row's link.
    keys = [c for c in candidates.columns if c not in ("cells", *M.LISTING_FIELDS)]

    def cell(i):
        return F.get(F.col("cells"), F.lit(i))

    texts = candidates.select(
        *keys,
        K.cell_text(cell(1)).alias("published_date"),
        K.cell_text(cell(2)).alias("closing_date"),
        K.cell_text(cell(3)).alias("opening_date"),
        K.cell_text(cell(4)).alias("_title_ref"),
        F.coalesce(K.cell_text(cell(5)), F.lit("")).alias("organisation"),
        K.cell_href(cell(4)).alias("_href"),
    )
    title, ref = N.split_title_ref(F.col("_title_ref"))
    rest = [c for c in texts.columns if c not in ("_title_ref", "_href")]
    return texts.select(
        *rest, X.once(X.link_url(F.col("_href")).alias("url"), title.alias("title"), ref.alias("ref_no"))
    )


def valid_rows(rows: DataFrame, kept: Column | None = None) -> DataFrame:
    notice = N.is_notice(
        *[F.col(c) for c in ("title", "closing_date", "opening_date", "published_date", "organisation")])
    return rows.where(X.whole(notice if kept is None else kept | notice))


def _order(rows: DataFrame, source_rank: int) -> Column:
    page_id = F.col("page_id") if "page_id" in rows.columns else None
    return N.row_order(source_rank, F.col("page_no"), page_id, F.col("row_ord"))


def extract_listing(
    pages: DataFrame, source_rank: int = 1, page_cap: int | None = None, strict: bool = True
) -> DataFrame:
    """Raw listing pages to valid listing rows with an explicit order.

    No shuffle: everything happens in the task that reads a page. The page cap is a filter on
    ``page_no`` and reaches the scan. Challenge pages yield nothing.
    """
    capped = pages if page_cap is None else cap_pages(pages, page_cap)
    rows = valid_rows(project_rows(candidate_rows(without_challenges(capped), strict)))
    return rows.select("source", *M.LISTING_FIELDS, _order(rows, source_rank))


def extract_outcomes(
    pages: DataFrame, source_rank: int = 1, page_cap: int | None = None, strict: bool = True
) -> DataFrame:
    """Listing rows and the pages that were put aside, from one pass over the pages.

    ``outcome`` is ``row`` or ``quarantine``; a quarantined page is one row with its page_id,
    page_url and reason. Written with ``partitionBy("outcome")``, each kind is read by itself.
    """
    capped = pages if page_cap is None else cap_pages(pages, page_cap)
    has = [c for c in ("page_id", "url") if c in capped.columns]
    challenge = F.coalesce(S.challenge_page(F.col("html")), F.lit(False))
    flagged = capped.select(
        "source", "page_no", *[F.col(c).alias({"url": "page_url"}.get(c, c)) for c in has],
        X.once(challenge.alias("_aside"), F.when(~challenge, F.col("html")).alias("html")),
    )
    aside = F.col("_aside")
    rows = valid_rows(project_rows(candidate_rows(flagged, strict, aside)), aside)

    def of_page(name, kind):
        return (F.when(aside, F.col(name)) if name in rows.columns else F.lit(None)).cast(kind).alias(name)

    return rows.select(
        F.when(aside, "quarantine").otherwise("row").alias("outcome"), "source",
        *[F.when(~aside, F.col(c)).alias(c) for c in M.LISTING_FIELDS], _order(rows, source_rank),
        of_page("page_id", "bigint"), of_page("page_url", "string"), F.when(aside, M.CHALLENGE_ERROR).alias("reason"),
    )


def quarantine_counts(outcomes: DataFrame) -> DataFrame:
    """Per source: listing rows, and pages that were put aside."""
    return outcomes.groupBy("source").agg(
        F.count_if(F.col("outcome") == "row").alias("n_rows"),
        F.count_if(F.col("outcome") == "quarantine").alias("quarantined"),
    )


def cap_pages(pages: DataFrame, page_cap: int | None = M.DEFAULT_PAGE_CAP) -> DataFrame:
    """Pages up to the cap, all for None; page numbers start at 1."""
    return pages if page_cap is None else pages.where(F.col("page_no") <= page_cap)


def without_challenges(pages: DataFrame) -> DataFrame:
    return pages.where(~S.challenge_page(F.col("html")))


def page_flags(pages: DataFrame) -> DataFrame:
    """Per page: challenge page, expired session, next page available."""
    keys = [c for c in pages.columns if c != "html"]
    return pages.select(
        *keys,
        S.challenge_page(F.col("html")).alias("is_challenge"),
        S.session_expired(F.col("html")).alias("is_expired"),
        S.has_next_page(F.col("html")).alias("has_next"),
    )


@F.pandas_udf(IntegerType())
def page_live_count(html: pd.Series) -> pd.Series:
    """Serial number in the last numbered row of a page: the number of live notices so far.

    Rows of all tables count, nested ones too, as a parser sees them. Use it on last pages only.
    """
    return html.map(lambda h: last_number(h, M.MIN_ROW_CELLS) if isinstance(h, str) else None).astype("Int32")


def live_counts(pages: DataFrame) -> DataFrame:
    """Pages and live-notice count per source; only the last page of a source is parsed.

    The page numbers are read by themselves first; of several stored copies of a last page the
    largest count holds.
    """
    last = pages.groupBy("source").agg(F.max("page_no").alias("total_pages"))
    ends = last.select(F.col("source").alias("_source"), F.col("total_pages").alias("_last"))
    bodies = pages.join(ends, (F.col("source") == F.col("_source")) & (F.col("page_no") == F.col("_last")), "left_semi")
    counts = bodies.select(F.col("source").alias("_of"), page_live_count("html").alias("_live")).groupBy("_of").agg(
        F.max("_live").alias("live_tenders"))
    return last.join(counts, F.col("source") == F.col("_of"), "left").select("source", "total_pages", "live_tenders")


def observe_live(pages: DataFrame, observation: Observation) -> DataFrame:
    """Attach the last page to a scan, so that a run needs no second pass for its counts.

    Each task remembers the body of its last page, nothing is parsed on the way, and repeated
    tasks do not matter, since both values are maxima. ``live_seen`` reads the counts.
    """
    return pages.observe(
        observation, F.max("page_no").alias("total_pages"), F.max_by("html", "page_no").alias("last_page"))


def live_seen(observation: Observation) -> dict:
    """total_pages and live_tenders of the pages that a written frame has passed."""
    seen = observation.get
    page = seen.get("last_page")
    return {
        "total_pages": seen.get("total_pages"),
        "live_tenders": last_number(page, M.MIN_ROW_CELLS) if page is not None else None,
    }
