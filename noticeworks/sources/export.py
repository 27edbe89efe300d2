"""Response export: seven listing fields per item and an envelope per source."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from noticeworks import model as M
from noticeworks.functions import status as S
from noticeworks.operators import listing as L


def response_items(rows: DataFrame) -> DataFrame:
    return rows.select(*M.LISTING_FIELDS)


def response_envelope(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """Per source: success, item count, pages, live notices and the error, if any.

    A source of which only challenge pages are stored has failed. Both inputs are reduced to one
    row per source before they meet, and the items themselves are exported beside the envelope
    instead of inside it, whatever their number.
    """
    counts = rows.groupBy("source").agg(F.count("*").alias("count"))
    readable = pages.select("source", (~S.challenge_page(F.col("html"))).alias("_readable")).groupBy("source").agg(
        F.max("_readable").alias("success"))
    seen = L.live_counts(pages).join(readable, "source")
    return seen.join(counts, "source", "left").select(
        "success", "source",
        F.coalesce("count", F.lit(0)).alias("count"),
        "total_pages", "live_tenders",
        F.when(~F.col("success"), M.CHALLENGE_ERROR).alias("error"),
    )


def write_response(rows: DataFrame, path: str) -> None:
    """Items as JSON lines, null fields included."""
    response_items(rows).write.option("ignoreNullFields", "false").mode("errorifexists").json(path)
