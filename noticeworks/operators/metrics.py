"""Data-completeness metrics and run counters, each in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from noticeworks import model as M
from noticeworks.functions import text as X


def status_metrics(notices: DataFrame, crawl_enabled: bool = True) -> DataFrame:
    """Counts of all, detailed, pending and not yet embedded notices, and the last update.

    A notice whose detail flag is null is in neither of the two detail counts.
    """
    return notices.agg(
        F.count("*").alias("tender_count"),
        F.count_if("detail_scraped").alias("detail_scraped_count"),
        F.count_if(~F.col("detail_scraped")).alias("pending_detail_count"),
        F.count_if(F.col("embedding").isNull()).alias("embedding_pending_count"),
        F.lit(crawl_enabled).alias("cloudflare_enabled"),
        F.max("updated_at").alias("last_updated_at"),
    )


def status_of_parts(parts: DataFrame, crawl_enabled: bool = True) -> DataFrame:
    """The same metrics from counts of parts: rows, detailed, undetailed, updated_at, embedded."""
    def total(c):
        return F.coalesce(F.sum(c), F.lit(0))

    return parts.agg(
        total("rows").alias("tender_count"),
        total("detailed").alias("detail_scraped_count"),
        total("undetailed").alias("pending_detail_count"),
        (total("rows") - total("embedded")).alias("embedding_pending_count"),
        F.lit(crawl_enabled).alias("cloudflare_enabled"),
        F.max("updated_at").alias("last_updated_at"),
    )


def run_counters(merged: DataFrame) -> DataFrame:
    """Per source: rows, rows with a URL, rows that a detail record was merged into, notice keys.

    ``merged`` holds listing rows after the detail merge. Rows are first reduced to one per
    key, so a key shared by very many rows costs one row per task.
    """
    per_key = merged.groupBy("source", X.key_or_missing(F.col("ref_no")).alias("_key")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("url") != "").alias("with_url"),
        F.count_if("detail_merged").alias("merged"),
    )
    return per_key.groupBy("source").agg(
        F.sum("n").alias("scraped"),
        F.sum("with_url").alias("with_url"),
        F.sum("merged").alias("merged"),
        F.count("*").alias("upserted"),
        F.coalesce(F.sum(F.when(F.col("_key") == M.MISSING_KEY, F.col("n") - 1)), F.lit(0)).alias(
            "lost_to_missing_key"
        ),
    )


def extractable_urls(chain: DataFrame) -> DataFrame:
    """One row: URLs with extractable data and all URLs, from the fallback chain's routes."""
    return chain.agg(
        F.count_if(F.col("route") != "none").alias("extractable"), F.count("*").alias("total")
    )


def last_updated(notices: DataFrame) -> DataFrame:
    """The newest update time; a top-1 that each task reduces before anything moves."""
    return (
        notices.select("updated_at").where(F.col("updated_at").isNotNull())
        .orderBy(F.desc("updated_at")).limit(1)
    )
