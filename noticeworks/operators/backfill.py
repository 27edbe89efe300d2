"""Backfill of snapshot payload items into the notice table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from noticeworks import model as M
from noticeworks.functions import text as X
from noticeworks.operators import crawljson as J, dedup


def backfill_rows(items: DataFrame) -> DataFrame:
    """Raw payload items to notice rows without detail.

    ``items`` carries the listing fields, an optional map ``fields`` with everything the payload
    held (its unknown keys end up in raw_data) and ``ingest_ord``.
    """
    raw = (
        J.unknown_fields(F.col("fields"), M.LISTING_FIELDS)
        if "fields" in items.columns
        else F.create_map().cast("map<string,string>")
    )
    return items.select(
        X.key_or_missing(F.col("ref_no")).alias("ref_no"),
        F.lit(M.PRIMARY_SOURCE).alias("source"),
        X.strip(F.coalesce("title", F.lit(""))).alias("title"),
        X.blank_to_null(F.col("organisation")).alias("organisation"),
        X.strip(F.coalesce("url", F.lit(""))).alias("url"),
        *[X.notice_date(F.col(d)).alias(d) for d in M.DATE_FIELDS],
        F.lit(False).alias("detail_scraped"),
        F.lit(True).alias("is_active"),
        raw.alias("raw_data"),
        "ingest_ord",
    )


def _is_bad() -> Column:
    return (F.col("title") == "") | (F.col("url") == "")


def backfill_inserts(items: DataFrame, existing: DataFrame) -> DataFrame:
    """The rows a backfill inserts: complete, not stored yet, last one per key."""
    return inserts_of(backfill_rows(items), existing)


def inserts_of(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """The same from notice rows. Keys are reduced first, so the check against the stored keys sees every key once and rows
    that share the missing-key marker cannot pile up in the join.
    """
    complete = rows.where(X.whole(~_is_bad()))
    latest = dedup.last_wins(complete, M.NOTICE_KEY, "ingest_ord").drop("ingest_ord")
    return latest.join(existing.select("ref_no").distinct(), "ref_no", "left_anti")


def backfill_counters(items: DataFrame, existing: DataFrame) -> DataFrame:
    """One row: items read, rejected as bad, already stored, duplicate in the snapshot, inserted."""
    return counters_of(backfill_rows(items), existing)


def counters_of(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """The same from notice rows. A row is rejected for the first reason that holds, in that order. Rows are counted per key
    before the stored keys are looked up, and duplicates follow from those counts: nothing is
    ranked, and the join sees every key at most twice.
    """
    per_key = (
        rows
        .groupBy(_is_bad().alias("bad"), "ref_no", "source")
        .agg(F.count("*").alias("n"))
    )
    known = existing.select("ref_no").distinct().withColumn("_known", F.lit(True))
    looked_up = per_key.join(known, "ref_no", "left")
    stored = ~F.col("bad") & F.col("_known").isNotNull()
    fresh = ~F.col("bad") & F.col("_known").isNull()

    def total(condition, value="n"):
        return F.coalesce(F.sum(F.when(condition, F.expr(value))), F.lit(0))

    return looked_up.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        total(F.col("bad")).alias("skipped_bad"),
        total(stored).alias("skipped_existing"),
        total(fresh, "n - 1").alias("skipped_duplicate"),
        F.count_if(fresh).alias("inserted"),
    )
