"""Filters over the notice table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def search_notices(
    notices: DataFrame,
    published_from=None,
    published_to=None,
    organisation: str | None = None,
    min_value: float | None = None,
    max_value: float | None = None,
) -> DataFrame:
    """Notices by publication range (end excluded), organisation and value range.

    Every condition is a plain comparison on a stored column, so it reaches the Parquet scan.
    """
    conditions: list[Column] = []
    if published_from is not None:
        conditions.append(F.col("published_date") >= F.lit(published_from).cast("timestamp_ntz"))
    if published_to is not None:
        conditions.append(F.col("published_date") < F.lit(published_to).cast("timestamp_ntz"))
    if organisation is not None:
        conditions.append(F.col("organisation") == organisation)
    if min_value is not None:
        conditions.append(F.col("tender_value") >= min_value)
    if max_value is not None:
        conditions.append(F.col("tender_value") <= max_value)
    for c in conditions:
        notices = notices.where(c)
    return notices


def scan_notices(
    notices: DataFrame, columns: list[str], null_column=None, equals: dict | None = None,
    limit: int | None = None, order: str = "id",
) -> DataFrame:
    """Projection with null and equality filters and an ordered limit (a top-n, no full sort)."""
    if null_column:
        notices = notices.where(F.col(null_column).isNull())
    for name, value in (equals or {}).items():
        notices = notices.where(F.col(name) == value)
    if limit is not None:
        notices = notices.orderBy(order).limit(limit)
    return notices.select(*columns)


def sample_rows(rows: DataFrame, n: int = 3) -> DataFrame:
    """The first rows in ingest order with shortened title and organisation."""
    return (
        rows.orderBy("ingest_ord").limit(n)
        .select(
            F.substring("title", 1, 80).alias("title"),
            "ref_no", "closing_date",
            F.substring("organisation", 1, 50).alias("organisation"),
        )
    )
