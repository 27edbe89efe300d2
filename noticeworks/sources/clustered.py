"""A search copy of the notices: files laid out for the search filters.

The copy is partitioned by source and publication month, and within that range-clustered and sorted
by organisation. A search reads the folders of its months only; in those files the footers' minima
and maxima and a Bloom filter on the organisation tell which row groups can hold it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from noticeworks.operators import search

MONTH = "published_month"
_NO_DATE = "none"
# Distinct organisations that the Bloom filter of a row group is sized for.
ORGANISATIONS = 100_000


def _month(date: Column) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(_NO_DATE))


def write_search_copy(notices: DataFrame, path: str, organisations: int = ORGANISATIONS) -> None:
    """Write the copy; notices have source, organisation, published_date and any further columns.

    Ranges go on by date and by all keys' hash, so that one organisation that holds a large part of
    a month is spread over files, too.
    """
    spread = F.xxhash64(*[c for c in ("ref_no", "title") if c in notices.columns], "published_date")
    keys = ["source", MONTH, "organisation", "published_date"]
    laid = notices.withColumn(MONTH, _month(F.col("published_date"))).withColumn("_spread", spread)
    laid.repartitionByRange(*keys, "_spread").sortWithinPartitions(*keys).drop("_spread").write.partitionBy(
        "source", MONTH).option("parquet.bloom.filter.enabled#organisation", "true").option(
        "parquet.bloom.filter.expected.ndv#organisation", str(organisations)).parquet(path)


def search_copy(
    spark: SparkSession, path: str, published_from=None, published_to=None, source: str | None = None, **more,
) -> DataFrame:
    """The notices of the copy that pass the filters of ``search.search_notices``, and of one source if named."""
    notices = spark.read.option("basePath", path).parquet(path)
    if source is not None:
        notices = notices.where(F.col("source") == source)
    # The same range by month: it only chooses folders.
    if published_from is not None:
        notices = notices.where(F.col(MONTH) >= _first_month(published_from))
    if published_to is not None:
        notices = notices.where(F.col(MONTH) <= _first_month(published_to))
    if published_from is not None or published_to is not None:
        notices = notices.where(F.col(MONTH) != _NO_DATE)
    return search.search_notices(notices, published_from, published_to, **more).drop(MONTH)


def _first_month(date) -> str:
    when = dt.datetime.fromisoformat(date) if isinstance(date, str) else date
    return when.strftime("%Y-%m")
