"""Stored crawl results: one JSON document per job with its records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from noticeworks import model as M


def read_crawl_results(spark: SparkSession, path: str) -> DataFrame:
    """Crawl results with a declared schema, so nothing is inferred.

    The JSON of a record is kept whole as a VARIANT: the reader parses it, once, and every field is
    taken from that. A line that is no JSON gives a row with its text in ``corrupt`` and nothing else.
    """
    return spark.read.schema(M.CRAWL_RESULT_SCHEMA).option("columnNameOfCorruptRecord", "corrupt").json(path)
