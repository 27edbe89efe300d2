"""Stored listing and detail pages, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from noticeworks import model as M


def read_pages(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Pages stored as Parquet; columns that a query does not use are never read."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_page_files(spark: SparkSession, path: str, source: str = M.PRIMARY_SOURCE) -> DataFrame:
    """Pages stored as one HTML file each; the page number is the last number in the file name."""
    files = spark.read.text(path, wholetext=True).withColumn("url", F.input_file_name())
    number = F.regexp_extract("url", r"(\d+)[^0-9/]*$", 1).try_cast("bigint")
    return files.select(
        number.alias("page_id"), F.lit(source).alias("source"), "url",
        number.alias("page_no"), F.col("value").alias("html"),
    )


def stream_pages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Pages arriving as Parquet files below a folder."""
    reader = spark.readStream.schema(M.PAGE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
