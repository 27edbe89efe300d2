"""Incremental runs: newly arrived pages."""

from __future__ import annotations

import functools
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from noticeworks.operators import listing as L, merge
from noticeworks.session import read_text
from noticeworks.sources.pages import stream_pages
from noticeworks.sources.store import NoticeTable


def stream_id(spark: SparkSession, checkpoint: str):
    """A function that gives the id Spark keeps in a checkpoint; the file is read once, while the stream runs."""
    return functools.cache(lambda: json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"])


def upsert_new_pages(
    spark: SparkSession,
    page_dir: str,
    table: NoticeTable,
    checkpoint: str,
    updated_at,
    files_per_batch: int | None = None,
    strict: bool = True,
):
    """Extract and upsert all pages that arrived since the last run, then stop.

    Each batch leaves its rows beside the table, and the table takes all of them in one write at the
    end: its buckets are rewritten once a run, however many batches the run has. The checkpoint
    remembers the files that were read; the table remembers the last batch of each stream, so a
    batch that is replayed after a failure changes nothing, and what a failed run has left is taken
    by the next. A stream is told by the id that Spark keeps in its checkpoint: a new or reset
    checkpoint is another stream.
    """
    pages = stream_pages(spark, page_dir, files_per_batch)

    stream = stream_id(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        cores = spark.sparkContext.defaultParallelism
        # A batch may have fewer files than there are cores.
        dealt = batch if batch.rdd.getNumPartitions() >= cores else batch.repartition(cores, "page_id", "page_no", "url")
        table.hold(merge.notice_rows(L.extract_listing(dealt, strict=strict)), stream(), batch_id)

    query = (
        pages.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    table.take_held(stream(), updated_at)
    return query
