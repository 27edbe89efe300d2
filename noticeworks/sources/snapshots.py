"""Snapshots of runs: all item rows plus one header row per run.

A snapshot has no upper size, so its items are stored as rows (one folder per run),
not as one array. ``payload_chunks`` and ``unpack`` convert to and from the array form, with one
array per listing page, which bounds each array by what a page holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from noticeworks.session import path_exists


def run_header(items: DataFrame) -> DataFrame:
    """Run header rows from item rows that carry their run columns."""
    return items.groupBy("snapshot_id", "source").agg(
        F.max("scraped_at").alias("scraped_at"),
        F.max("live_tenders").alias("live_tenders"),
        F.count("*").alias("count"),
    )


def latest_header(headers: DataFrame) -> DataFrame:
    """The one newest run, as the single row with id 1."""
    newest = headers.agg(
        F.max_by(F.struct(*headers.columns), F.struct("scraped_at", "snapshot_id")).alias("_h")
    ).where(F.col("_h").isNotNull())
    return newest.select(F.lit(1).alias("id"), "_h.*", F.col("_h.scraped_at").alias("updated_at"))


def history(headers: DataFrame, n: int = 10) -> DataFrame:
    """The newest runs first (a top-n, no full sort)."""
    return headers.orderBy(F.desc("scraped_at"), F.desc("snapshot_id")).limit(n)


def payload_chunks(items: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Items packed into one payload array per page, in page order.

    A page is told by all of the order but the row: source, crawl, job, number and stored page. The
    same page number of different jobs never meets in one array.
    """
    packed = F.collect_list(F.struct("ingest_ord", F.struct(*fields).alias("item")))
    page = [f for f in items.schema["ingest_ord"].dataType.names if f not in ("page_no", "row_ord")]
    return items.groupBy(
        *keys, F.col("ingest_ord.page_no").alias("chunk_no"), *[F.col(f"ingest_ord.{f}").alias(f"_{f}") for f in page]
    ).agg(F.transform(F.array_sort(packed), lambda x: x["item"]).alias("payload")).drop(*[f"_{f}" for f in page])


def unpack(snapshots: DataFrame, payload: str = "payload") -> DataFrame:
    """Payload arrays back to rows."""
    keys = [c for c in snapshots.columns if c != payload]
    return snapshots.select(*keys, F.inline(payload))


def diff(before: DataFrame, after: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """New, changed and gone rows between two snapshots (each with one row per key)."""
    old = before.select(*keys, F.struct(*compare).alias("_old"))
    new = after.select(*keys, F.struct(*compare).alias("_new"))
    joined = old.join(new, keys, "full_outer")
    change = (
        F.when(F.col("_old").isNull(), "new")
        .when(F.col("_new").isNull(), "gone")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    )
    return joined.select(*keys, change.alias("change"), F.col("_old").alias("before"), F.col("_new").alias("after")).where(
        F.col("change").isNotNull()
    )


class SnapshotStore:
    """Append-only snapshots below ``path``: ``items`` and ``headers``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def append(
        self, items: DataFrame, snapshot_id: str, scraped_at, source: str, seen=None
    ) -> DataFrame:
        """Write the items of a run, then its header; return the items as stored.

        The header is written last, so a run that failed half-way is never the latest one and
        its items are written anew. A run whose header exists is complete: it is left as it is
        and nothing is computed again. ``seen``, called when the items are written, gives
        ``live_tenders`` and ``total_pages``.
        """
        folder = f"{self.path}/items/snapshot_id={snapshot_id}"
        header = self._header_path(snapshot_id)
        if not self.complete(snapshot_id):
            items.write.mode("overwrite").parquet(folder)
            seen = seen() if seen is not None else {}
            self.spark.read.parquet(folder).agg(F.count("*").alias("count")).select(
                F.lit(snapshot_id).alias("snapshot_id"),
                F.lit(scraped_at).cast("timestamp_ntz").alias("scraped_at"),
                F.lit(source).alias("source"),
                F.lit(seen.get("live_tenders")).cast("int").alias("live_tenders"),
                F.lit(seen.get("total_pages")).cast("bigint").alias("total_pages"),
                "count",
            ).write.mode("overwrite").parquet(header)
        return self.items(snapshot_id)

    def complete(self, snapshot_id: str) -> bool:
        """Whether a run is stored whole."""
        return path_exists(self.spark, f"{self._header_path(snapshot_id)}/_SUCCESS")

    def _header_path(self, snapshot_id: str) -> str:
        return f"{self.path}/headers/run={snapshot_id}"

    def header(self, snapshot_id: str) -> DataFrame:
        """The header row of one run."""
        return self.spark.read.parquet(self._header_path(snapshot_id))

    def headers(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/headers").drop("run")

    def items(self, snapshot_id: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/items/snapshot_id={snapshot_id}")

    def latest(self) -> DataFrame:
        return latest_header(self.headers())

    def latest_items(self) -> DataFrame:
        """Items of the newest run; one header row decides which folder is read."""
        newest = self.latest().head()
        return self.items(newest["snapshot_id"])
