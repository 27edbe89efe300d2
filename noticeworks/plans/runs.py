"""Whole runs: scheduled run, listing run, backfill run, status."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from noticeworks import model as M
from noticeworks.operators import (
    backfill, crawljson as J, listing as L, merge, metrics, vectors,
)
from noticeworks.functions import compose as C
from noticeworks.session import path_exists, shared_dir
from noticeworks.sources import export
from noticeworks.sources.snapshots import SnapshotStore
from noticeworks.sources.store import NoticeTable

SNAPSHOT_SOURCE = "eprocure.gov.in/AdvancedSearch"  # fixed value: how snapshots name the listing


@dataclasses.dataclass
class DetailSources:
    """What the detail stage reads: which job was submitted for which URL, the jobs' results, and
    stored detail pages (url, html) for the URLs that no job answers."""

    submitted: DataFrame
    jobs: DataFrame
    pages: DataFrame


def _written(df: DataFrame, name: str) -> DataFrame:
    """A table written to the shared folder and read back."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merged_rows(scraped: DataFrame, detail: DataFrame | DetailSources | None, strict: bool = True) -> DataFrame:
    """Scraped rows with their detail: ready records, or those that the fallback chain finds."""
    if detail is None:
        return scraped.withColumn("detail_merged", F.lit(False))
    if isinstance(detail, DetailSources):
        best = merge.detail_records(
            scraped, detail.submitted, detail.jobs, detail.pages, lambda df: _written(df, "answers"), strict)
        detail = best.where(F.col("route") != "none").withColumn("ingest_ord", F.lit(0))
    return merge.merge_detail(scraped, detail)


def scheduled_run(
    spark: SparkSession,
    run_id: str,
    run_at,
    listing_jobs: DataFrame | None,
    listing_pages: DataFrame,
    detail: DataFrame | DetailSources | None,
    table: NoticeTable,
    snapshots: SnapshotStore,
    page_cap: int | None = None,
    embed_limit: int | None = None,
    embed=vectors.hash_vectors,
    strict: bool = True,
) -> DataFrame:
    """Collect, fetch detail, snapshot, upsert, embed; returns the run counters per source.

    The pages are tokenised once, into rows and quarantined pages, written apart; the detail stage
    asks for the URLs of those rows. Crawled rows come before scraped ones. The snapshot is written
    before anything after it reads it, so a lost executor costs a re-read, not a re-extraction. The
    run id names all writes, so running it again changes nothing and returns the same counters.
    The counters have, beside those of each source, the vectors of the run (``embedded``) and its
    ``outcome``: ``ok``, or ``failed`` if no notice was stored.
    """
    kept = f"{snapshots.path}/counters/run={run_id}"
    if not path_exists(spark, f"{kept}/_SUCCESS"):
        outcomes = f"{snapshots.path}/outcomes/run={run_id}"
        if not snapshots.complete(run_id):
            live = Observation()
            pages = L.observe_live(L.cap_pages(listing_pages, page_cap), live)
            found = L.extract_outcomes(pages, strict=strict)
            found.write.mode("overwrite").partitionBy("outcome").parquet(outcomes)
            rows = spark.read.schema(found.schema).parquet(outcomes).where("outcome = 'row'")
            items = merged_rows(rows.select("source", *M.LISTING_FIELDS, "ingest_ord"), detail, strict)
            if listing_jobs is not None:
                central = J.extract_listing_json(listing_jobs, source_rank=0).drop("serial_no", "corrigendum", "job_id")
                items = merge.union_sources(central, items)
            snapshots.append(items, run_id, run_at, SNAPSHOT_SOURCE, lambda: L.live_seen(live))
        stored = snapshots.items(run_id)
        table.upsert(merge.notice_rows(stored), run_at, batch=f"{run_id}:notices")
        embed_pending(table, embed_limit, embed, batch=f"{run_id}:vectors")
        aside = quarantine(spark, snapshots, run_id).groupBy("source").agg(F.count("*").alias("quarantined"))
        upserted = table.batch_rows(f"{run_id}:notices")
        metrics.run_counters(stored).join(aside, "source", "full_outer").na.fill(0).withColumns({
            "embedded": F.lit(table.batch_rows(f"{run_id}:vectors")).cast("bigint"),
            "outcome": F.lit("ok" if upserted else "failed"),
        }).coalesce(1).write.mode("overwrite").parquet(kept)
    return spark.read.parquet(kept)


def quarantine(spark: SparkSession, snapshots: SnapshotStore, run_id: str) -> DataFrame:
    """The pages that a run put aside: source, page_id, page_no, page_url and reason."""
    schema = f"source STRING, page_id BIGINT, page_url STRING, reason STRING, ingest_ord {M.ORDER_TYPE}, outcome STRING"
    found = spark.read.schema(schema).parquet(f"{snapshots.path}/outcomes/run={run_id}").where("outcome = 'quarantine'")
    return found.select("source", "page_id", F.col("ingest_ord.page_no").alias("page_no"), "page_url", "reason")


def embed_pending(table: NoticeTable, limit: int | None = None, embed=vectors.hash_vectors, batch=None) -> None:
    """Vectors for the pending notices (up to ``limit``, if given), written back to the table."""
    def choose(notices):
        chosen = vectors.pending(notices.withColumn("id", F.struct(*M.NOTICE_KEY)), limit)
        return chosen.withColumn("text", C.notice_text())

    table.embed_pending(choose, embed, batch, narrow=embed is vectors.hash_vectors)


def listing_run(
    run_id: str, run_at, listing_pages: DataFrame, snapshots: SnapshotStore,
    page_cap: int | None = None, strict: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Extract and snapshot only; returns response items and envelope."""
    live = Observation()
    pages = L.observe_live(L.cap_pages(listing_pages, page_cap), live)
    stored = snapshots.append(
        L.extract_listing(pages, strict=strict), run_id, run_at, SNAPSHOT_SOURCE, lambda: L.live_seen(live)
    )
    envelope = snapshots.header(run_id).select("source", "count", "total_pages", "live_tenders")
    return export.response_items(stored), envelope


def backfill_run(items: DataFrame, table: NoticeTable, run_at, batch: str | None = None) -> DataFrame:
    """Insert snapshot items that the table lacks; returns the counters.

    The items are normalised once and staged. Counters and inserts both come from that stage and from
    the keys of one version of the table, and the counters are written before the insert.
    """
    rows = _written(backfill.backfill_rows(items), "backfill")
    existing = table.notices().select("ref_no")
    counters = _written(backfill.counters_of(rows, existing), "backfill_counters")
    table.insert_new(backfill.inserts_of(rows, existing), run_at, batch)
    return counters


def status(table: NoticeTable, crawl_enabled: bool = True) -> DataFrame:
    """The status metrics of the stored notices."""
    return table.status(crawl_enabled)
