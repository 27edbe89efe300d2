"""Unions, detail merge, fallback chain, normalised notice rows and the upsert rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from noticeworks import model as M
from noticeworks.functions import text as X
from noticeworks.operators import crawljson as J, dedup, detail as D

_NO_MATCH = "\u0000"  # cannot start a URL


def union_sources(*frames: DataFrame) -> DataFrame:
    """Union by name; a column that one source lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _spread_key(key: Column, row_hash: Column) -> Column:
    """A join key that spreads rows which cannot match instead of piling them on one task."""
    return F.when(key.isNotNull() & (key != ""), key).otherwise(
        F.concat(F.lit(_NO_MATCH), F.pmod(row_hash, F.lit(1 << 20)).cast("string"))
    )


def merge_detail(listing: DataFrame, detail: DataFrame) -> DataFrame:
    """Detail fields into listing rows by URL; a non-null detail value wins.

    Of several detail rows of one URL the last by ``ingest_ord`` counts, which they must have. Rows without a URL get spread keys, and a URL that many
    listing rows share is split by the skew join, so no task takes more than its share.
    ``detail_merged`` tells the rows that got any field.
    """
    if "ingest_ord" not in detail.columns:
        raise ValueError("detail rows need ingest_ord, since the last one of a URL counts")
    fields = [c for c in detail.columns if c in M.DETAIL_FIELDS or c in M.LISTING_FIELDS]
    fields = [c for c in fields if c != "url"]
    left = listing.withColumn(
        "_key", _spread_key(F.col("url"), F.xxhash64(*listing.columns))
    )
    right = (
        detail.where(F.col("url") != "")
        # The second key keeps the join's own exchange, which is what AQE can split at a hot URL.
        .groupBy(F.col("url").alias("_url"), F.xxhash64("url").alias("_h"))
        .agg(F.max_by(F.struct(*[F.col(c).alias(f"_d_{c}") for c in fields]), "ingest_ord").alias("_d"))
        .select("_url", "_d.*")
    )
    # A hash join reads the listing rows as they come: sorted, those of a hot URL would all be held by one task.
    joined = left.join(right.hint("shuffle_hash"), left["_key"] == right["_url"], "left")
    kept = [c for c in listing.columns if c not in fields]
    return joined.select(
        *kept,
        *[
            (F.coalesce(f"_d_{c}", c) if c in listing.columns else F.col(f"_d_{c}")).alias(c)
            for c in fields
        ],
        X.any_of([F.col(f"_d_{c}").isNotNull() for c in fields]).alias("detail_merged"),
    )


def cover_urls(requested: DataFrame, results: DataFrame) -> DataFrame:
    """One row per distinct requested URL, with the result fields where there are any."""
    rest = [c for c in results.columns if c != "url"]
    urls = requested.select("url").where(F.col("url").isNotNull()).select(
        "url", F.lit(True).alias("_asked"), *[F.lit(None).cast(results.schema[c].dataType).alias(c) for c in rest]
    )
    both = urls.unionByName(results.withColumn("_asked", F.lit(False)).select("url", "_asked", *rest))
    grouped = both.groupBy("url").agg(
        F.max("_asked").alias("_asked"),
        *[F.max_by(c, F.when(~F.col("_asked"), 1)).alias(c) for c in rest],
    )
    return grouped.where("_asked").drop("_asked")


def fallback_chain(
    requested: DataFrame, submitted: DataFrame, job_fields: DataFrame, direct: DataFrame
) -> DataFrame:
    """Best available detail record per requested URL and the route that gave it.

    Routes in order: job JSON, job HTML, direct page, none. ``submitted`` maps jobs to URLs,
    ``job_fields`` holds each job's first usable record (with its route), ``direct`` the
    records of directly stored pages. All candidates meet in one aggregate keyed by URL, which
    reduces inside each task first: one shuffle instead of one per route.
    """
    return best_route(requested, submitted.join(job_fields, "job_id"), direct)


def detail_records(
    requested: DataFrame, submitted: DataFrame, jobs: DataFrame, pages: DataFrame, keep, strict: bool = True
) -> DataFrame:
    """The fallback chain from raw crawl jobs and raw direct pages: each URL's best record and its route.

    The chain goes on only for what is left: jobs of other URLs are not parsed, and of the direct
    pages only those whose URL no job has answered reach the tokenizer. Both are semi-joins on the
    URL, ahead of the parsing, for which Spark can send a Bloom filter to the scan of the pages.
    ``keep`` stores the jobs' answers, which two steps read, and returns them (e.g. written Parquet).
    """
    asked = requested.select("url").where(F.col("url") != "").distinct()
    sent = submitted.where(F.col("job_id").isNotNull()).join(asked, "url", "left_semi")
    answers = keep(sent.join(J.first_usable(jobs.join(sent, "job_id", "left_semi"), strict), "job_id"))
    direct = D.extract_detail(unanswered_pages(asked, answers, pages), strict)
    return best_route(asked, answers, direct)


def unanswered_pages(asked: DataFrame, answers: DataFrame, pages: DataFrame) -> DataFrame:
    """The pages whose URL is asked for and has no answer yet, as (url, html)."""
    rest = asked.join(answers.select("url"), "url", "left_anti")
    return pages.select("url", "html").join(rest, "url", "left_semi")


def best_route(requested: DataFrame, jobs: DataFrame, direct: DataFrame) -> DataFrame:
    """The best of all candidates per requested URL; ``jobs`` has url, job_id, route and the fields."""
    names = M.DETAIL_FIELDS

    def candidate(df, rank, route):
        known = [c for c in names if c in df.columns]
        tie = F.col("job_id") if "job_id" in df.columns else F.hex(F.xxhash64(*known)) if known else F.lit("")
        return df.select(
            "url", rank.alias("_rank"), tie.alias("_tie"), route.alias("route"),
            F.struct(*[F.col(c) if c in df.columns else F.lit(None).cast(M.detail_type(c)).alias(c)
                       for c in names]).alias("fields"),
        )

    from_jobs = candidate(
        jobs, F.when(F.col("route") == "json", 1).otherwise(2), F.concat(F.lit("job_"), F.col("route"))
    )
    from_direct = candidate(direct, F.lit(3), F.lit("direct")).where(J.any_field(F.col("fields")))
    nothing = candidate(
        requested.select("url").where(F.col("url") != ""), F.lit(9), F.lit("none")
    )
    best = (
        from_jobs.unionByName(from_direct).unionByName(nothing)
        .groupBy("url")
        .agg(
            F.min_by(F.struct("route", "fields"), F.struct("_rank", "_tie")).alias("_best"),
            F.max("_rank").alias("_last"),
        )
        .where(F.col("_last") == 9)
    )
    return best.select("url", "_best.route", "_best.fields.*")


def split_routes(requested: DataFrame, submitted: DataFrame) -> DataFrame:
    """Distinct requested URLs with their route: ``job`` where submitted, else ``direct``."""
    asked = requested.select("url", F.lit(1).alias("_ask"), F.lit(0).alias("_job")).where(
        F.col("url") != ""
    )
    sent = submitted.where(F.col("job_id").isNotNull()).select(
        "url", F.lit(0).alias("_ask"), F.lit(1).alias("_job")
    )
    flags = asked.unionByName(sent).groupBy("url").agg(
        F.max("_ask").alias("_ask"), F.max("_job").alias("_job")
    )
    return flags.where("_ask = 1").select(
        "url", F.when(F.col("_job") == 1, "job").otherwise("direct").alias("route")
    )


def notice_rows(items: DataFrame, compat_source: bool = False) -> DataFrame:
    """Merged items to typed notice rows.

    The real source is kept; ``compat_source`` stamps every row with the primary source, which
    makes equal references of different sources one notice.
    """
    have = set(items.columns)

    def col(name, kind="string"):
        return F.col(name) if name in have else F.lit(None).cast(kind).alias(name)

    padded = items.select(
        "ingest_ord",
        *[col(f) for f in ("source", *M.LISTING_FIELDS)],
        *[col(f, M.detail_type(f)) for f in M.DETAIL_FIELDS],
    )
    source = F.lit(M.PRIMARY_SOURCE) if compat_source else F.coalesce("source", F.lit(M.PRIMARY_SOURCE))
    return padded.select(
        X.key_or_missing(F.col("ref_no")).alias("ref_no"),
        source.alias("source"),
        X.strip(F.coalesce("title", F.lit(""))).alias("title"),
        X.blank_to_null(F.col("organisation")).alias("organisation"),
        X.strip(F.coalesce("url", F.lit(""))).alias("url"),
        *[X.notice_date(F.col(d)).alias(d) for d in M.DATE_FIELDS],
        F.lit(True).alias("is_active"),
        *M.STORED_DETAIL_FIELDS,
        X.has_detail().alias("detail_scraped"),
        J.packed_fields(M.PACKED_FIELDS).alias("raw_data"),
        "ingest_ord",
    )


def merge_notices(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """The upsert rule on (ref_no, source); ``incoming`` holds one row per key.

    A null incoming value keeps the stored one; title, url, is_active, detail_scraped and
    raw_data are never null and always overwrite. Keys of one side only pass through. Both
    sides are unique on the key, so no key can be hot.
    """
    old = current.alias("o")
    new = incoming.withColumn("_new", F.lit(True)).alias("n")
    on = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in M.NOTICE_KEY]
    joined = old.join(new, on, "full_outer")

    def merged(c):
        mine, theirs = F.col(f"n.{c}"), F.col(f"o.{c}")
        if c not in incoming.columns:
            return theirs
        if c in M.ALWAYS_WRITTEN:
            return F.when(F.col("n._new"), mine).otherwise(theirs).alias(c)
        return F.coalesce(mine, theirs).alias(c)

    return joined.select(*[merged(c) for c in current.columns])


def newer(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both sides, each with one row per key; an incoming value that is not null wins."""
    values = [c for c in current.columns if c not in keys]
    new = incoming.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in values])
    joined = current.join(new, keys, "full_outer")
    return joined.select(*keys, *[F.coalesce(f"_new_{c}", c).alias(c) for c in values])


def latest_per_key(rows: DataFrame) -> DataFrame:
    """One incoming row per notice key, the last one; needed before an upsert."""
    return dedup.last_wins(rows, M.NOTICE_KEY, "ingest_ord")


def fold_batches(rows: DataFrame, batch: str) -> DataFrame:
    """Notice rows of numbered batches as one row per key, as if each batch had been upserted in turn.

    Of a batch the last row of a key counts; then the newest value that is not null holds, and the
    columns that are always written come from the newest batch. ``ingest_ord`` is that of its row.
    """
    latest = dedup.last_wins(rows, [*M.NOTICE_KEY, batch], "ingest_ord")
    values = [c for c in rows.columns if c not in (*M.NOTICE_KEY, batch)]

    def newest(c):
        kept = c in M.ALWAYS_WRITTEN or c == "ingest_ord"
        return F.max_by(c, batch if kept else F.when(F.col(c).isNotNull(), F.col(batch))).alias(c)

    return latest.groupBy(*M.NOTICE_KEY).agg(*map(newest, values))


def new_keys(items: DataFrame, existing: DataFrame) -> DataFrame:
    """Items whose ref_no is not stored yet; the reference alone decides, not the source."""
    return items.join(existing.select("ref_no").distinct(), "ref_no", "left_anti")
