"""Crawl results: typed JSON, listing rows and the first usable record of a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from noticeworks import model as M
from noticeworks.functions import notice as N, status as S, text as X
from noticeworks.operators import dedup, detail as D


def parsed(c: Column) -> Column:
    """JSON text to a VARIANT, null where it is none."""
    return F.try_parse_json(c)


def _field(value: Column, name: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, f"$.{name}", kind)


def _is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def detail_json(c: Column) -> Column:
    """Detail JSON to a typed struct; numbers may arrive as numbers or as text."""
    fields = []
    for name in M.DETAIL_FIELDS:
        if name not in M.DETAIL_JSON_FIELDS:
            value = F.lit(None).cast("string")
        elif name in M.AMOUNT_FIELDS:
            value = X.amount(_field(c, name))
        elif name in M.DAY_FIELDS:
            value = _field(c, name).try_cast("double").try_cast("bigint")
        else:
            value = _field(c, name)
        fields.append(value.alias(name))
    return F.struct(*fields)


def json_fields(text: Column) -> Column:
    """All non-null fields of a JSON object, given as text, as a map in their order, unknown ones included."""
    return F.map_filter(F.from_json(text, "map<string,string>"), lambda k, v: v.isNotNull())


def fields_of(c: Column) -> Column:
    """The same of a VARIANT, in the order of their names."""
    return F.map_filter(F.try_variant_get(c, "$", "map<string,string>"), lambda k, v: v.isNotNull())


def json_usable(c: Column) -> Column:
    """Whether any field of a VARIANT object is set."""
    return F.coalesce(F.size(fields_of(c)) > 0, F.lit(False))


def unknown_fields(fields: Column, known: list[str]) -> Column:
    """Entries of a map whose key has no column of its own."""
    names = F.array(*[F.lit(k) for k in known])
    return F.map_filter(fields, lambda k, v: ~F.array_contains(names, k))


def packed_fields(names: list[str]) -> Column:
    """Named columns packed into a map."""
    entries = F.array(*[F.struct(F.lit(n), F.col(n).cast("string")) for n in names])
    return F.map_from_entries(entries)


def compact_json(columns: list[str]) -> Column:
    """A row as JSON without its null entries."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "true"})


def _json_of(jobs: DataFrame, record: Column) -> Column:
    """The JSON of a record: as it was read, or parsed here, once, where a job holds text."""
    kind = jobs.schema["records"].dataType.elementType["json"].dataType
    return parsed(record["json"]) if isinstance(kind, StringType) else record["json"]


def listing_records(jobs: DataFrame) -> DataFrame:
    """Completed records of crawl jobs, one row per crawled listing page, with its whole JSON;
    ``crawled_at`` is optional."""
    rec = F.posexplode_outer("records").alias("record_ord", "_rec")
    at = F.col("crawled_at") if "crawled_at" in jobs.columns else F.lit(None)
    return (
        jobs.select("job_id", at.cast("timestamp_ntz").alias("seen_at"), rec)
        .where(F.col("_rec.status") == "completed")
        .select("job_id", "seen_at", "record_ord", X.once(_json_of(jobs, F.col("_rec")).alias("page")))
    )


def listing_rows(jobs: DataFrame, source_rank: int = 0) -> DataFrame:
    """Crawl jobs to normalised listing rows, duplicates included.

    Narrow: parse a record, explode its rows, project. An element that is no object, or that names neither
    an id nor a title, is skipped. Rows are ordered by crawl time, job, record and place in it.
    """
    pages = listing_records(jobs)
    items = pages.select(
        "job_id", "seen_at", "record_ord",
        F.posexplode_outer(_field(F.col("page"), "tenders", "array<variant>")).alias("row_ord", "_item"),
    ).where(X.whole(_is_object(F.col("_item"))))
    raw = items.select(
        "job_id", "seen_at", "record_ord", "row_ord",
        X.once(*[_field(F.col("_item"), f).alias(f) for f in M.LISTING_JSON_FIELDS]),
    )
    path = X.strip(F.coalesce("detail_path", F.lit("")))
    rows = raw.select(
        F.lit(M.CENTRAL_SOURCE).alias("source"),
        X.key_or_missing(F.col("tender_id")).alias("ref_no"),
        X.strip(F.coalesce("title", F.lit(""))).alias("title"),
        *[X.blank_to_null(F.col(c)).alias(c) for c in ("organisation", *M.DATE_FIELDS)],
        X.link_url(path).alias("url"),
        X.blank_to_null(F.col("tender_id")).alias("tender_id"),
        "serial_no", "corrigendum", "job_id",
        N.row_order(source_rank, F.col("record_ord"), None, F.col("row_ord"), F.col("seen_at"), F.col("job_id")),
    )
    return rows.where(X.whole(F.col("tender_id").isNotNull() | (F.col("title") != "")))


def extract_listing_json(jobs: DataFrame, source_rank: int = 0) -> DataFrame:
    """Crawl jobs to listing rows, the first row of each id (or title) winning over all pages."""
    rows = listing_rows(jobs, source_rank).withColumn(
        "_key", F.coalesce("tender_id", "title")
    )
    return dedup.first_wins(rows, ["job_id", "_key"], "ingest_ord").drop("_key")


def page_completeness(jobs: DataFrame) -> DataFrame:
    """Per job: crawled pages, extracted rows, the total the pages claim, and whether all of it is there.

    ``unique_rows`` are the rows that the listing keeps; ``gap`` is what the claimed total has more
    than those, and a job is complete if that is nothing. Without a claim both are null.
    """
    kept = listing_rows(jobs).select("job_id", F.coalesce("tender_id", "title").alias("_key")).distinct().groupBy(
        "job_id").agg(F.count("*").alias("_kept"))
    per_page = listing_records(jobs).select(
        "job_id",
        F.size(F.filter(_field(F.col("page"), "tenders", "array<variant>"), _is_object)).alias("_rows"),
        _field(F.col("page"), "page_number").try_cast("bigint").alias("_page"),
        _field(F.col("page"), "total_records").try_cast("bigint").alias("_total"),
    )
    per_job = per_page.groupBy("job_id").agg(
        F.count("*").alias("pages"),
        F.sum(F.greatest("_rows", F.lit(0))).alias("extracted_rows"),
        F.max("_page").alias("last_page"),
        F.max("_total").alias("claimed_total"),
    )
    gap = F.greatest(F.col("claimed_total") - F.col("unique_rows"), F.when(F.col("claimed_total").isNotNull(), 0))
    return per_job.join(kept, "job_id", "left").select(
        *per_job.columns, F.coalesce("_kept", F.lit(0)).alias("unique_rows")).select(
        "*", gap.alias("gap"), (gap == 0).alias("complete"))


def first_usable(jobs: DataFrame, strict: bool = True) -> DataFrame:
    """Per job the fields of its first usable record: JSON if any field is set, else its HTML.

    Records after the first one with usable JSON can never win, so they are cut before anything
    is parsed; a body is tokenised only where the JSON is empty and the session is alive. Bodies
    never reach a shuffle, and each task sends one row per job.
    """
    records = F.transform("records", lambda r: F.struct(
        r["status"].alias("status"), _json_of(jobs, r).alias("json"), r["html"].alias("html")))
    whole = jobs.select("job_id", X.once(records.alias("records")))
    ok = F.transform("records", lambda r: (r["status"] == "completed") & json_usable(r["json"]))
    flagged = whole.select("job_id", "records", X.once(ok.alias("ok")))
    first_json = F.array_position("ok", F.lit(True)).cast("int")
    kept = F.slice(
        F.arrays_zip(F.col("records").alias("r"), F.col("ok").alias("ok")),
        F.lit(1), F.when(first_json > 0, first_json).otherwise(1 << 30),
    )
    recs = flagged.select("job_id", F.posexplode_outer(kept).alias("record_ord", "_rec"))
    marked = recs.where(F.col("_rec.r.status") == "completed").select(
        "job_id", "record_ord", F.col("_rec.ok").alias("_is_json"),
        F.col("_rec.r.json").alias("json"), F.col("_rec.r.html").alias("html"),
    )
    body = F.when(~F.col("_is_json") & ~S.session_expired(F.col("html")), F.col("html"))
    parsed = D.detail_pairs(marked.withColumn("html", body), strict)
    typed = parsed.select(
        "job_id", "record_ord", "_is_json",
        X.once(
            F.when(F.col("_is_json"), detail_json(F.col("json")))
            .otherwise(F.struct(*D.detail_columns(F.col("pairs")))).alias("fields")
        ),
    )
    candidates = typed.where(F.col("_is_json") | X.whole(any_field(F.col("fields"))))
    route = F.when(F.col("_is_json"), "json").otherwise("html").alias("route")
    won = candidates.groupBy("job_id").agg(
        F.min_by(F.struct(route, "fields"), "record_ord").alias("_won")
    )
    return won.select("job_id", "_won.route", "_won.fields.*")


def any_field(fields: Column) -> Column:
    return X.any_of([fields[f].isNotNull() for f in M.DETAIL_FIELDS])
