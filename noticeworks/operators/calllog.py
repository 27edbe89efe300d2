"""Audits over a fetch log: call budget and job state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from noticeworks import model as M
from noticeworks.functions import status as S


def call_budget(
    log: DataFrame,
    key: str = "key",
    ts: str = "ts",
    window_seconds: int = M.CALL_WINDOW_SECONDS,
    budget: int = M.CALL_BUDGET,
) -> DataFrame:
    """Adds, per call, the calls of its key in the trailing window and whether that is too many.

    A call exactly one window old still counts. A call without a time stamp has no count (null).
    Every (key, time slot) is a window group of its own, to which the calls of the slot before it are
    copied as bare time stamps. So the log is read and shuffled once, a call's columns travel with it
    instead of being joined back, and a busy key spreads over as many tasks as it has slots.
    """
    span = window_seconds * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    slot = F.floor(micros / F.lit(span))
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(log.columns)])

    def copy(at, own):
        return F.struct(at.cast("bigint").alias("slot"), own.alias("row"))

    nothing = F.lit(None).cast(log.select(row.alias("r")).schema["r"].dataType)
    # Calls without a stamp meet nobody: any slot will do, so they are spread.
    spread = -1 - F.pmod(F.xxhash64(row), F.lit(1 << 20))
    copies = F.when(micros.isNull(), F.array(copy(spread, row))).otherwise(
        F.array(copy(slot, row), copy(slot + 1, nothing)))
    dealt = log.select(F.col(key).alias("k"), micros.alias("us"), F.explode(copies).alias("at")).select(
        "k", "us", "at.slot", "at.row")
    trailing = Window.partitionBy("k", "slot").orderBy("us").rangeBetween(-span, 0)
    counted = dealt.withColumn("n", F.when(F.col("us").isNotNull(), F.count("*").over(trailing))).where("row is not null")
    return counted.select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(log.columns)],
        F.col("n").alias("calls_in_window"), (F.col("n") > budget).alias("over_budget"),
    )


def job_state(log: DataFrame, timeout_seconds: int = M.JOB_TIMEOUT_SECONDS) -> DataFrame:
    """Latest state per job from its poll events, with a timed-out flag.

    Columns of the log: job_id, ts, seq, status. Partial aggregation leaves one row per job and
    task before the shuffle.
    """
    agg = log.groupBy("job_id").agg(
        F.max_by("status", F.struct("ts", "seq")).alias("status"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.count("*").alias("polls"),
    )
    return _with_state(agg, timeout_seconds)


def job_state_of_segments(segments: DataFrame, timeout_seconds: int = M.JOB_TIMEOUT_SECONDS) -> DataFrame:
    """The same from stretches of polls that a stream has written (``model.JOB_SCHEMA``)."""
    stamp = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    agg = segments.groupBy("job_id").agg(
        F.max_by("status", F.struct("status_us", "status_seq")).alias("status"),
        stamp(F.min("first_us")).alias("first_ts"),
        stamp(F.max("last_us")).alias("last_ts"),
        F.sum("polls").alias("polls"),
    )
    return _with_state(agg, timeout_seconds)


def _with_state(agg: DataFrame, timeout_seconds: int) -> DataFrame:
    elapsed = F.unix_micros(F.col("last_ts").cast("timestamp")) - F.unix_micros(
        F.col("first_ts").cast("timestamp")
    )
    state = S.job_class(F.col("status"))
    return agg.select(
        "job_id", "status", state.alias("state"), "first_ts", "last_ts", "polls",
        ((state == "running") & (elapsed >= timeout_seconds * 1_000_000)).alias("timed_out"),
    )


def fetch_outcomes(log: DataFrame) -> DataFrame:
    """Adds the outcome class of every submission and poll by HTTP status."""
    return log.withColumn("submit_outcome", S.submit_class(F.col("http_status"))).withColumn(
        "poll_outcome", S.poll_class(F.col("http_status"))
    )
