"""Streams of log events: job states with timers, and the call budget by event time."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import BooleanType, LongType, StructType

from noticeworks import model as M
from noticeworks.operators import calllog
from noticeworks.sources.store import JobTable
from noticeworks.streaming.incremental import stream_id

_STATE = "segment string, status string, status_us bigint, status_seq bigint, first_us bigint, last_us bigint, polls bigint"
_JOB = Row(*[c.split()[0] for c in M.JOB_SCHEMA.split(", ")])
_ENDED = [*M.DONE_STATUSES, *M.FAILED_STATUSES]


class JobStates(StatefulProcessor):
    """Follows a job while it is open: its state goes when a poll ends it, or when its time is up.

    Polls that arrive afterwards start a new segment; readers put the segments of a job together.
    """

    def __init__(self, timeout_seconds: int):
        self.timeout_ms = timeout_seconds * 1000

    def init(self, handle) -> None:
        self.handle = handle
        self.job = handle.getValueState("job", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        polls = sorted(rows, key=lambda r: (r.us, r.seq))
        first, last = polls[0], polls[-1]
        # Every call to the state store is a message: a job without state has no timer, and nothing to clear.
        old = self.job.get()
        segment, status, us, seq, first_us, last_us, count = old or (
            f"{first.us}:{first.seq}", last.status, last.us, last.seq, first.us, last.us, 0)
        if (last.us, last.seq) >= (us, seq):
            status, us, seq = last.status, last.us, last.seq
        now = (segment, status, us, seq, min(first_us, first.us), max(last_us, last.us), count + len(polls))
        if old is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        if status not in _ENDED:
            self.job.update(now)
            self.handle.registerTimer(now[4] // 1000 + self.timeout_ms)
        elif old is not None:
            self.job.clear()
        yield _JOB(key[0], *now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.job.clear()
        return iter(())

    def close(self) -> None:
        pass


def job_states(
    spark: SparkSession, events: DataFrame, table: JobTable, checkpoint: str,
    timeout_seconds: int = M.JOB_TIMEOUT_SECONDS, late: str = "1 hour",
):
    """Follow a stream of poll events (job_id, ts, seq, status) into a table of job states; returns the
    query and the states.

    Only open jobs have state, each one small row and one timer; jobs whose time is up by the
    watermark lose it, too. Events more than ``late`` behind the newest one may be dropped. Every
    trigger brings the changed rows to the one table, once; data of old versions is removed.
    """
    polls = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late).select(
        "job_id", "at", F.unix_micros("at").alias("us"), F.col("seq").cast("bigint").alias("seq"), "status")
    changed = polls.groupBy("job_id").transformWithState(
        JobStates(timeout_seconds), M.JOB_SCHEMA, "Update", "EventTime")
    stream = stream_id(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        table.put(batch, (stream(), batch_id))
        table.clean_up()

    query = (
        changed.writeStream.outputMode("update").trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    return query, calllog.job_state_of_segments(table.segments(), timeout_seconds)


def call_budget_stream(
    log: DataFrame, key: str = "key", ts: str = "ts", late: str = "1 minute",
    window_seconds: int = M.CALL_WINDOW_SECONDS, budget: int = M.CALL_BUDGET,
) -> DataFrame:
    """The call budget of a stream of calls, as a streaming frame for append mode.

    Event-time windows of two slots follow each other slot by slot, so each slot is the second half
    of one window whose first half holds all calls that its own can reach back to. A window is
    closed, and the calls of its second half returned with their counts, when the watermark passes
    its end; until then calls up to ``late`` behind the newest one are counted in. State is kept for
    open windows only. Calls without a time stamp pass with no count.
    """
    span = window_seconds * 1_000_000
    schema = StructType(list(log.schema.fields)).add("calls_in_window", LongType()).add("over_budget", BooleanType())
    stamped = log.where(F.col(ts).isNotNull()).withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", late)
    two_slots = F.window("_at", f"{2 * window_seconds} seconds", f"{window_seconds} seconds")
    groups = stamped.groupBy(F.col(key).alias("_key"), two_slots.alias("_window")).agg(
        F.collect_list(F.struct(F.unix_micros("_at").alias("us"), F.struct(*log.columns).alias("row"))).alias("calls")
    ).select(F.unix_micros("_window.end").alias("end_us"), "calls")

    def counted(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            column, ends = batch.column("calls"), batch.column("end_us").to_numpy()
            offsets, flat = column.offsets.to_numpy(), column.values
            us = flat.field("us").to_numpy()
            own, counts = [], []
            for a, b, end in zip(offsets[:-1], offsets[1:], ends):
                stamps = np.sort(us[a:b])
                mine = np.flatnonzero(us[a:b] >= end - span)
                at = us[a:b][mine]
                own.append(mine + a)
                counts.append(np.searchsorted(stamps, at, "right") - np.searchsorted(stamps, at - span, "left"))
            if not own:
                continue
            n = np.concatenate(counts)
            rows = flat.field("row").take(pa.array(np.concatenate(own)))
            yield pa.RecordBatch.from_arrays([*rows.flatten(), pa.array(n), pa.array(n > budget)], names=schema.names)

    unstamped = log.where(F.col(ts).isNull()).withColumns({
        "calls_in_window": F.lit(None).cast("bigint"), "over_budget": F.lit(None).cast("boolean")})
    return groups.mapInArrow(counted, schema).unionByName(unstamped)
