"""Keyed state of a stream: the last status of each task, which survives a restart."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATUS = "task string, status string, at timestamp, events long"


def _last(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState, idle_ms: int) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        status, at, order, n = state.get
        state.remove()
        yield pd.DataFrame({"task": [key[0]], "status": ["timed_out" if status == "running" else status], "at": [pd.Timestamp(at)], "events": [n]})
        return
    status, at, order, n = state.get if state.exists else (None, 0, "", 0)
    for batch in batches:
        n += len(batch)
        for when, said in zip(batch["at"], batch["status"], strict=True):
            # the later event, of equally late ones the greater status
            if (when.value, said or "") >= (at, order):
                status, at, order = said, when.value, said or ""
    state.update((status, at, order, n))
    state.setTimeoutTimestamp(max(at // 1_000_000, state.getCurrentWatermarkMs()) + idle_ms)
    yield pd.DataFrame({"task": [key[0]], "status": [status], "at": [pd.Timestamp(at)], "events": [n]})


def last_statuses(events: DataFrame, task: str, status: str, at: str, idle_ms: int = 3_600_000, late: str = "10 minutes") -> DataFrame:
    """(task, status, at, events) of each task that a batch tells about: its latest status so far and how many events it had.

    Events may come in any order; those behind the watermark still count while their task has state. A task without events
    for ``idle_ms`` of event time is told once more, as timed_out if it was running, and forgotten. Null tasks are one
    task, null times are dropped.
    """
    rows = events.select(F.col(task).cast("string").alias("task"), F.col(status).cast("string").alias("status"), F.col(at).cast("timestamp").alias("at")).filter("at IS NOT NULL").withWatermark("at", late)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        return _last(key, batches, state, idle_ms)

    return rows.groupBy("task").applyInPandasWithState(step, STATUS, "status string, at long, order string, events long", "update", GroupStateTimeout.EventTimeTimeout)


def to_table(statuses: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Writes each batch's statuses to a folder of its own number, in place of what a lost attempt left there; see
    :func:`latest` for the table."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return statuses.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(updates: DataFrame) -> DataFrame:
    """The last row of each task over all batches."""
    return updates.groupBy("task").agg(F.max_by(F.struct("status", "at", "events"), F.struct("batch", "at", "events")).alias("x")).select("task", "x.*")
