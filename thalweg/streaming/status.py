"""The queue of work units as a stream: status changes in, the current status and totals out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The states and what may follow each.
NEXT = {
    "READY": ("FP_PROCESSING",),
    "FP_PROCESSING": ("FP_DONE", "FP_ERROR"),
    "FP_DONE": ("WS_PROCESSING",),
    "WS_PROCESSING": ("WS_DONE", "WS_ERROR"),
    "FP_ERROR": ("READY",),
    "WS_ERROR": ("FP_DONE",),
    "WS_DONE": (),
}


def latest(changes: DataFrame) -> DataFrame:
    """(aoi_id, status, ts) of the latest change of each unit; of equal times the last name."""
    return changes.groupBy("aoi_id").agg(F.max(F.struct("ts", "status")).alias("m")).select("aoi_id", "m.status", "m.ts")


def counted(changes: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Changes by status in windows of event time; those later than ``late`` are ignored by a stream."""
    return changes.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "status").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "status", "n")


def transitions(changes: DataFrame) -> DataFrame:
    """(aoi_id, before, status, valid) of every change of a stream, checked against the unit's state so far; a unit begins before READY."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        now = state.get[0] if state.exists else None
        for frame in frames:
            rows = []
            for status in frame.sort_values("ts", kind="stable")["status"]:
                valid = status == "READY" if now is None else status in NEXT.get(now, ())
                rows.append((key[0], now, status, valid))
                now = status if valid else now
            if now is not None:
                state.update((now,))
            yield pd.DataFrame(rows, columns=["aoi_id", "before", "status", "valid"])

    return changes.groupBy("aoi_id").applyInPandasWithState(step, "aoi_id long, before string, status string, valid boolean", "status string", "append", "NoTimeout")


def claim_batches(changes: DataFrame, process: Callable[[DataFrame], None], checkpoint: str):
    """Start a query that gives ``process`` the units that are READY in each batch."""

    def run(batch: DataFrame, _: int) -> None:
        process(latest(batch).filter("status = 'READY'"))

    return changes.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).start()
