"""Event-time operators; Spark's own additions beside the batch operators.  All work on batch tables too."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, size: str, slide: str | None = None, late: str = "10 minutes", ts: str = "ts", by: str = "event_type", value: str = "value") -> DataFrame:
    """(window_start, by, n, total) per tumbling or sliding window."""
    frame = F.window(ts, size, slide) if slide else F.window(ts, size)
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    return rows.groupBy(frame.alias("w"), by).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), by, "n", "total")


def sessions(events: DataFrame, by: str = "user_id", gap: str = "30 minutes", late: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """(by, session_start, session_end, n): events of a user no further apart than the gap."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    return rows.groupBy(F.session_window(ts, gap).alias("w"), by).agg(F.count("*").alias("n")).select(by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def live_overlay(log: DataFrame, live: DataFrame, key: str = "job_id") -> DataFrame:
    """A job log, streaming or not, with the live state of a static table where it has one."""
    return log.join(live.select(key, "live_state"), key, "left").withColumn("state", F.coalesce("live_state", "status"))


def distinct_events(events: DataFrame, key: str = "event_id", late: str = "10 minutes", ts: str = "ts") -> DataFrame:
    if events.isStreaming:
        return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])
    return events.dropDuplicates([key])


def streaming_ema(events: DataFrame, by: str = "user_id", value: str = "value", order: str = "event_id", alpha: float = 0.35) -> DataFrame:
    """(by, n, smoothed): each micro-batch's exponential mean per group, kept as state across batches."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, mean = state.get if state.exists else (0, math.nan)
        rows = pd.concat(list(batches)).sort_values(order)
        for v in rows[value].dropna():
            n, mean = n + 1, v if n == 0 else alpha * v + (1 - alpha) * mean
        state.update((n, mean))
        yield pd.DataFrame({by: [key[0]], "n": [n], "smoothed": [mean]})

    kind = events.schema[by].dataType.simpleString()
    return events.select(by, order, value).groupBy(by).applyInPandasWithState(update, f"{by} {kind}, n long, smoothed double", "n long, mean double", "update", "NoTimeout")
