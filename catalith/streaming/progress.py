"""Structured Streaming forms of the time-driven operators: watermarked sessions, windows, idle alarms, exact-once records."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def event_time(events: DataFrame, at: str = "ts") -> DataFrame:
    """Events with their time as TIMESTAMP, as watermarks need it."""
    return events.withColumn(at, F.col(at).cast("timestamp"))


def stream_sessions(events: DataFrame, key: list[str], at: str, gap: str, late: str) -> DataFrame:
    """STR-01: sessions closed by an idle gap; events later than `late` are dropped by the watermark."""
    rows = event_time(events, at).withWatermark(at, late)
    out = rows.groupBy(*key, F.session_window(at, gap).alias("w")).agg(F.count(F.lit(1)).alias("n_events"))
    return out.select(*key, F.col("w.start").alias("started"), F.col("w.end").alias("closed"), "n_events")


def stream_counts(events: DataFrame, key: list[str], at: str, window: str, late: str) -> DataFrame:
    """AGG-05 over tumbling windows of a stream."""
    rows = event_time(events, at).withWatermark(at, late)
    return rows.groupBy(*key, F.window(at, window).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(*key, F.col("w.start").alias("started"), "n")


def stream_new_keys(events: DataFrame, key: list[str], at: str, late: str) -> DataFrame:
    """STR-03, SET-02: the first row of each key within the watermark, so that a resumed run repeats nothing."""
    return event_time(events, at).withWatermark(at, late).dropDuplicatesWithinWatermark(key)


def stream_idle_alarms(events: DataFrame, key: str, at: str, idle_seconds: int, late: str) -> DataFrame:
    """STR-01, STR-04: one alarm per key and idle period: no event for `idle_seconds` of event time. State is one time and count per key."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, n = state.get if state.exists else (0, 0)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({key: [k[0]], "last_ms": [last], "n_events": [n]})
            return
        for b in batches:
            last, n = max(last, int(b["ms"].max())), n + len(b)
        state.update((last, n))
        state.setTimeoutTimestamp(max(last + idle_seconds * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({key: [], "last_ms": [], "n_events": []}).astype({"last_ms": "int64", "n_events": "int64"})

    rows = event_time(events, at).withWatermark(at, late).withColumn("ms", F.unix_millis(at))
    kind = events.schema[key].dataType.simpleString()
    return rows.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, last_ms bigint, n_events bigint", "last bigint, n bigint", "append", GroupStateTimeout.EventTimeTimeout)
