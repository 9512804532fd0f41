"""Event logs: idle gaps, sessions, budgets, streaks, bounded logs, current states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def idle_gaps(events: DataFrame, key: list[str], at: str, order: list[str], seconds: int) -> DataFrame:
    """STR-01: events with the seconds since the event before and the number of the session they belong to; a longer gap starts a new one."""
    w = Window.partitionBy(*key).orderBy(at, *order)
    gap = F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(F.lag(at).over(w).cast("timestamp"))
    marked = events.withColumn("gap_seconds", F.floor(gap / 1_000_000))
    new = F.when(gap.isNull() | (gap > seconds * 1_000_000), 1).otherwise(0)
    return marked.withColumn("__new", new).withColumn("session", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def sessions(events: DataFrame, key: list[str], at: str, order: list[str], seconds: int) -> DataFrame:
    """STR-01: per key and session its start, end and events."""
    return idle_gaps(events, key, at, order, seconds).groupBy(*key, "session").agg(F.min(at).alias("started"), F.max(at).alias("ended"), F.count(F.lit(1)).alias("n_events"))


def within_budget(events: DataFrame, key: list[str], order: list[str], cost: Column, budget: float) -> DataFrame:
    """STR-02: events with the cost spent so far and whether it is within the budget."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return events.withColumn("spent", F.sum(cost).over(w)).withColumn("within", F.col("spent") <= budget)


def streaks(events: DataFrame, key: list[str], order: list[str], reset: Column) -> DataFrame:
    """WIN-06, WIN-07: events with the number of events since the last reset, 0 on a reset itself."""
    w = Window.partitionBy(*key).orderBy(*order)
    island = F.sum(F.when(reset, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = events.withColumn("__reset", reset).withColumn("__island", island)
    inside = Window.partitionBy(*key, "__island").orderBy(*order)
    return marked.withColumn("streak", F.count_if(~F.col("__reset")).over(inside.rowsBetween(Window.unboundedPreceding, 0))).drop("__reset", "__island")


def current_state(events: DataFrame, key: list[str], state: str, order: list[str]) -> DataFrame:
    """VAL-13: last state of each key."""
    return events.groupBy(*key).agg(F.max_by(state, F.struct(*order)).alias("state"), F.count(F.lit(1)).alias("n_states"))


def is_fresh(expires_at: Column, now: Column) -> Column:
    """FLT-07, STR-04: no expiry, or one after `now`."""
    return F.coalesce(expires_at > now, F.lit(True))
