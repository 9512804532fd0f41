"""Counts, rates and shares over records, queues and work results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# From when a catalogue counts as that of a multi-brand retailer.
RETAILER_SAMPLE, RETAILER_VENDORS, RETAILER_SHARE = 8, 6, 0.6
# From when outcomes count as dumped into review.
DUMP_COUNT, DUMP_SHARE = 5, 0.8


def vendor_diversity(products: DataFrame, site: list[str], vendor: str) -> DataFrame:
    """AGG-01, AGG-02: per site the products with a vendor, different vendors, those of the top vendor and whether it is a multi-brand retailer.

    Counts per vendor first, so a site with a third of all rows is reduced before it meets one task. Blank vendors are ignored.
    """
    per = products.filter(F.coalesce(F.trim(vendor) != "", F.lit(False))).groupBy(*site, F.trim(vendor).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    out = per.groupBy(*site).agg(F.sum("n").cast("bigint").alias("with_vendor"), F.count(F.lit(1)).alias("vendors"), F.max("n").alias("top_vendor"))
    return out.withColumn("is_retailer", (F.col("with_vendor") >= RETAILER_SAMPLE) & (F.col("vendors") >= RETAILER_VENDORS) & (F.col("top_vendor") < F.lit(RETAILER_SHARE) * F.col("with_vendor")))


def presence(rows: DataFrame, site: list[str], facts: dict[str, Column]) -> DataFrame:
    """AGG-03, AGG-04: per site the rows and, per fact, how many have it; null counts as not."""
    return rows.groupBy(*site).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(f"n_{k}") for k, c in facts.items()])


def coverage(rows: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """AGG-04: (field, filled, total, rate): share of rows with a value, to two decimals; one pass over all fields."""
    one = rows.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in fields.items()])
    stacked = one.select("__n", F.inline(F.array(*[F.struct(F.lit(k).alias("field"), F.col(k).alias("filled")) for k in fields])))
    rate = F.round(F.when(F.col("__n") > 0, F.col("filled").cast("decimal(20,0)") / F.col("__n").cast("decimal(20,0)")).otherwise(0), 2)
    return stacked.select("field", "filled", F.col("__n").alias("total"), rate.cast("double").alias("rate"))


def status_counts(rows: DataFrame, group: list[str], status: str, known: list[str], default: str) -> DataFrame:
    """AGG-05, AGG-06, AGG-15: per group the rows of each known status; unknown ones count as `default`."""
    s = F.when(F.col(status).isin(known), F.col(status)).otherwise(default)
    return rows.groupBy(*group).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(s == k).alias(k) for k in known])


def dominant_share(rows: DataFrame, group: list[str], reason: str) -> DataFrame:
    """AGG-11: per group the rows, those of the most frequent reason, and whether one reason dominates (at least 5 rows and 80 % of them)."""
    per = rows.groupBy(*group, reason).agg(F.count(F.lit(1)).alias("n"))
    out = per.groupBy(*group).agg(F.sum("n").cast("bigint").alias("total"), F.max("n").alias("top"))
    return out.withColumn("dominated", (F.col("total") >= DUMP_COUNT) & (F.col("top") * 10 >= F.col("total") * int(DUMP_SHARE * 10)))


def all_resolved(rows: DataFrame, group: list[str], resolved: Column) -> DataFrame:
    """AGG-12: per group whether it has rows and all are resolved; null is not."""
    return rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(resolved, F.lit(False))).alias("complete"))


def task_groups(tasks: DataFrame, key: Column, order: str) -> DataFrame:
    """AGG-13: tasks with group key, group size and place within the group; tasks that share a key run one after another."""
    from pyspark.sql import Window

    keyed = tasks.withColumn("group_key", key)
    w = Window.partitionBy("group_key")
    return keyed.withColumn("group_size", F.count(F.lit(1)).over(w)).withColumn("place", F.row_number().over(w.orderBy(order)))


def promotable(samples: DataFrame, profile: list[str], valid: Column, least: int = 2) -> DataFrame:
    """AGG-14: profiles with at least `least` valid samples."""
    return samples.groupBy(*profile).agg(F.count_if(F.coalesce(valid, F.lit(False))).alias("valid_samples")).withColumn("promoted", F.col("valid_samples") >= least)
