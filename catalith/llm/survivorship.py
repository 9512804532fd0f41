"""Best representative of each group of duplicate records, field by field."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions import text as T
from catalith.functions import urls as U


@dataclass(frozen=True)
class Attribute:
    """A field of the surviving record: its value, when it counts as filled, and what ranks before the time (greater is better)."""

    name: str
    value: Column
    filled: Column
    priority: Column | None = None


def survivors(records: DataFrame, group: Column, attributes: list[Attribute], time_col: str, id_col: str, with_values: bool = True) -> DataFrame:
    """(group_key, group_id, n_records, one struct<record_id, value> per attribute): one record per group, built field by field.

    One aggregation with partial results before the shuffle: per attribute the maximum of (filled, priority, time, smaller id, value), so a
    group of any size costs one buffer per task. Null times count as earliest, ties go to the smaller id; an attribute filled nowhere is
    null. Records without a group key belong to no group. Extra columns don't matter. An empty table gives no groups.
    """
    long_ago = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    at = F.coalesce(F.col(time_col).cast("timestamp_ntz"), long_ago)
    id_ = F.col(id_col)
    columns = [group.alias("group_key"), id_.alias("__id"), at.alias("__at")]
    for i, a in enumerate(attributes):
        columns += [F.coalesce(a.filled, F.lit(False)).alias(f"__f{i}"), (a.priority if a.priority is not None else F.lit(0)).cast("bigint").alias(f"__p{i}")]
        columns += [a.value.alias(f"__v{i}")] if with_values else []
    rows = records.select(*columns).filter(F.col("group_key").isNotNull())

    def best(i: int) -> Column:
        rank = F.struct(F.col(f"__p{i}").alias("p"), F.col("__at").alias("t"), (-F.col("__id")).alias("i"))
        kept = F.struct(F.col("__id").alias("record_id"), *([F.col(f"__v{i}").alias("value")] if with_values else []))
        return F.max_by(kept, F.when(F.col(f"__f{i}"), rank)).alias(attributes[i].name)

    return rows.groupBy("group_key").agg(F.min("__id").alias("group_id"), F.count(F.lit(1)).alias("n_records"), *[best(i) for i in range(len(attributes))])


TEXT_FIELDS = ["title", "price", "currency", "description", "ingredients", "supplement_facts", "sku", "form"]


def crawl_attributes() -> list[Attribute]:
    """The fields of a crawl record: texts filled unless blank or filler; of images the most different pictures rank first."""
    texts = [Attribute(f, F.col(f"fields.{f}"), T.is_filled(F.col(f"fields.{f}"))) for f in TEXT_FIELDS]
    pictures = F.array_distinct(F.filter(F.transform("fields.images", U.picture_key), lambda k: k.isNotNull()))
    many = F.coalesce(F.size(pictures), F.lit(0))
    return [*texts, Attribute("images", F.col("fields.images"), many > 0, many)]


def crawl_survivors(crawl: DataFrame, with_values: bool = True) -> DataFrame:
    """Surviving record of each product page and variant of the crawl table."""
    return survivors(crawl, U.page_key(F.col("product_url")), crawl_attributes(), "captured_at", "record_id", with_values)


def long_form(groups: DataFrame, names: list[str], keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(group_id, field_name, record_id): one row per group and filled field."""
    rows = keep(groups) if keep else groups
    entries = F.array(*[F.struct(F.lit(n).alias("field_name"), F.col(f"{n}.record_id").alias("record_id")) for n in names])
    return rows.select("group_id", F.inline(entries)).filter(F.col("record_id").isNotNull())
