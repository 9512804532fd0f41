"""Joins of records with vocabularies, reviews, plans and earlier passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def vocabulary_key(name: Column) -> Column:
    """JOIN-01: lower case, & as and, apostrophes dropped, other signs as spaces, one trailing s dropped."""
    t = F.regexp_replace(F.replace(F.lower(name), F.lit("&"), F.lit(" and ")), "['’]", "")
    return F.regexp_replace(F.trim(F.regexp_replace(t, "[^a-z0-9]+", " ")), "s$", "")


def match_vocabulary(values: DataFrame, value: str, vocabulary: DataFrame, aliases: DataFrame) -> DataFrame:
    """JOIN-01: `values` with entry_id and entry_name: by key among names, else by key among aliases; null for no match.

    Of names with one key the last by id counts. Whether the tables are broadcast is left to the planner, which knows their bytes.
    """
    names = vocabulary.select(vocabulary_key(F.col("name")).alias("__k"), F.col("id").alias("__id"), F.col("name").alias("__name")).groupBy("__k").agg(F.max(F.struct("__id", "__name")).alias("__n"))
    other = aliases.select(vocabulary_key(F.col("alias")).alias("__a"), F.col("canonical").alias("__c")).groupBy("__a").agg(F.min("__c").alias("__c"))
    by_alias = other.join(vocabulary.groupBy("name").agg(F.max("id").alias("__id")), F.col("__c") == F.col("name")).select("__a", F.struct(F.col("__id"), F.col("__c").alias("__name")).alias("__m"))
    rows = values.withColumn("__key", vocabulary_key(F.col(value))).join(names, F.col("__key") == F.col("__k"), "left").join(by_alias, F.col("__key") == F.col("__a"), "left")
    hit = F.coalesce("__n", "__m")
    return rows.select(*values.columns, hit["__id"].alias("entry_id"), hit["__name"].alias("entry_name"))


def align_lists(matched: DataFrame, key: list[str], value: str, pos: str) -> DataFrame:
    """JOIN-02: per key the matched entries without doubles and the unmatched phrases, both in order of first place."""
    first = matched.groupBy(*key, F.coalesce("entry_id", F.concat(F.lit("?"), F.lower(value))).alias("__e")).agg(F.min(F.struct(F.col(pos), F.col("entry_name"), F.col(value))).alias("f"))
    ordered = lambda cond, part: F.transform(F.array_sort(F.collect_list(F.when(cond, F.col("f")))), lambda x: x[part])
    return first.groupBy(*key).agg(ordered(F.col("f.entry_name").isNotNull(), "entry_name").alias("matched"), ordered(F.col("f.entry_name").isNull(), value).alias("unmatched"))


def latest_review(subjects: DataFrame, reviews: DataFrame, url: str, pos: str) -> DataFrame:
    """JOIN-03: subjects with the last review of their address, compared without case; null where there is none."""
    last = reviews.groupBy(F.lower(url).alias("__u")).agg(F.max_by(F.struct(*[c for c in reviews.columns if c != url]), F.col(pos)).alias("review"))
    return subjects.join(last, F.lower(subjects[url]) == F.col("__u"), "left").drop("__u")


def uncovered(wanted: Column, reviewed: Column) -> Column:
    """JOIN-04: items of a list no review covers; empty for complete coverage, null lists count as empty."""
    empty = F.array().cast("array<string>")
    return F.array_except(F.coalesce(wanted, empty), F.coalesce(reviewed, empty))


def key_audit(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """JOIN-05: (key, problem) of keys missing on the right, orphans of the right, and doubles on either side."""
    a, b = left.groupBy(key).agg(F.count(F.lit(1)).alias("__l")), right.groupBy(key).agg(F.count(F.lit(1)).alias("__r"))
    both = a.join(b, key, "full_outer")
    problems = F.array_compact(F.array(F.when(F.col("__r").isNull(), "missing"), F.when(F.col("__l").isNull(), "orphan"), F.when(F.col("__l") > 1, "duplicate_left"), F.when(F.col("__r") > 1, "duplicate_right")))
    return both.select(key, F.explode(problems).alias("problem"))


def reconcile(expected: DataFrame, observed: DataFrame, key: list[str], capped_at: int) -> DataFrame:
    """JOIN-06: expected against observed counts: unchecked, capped, mismatch or satisfied."""
    joined = expected.join(observed, key, "left").withColumn("observed", F.coalesce("observed", F.lit(0).cast("bigint")))
    verdict = F.when(F.col("expected").isNull(), "unchecked").when(F.col("observed") >= F.col("expected"), "satisfied").when(F.col("observed") >= capped_at, "capped").otherwise("mismatch")
    return joined.withColumn("verdict", verdict)


def unresolved(failed: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """JOIN-07, SET-03, STR-03: rows of `failed` whose key no row of `done` has; how a run is resumed."""
    return failed.join(done.select(*key).distinct(), key, "left_anti")


def has_inference(values: Column, inferences: Column) -> Column:
    """JOIN-08: values without an inference of the same text, compared without case."""
    return F.filter(values, lambda v: ~F.exists(inferences, lambda i: F.lower(i["value"]) == F.lower(v)))


def first_relation(records: DataFrame, routes: DataFrame, origin: str, step: str, relation: str) -> DataFrame:
    """JOIN-09: records with the relation of the first step of their origin."""
    first = routes.groupBy(origin).agg(F.min_by(relation, step).alias(relation))
    return records.join(first, origin, "left")


def best_per_key(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """WIN-01: the first row of each key by an order that must be total."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def top_per_key(rows: DataFrame, key: list[str], order: list[Column], n: int) -> DataFrame:
    """WIN-05, STR-05, IMG-07: the first n rows of each key, with their rank."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
