"""Unions, ordered distinct, differences, and closure over links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.runtime import materialise


def union_passes(passes: list[DataFrame]) -> DataFrame:
    """SET-01: records of several passes with `pass_no`; columns a pass lacks are null."""
    numbered = [p.withColumn("pass_no", F.lit(i)) for i, p in enumerate(passes)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def ordered_distinct(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """SET-02, WIN-03: the first row of each key by `order` (total)."""
    first = rows.groupBy(*key).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in key]), order).alias("f"))
    return first.select(*key, "f.*")


def reachable(edges: DataFrame, seeds: DataFrame, source: str = "src", target: str = "dst", quiet_rounds: int = 1, max_rounds: int | None = None) -> DataFrame:
    """SET-04: (node, round) of all nodes reached from `seeds`(node), with the round of first discovery.

    Rounds of frontier join, difference and union, each written to the shared folder, until `quiet_rounds` rounds in a row find nothing new,
    however many rounds that takes. Where `max_rounds` is given and its last round still finds nodes, it raises: nodes are never left out.
    Null counts as one node without links. Only the number of new nodes comes to the driver.
    """
    found = materialise(seeds.select("node").distinct().withColumn("round", F.lit(0)), "reached")
    frontier, quiet, n = found, 0, 0
    while quiet < quiet_rounds:
        n += 1
        step = frontier.join(edges, F.col("node") == F.col(source)).select(F.col(target).alias("node")).distinct()
        frontier = materialise(step.join(found.select(F.col("node").alias("__found")), F.col("node").eqNullSafe(F.col("__found")), "left_anti").withColumn("round", F.lit(n)), "frontier")
        if frontier.isEmpty():
            quiet += 1
        elif max_rounds is not None and n >= max_rounds:
            raise ValueError(f"round {n} still finds nodes, and no more than {max_rounds} rounds are allowed")
        else:
            quiet, found = 0, materialise(found.unionByName(frontier), "reached")
    return found
