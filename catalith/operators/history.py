"""History of changing attributes: type-two dimension tables built from snapshots and kept by merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.runtime import literal_table, materialise

#: A key with more rows than this is hot: its time line is cut into pieces, so that no task holds all its rows.
HOT_ROWS = 1_000_000
#: Hot keys looked for, and keys the sketch that finds them tracks.
HOT_KEYS, TRACKED_KEYS = 1000, 100_000
#: Length of the pieces the time line of a hot key is cut into.
PIECE = "hour"


def _hash(attributes: list[str]) -> Column:
    return F.xxhash64(*[F.struct(F.col(a).isNull().alias("n"), F.col(a).alias("v")) for a in attributes])


def hot_keys(snapshots: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> list[int]:
    """Hashes of the keys with more than `hot_rows` rows, of at most HOT_KEYS of them (the ones with most rows).

    One pass over the key columns with a frequent-items sketch per task: nothing is shuffled but the sketches. The list only decides how rows
    are spread over tasks, never what comes out.
    """
    counted = snapshots.select(F.xxhash64(F.struct(*keys)).alias("h")).agg(F.expr(f"approx_top_k(h, {HOT_KEYS}, {TRACKED_KEYS})").alias("top")).first()
    return [x["item"] for x in counted["top"] or [] if x["count"] > hot_rows]


def latest_per_time(snapshots: DataFrame, keys: list[str], time_col: str, attributes: list[str], order: list[str], piece: str | None = None) -> DataFrame:
    """(key struct, piece where given, at, attributes): one row per key and time, that of the greatest `order` (the last of repeated or corrected captures).

    Rows without a time have no place on a time line and are left out. Rows are shuffled once, by key and piece of time (no pieces where
    `piece` is None); keys stand in one struct, so null parts compare as equal.
    """
    at = F.col(time_col)
    line = ["key", "piece"] if piece else ["key"]
    cut = [F.date_trunc(piece, at.cast("timestamp_ntz")).alias("piece")] if piece else []
    rows = snapshots.filter(at.isNotNull()).select(F.struct(*keys).alias("key"), *cut, at.alias("at"), *attributes, F.struct(*order).alias("nth"))
    last = rows.repartition(*line).groupBy(*line, "at").agg(F.max_by(F.struct(*attributes), F.struct("nth", F.xxhash64(*attributes))).alias("a"))
    return last.select(*line, "at", *[F.col(f"a.{c}").alias(c) for c in attributes])


def _changes(events: DataFrame, line: list[str], attributes: list[str]) -> DataFrame:
    """(line, at, nth in the line, known attributes, those known before as __b_...): the rows of each line (a key, or a piece of a hot key) that
    may start a version: its first one, and those whose known values differ from the ones known before in the line."""
    inside = Window.partitionBy(*line).orderBy("at")
    known = events.select(*line, "at", F.row_number().over(inside).alias("nth"), *[F.last(a, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias(a) for a in attributes])
    before = known.withColumn("attr_hash", _hash(attributes)).withColumns({"__hash": F.lag("attr_hash").over(inside)} | {f"__b_{a}": F.lag(a).over(inside) for a in attributes})
    differs = reduce(Column.__or__, [~F.col(a).eqNullSafe(F.col(f"__b_{a}")) for a in attributes])
    return before.filter((F.col("nth") == 1) | (F.col("attr_hash") != F.col("__hash")) | differs)


def _whole_lines(events: DataFrame, attributes: list[str]) -> DataFrame:
    """Versions of keys whose time line is whole: every change is a version, closed by the next one. No further shuffle."""
    closing = F.lead("at").over(Window.partitionBy("key").orderBy("at"))
    return _changes(events, ["key"], attributes).select("key", F.col("at").alias("valid_from"), closing.alias("valid_to"), *attributes, "attr_hash")


def _cut_lines(events: DataFrame, attributes: list[str]) -> DataFrame:
    """Versions of hot keys, whose time lines are cut: changes of each piece are written (a few rows of each), the values known at the end of each
    piece are carried over the pieces by a window over one row per piece, and changes that were none beside the carried values drop out."""
    changes = materialise(_changes(events, ["key", "piece"], attributes), "changes")
    ends = changes.groupBy("key", "piece").agg(F.max_by(F.struct(*attributes), "at").alias("e")).select("key", "piece", *[F.col(f"e.{a}").alias(f"__e_{a}") for a in attributes])
    line = Window.partitionBy("key").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("key", "piece", F.count(F.lit(1)).over(line).alias("__pieces"), *[F.last(f"__e_{a}", ignorenulls=True).over(line).alias(f"__c_{a}") for a in attributes])
    joined = changes.join(carried, ["key", "piece"])
    for a in attributes:
        joined = joined.withColumn(a, F.coalesce(a, f"__c_{a}")).withColumn(f"__b_{a}", F.coalesce(f"__b_{a}", f"__c_{a}"))
    first = (F.col("nth") == 1) & (F.col("__pieces") == 0)
    real = joined.filter(first | reduce(Column.__or__, [~F.col(a).eqNullSafe(F.col(f"__b_{a}")) for a in attributes]))
    versions = materialise(real.select("key", "piece", F.col("at").alias("valid_from"), *attributes, _hash(attributes).alias("attr_hash")), "versions")
    starts = versions.groupBy("key", "piece").agg(F.min("valid_from").alias("__first"))
    following = starts.select("key", "piece", F.lead("__first").over(Window.partitionBy("key").orderBy("piece")).alias("__next"))
    inside = Window.partitionBy("key", "piece").orderBy("valid_from")
    closed = versions.withColumn("__inside", F.lead("valid_from").over(inside)).join(following, ["key", "piece"])
    return closed.select("key", "valid_from", F.coalesce("__inside", "__next").alias("valid_to"), *attributes, "attr_hash")


def build_history(snapshots: DataFrame, keys: list[str], time_col: str, attributes: list[str], order: list[str], piece: str = PIECE, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Versions of each key: (keys, valid_from, valid_to or null, attributes as known, attr_hash).

    Of rows with the same key and time the one with the greatest `order` counts. A null attribute says nothing: the last known value stands.
    The first row of a key starts a version, and so does each row whose known attributes differ (by hash, then by value) from those of the
    version then open, which it closes. Rows are read for the history and shuffled once, by key, and finished in that stage. Only keys with more
    than `hot_rows` rows, which a sketch finds beforehand, are cut into pieces of time, so that they are spread over many tasks; of the 1000
    largest such keys, a smaller one is sorted as a whole in one task, on disk where need be. Keys may be null, rows may repeat, an empty
    table gives an empty history.
    """
    spark = snapshots.sparkSession
    hot = hot_keys(snapshots, keys, hot_rows)
    if not hot:
        versions = _whole_lines(latest_per_time(snapshots, keys, time_col, attributes, order), attributes)
    else:
        marked = snapshots.withColumn("__h", F.xxhash64(F.struct(*keys)))
        listed = F.broadcast(literal_table(spark, [(h,) for h in hot], "__h bigint"))
        rest = _whole_lines(latest_per_time(marked.join(listed, "__h", "left_anti"), keys, time_col, attributes, order), attributes)
        cut = _cut_lines(latest_per_time(marked.join(listed, "__h", "left_semi"), keys, time_col, attributes, order, piece), attributes)
        versions = rest.unionByName(cut)
    return versions.select(*[F.col(f"key.{k}").alias(k) for k in keys], "valid_from", "valid_to", *attributes, "attr_hash")


def merge_history(history: DataFrame | None, snapshots: DataFrame, keys: list[str], time_col: str, attributes: list[str], order: list[str], earlier: DataFrame | None = None) -> DataFrame:
    """The history after a batch of snapshots: closes changed versions with an end date and inserts the new ones. None is the history before the first batch.

    Versions of keys not in the batch pass unchanged. The batch may hold a key any number of times. `earlier` are all captures the history was
    built from, with the columns of the batch: keys of the batch are rebuilt from them, so late captures and corrections give what a rebuild
    of everything gives. A key of the batch that has versions but no earlier capture raises.
    Versions do not tell when they were seen again, nor which values were merely carried, so without `earlier` every capture of the batch must
    be later than all captures of its key before; a capture not after the start of the last version raises, but one between that start and a
    later capture of the same values can't be told from the history. Without `earlier` only the open version of a key of the batch meets its
    captures; its closed versions pass.
    """
    if history is None:
        return build_history(snapshots, keys, time_col, attributes, order)
    batch = snapshots.filter(F.col(time_col).isNotNull()).select(F.struct(*keys).alias("__key"), F.col(time_col).cast(history.schema["valid_from"].dataType).alias("__at"))
    touched = batch.select("__key").distinct()
    marked = history.withColumn("__key", F.struct(*keys))
    columns = list(dict.fromkeys([*keys, time_col, *attributes, *order]))
    at = F.col(time_col).cast(history.schema["valid_from"].dataType)
    new = snapshots.select(*columns).withColumn(time_col, at)
    if earlier is not None:
        kept = marked.join(touched, "__key", "left_anti").drop("__key")
        known = marked.join(touched, "__key", "left_semi")
        old = earlier.select(*columns).withColumn(time_col, at).withColumn("__key", F.struct(*keys)).join(touched, "__key", "left_semi")
        if not known.join(old.filter(F.col(time_col).isNotNull()).select("__key").distinct(), "__key", "left_anti").isEmpty():
            raise ValueError("earlier captures of a key of the batch are missing")
        rebuilt = build_history(old.drop("__key").unionByName(new), keys, time_col, attributes, order)
    else:
        current = marked.filter(F.col("valid_to").isNull())
        if not batch.join(current, "__key").filter(F.col("__at") <= F.col("valid_from")).isEmpty():
            raise ValueError("the batch holds late captures: the earlier captures are needed")
        kept = marked.filter(F.col("valid_to").isNotNull()).unionByName(current.join(touched, "__key", "left_anti")).drop("__key")
        extra = [c for c in columns if c not in (*keys, time_col, *attributes)]
        open_ones = current.join(touched, "__key", "left_semi").select(*keys, F.col("valid_from").alias(time_col), *attributes, *[F.lit(None).cast(snapshots.schema[c].dataType).alias(c) for c in extra])
        rebuilt = build_history(open_ones.unionByName(new), keys, time_col, attributes, order)
    return kept.select(*rebuilt.columns).unionByName(rebuilt)
