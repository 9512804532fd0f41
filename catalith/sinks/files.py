"""Strict exports: all-or-nothing records, JSON, JSON Lines, CSV, and driver files written atomically."""

from __future__ import annotations

import json
import os
import tempfile
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


# Columns of the export, in order.
EXPORT_COLUMNS = [
    "domain", "productName", "productUrl", "channel", "externalId", "sourceUrl", "capturedAt", "crawlScope", "source", "price", "currency", "listPrice", "rating", "reviewCount", "salesRank", "inStock", "unitsSold", "unitsSoldPeriod",
    "images", "healthFunctions", "mainIngredients", "productForm", "variantAttrs", "titleRaw", "updateExisting", "error",
]


@dataclass(frozen=True)
class Export:
    """Rows fit for export, rows with their errors, and one row of counts."""

    rows: DataFrame
    errors: DataFrame
    summary: DataFrame


def gate(checks: dict[str, Column]) -> Column:
    """VAL-10: names of the checks that don't hold, in declared order; null counts as not holding."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()]))


def build_export(rows: DataFrame, record: list[str], checks: dict[str, Column]) -> Export:
    """SNK-01: rows pass only if every row of their record passes; the others come with what they lack."""
    checked = rows.withColumn("missing", gate(checks))
    bad = checked.filter(F.size("missing") > 0)
    good = checked.join(bad.select(*record).distinct(), record, "left_anti").drop("missing")
    summary = checked.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.size("missing") == 0).alias("valid_rows"))
    return Export(good, bad, summary)


def flat(df: DataFrame) -> DataFrame:
    """SNK-03: nested columns as JSON text, for CSV."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (ArrayType, MapType, StructType))]
    return df.withColumns({c: F.to_json(c) for c in nested}) if nested else df


def envelope(df: DataFrame) -> DataFrame:
    """SNK-03: each row as the request {"json": row}, absent values left out."""
    return df.select(F.to_json(F.struct(F.struct(*df.columns).alias("json"))).alias("value"))


def export_columns(df: DataFrame) -> DataFrame:
    """SNK-03: the columns of the export, in their order and by their names; they are found under these names or with underscores, absent ones are null."""
    snake = {c: "".join("_" + x.lower() if x.isupper() else x for x in c) for c in EXPORT_COLUMNS}
    pick = lambda c: F.col(c) if c in df.columns else F.col(snake[c]) if snake[c] in df.columns else F.lit(None).cast("string")
    return df.select(*[pick(c).alias(c) for c in EXPORT_COLUMNS])


def write(df: DataFrame, path: str, kind: str) -> None:
    """SNK-03, SNK-04: as 'jsonl', 'json' (envelopes), 'csv' (quoted, header) or 'export' (csv of the export's columns, each file with a byte order mark);
    the job commits all files or none."""
    if kind == "export":
        out = flat(export_columns(df))
        out = out.withColumnRenamed(out.columns[0], "\ufeff" + out.columns[0])
        out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    elif kind == "csv":
        flat(df).write.mode("overwrite").option("header", True).option("quoteAll", False).option("escape", '"').csv(path)
    elif kind == "json":
        envelope(df).write.mode("overwrite").text(path)
    else:
        df.write.mode("overwrite").json(path)


def _remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_gated(export: Export, complete: bool, folder: str, kind: str = "jsonl") -> str:
    """SNK-02: formal rows only for a complete run without errors; else those of an earlier run are deleted, and candidates, errors and a report of the counts
    are written. Returns what was written."""
    spark = export.rows.sparkSession
    if complete and export.errors.isEmpty():
        write(export.rows, f"{folder}/formal", kind)
        _remove(spark, [f"{folder}/{name}" for name in ("candidates", "errors", "report")])
        return "formal"
    _remove(spark, [f"{folder}/formal"])
    write(export.rows, f"{folder}/candidates", kind)
    write(export.errors, f"{folder}/errors", "jsonl")
    write(export.summary.withColumn("run_complete", F.lit(complete)), f"{folder}/report", "jsonl")
    return "candidates"


def write_by_task(results: DataFrame, path: str) -> None:
    """SNK-05: worker results, one folder per task."""
    results.write.mode("overwrite").partitionBy("task_id").json(path)


def write_json_atomic(value: object, path: str) -> None:
    """SNK-04: a small driver file, complete or not at all."""
    folder = os.path.dirname(os.path.abspath(path))
    handle, name = tempfile.mkstemp(dir=folder, suffix=".part")
    with os.fdopen(handle, "w", encoding="utf-8") as file:
        json.dump(value, file, ensure_ascii=False, indent=2)
    os.replace(name, path)
