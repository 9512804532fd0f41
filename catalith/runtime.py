"""Session-level helpers shared by all operators: shared folder, written intermediates, sides of joins, bounded reference lists."""

from __future__ import annotations

import atexit
import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, Row, SparkSession

#: Rows a reference list read by the driver may have.
SMALL_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share, as the cluster names it in spark.checkpoint.dir. Where it is unset a local session gets a folder of its own;
    on a cluster, whose executors would not see such a folder, it raises."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        named = "file://" + os.path.join(tempfile.gettempdir(), f"catalith-{os.getuid()}")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


_runs: dict[str, tuple] = {}


def run_dir(spark: SparkSession) -> str:
    """Folder for the intermediates of this application, below the shared folder; deleted by `clear_intermediates`, at the latest when the driver ends."""
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/catalith-{app}"
    if app not in _runs:
        _runs[app] = (spark._jvm, spark._jsc.hadoopConfiguration(), path)
    return path


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table."""
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def clear_intermediates(spark: SparkSession | None = None) -> None:
    """Delete what this driver's applications (or that of `spark`) wrote below their run folders; results read from it must have been consumed."""
    for app in [spark.sparkContext.applicationId] if spark is not None else list(_runs):
        if app in _runs:
            jvm, conf, path = _runs.pop(app)
            try:
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(conf).delete(target, True)
            except Exception:  # noqa: BLE001 - the JVM may have ended before the driver's Python did
                pass


atexit.register(clear_intermediates)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back: cuts lineage, survives the loss of executors."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _write_shared(spark: SparkSession, payload: bytes, name: str) -> str:
    path = f"{run_dir(spark)}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.create(target, True)
    try:
        stream.write(payload)
    finally:
        stream.close()
    return files.makeQualified(target).toString()


def share_bytes(spark: SparkSession, payload: bytes, label: str) -> str:
    """Put one file into the shared folder, ship it to every executor and return the name for SparkFiles.get."""
    name = f"{label}-{uuid.uuid4().hex}"
    spark.sparkContext.addFile(_write_shared(spark, payload, name))
    return name


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this library importable in the Python workers of every executor, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root, buffer = Path(__file__).parent, io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*")):
            if file.is_file() and "__pycache__" not in file.parts:
                archive.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(_write_shared(spark, buffer.getvalue(), f"catalith-{uuid.uuid4().hex}.zip"))
    _shipped.add(app)


def dimension(df: DataFrame, label: str = "side") -> DataFrame:
    """`df` written once to the shared folder, for a join side that is usually small: its bytes are then known to the planner, which broadcasts it
    only within spark.sql.autoBroadcastJoinThreshold and shuffles beyond. Nothing is computed twice and no hint overrides the size."""
    return materialise(df, label)


def bounded_rows(df: DataFrame, max_rows: int = SMALL_ROWS) -> list[Row]:
    """Rows of a reference table for use on the driver; raises beyond `max_rows` rather than dropping any."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"a reference table has more than {max_rows} rows")
    return rows


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A fixed table of the library as a local relation (no Python worker, no file), e.g. literal_table(spark, [("g", 1)], "unit string, n int"); decimals are written decimal(20_6)."""
    fields = [[x.replace("_", ",") if x.startswith("decimal") else x for x in part.split()] for part in schema.split(",")]

    def literal(value: object, kind: str) -> str:
        if value is None:
            return f"CAST(NULL AS {kind})"
        if isinstance(value, bool) or not isinstance(value, str):
            return f"CAST({value} AS {kind})"
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(literal(v, f[1]) for v, f in zip(row, fields, strict=True)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(f[0] for f in fields)})")
