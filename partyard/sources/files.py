"""Contracted run outputs and versioned snapshots on shared storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partyard.contracts import conform
from partyard.operators.ranking import top_parts
from partyard.session import stored


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all files that hold anything, with their place."""
    return _placed(spark.read.text(path), "value").filter(F.col("value").rlike(r"[^\x00-\x20]"))


def _placed(rows: DataFrame, *columns: str | Column) -> DataFrame:
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
        *columns,
    )


def _widest(lines: DataFrame) -> int:
    """Commas of the widest header line and one; 0 without any line."""
    first = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("value"))
    commas = F.length("value") - F.length(F.replace("value", F.lit(","), F.lit(""))) + 1
    return first.agg(F.max(commas)).first()[0] or 0


def _records(spark: SparkSession, path: str, multi_line: bool) -> DataFrame | None:
    """file, start, line and the cells of every record, headers among them."""
    lines = _lines(spark, path)
    if not multi_line:
        lines = stored(lines)
    width = _widest(lines)
    if not width:
        return None
    cells = [f"c{k}" for k in range(width)]
    kind = ", ".join(f"{c} string" for c in cells)
    if multi_line:
        reader = spark.read.schema(kind).option("multiLine", True).option("escape", '"')
        return stored(_placed(reader.csv(path), F.array(*cells).alias("cells")))
    read = lines.withColumn("read", F.from_csv("value", kind, {"escape": '"'}))
    return read.select("file", "start", "line", F.array(*(F.col(f"read.{c}") for c in cells)).alias("cells"))


def read_run_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    multi_line: bool = False,
    faults: str | None = None,
) -> DataFrame:
    """A run output with header lines, read under its contract.

    Columns are matched by name in every file, so a file may lack some or order them
    differently: every record meets its own file's header, of equal names the first
    counts.  Types come from the contract and nothing is inferred; a value its type
    cannot take is null, and ``faults`` names a column that counts those of a record.

    The files are read once, into a table below the shared folder; headers come from
    the parts of it that begin a file.  Neither the list of files nor the headers pass
    through the driver, only the width of the widest header.  Files stay splittable
    unless ``multi_line`` allows line breaks inside values; then a file is read whole by
    one task, and all are read once more for the headers' width.
    """
    wanted = T.StructType(list(schema) + ([T.StructField(faults, T.LongType())] if faults else []))
    records = _records(spark, path, multi_line)
    if records is None:
        return spark.createDataFrame([], wanted)
    heads = records.filter("start = 0").groupBy("file").agg(F.min(F.struct("line", "cells")).alias("head"))
    heads = heads.select(
        "file",
        F.col("head.line").alias("head"),
        F.transform("head.cells", lambda c: F.ltrim(c, F.lit("\ufeff"))).alias("names"),
    )
    rows = records.join(heads, "file").filter("line <> head")
    cells = [F.get("cells", F.coalesce(F.array_position("names", f.name), F.lit(0)).cast("int") - 1) for f in schema]
    values = [c.try_cast(f.dataType) for c, f in zip(cells, schema, strict=True)]
    out = [v.alias(f.name) for v, f in zip(values, schema, strict=True)]
    if faults:
        wrong = [(v.isNull() & c.isNotNull()).cast("long") for c, v in zip(cells, values, strict=True)]
        out.append(sum(wrong, F.lit(0).cast("long")).alias(faults))
    return rows.select(out)


def write_run_csv(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    rows = conform(df, schema) if schema is not None else df
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def save_rankings(ranked: DataFrame, full_path: str, top_path: str, top_n: int) -> None:
    """The full ranking and its first ``top_n`` rows per vehicle, as CSV."""
    write_run_csv(ranked, full_path)
    write_run_csv(top_parts(ranked, top_n), top_path)


def publish_snapshot(df: DataFrame, path: str, version: int) -> None:
    """Write one version of a keyed table; a repeated write replaces it.

    Upserts yield a new version instead of changing files in place, so readers
    of the old version are safe and a lost executor only repeats its tasks.
    """
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


def snapshot_versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a keyed table, from a listing of their success markers."""
    jvm = spark._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
    files = marker.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marker)
    names = (status.getPath().getParent().getName() for status in files or [])
    return sorted(int(name.split("=", 1)[1]) for name in names)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version; no other version is opened."""
    return spark.read.parquet(f"{path}/version={snapshot_versions(spark, path)[-1]}")
