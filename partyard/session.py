"""Session helper for tests, the bench and scripts; a cluster brings its own."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession


# Settings the plans are written for.  Whole-stage methods beyond 8,000 bytes are
# never compiled by HotSpot; below the limit Spark falls back to projections whose
# code it can split.
PLAN_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in PLAN_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", app: str = "partyard", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("PARTYARD_DRIVER_MEMORY", "8g"))
    )
    for key, value in (PLAN_SETTINGS | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint folder.

    It is never guessed: a folder of one machine's own would be unreadable to the
    others.  Callers without a cluster name one with ``SparkContext.setCheckpointDir``.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return named.rstrip("/")


def spread(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Deal rows out by their keys, to as many tasks as a shuffle has.

    For costly work right behind a scan: a file, or a row group of one, is else one task
    however much work its rows make.  The number is named, so that Spark does not put the
    shares, small as stored rows, together again.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def settle(df: DataFrame) -> DataFrame:
    """Store a small result that several later steps read, and cut its lineage.

    The checkpoint lives in the shared folder, so it outlasts lost executors.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Write a result as Parquet below the shared folder and read it back.

    For larger results than ``settle``: columns stay prunable and compressed.
    """
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
