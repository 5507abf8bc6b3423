"""Scratch tables below the session's ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder is taken and remembered,
    in local mode only: on a cluster each machine would write to its own disk.
    """
    key = "spark.checkpoint.dir"
    root = spark.sparkContext.getConf().get(key) or spark.conf.get(key, None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError(f"{key} must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tallyframe-")
        spark.conf.set(key, root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written and read back, with its folder, for :func:`discard`.

    Cuts the lineage with files every executor can read again, so a lost
    executor costs the rerun of its own tasks only.
    """
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """As :func:`written`, for tables that stay until the result is read."""
    return written(df, name)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`written` once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
