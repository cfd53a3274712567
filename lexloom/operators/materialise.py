"""Cutting long lineages: intermediate rows written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str = "rows") -> str:
    """A new path in the session's checkpoint folder; what is written there goes when the session's JVM ends.

    Without such a folder a temporary one is made, but only under a local master: executors of a cluster would
    each write to a disk of their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="lexloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/lexloom/{name}-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def cut(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` written to the session's checkpoint folder and read back."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
