"""Shared helpers: durable cuts of the lineage, id handling, small numeric utilities."""

from __future__ import annotations

import contextlib
import gc
import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors share.

    It is the session's ``spark.checkpoint.dir``; only where that is unset under a local master (tests)
    is a temporary folder of this machine used instead. On a cluster such folders would be many, so it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="lexloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/lexloom"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the session's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends at those files,
    so a lost executor costs no recomputation and each consumer sees the same rows."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Cuts of one computation by name, so that those which later ones replace are deleted at once and not
    when the session ends. A table may go when all that read it is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, name)
        self.paths.setdefault(name, []).append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def free(self, *names: str) -> None:
        """Delete these tables (all versions), and let the cleaner drop shuffle files of plans that are gone."""
        self.forget(*names)
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def forget(self, *names: str) -> None:
        """Delete these tables (all versions)."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            for path in self.paths.pop(name, []):
                where = jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(conf).delete(where, True)


def give_back() -> None:
    """Return a Python worker's unused memory to the system: workers stay, and share the executor's limit."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


#: a session's setting, and the bytes that an Arrow batch for Python holds at most (and one row more)
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on rows go to Python workers in small batches. A batch is held several times over, by the
    executor's buffers and by the worker as Arrow, strings and result, and neither gives all of that back, so
    with long texts its size decides what an executor takes besides its heap. Results do not depend on it;
    a smaller limit of the session stays."""
    limit = spark.conf.get(BATCH_SETTING, None)
    if limit is None or spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


class Carried:
    """The columns of an input under private names while an operator works, so that none can clash with
    the operator's own. At the end they are back under their names; one that is named like one of
    ``outputs`` (in any case) comes back as ``input_`` and its name."""

    def __init__(self, docs: DataFrame, *outputs: str):
        self._private = [f"ll_in{i}" for i in range(len(docs.columns))]
        self._names, self.df = docs.columns, docs.toDF(*self._private)
        taken, self._public = {c.lower() for c in (*docs.columns, *outputs)}, []
        for c in docs.columns:
            public = c
            while public.lower() in taken and (public != c or c.lower() in {o.lower() for o in outputs}):
                public = f"input_{public}"
            taken.add(public.lower())
            self._public.append(public)

    def name(self, column: str) -> str:
        """The private name of a column of the input."""
        return self._private[[c.lower() for c in self._names].index(column.lower())]

    def back(self, **instead: Column) -> list[Column]:
        """All columns of the input, those named in ``instead`` replaced."""
        low = {k.lower(): v for k, v in instead.items()}
        return [low.get(c.lower(), F.col(p)).alias(public) for c, p, public in zip(self._names, self._private, self._public)]


def group_target(rows: int, least: int = 256, groups: int = 4096) -> int:
    """Rows that one salted group may hold: a fixed share of the table, so that the number of
    groups stays bounded while no task gets more than about 1/``groups`` of the rows."""
    return max(least, math.ceil(rows / groups))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
