"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space, everywhere in this subpackage: space and the controls 9 to 13.
WS = " \t\n\x0b\x0c\r"
#: A word: a run of anything else (for Java's and Python's regular expressions).
WORD = r"[^\x20\x09-\x0D]+"

_scratch: dict[str, str] = {}
#: Bytes of a batch between the JVM and Python workers: Spark's own limit, and the one that this subpackage
#: puts in its place. A task holds a batch on both sides, with room to grow, beside the heap.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
SPARK_BYTES, LESS_BYTES = "67108864b", "8388608b"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The column as text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def scratch(spark: SparkSession) -> str:
    """A folder of this session below spark.checkpoint.dir, which driver and executors share.

    Where the setting is absent (tests, a single machine) a temporary folder serves.
    The folder goes when the driver's process ends. With the first call the session gets the smaller
    batches of LESS_BYTES, unless it has a limit of its own.
    """
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        if spark.conf.get(BATCH, None) == SPARK_BYTES:
            spark.conf.set(BATCH, LESS_BYTES)
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            base = "file://" + tempfile.mkdtemp(prefix="tessera-")
        _scratch[app] = f"{base.rstrip('/')}/tessera-{uuid.uuid4().hex}"
        atexit.register(_drop, spark, _scratch[app])
    return _scratch[app]


def _drop(spark: SparkSession, path: str) -> None:
    """At the driver's end, whether the session still runs or was stopped."""
    if spark.sparkContext._jsc is not None:
        drop_path(spark, path)
    elif (jvm := SparkContext._jvm) is not None:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(where, True)


def drop_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def written_at(df: DataFrame) -> tuple[DataFrame, str]:
    """df, computed once and read back from a table in the shared folder; and where that is.

    Unlike a cache it outlives lost executors, and unlike checkpoint() it runs the last
    stage once.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame) -> DataFrame:
    return written_at(df)[0]


def trim() -> None:
    """Gives free memory back to the system."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def frugal(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A function of batches that gives free memory back to the system when a task ends: Python workers
    outlive their tasks, and idle ones would hold what the largest of them took."""

    @wraps(run)
    def each(batches):
        try:
            yield from run(batches)
        finally:
            trim()

    return each
