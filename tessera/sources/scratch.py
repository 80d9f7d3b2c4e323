"""Tables that cut a plan's lineage: written to the folder that driver and executors share, and read again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """One of this session below spark.checkpoint.dir; without that setting a temporary one, for a local session only.
    It goes when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            made = tempfile.mkdtemp(prefix="tessera-")
            atexit.register(shutil.rmtree, made, True)
            base = f"file://{made}"
        _folders[app] = f"{base.rstrip('/')}/tables-{uuid.uuid4().hex}"
        atexit.register(drop, spark, _folders[app])
    return _folders[app]


def drop(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame) -> DataFrame:
    """df, computed once; it outlives lost executors."""
    path = f"{folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
