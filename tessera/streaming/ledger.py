"""Batches that count once: their rows in a folder each, and a ledger of those that are whole."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "batch bigint, rows bigint, digest bigint"


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def in_ledger(spark: SparkSession, path: str, batch: int) -> bool:
    where, store = _path(spark, f"{path}/ledger/{batch:09d}.json")
    return store.exists(where)


def enter(spark: SparkSession, path: str, batch: int, rows: int, digest: int) -> None:
    """Makes a batch count: the entry is written beside and renamed, so it is there as a whole or not at all."""
    final, store = _path(spark, f"{path}/ledger/{batch:09d}.json")
    beside, _ = _path(spark, f"{path}/ledger/.{batch:09d}.tmp")
    out = store.create(beside, True)
    out.write(json.dumps({"batch": batch, "rows": rows, "digest": digest}).encode())
    out.close()
    store.rename(beside, final)


def committed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of the batches that the ledger has; what a batch that died left behind is not among them."""
    where, store = _path(spark, f"{path}/ledger")
    names = [s.getPath().getName() for s in store.listStatus(where)] if store.exists(where) else []
    at = [f"{path}/data/{n.removesuffix('.json')}" for n in sorted(names) if n.endswith(".json")]
    return spark.read.schema(schema).parquet(*at) if at else spark.createDataFrame([], schema)


def commit(rows: DataFrame, batch: int, path: str) -> bool:
    """Writes a batch's rows and enters it. A batch that the ledger has is left alone; what it left when it died is
    replaced. Says whether it was new."""
    spark = rows.sparkSession
    if in_ledger(spark, path, batch):
        return False
    at = f"{path}/data/{batch:09d}"
    rows.write.mode("overwrite").parquet(at)
    n, digest = spark.read.schema(rows.schema).parquet(at).agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64(*rows.columns)), F.lit(0))).first()
    enter(spark, path, batch, n, digest)
    return True


def run_once(stream: DataFrame, work: Callable[[DataFrame], DataFrame], key: str, path: str, checkpoint: str) -> None:
    """Runs ``work`` over all that a stream has, each key once over any number of runs, batches and repeats.

    A batch drops the keys that an earlier one has, works on the rest and commits it. Killed anywhere, the next run on
    this checkpoint does the batch again: it adds nothing if it was entered, and replaces its rows if it was not.
    """
    schema = work(stream).schema

    def each(rows: DataFrame, batch: int) -> None:
        if in_ledger(rows.sparkSession, path, batch):
            return
        done = committed(rows.sparkSession, path, schema).select(key).distinct()
        commit(work(rows.join(done, key, "left_anti")), batch, path)

    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
