"""Track votes over a file stream, with a checkpoint to go on from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

READS = "track bigint, frame bigint, text string, conf double, ts timestamp"


def read_stream(spark: SparkSession, path: str, files_per_trigger: int = 4) -> DataFrame:
    return spark.readStream.schema(READS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def stream_votes(reads: DataFrame, late: str | None = None) -> DataFrame:
    """Confidence per track and text so far. With ``late``, hourly windows close that much later and
    their state goes; without, state grows with the tracks."""
    sums = [F.sum("conf").alias("votes"), F.min("frame").alias("first_seen"), F.count("*").alias("n")]
    if late is None:
        return reads.groupBy("track", "text").agg(*sums)
    return reads.withWatermark("ts", late).groupBy(F.window("ts", "1 hour"), "track", "text").agg(*sums)


def stream_sessions(reads: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    return reads.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("s"), "track").agg(F.count("*").alias("n"), F.sum("conf").alias("votes")).select("track", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n", "votes")


def run_to_files(df: DataFrame, path: str, checkpoint: str) -> None:
    """Appends to Parquet, each input once over any number of runs on one checkpoint."""
    df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def closing(reads: DataFrame, after: str = "1 day") -> DataFrame:
    """A last row of no track, so much later than all others that a watermark which has seen it closes every session."""
    return reads.agg(F.max("ts").alias("t")).where("t IS NOT NULL").select(F.lit(None).cast("bigint").alias("track"), F.lit(None).cast("bigint").alias("frame"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("double").alias("conf"), (F.col("t") + F.expr(f"INTERVAL {after}")).alias("ts"))


def run_updates(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Runs in update mode; each batch's changed rows go to files, with the batch's number. A batch that runs
    again replaces its files. Nothing gathers on the driver."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.read.parquet(path)


def last_state(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Each key's row as the last batch that changed it left it."""
    rest = [c for c in changes.columns if c not in (*keys, "batch")]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("s")).select(*keys, "s.*")
