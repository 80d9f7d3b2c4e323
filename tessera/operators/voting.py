"""Votes over the readings of a track."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F


def votes(reads: DataFrame, key: str = "track", text: str = "text", conf: str = "conf", frame: str = "frame") -> DataFrame:
    return reads.groupBy(key, text).agg(F.sum(conf).alias("votes"), F.min(frame).alias("first_seen"), F.count("*").alias("n"))


def winner(votes: DataFrame, key: str = "track") -> DataFrame:
    """The text with the most confidence of each track, ties to the one seen first."""
    order = W.partitionBy(key).orderBy(F.desc(F.round("votes", 6)), "first_seen")
    return votes.withColumn("r", F.row_number().over(order)).where("r = 1").drop("r")


def best_read(reads: DataFrame, key: str = "track", conf: str = "conf", frame: str = "frame") -> DataFrame:
    """The reading of the highest confidence, the first of equals."""
    order = W.partitionBy(key).orderBy(F.desc(conf), frame)
    return reads.withColumn("r", F.row_number().over(order)).where("r = 1").drop("r")


def running_winner(reads: DataFrame, key: str = "track", text: str = "text", conf: str = "conf", frame: str = "frame") -> DataFrame:
    """After each frame, the leading text of its track: that with the most confidence so far, ties to the
    one seen first.

    Confidence is not negative, so a text's total only rises, and what leads after a frame is the greatest
    of all totals up to it: a running sum per text and a running maximum per track, without arrays. Totals
    compare by whole millionths.
    """
    texts = W.partitionBy(key, text).orderBy(frame)
    rows = reads.select(key, frame, text, F.sum(conf).over(texts.rowsBetween(W.unboundedPreceding, 0)).alias("v"), F.min(frame).over(texts).alias("first"))
    best = F.max(F.struct(F.round("v", 6).alias("at"), (-F.col("first")).alias("first"), F.col("v"), F.col(text).alias("t")))
    rows = rows.withColumn("o", best.over(W.partitionBy(key).orderBy(frame).rowsBetween(W.unboundedPreceding, 0)))
    return rows.select(key, frame, F.col("o.t").alias("leader"), F.round("o.v", 4).alias("votes"))
