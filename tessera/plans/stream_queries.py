"""Queries whose input comes as a stream: votes, winners, sessions, labels."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import voting
from ..sources import scratch, sinks
from ..streaming import ledger, tracks
from ..streaming import votes as stream
from . import bindings as b
from .more_queries import VOTES
from .queries import ORACLE, query, shown

#: Slices that a table arrives in.
SLICES = 4


class Arrivals:
    """A table as the input of a stream: rows are written once, in parallel, and come slice by slice, in order.

    ``next()`` moves the next slice to where the stream reads, and says whether there was one.
    """

    def __init__(self, rows: DataFrame, order: str, slices: int = SLICES):
        self.spark, self.schema = rows.sparkSession, rows.schema
        self.at = f"{scratch.folder(self.spark)}/stream-{uuid.uuid4().hex}"
        low, high = rows.agg(F.min(order), F.max(order)).first()
        span = (high - low + 1) if low is not None else 1
        rows.withColumn("__slice", F.floor((F.col(order) - F.lit(low)) * slices / span)).write.partitionBy("__slice").parquet(f"{self.at}/waiting")
        self.left: Iterator[int] = iter(range(slices))
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        self.path, self.store = path, path(self.at).getFileSystem(self.spark._jsc.hadoopConfiguration())
        self.store.mkdirs(path(f"{self.at}/in"))

    def next(self) -> bool:
        for k in self.left:
            come = self.path(f"{self.at}/waiting/__slice={k}")
            if self.store.exists(come):
                return self.store.rename(come, self.path(f"{self.at}/in/{k:06d}"))
        return False

    def last(self, rows: DataFrame) -> None:
        """More rows, after all slices."""
        rows.write.parquet(f"{self.at}/in/last")

    def read(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).option("recursiveFileLookup", True).parquet(f"{self.at}/in")


def _reads(spark, sf) -> DataFrame:
    return b.reads(spark, sf).select("track", "frame", "text", "conf", "ts")


def _after_each_slice(come: Arrivals, run) -> None:
    while come.next():
        run()


@query(VOTES + " SELECT track, text, round(votes, 4) AS votes, first_seen, n FROM v")
def stream_vote(spark, sf):
    """Votes after the last batch of a stream in update mode."""
    return shown(stream.last_state(_vote_changes(spark, sf), ["track", "text"]), 4)


def _vote_changes(spark, sf) -> DataFrame:
    come = Arrivals(_reads(spark, sf), "frame")
    _after_each_slice(come, lambda: stream.run_updates(stream.stream_votes(come.read()), f"{come.at}/out", f"{come.at}/ck"))
    return spark.read.parquet(f"{come.at}/out")


@query(VOTES + ", r AS (SELECT *, row_number() OVER (PARTITION BY track ORDER BY round(votes, 6) DESC, first_seen) AS r FROM v) SELECT track, text, round(votes, 4) AS votes FROM r WHERE r = 1")
def stream_winner(spark, sf):
    """Each track's winner after the last batch of a stream in update mode, whose batches hold changes only."""
    return shown(voting.winner(stream.last_state(_vote_changes(spark, sf), ["track", "text"])).select("track", "text", "votes"), 4)


@query(ORACLE["track_vote_running"])
def stream_running_winner(spark, sf):
    """Each track's winner at every frame of a stream, from state."""
    come = Arrivals(_reads(spark, sf), "frame")
    with tracks.state_store(spark, ends=False):
        # no track ends, however long it is away
        _after_each_slice(come, lambda: stream.run_to_files(tracks.stream_running_winner(come.read(), idle="4000 days"), f"{come.at}/out", f"{come.at}/ck"))
    return spark.read.schema(tracks.WINNERS).parquet(f"{come.at}/out")


@query("""WITH e AS (SELECT user_id AS track, ts, value, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE AS gap FROM events), s AS (SELECT *, sum(coalesce(gap, true)::INT) OVER (PARTITION BY track ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT track, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n, round(sum(value), 4) AS votes FROM s GROUP BY track, k""")
def stream_session(spark, sf):
    """Sessions of a stream. After its slices a last row of no track moves the watermark past them all."""
    come = Arrivals(_reads(spark, sf), "frame")
    run = lambda: stream.run_to_files(stream.stream_sessions(come.read()), f"{come.at}/out", f"{come.at}/ck")
    _after_each_slice(come, run)
    come.last(stream.closing(_reads(spark, sf)))
    run()
    out = spark.read.schema("track bigint, start timestamp, end timestamp, n bigint, votes double").parquet(f"{come.at}/out")
    return shown(out.select("track", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n", "votes"), 4)


# labels, each image once ------------------------------------------------------------------------

#: Fixed value: the least confidence of a pseudo label.
LEAST = 0.1


def _labelled(boxes: DataFrame) -> DataFrame:
    """Label text of each image that has a box of LEAST confidence."""
    sure = boxes.where(F.col("conf") >= LEAST).withColumn("stem", F.col("image_id")).withColumn("line_no", F.col("box_id"))
    return sinks.label_files(sure).select("split", F.col("stem").alias("image_id"), "text")



@query(f"""WITH {b.ANNOTATIONS}, k AS (SELECT image_id, min(floor((box_id - lo) * {SLICES} / (hi - lo + 1))) AS k FROM a, (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events) WHERE value / 500.0::DOUBLE >= {LEAST} GROUP BY image_id),
s AS (SELECT a.* FROM a JOIN k USING (image_id), (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events) WHERE floor((box_id - lo) * {SLICES} / (hi - lo + 1)) = k)
SELECT split, image_id, string_agg(printf('%d %.6f %.6f %.6f %.6f', 0, xc, yc, w, h), chr(10) ORDER BY box_id) AS text FROM s WHERE value / 500.0::DOUBLE >= {LEAST} GROUP BY split, image_id""")
def labels_once(spark, sf):
    """Label files of images that come as a stream, each image once: from the first slice that has a sure box of it.
    The run dies after it wrote its second batch and before that counted; the next one goes on."""
    a = b.annotations(spark, sf).select("split", "image_id", "box_id", "xc", "yc", "w", "h", (F.col("value") / 500.0).alias("conf"))
    come = Arrivals(a, "box_id")
    out, ck = f"{come.at}/out", f"{come.at}/ck"
    come.next()
    ledger.run_once(come.read(), _labelled, "image_id", out, ck)
    # what a run leaves that dies between its rows and their entry: more rows than count, and no entry
    _labelled(spark.read.schema(come.schema).option("recursiveFileLookup", True).parquet(f"{come.at}/in")).write.parquet(f"{out}/data/{1:09d}")
    _after_each_slice(come, lambda: ledger.run_once(come.read(), _labelled, "image_id", out, ck))
    return ledger.committed(spark, out, "split string, image_id bigint, text string")
