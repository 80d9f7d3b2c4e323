"""Each track's winner at every frame of a stream, kept in state that ends with the track."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WINNERS = "track bigint, frame bigint, leader string, votes double"


IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


@contextmanager
def state_store(spark: SparkSession, ends: bool = True):
    """The state store that processors need, for the streams started meanwhile. Where no track ends, batches without
    rows, which only run timers, are left out."""
    now = {PROVIDER: ROCKS} | ({} if ends else {IDLE_BATCHES: "false"})
    before = {k: spark.conf.get(k) for k in now}
    for k, v in now.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


class RunningWinner(StatefulProcessor):
    """Per track: the confidence of each text so far and the frame that first had it, in one value, the leading text
    first. A timer ends a track that is not seen for ``idle`` milliseconds of event time; its state goes then. A timer
    that comes when the track was seen since is set anew, so batches leave it alone."""

    def __init__(self, idle: int):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.votes = handle.getValueState("votes", "seen long, votes array<struct<text: string, votes: double, first_seen: long>>")
        self.ends = handle.getValueState("ends", "at long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        batch = sorted(((int(r.frame), r.text, float(r.conf), r.ts) for r in rows), key=itemgetter(0))
        state = self.votes.get()
        votes = {x[0]: (x[1], x[2]) for x in state[1]} if state else {}
        best = next(iter(votes), None)
        total, first = votes.get(best, (-1.0, 0))
        at = round(total, 6)
        for frame, text, conf, _ in batch:
            known = votes.get(text, (0.0, frame))
            mine = votes[text] = (known[0] + conf, known[1])
            # only this text's total rose; totals compare by whole millionths, ties go to the text seen first
            rose = round(mine[0], 6)
            if text == best or (rose, -mine[1]) > (at, -first):
                best, (total, first), at = text, mine, rose
            yield Row(track=int(key[0]), frame=frame, leader=best, votes=round(total, 4))
        seen = max(int(pd.Timestamp(max(x[3] for x in batch)).value // 1_000_000), state[0] if state else 0)
        leader = [(best, total, first)]
        self.votes.update((seen, leader + [(text, *v) for text, v in votes.items() if text != best]))
        if state is None:
            self._until(seen + self.idle)

    def _until(self, at: int) -> None:
        self.handle.registerTimer(at)
        self.ends.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        end = self.votes.get()[0] + self.idle
        if end > timerValues.getCurrentWatermarkInMs():
            self._until(end)
        else:
            self.votes.clear()
            self.ends.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_running_winner(reads: DataFrame, idle: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """After each frame of a stream, the leading text of its track: what voting.running_winner gives of a table.

    Frames come in order from batch to batch; within one they are put in order. A track that is not seen for ``idle``
    of event time is over: its state goes, and later frames of that number start anew. Confidence is not negative; rows
    without a track, a time or a confidence are left out.
    """
    ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    whole = reads.where("track IS NOT NULL AND ts IS NOT NULL AND conf IS NOT NULL").withWatermark("ts", late)
    return whole.groupBy("track").transformWithState(RunningWinner(ms), WINNERS, "Append", "EventTime")


def state_rows(spark: SparkSession, checkpoint: str, name: str = "votes") -> DataFrame:
    """What a stopped stream's state of that name holds."""
    return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
