import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import voting
from tessera.plans import stream_queries
from tessera.streaming import ledger, tracks
from tessera.streaming import votes as stream
from tests.conftest import SF

T = dt.datetime(2024, 1, 1)


def reads(spark, rows):
    return spark.createDataFrame([(t, f, x, c, T + dt.timedelta(minutes=m)) for t, f, x, c, m in rows], stream.READS)


def test_winners_at_every_frame_and_state_that_ends(spark, tmp_path):
    r = random.Random(4)
    rows = [(k, f, r.choice("abc"), r.randrange(9) / 8, f) for k in (1, 2) for f in range(40)]
    rows += [(3, 500, None, 0.5, 500), (None, 501, "a", 0.5, 501), (3, 502, "a", None, 502)]
    path, ck, out = (f"{tmp_path}/{x}" for x in ("in", "ck", "out"))
    first, rest = reads(spark, [x for x in rows if x[1] < 17]), reads(spark, [x for x in rows if x[1] >= 17])
    run = lambda: stream.run_to_files(tracks.stream_running_winner(stream.read_stream(spark, path), idle="60 minutes", late="10 minutes"), out, ck)
    with tracks.state_store(spark):
        first.write.mode("append").parquet(path)
        run()
        assert tracks.state_rows(spark, ck).count() > 0
        rest.write.mode("append").parquet(path)
        run()
        run()  # nothing new: nothing again
        got = spark.read.schema(tracks.WINNERS).parquet(out)
        whole = reads(spark, [x for x in rows if x[0] is not None and x[3] is not None])
        want = voting.running_winner(whole).collect()
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want)) and len(want) == 81
        stream.closing(whole, "2 days").withColumn("track", F.lit(9).cast("bigint")).withColumn("conf", F.lit(1.0)).withColumn("frame", F.lit(0).cast("bigint")).write.mode("append").parquet(path)
        run()
        left = {x.key.track for x in tracks.state_rows(spark, ck).select("key").collect()}
        assert left == {9}  # the tracks that are over have no state
        assert spark.read.format("statestore").option("stateVarName", "ends").load(ck).count() == 1
    assert spark.conf.get(tracks.PROVIDER) != tracks.ROCKS


def test_a_track_seen_after_its_timer_was_set_goes_on(spark, tmp_path):
    path, ck, out = (f"{tmp_path}/{x}" for x in ("in", "ck", "out"))
    rows = [(1, f, "ab"[f % 40 > 0], 0.25 + f % 3, f) for f in range(0, 160, 40)] + [(2, 0, "a", 0.5, 0)]  # track 1 comes every 40 minutes
    timers = []
    with tracks.state_store(spark):
        for k in range(4):
            reads(spark, [x for x in rows if x[1] == 40 * k]).write.mode("append").parquet(path)
            stream.run_to_files(tracks.stream_running_winner(stream.read_stream(spark, path), idle="60 minutes", late="0 minutes"), out, ck)
            timers.append({x.key.track: x.value["at"] for x in spark.read.format("statestore").option("stateVarName", "ends").load(ck).collect()})
    assert [{*t} for t in timers] == [{1, 2}, {1, 2}, {1}, {1}]
    assert timers[0][1] == timers[1][1] < timers[2][1]  # a batch leaves the timer alone; one that comes early is set anew
    got = spark.read.schema(tracks.WINNERS).parquet(out)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, voting.running_winner(reads(spark, rows)).collect()))


def test_sessions_come_from_the_stream(spark, monkeypatch):
    whole = stream_queries.stream_session(spark, SF).count()
    assert whole > 100
    monkeypatch.setattr(stream, "closing", lambda reads: reads.where("false"))
    assert stream_queries.stream_session(spark, SF).count() < whole  # open ones stay in the state
    monkeypatch.setattr(stream, "stream_sessions", lambda reads: reads.where("false").selectExpr("track", "ts AS start", "ts AS end", "1L AS n", "conf AS votes"))
    assert stream_queries.stream_session(spark, SF).count() == 0


def test_a_batch_counts_once(spark, tmp_path):
    path, schema = f"file://{tmp_path}/led", "k bigint, v string"
    df = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    assert ledger.committed(spark, path, schema).count() == 0
    df.write.parquet(f"{path}/data/{7:09d}")  # of a batch that died
    assert ledger.committed(spark, path, schema).count() == 0
    assert ledger.commit(df.where("k = 1"), 7, path) and not ledger.commit(df, 7, path)
    assert [tuple(r) for r in ledger.committed(spark, path, schema).collect()] == [(1, "a")]
    assert ledger.commit(df.where("k > 5"), 8, path) and ledger.committed(spark, path, schema).count() == 1


@pytest.mark.parametrize("when", ["before", "written", "entered"])
def test_a_run_that_dies_is_taken_up(spark, tmp_path, monkeypatch, when):
    path, ck, out = (f"file://{tmp_path}/{x}" for x in ("in", "ck", "out"))
    schema = "k bigint, v bigint"
    for part in ([(1, 1), (2, 1)], [(2, 2), (3, 2), (3, 3)], [(4, 3), (1, 3)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    made = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    work = lambda rows: rows.groupBy("k").agg(F.max("v").alias("best"))
    enter, commit = ledger.enter, ledger.commit

    def dies(spark, path, batch, *rest):
        if batch == 1:
            if when == "entered":
                enter(spark, path, batch, *rest)
            raise RuntimeError("killed")
        enter(spark, path, batch, *rest)

    monkeypatch.setattr(ledger, "enter", dies)
    if when == "before":
        monkeypatch.setattr(ledger, "commit", lambda rows, batch, path: commit(rows, batch, path) if batch != 1 else dies(spark, path, 1))
    with pytest.raises(Exception, match="killed"):
        ledger.run_once(made(), work, "k", out, ck)
    monkeypatch.setattr(ledger, "enter", enter)
    monkeypatch.setattr(ledger, "commit", commit)
    for _ in range(2):
        ledger.run_once(made(), work, "k", out, ck)
        got = sorted(tuple(r) for r in ledger.committed(spark, out, "k bigint, best bigint").collect())
        assert got == [(1, 1), (2, 1), (3, 3), (4, 3)]
