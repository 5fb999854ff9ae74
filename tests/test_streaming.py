"""Restart semantics of the de-duplicating stream (T2): a second run on the
same checkpoint processes only new files and never re-emits a question."""

import datetime as dt
import os

from treepref.session import scratch_path
from treepref.streaming import streams as ST

SCHEMA = "question string, ts timestamp"


def _write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_dedup_survives_restart(spark):
    src, sink, ck = (scratch_path(spark, n) for n in ("t2-src", "t2-sink", "t2-ck"))
    t0 = dt.datetime(2024, 1, 1)
    _write(spark, src, [("q1", t0), ("q2", t0), ("q1", t0 + dt.timedelta(minutes=1))])
    schema = spark.read.parquet(src).schema
    ST.stream_resume_dedup(spark, src, schema, sink, ck, delay="1 day")
    first = sorted(r.question for r in spark.read.parquet(sink).collect())
    assert first == ["q1", "q2"]
    _write(spark, src, [("q2", t0 + dt.timedelta(minutes=2)), ("q3", t0 + dt.timedelta(minutes=3))])
    ST.stream_resume_dedup(spark, src, schema, sink, ck, delay="1 day")
    after = sorted(r.question for r in spark.read.parquet(sink).collect())
    assert after == ["q1", "q2", "q3"]


def test_running_counters_latest_state(spark):
    src, sink, ck = (scratch_path(spark, n) for n in ("t3-src", "t3-sink", "t3-ck"))
    sch = "run_id string, correct int"
    spark.createDataFrame([("a", 1), ("a", 0), ("b", 1)], sch).coalesce(1).write.parquet(src)
    spark.createDataFrame([("a", 1), ("b", 1)], sch).coalesce(1).write.mode("append").parquet(src)
    ST.stream_running_accuracy(spark, src, spark.read.parquet(src).schema, sink, ck)
    state = {r.run_id: (r.n, r.n_correct) for r in ST.latest_state(spark.read.parquet(sink), "run_id").collect()}
    assert state == {"a": (3, 2), "b": (2, 2)}


def test_dedup_without_a_delay_keeps_no_state(spark):
    src, sink, ck = (scratch_path(spark, n) for n in ("t2-src", "t2-sink", "t2-ck"))
    t0 = dt.datetime(2024, 1, 1)
    _write(spark, src, [("q1", t0), ("q2", t0), ("q1", t0 + dt.timedelta(minutes=1)), (None, t0), (None, t0)])
    schema = spark.read.parquet(src).schema
    ST.stream_resume_dedup(spark, src, schema, sink, ck)
    # A year later the questions are still known, and the earliest row of a question stands.
    _write(spark, src, [("q2", t0 + dt.timedelta(days=400)), ("q3", t0 + dt.timedelta(days=400)), (None, t0)])
    _write(spark, src, [("q3", t0 + dt.timedelta(days=401))])
    ST.stream_resume_dedup(spark, src, schema, sink, ck, files_per_batch=1)
    got = sorted(((r.question or "", r.ts) for r in spark.read.parquet(sink).collect()))
    assert [q for q, _ in got] == ["", "q1", "q2", "q3"] and got[1][1] == t0
    assert not os.path.exists(f"{ck.removeprefix('file:')}/state")


def test_a_batch_that_runs_again_replaces_its_rows(spark):
    sink = scratch_path(spark, "sink")
    for n in (3, 5):
        ST.write_batch(spark.range(n), sink, 0)
    ST.write_batch(spark.range(2), sink, 1)
    assert spark.read.parquet(sink).count() == 7
    schema = spark.range(1).schema
    assert ST.written_before(spark, sink, 1, schema).count() == 5
    assert ST.written_before(spark, sink, 0, schema).count() == 0
    assert ST.written_before(spark, scratch_path(spark, "none"), 3, schema).count() == 0
