"""Streaming queries (T1-T3): input written as several files from the driver
tables, processed by an ``availableNow`` stream, result read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators import trace as TR
from ..operators.ratings import PAIR_COLUMNS
from ..session import ROWS_PER_TASK, dealt, scratch_path, table
from ..sources import fixtures as FX
from ..streaming import streams as ST
from .oracle_fixtures import with_fx
from .q_ratings import _PAIR_FX
from .q_scoring import RESULTS_SQL
from .q_steps import CHAIN, PAIRS_SQL, _questions, _selected
from .registry import r6, register


def _stage(df, spark, name):
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return path, spark.read.parquet(path).schema


@register("stream_pairs", with_fx("SELECT * FROM decor", "rlhf_qa", "rlhf_rating", **_PAIR_FX))
def stream_pairs(spark, d):
    wide = FX.wide_table(spark, d)
    src, schema = _stage(wide, spark, "stream-wide")
    sink, ck = scratch_path(spark, "stream-pairs"), scratch_path(spark, "stream-pairs-ck")
    ST.stream_pairs(spark, src, schema, sink, ck)
    out = spark.read.parquet(sink)
    return out.select(*[r6(c).alias(c) if c in ("helpful", "honest", "harmless", "composite") else c
                        for c in PAIR_COLUMNS])


@register("stream_resume_dedup", "SELECT DISTINCT 'user ' || CAST(user_id AS VARCHAR) AS question FROM events")
def stream_resume_dedup(spark, d):
    ev = table(spark, d, "events").select(F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("question"),
                                          F.col("ts").cast("timestamp").alias("ts"))
    src, schema = _stage(ev, spark, "stream-tasks")
    sink, ck = scratch_path(spark, "stream-dedup"), scratch_path(spark, "stream-dedup-ck")
    ST.stream_resume_dedup(spark, src, schema, sink, ck)
    return spark.read.parquet(sink).select("question")


@register("stream_running_accuracy", with_fx("""
  SELECT prompt AS run_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN cs > rs THEN 1 ELSE 0 END) AS BIGINT) AS n_correct
  FROM results GROUP BY prompt
""", "pref_eval", extra={"results": RESULTS_SQL}))
def stream_running_accuracy(spark, d):
    res = E.preference_results(FX.pref_eval(spark, d)).select(F.col("prompt").alias("run_id"), "sample_id", "correct")
    src, schema = _stage(res, spark, "stream-results")
    sink, ck = scratch_path(spark, "stream-acc"), scratch_path(spark, "stream-acc-ck")
    ST.stream_running_accuracy(spark, src, schema, sink, ck)
    return ST.latest_state(spark.read.parquet(sink), "run_id").select(
        "run_id", F.col("n").cast("bigint").alias("n"), F.col("n_correct").cast("bigint").alias("n_correct"))


@register("stream_step_pairs", with_fx("SELECT prompt, chosen, rejected FROM pairs", "trace",
                                       extra={**CHAIN["extra"], "pairs": PAIRS_SQL}))
def stream_step_pairs(spark, d):
    # Whole questions to a file, 40 rows each.
    src, schema = _stage(dealt(FX.trace_tree(spark, d), "question_id", 40 * ROWS_PER_TASK), spark, "stream-traces")
    sink, ck = scratch_path(spark, "stream-steps"), scratch_path(spark, "stream-steps-ck")
    ST.stream_step_pairs(spark, src, schema, sink, ck, _questions(spark, d), lambda lv: _selected(spark, d, lv),
                         lambda t: TR.search(t).drop("parent_id"))
    return spark.read.parquet(sink).select("prompt", "chosen", "rejected")
