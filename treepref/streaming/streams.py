"""Structured Streaming forms.

The reference appends results to files during long runs and skips finished
questions on restart.  Here the same needs are streaming queries over a
directory of input files: stateless pair building (T1), de-duplication of
questions with bounded state (T2), running counters per run (T3) and the pair side
of pipeline C.  Every
query has its own checkpoint folder, so a restarted job resumes exactly where
it stopped; ``availableNow`` processes what is there and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.ratings import union_pairs
from ..operators.steps import QA_STEPS, StepSpec, step_pairs
from ..session import drop_path, materialize, scratch_path

#: Input files of a micro-batch, if the caller says nothing.
FILES_PER_BATCH = 1000


def read_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)


def write_batch(df: DataFrame, sink: str, batch_id: int) -> None:
    """A micro-batch as its own folder ``batch_id=N`` of the sink: a batch that runs
    again after a failure replaces its rows."""
    df.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")


def written_before(spark: SparkSession, sink: str, batch_id: int, schema: StructType) -> DataFrame:
    """The rows that earlier batches wrote."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sink)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    kept = StructType([*schema.fields, StructField("batch_id", LongType())])
    return spark.read.schema(kept).parquet(sink).where(F.col("batch_id") < batch_id).drop("batch_id")


def run_available_now(df: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet", mode: str = "append",
                      foreach_batch: Callable | None = None) -> None:
    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode(mode)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        q = w.format(fmt).option("path", sink).start()
    q.awaitTermination()


def stream_pairs(spark: SparkSession, wide_dir: str, schema: StructType, sink: str, checkpoint: str,
                 languages=("en",), files_per_batch: int = FILES_PER_BATCH) -> None:
    """Wide rows arriving as files -> decorated pairs appended to a parquet
    sink (the stateless part of pipeline A)."""
    src = read_stream(spark, wide_dir, schema, files_per_batch=files_per_batch)
    run_available_now(union_pairs(src, languages), sink, checkpoint)


def stream_resume_dedup(spark: SparkSession, task_dir: str, schema: StructType, sink: str, checkpoint: str,
                        event_time: str = "ts", key: str = "question", delay: str | None = None,
                        files_per_batch: int = FILES_PER_BATCH) -> None:
    """Drop questions already seen; the checkpoint makes a restart skip
    everything already emitted.

    With ``delay``, state per question lives in the executors until the watermark
    passes its event time plus the delay, so a question that comes back later is
    emitted again and state is bounded by the questions of a delay.

    Without, a question is emitted once however old it is, and executors hold no
    state: a batch keeps the earliest row of each question (ties: the smallest
    row) and drops those that the sink holds (``left_anti``; only the key column
    of the sink is read).  A batch that runs again replaces its own rows.  Null
    questions count as one question.
    """
    src = read_stream(spark, task_dir, schema, files_per_batch=files_per_batch)
    if delay is not None:
        run_available_now(src.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key]), sink, checkpoint)
        return
    rest = [c for c in src.columns if c not in (key, event_time)]

    def write(batch: DataFrame, batch_id: int) -> None:
        one = batch.groupBy(key).agg(F.min(F.struct(event_time, *rest)).alias("r")).select(key, "r.*")
        seen = written_before(spark, sink, batch_id, StructType([schema[key]])).withColumnRenamed(key, "_seen")
        new = one.join(seen, F.col(key).eqNullSafe(F.col("_seen")), "left_anti")
        write_batch(new.select(*src.columns), sink, batch_id)

    run_available_now(src, sink, checkpoint, foreach_batch=write)


def stream_step_pairs(spark: SparkSession, trace_dir: str, schema: StructType, sink: str, checkpoint: str,
                      questions: DataFrame, select: Callable[[DataFrame], DataFrame],
                      prepare: Callable[[DataFrame], DataFrame] = lambda t: t, spec: StepSpec = QA_STEPS,
                      files_per_batch: int = FILES_PER_BATCH) -> None:
    """Pipeline C as a stream: files that hold whole questions' search traces -> step pairs.

    ``prepare`` turns a batch of traces into levels, ``select`` levels into selected
    paths.  Pairs of different questions never meet, so batches of whole questions
    give the pairs of a batch job.  Every batch writes its own folder of the sink,
    so a batch that runs again adds nothing.  A batch without rows writes an empty folder.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        path = scratch_path(spark, "levels")
        levels = materialize(prepare(batch), path=path)
        write_batch(step_pairs(levels, select(levels), questions, spec=spec), sink, batch_id)
        drop_path(spark, path)

    run_available_now(read_stream(spark, trace_dir, schema, files_per_batch=files_per_batch), sink, checkpoint,
                      foreach_batch=write)


def stream_running_accuracy(spark: SparkSession, results_dir: str, schema: StructType, sink: str, checkpoint: str,
                            run_id: str = "run_id", correct: str = "correct",
                            files_per_batch: int = FILES_PER_BATCH) -> None:
    """Running counters per run in update mode.  Each micro-batch's updated
    rows are written with their batch id (a change log; a batch that runs again
    replaces its rows); the current state of a run is its row from the latest batch."""
    src = read_stream(spark, results_dir, schema, files_per_batch=files_per_batch)
    agg = src.groupBy(run_id).agg(F.count("*").alias("n"), F.sum(F.col(correct).cast("bigint")).alias("n_correct"))
    run_available_now(agg, sink, checkpoint, mode="update", foreach_batch=lambda b, i: write_batch(b, sink, i))


def latest_state(changes: DataFrame, key: str) -> DataFrame:
    """Current state per key from a change log written by :func:`stream_running_accuracy`."""
    cols = [c for c in changes.columns if c not in (key, "batch_id")]
    latest = changes.groupBy(key).agg(F.max_by(F.struct(*cols), "batch_id").alias("s"))
    return latest.select(key, "s.*")
