"""Sinks (S10-S12).  Output goes to directories of part files written by
executors; nothing is gathered on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F


def sink_pairs_json(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """JSON lines (one record per line), optionally partitioned (e.g. by
    language) for partition pruning downstream."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.json(path)
    return path


def sink_columnar(df: DataFrame, path: str) -> str:
    """The three training columns as parquet."""
    df.select("prompt", "chosen", "rejected").write.mode("overwrite").parquet(path)
    return path


def sink_eval_report(results: DataFrame, metrics: Sequence[Column], path: str, correct: str = "n_correct",
                     total: str = "n") -> str:
    """Result rows as a parquet table and the one-row report (counts,
    accuracy, where the results are) as JSON next to it.

    The counts (``evaluate.preference_metrics`` or ``error_metrics``) are observed while the
    results are written, so every row is read and scored once.  Results are never folded into the
    report row."""
    res_path, seen = f"{path}/results", Observation()
    results.observe(seen, *metrics).write.mode("overwrite").parquet(res_path)
    row = {k: v or 0 for k, v in seen.get.items()}
    row |= {"accuracy": row[correct] / row[total] if row[total] else 0.0, "results_path": res_path}
    results.sparkSession.createDataFrame([Row(**row)]).coalesce(1).write.mode("overwrite").json(f"{path}/report")
    return path


def trace_records(levels: DataFrame, selected: DataFrame, question: str = "question") -> DataFrame:
    """Trace records in the reference's shape, one per question, as JSON text ``rec``:
    ``{question: {"0": {candiate: [...], values: [...]}, ..., correct: [...]}}``
    with whatever steps ``levels`` holds.

    A record holds one question's search tree, whose size is set by the search
    parameters (samples x kept per level), not by the data volume.
    """
    per_step = levels.groupBy(question, "step").agg(
        F.array_sort(F.collect_list(F.struct("path_id", "candidate", F.col("value").cast("double").alias("value")))).alias("c"))
    text = F.to_json(F.struct(F.transform("c", lambda s: s["candidate"]).alias("candiate"),
                              F.transform("c", lambda s: s["value"]).alias("values")))
    per_step = per_step.select(question, "step", F.concat(F.lit('"'), F.col("step").cast("string"), F.lit('":'), text).alias("s"))
    steps = per_step.groupBy(question).agg(F.array_sort(F.collect_list(F.struct("step", "s"))).alias("steps"))
    corr = selected.groupBy(question).agg(F.array_sort(F.collect_list("item")).alias("correct"))
    rec = steps.join(corr, question, "left")
    # A one-element array around the question gives it the escapes of JSON.
    name = F.expr(f"substring(to_json(array(`{question}`)), 2, length(to_json(array(`{question}`))) - 2)")
    found = F.to_json(F.coalesce("correct", F.array().cast("array<string>")))
    body = F.concat_ws(",", F.transform("steps", lambda x: x["s"]), F.concat(F.lit('"correct":'), found))
    return rec.select(F.concat(F.lit("{"), name, F.lit(":{"), body, F.lit("}}")).alias("rec"))


def sink_trace_json(records: DataFrame, path: str, legacy: bool = True) -> str:
    """S7 writer.  ``legacy=True`` reproduces the reference's layout (each
    object ends with a newline before its closing brace and is followed by
    ``,\\n``; a closing ``\\n]`` part); otherwise JSON lines."""
    js = F.col("rec")
    if not legacy:
        records.select(js.alias("value")).write.mode("overwrite").text(path)
        return path
    body = F.concat(F.substring(js, 1, F.length(js) - 1), F.lit("\n}"))
    records.select(body.alias("value")).write.mode("overwrite").option("lineSep", ",\n").text(path)
    records.sparkSession.range(1).select(F.lit("\n]").alias("value")).write.mode("append").text(path)
    return path
