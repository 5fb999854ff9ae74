"""Source and sink queries (S1 lives with pipeline A): write data derived from
the driver tables under the shared checkpoint folder, read it back with the
library's readers, compare with the tables directly."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path, table
from ..sources import fixtures as FX
from ..sources import readers as RD
from ..sources import sinks as SK
from ..operators import evaluate as E
from .oracle_fixtures import with_fx
from .q_scoring import RESULTS_SQL
from .q_steps import CHAIN, _levels, _selected
from .registry import r6, register


@register("sink_pairs_json", with_fx("SELECT sample_id, prompt, chosen, rejected FROM pref_eval", "pref_eval"))
def sink_pairs_json(spark, d):
    path = SK.sink_pairs_json(FX.pref_eval(spark, d).drop("generated"), scratch_path(spark, "pairs-json"))
    return spark.read.schema("sample_id bigint, prompt string, chosen string, rejected string").json(path)


@register("scan_pairs_json", with_fx("SELECT sample_id, prompt, generated, chosen, rejected FROM pref_eval", "pref_eval"))
def scan_pairs_json(spark, d):
    path = SK.sink_pairs_json(FX.pref_eval(spark, d), scratch_path(spark, "pairs-json"))
    df = RD.scan_pairs_json(spark, path, "sample_id bigint, prompt string, generated string, chosen string, rejected string")
    return df.drop("seq")


@register("sink_columnar", with_fx("SELECT prompt, chosen, rejected FROM pref_eval", "pref_eval"))
def sink_columnar(spark, d):
    path = SK.sink_columnar(FX.pref_eval(spark, d), scratch_path(spark, "pairs-parquet"))
    return spark.read.parquet(path)


@register("sink_eval_report", with_fx("""
  WITH r AS (SELECT sample_id, prompt, generated, chosen, rejected FROM pref_eval)
  SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN cs > rs THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
         round(sum(CASE WHEN cs > rs THEN 1 ELSE 0 END) / count(*), 6) AS accuracy, CAST(count(*) AS BIGINT) AS n_results
  FROM results
""", "pref_eval", extra={"results": RESULTS_SQL}))
def sink_eval_report(spark, d):
    res = E.preference_results(FX.pref_eval(spark, d))
    path = SK.sink_eval_report(res, E.preference_metrics(), scratch_path(spark, "eval-report"))
    report = spark.read.schema("n bigint, n_correct bigint, accuracy double, results_path string").json(f"{path}/report")
    n_res = spark.read.parquet(f"{path}/results").select(F.count("*").cast("bigint").alias("n_results"))
    return report.select("n", "n_correct", r6("accuracy").alias("accuracy"), n_res.scalar().alias("n_results"))


@register("scan_task_csv", with_fx("SELECT question, ground_truth AS answer FROM qa_pred", "qa_pred"))
def scan_task_csv(spark, d):
    path = scratch_path(spark, "tasks-csv")
    FX.qa_pred(spark, d).select(F.col("question").alias("Question"), F.col("ground_truth").alias("Answer")) \
        .write.option("header", True).option("escape", '"').csv(path)
    return RD.scan_task_csv(spark, path).drop("seq")


@register("scan_text_csv", "SELECT text AS question, CAST(doc_id AS VARCHAR) AS answer FROM documents")
def scan_text_csv(spark, d):
    # Whole texts with quotes and newlines, in fields that reach over lines.
    path = scratch_path(spark, "texts-csv")
    table(spark, d, "documents").select(F.col("doc_id").alias("Answer"), F.col("text").alias("Question")) \
        .write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    return RD.scan_task_csv(spark, path).drop("seq")


@register("scan_claims_jsonl", with_fx("SELECT claim AS question, label AS answer FROM fact_pred", "fact_pred"))
def scan_claims_jsonl(spark, d):
    path = scratch_path(spark, "claims-jsonl")
    FX.fact_pred(spark, d).select("claim", "label").write.json(path)
    return RD.scan_claims_jsonl(spark, path).drop("seq")


@register("scan_nested_qa_json", with_fx("""
  SELECT CAST(row_number() OVER (PARTITION BY item_id // 10 ORDER BY item_id) - 1 AS BIGINT) AS pos,
         question, ground_truth AS answer
  FROM qa_pred
""", "qa_pred"))
def scan_nested_qa_json(spark, d):
    path = scratch_path(spark, "nested-qa")
    q = FX.qa_pred(spark, d)
    recs = q.groupBy((F.col("item_id") / 10).cast("bigint").alias("g")).agg(
        F.array_sort(F.collect_list(F.struct("item_id", F.col("question").alias("Question"),
                                             F.array("ground_truth", F.lit("alt")).alias("Answer")))).alias("d"))
    recs.select(F.transform("d", lambda s: F.struct(s["Question"].alias("Question"), s["Answer"].alias("Answer"))).alias("data")) \
        .write.json(path)
    return RD.scan_nested_qa_json(spark, path).drop("seq")


@register("scan_flat_qa_json", with_fx("SELECT question, ground_truth AS answer FROM qa_pred", "qa_pred"))
def scan_flat_qa_json(spark, d):
    path = scratch_path(spark, "flat-qa")
    FX.qa_pred(spark, d).select("question", F.col("ground_truth").alias("answer")).write.json(path)
    return RD.scan_flat_qa_json(spark, path).drop("seq")


TRACE_ORACLE = with_fx("""
  SELECT 'Question ' || CAST(question_id AS VARCHAR) AS question, CAST(step AS BIGINT) AS step,
         row_number() OVER (PARTITION BY question_id, step ORDER BY path_id, candidate) - 1 AS idx, candidate,
         round(CAST(score AS DOUBLE), 6) AS value FROM lv
  UNION ALL
  SELECT 'Question ' || CAST(question_id AS VARCHAR), CAST(NULL AS BIGINT),
         row_number() OVER (PARTITION BY question_id ORDER BY item) - 1, item, CAST(NULL AS DOUBLE) FROM sel
""", "trace", **CHAIN)


def _trace_roundtrip(spark, d, legacy):
    lv = _levels(spark, d)
    sel = _selected(spark, d, lv)
    qn = F.concat(F.lit("Question "), F.col("question_id").cast("string"))
    recs = SK.trace_records(lv.select(qn.alias("question"), "step", "path_id", "candidate", F.col("score").alias("value")),
                            sel.select(qn.alias("question"), "item"))
    path = SK.sink_trace_json(recs, scratch_path(spark, "trace"), legacy=legacy)
    t = RD.explode_trace(RD.scan_trace_json(spark, path, legacy=legacy))
    return t.select("question", "step", "idx", "candidate", r6("value").alias("value"))


@register("scan_trace_json", TRACE_ORACLE)
def scan_trace_json(spark, d):
    return _trace_roundtrip(spark, d, legacy=True)


@register("explode_trace", TRACE_ORACLE)
def explode_trace(spark, d):
    return _trace_roundtrip(spark, d, legacy=False)


@register("scan_run_log", with_fx("""
  SELECT CAST(row_number() OVER (ORDER BY line_no) - 1 AS BIGINT) AS line_no, line FROM run_log
""", "run_log"))
def scan_run_log(spark, d):
    path = scratch_path(spark, "run-log")
    FX.run_log(spark, d).orderBy("line_no").select(F.col("line").alias("value")).write.text(path)
    return RD.scan_run_log(spark, path).select("line_no", "line")


@register("image_manifest", """
  SELECT page_id, 'img_' || CAST(page_id AS VARCHAR) || '.png' AS path, CAST(strlen(html) AS BIGINT) AS n_bytes,
         upper(hex(substr(html, 1, 8))) AS magic,
         CASE WHEN starts_with(upper(hex(substr(html, 1, 8))), '89504E470D0A1A0A') THEN 'png'
              WHEN starts_with(upper(hex(substr(html, 1, 8))), 'FFD8FF') THEN 'jpeg'
              WHEN starts_with(upper(hex(substr(html, 1, 8))), '47494638') THEN 'gif'
              WHEN starts_with(upper(hex(substr(html, 1, 8))), '52494646') THEN 'webp'
              WHEN starts_with(upper(hex(substr(html, 1, 8))), '424D') THEN 'bmp' ELSE 'unknown' END AS format
  FROM pages
""")
def image_manifest(spark, d):
    p = table(spark, d, "pages")
    return RD.image_manifest(p, "page_id", F.col("html").cast("binary"))


@register("image_manifest_files", """
  SELECT page_id // 100 AS folder, CAST(sum(strlen(html) + 1) AS BIGINT) AS n_bytes,
         upper(hex(substr(arg_min(html, page_id), 1, 8))) AS magic, 'unknown' AS format FROM pages GROUP BY 1
""")
def image_manifest_files(spark, d):
    # A file for every hundred page ids, each page ended by a newline.
    path = scratch_path(spark, "image-files")
    pages = table(spark, d, "pages").select(F.floor(F.col("page_id") / 100).alias("folder"), "page_id", "html")
    pages.repartition("folder").sortWithinPartitions("folder", "page_id").drop("page_id").write.partitionBy("folder").text(path)
    files = RD.image_manifest_files(spark, path, pattern="*.txt")
    folder = F.regexp_extract("file", "/folder=([0-9]+)/", 1).cast("bigint")
    return files.select(folder.alias("folder"), "n_bytes", "magic", "format")
