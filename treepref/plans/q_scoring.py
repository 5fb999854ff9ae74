"""Pipeline D queries: scalar scorers (F1-F7, F9, F10) and evaluation."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from ..functions import score as S
from ..functions import text as T
from ..operators import evaluate as E
from ..session import table
from ..sources import fixtures as FX
from .oracle_fixtures import WS, strip, with_fx
from .registry import r6, register

PUNCT_SQL = string.punctuation.replace("'", "''")
NONWORD = r"[^\p{L}\p{N}_]+"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda t: t <> '')"


def norm_sql(x: str) -> str:
    """Every word is fenced by chr(1); fenced articles go, then the fences."""
    plain = f"translate(lower({x}), '{PUNCT_SQL}', '')"
    fenced = f"regexp_replace({plain}, '([\\p{{L}}\\p{{N}}_]+)', chr(1) || '\\1' || chr(1), 'g')"
    bare = f"replace(regexp_replace({fenced}, chr(1) || '(a|an|the)' || chr(1), ' ', 'g'), chr(1), '')"
    return f"array_to_string({words(bare)}, ' ')"


def last_num(x: str) -> str:
    return f"list_extract(regexp_extract_all({x}, '\\p{{Nd}}+'), -1)"


def first_num(x: str) -> str:
    return f"list_extract(regexp_extract_all({x}, '\\p{{Nd}}+'), 1)"


def answer_match(e: str, gt: str) -> str:
    g2 = f"regexp_replace({gt}, '{NONWORD}', '', 'g')"
    e2 = f"regexp_replace({e}, '{NONWORD}', '', 'g')"
    return f"(contains({e}, {gt}) OR ({g2} <> '' AND contains(lower({e2}), lower({g2}))))"


# F1 ------------------------------------------------------------------------
@register("normalize_answer", f"""
  SELECT doc_id, {norm_sql('text')} AS normalized
  FROM documents
""")
def normalize_answer(spark, d):
    return table(spark, d, "documents").select("doc_id", T.normalize_answer("text").alias("normalized"))


# F2 ------------------------------------------------------------------------
@register("extract_number_last", with_fx(f"""
  SELECT l_orderkey, l_linenumber,
         coalesce({last_num("CASE WHEN NOT contains(y, 'arabic numerals') THEN y "
                            "WHEN contains(y, '(arabic numerals) is ') THEN replace(split_part(y, '(arabic numerals) is ', 2), ',', '') END")},
                  '-1') AS number
  FROM (SELECT l_orderkey, l_linenumber, {strip('prediction')} AS y FROM math_raw)
""", "math_raw"))
def extract_number_last(spark, d):
    return FX.math_raw(spark, d).select("l_orderkey", "l_linenumber",
                                        T.extract_number_last("prediction").alias("number"))


# F3 ------------------------------------------------------------------------
MATH_CORRECT_SQL = f"""
  CASE WHEN {last_num("CASE WHEN contains(y, 'arabic numerals') THEN string_split(y, '(arabic numerals) is ')[-1] ELSE y END")}
            = {first_num('truth')} THEN 1 ELSE 0 END
"""


@register("math_correct", with_fx(f"""
  SELECT l_orderkey, l_linenumber, truth, CAST({MATH_CORRECT_SQL} AS BIGINT) AS correct
  FROM (SELECT l_orderkey, l_linenumber, replace({strip('prediction')}, ',', '') AS y,
               {strip("split_part(answer, '####', 2)")} AS truth FROM math_raw)
""", "math_raw"))
def math_correct(spark, d):
    m = FX.math_raw(spark, d).withColumn("truth", T.strip(T.after_first("answer", "####")))
    return m.select("l_orderkey", "l_linenumber", "truth", S.math_correct("prediction", "truth").alias("correct"))


# F4 ------------------------------------------------------------------------
QA_E = f"replace(split_part(split_part(lower({strip('prediction')}), 'so the final answer is', 2), chr(10), 1), ': ', '')"


@register("qa_correct", with_fx(f"""
  SELECT item_id, CAST(CASE WHEN contains(prediction, 'answer is')
                             AND contains(lower({strip('prediction')}), 'so the final answer is')
                             AND {answer_match(QA_E, 'ground_truth')} THEN 1 ELSE 0 END AS BIGINT) AS correct
  FROM qa_pred
""", "qa_pred"))
def qa_correct(spark, d):
    return FX.qa_pred(spark, d).select("item_id", S.qa_correct("prediction", "ground_truth").alias("correct"))


# F5 ------------------------------------------------------------------------
CL_E = f"replace(split_part(lower(split_part({strip('prediction')}, 'answer is', 2)), chr(10), 1), ': ', '')"


@register("claim_correct", with_fx(f"""
  SELECT doc_id, CAST(CASE WHEN contains(prediction, 'answer is') AND {answer_match(CL_E, 'label')}
                      THEN 1 ELSE 0 END AS BIGINT) AS correct
  FROM fact_pred
""", "fact_pred"))
def claim_correct(spark, d):
    return FX.fact_pred(spark, d).select("doc_id", S.claim_correct("prediction", "label").alias("correct"))


# F6 ------------------------------------------------------------------------
def jacc(a: str, b: str) -> str:
    wa, wb = f"list_distinct({words(f'lower({a})')})", f"list_distinct({words(f'lower({b})')})"
    inter = f"len(list_intersect({wa}, {wb}))"
    return (f"CASE WHEN len({wa}) = 0 AND len({wb}) = 0 THEN 1.0 WHEN len({wa}) = 0 OR len({wb}) = 0 THEN 0.0 "
            f"ELSE {inter} / (len({wa}) + len({wb}) - {inter}) END")


@register("jaccard_words", with_fx(f"""
  SELECT sample_id, round({jacc('generated', 'chosen')}, 6) AS chosen_similarity,
         round({jacc('generated', 'rejected')}, 6) AS rejected_similarity
  FROM pref_eval
""", "pref_eval"))
def jaccard_words(spark, d):
    r = E.preference_results(FX.pref_eval(spark, d))
    return r.select("sample_id", r6("chosen_similarity").alias("chosen_similarity"),
                    r6("rejected_similarity").alias("rejected_similarity"))


# F7 ------------------------------------------------------------------------
def cos(a: str, b: str) -> str:
    dot = f"list_sum(list_transform(range(1, len({a}) + 1), lambda i: {a}[i]::DOUBLE * {b}[i]::DOUBLE))"
    na = f"sqrt(list_sum(list_transform({a}, lambda x: x::DOUBLE * x::DOUBLE)))"
    nb = f"sqrt(list_sum(list_transform({b}, lambda x: x::DOUBLE * x::DOUBLE)))"
    return f"CASE WHEN {na} > 0 AND {nb} > 0 THEN {dot} / ({na} * {nb}) ELSE 0.0 END"


@register("cosine_similarity", with_fx(f"""
  SELECT sample_id, round({cos('generated', 'chosen')}, 6) AS chosen_similarity,
         round({cos('generated', 'rejected')}, 6) AS rejected_similarity
  FROM pref_vectors
""", "pref_vectors"))
def cosine_similarity(spark, d):
    p = FX.pref_vectors(spark, d)
    return p.select("sample_id", r6(S.cosine_similarity("generated", "chosen")).alias("chosen_similarity"),
                    r6(S.cosine_similarity("generated", "rejected")).alias("rejected_similarity"))


def text_cos(va: str, vb: str, a: str, b: str) -> str:
    return (f"CASE WHEN coalesce({a}, '') = '' AND coalesce({b}, '') = '' THEN 1.0 "
            f"WHEN coalesce({a}, '') = '' OR coalesce({b}, '') = '' THEN 0.0 ELSE {cos(va, vb)} END")


@register("text_similarity", with_fx(f"""
  SELECT sample_id, round({text_cos('v.generated', 'v.chosen', 't.g', 't.c')}, 6) AS chosen_similarity,
         round({text_cos('v.generated', 'v.rejected', 't.g', 't.r')}, 6) AS rejected_similarity
  FROM pref_vectors v JOIN (
    SELECT sample_id, split_part(generated, chr(10), 2) AS g, split_part(chosen, chr(10), 2) AS c,
           split_part(rejected, chr(10), 2) AS r FROM pref_eval) t USING (sample_id)
""", "pref_vectors", "pref_eval"))
def text_similarity(spark, d):
    # The second lines of the texts: some texts have none.
    names = ("generated", "chosen", "rejected")
    texts = FX.pref_eval(spark, d, line=2).select("sample_id", *[F.col(c).alias(f"{c}_text") for c in names])
    p = FX.pref_vectors(spark, d).join(texts, "sample_id")
    return p.select("sample_id", *[
        r6(S.text_similarity("generated", c, "generated_text", f"{c}_text")).alias(f"{c}_similarity") for c in names[1:]])


# F9 ------------------------------------------------------------------------
@register("has_final_answer", with_fx("""
  SELECT item_id, CAST(CASE WHEN contains(lower(prediction), 'the final answer is') THEN 1 ELSE 0 END AS BIGINT) AS has_final
  FROM qa_pred
""", "qa_pred"))
def has_final_answer(spark, d):
    return FX.qa_pred(spark, d).select("item_id", S.has_final_answer("prediction").cast("bigint").alias("has_final"))


# F10 -----------------------------------------------------------------------
@register("preview", with_fx("""
  SELECT sample_id, left(prompt, 100) AS prompt, left(chosen, 100) AS chosen, left(rejected, 100) AS rejected
  FROM pref_eval ORDER BY sample_id LIMIT 3
""", "pref_eval"))
def preview(spark, d):
    p = FX.pref_eval(spark, d)
    return p.orderBy("sample_id").limit(3).select(
        "sample_id", *[F.left(F.col(c), F.lit(100)).alias(c) for c in ("prompt", "chosen", "rejected")])


# J1 ------------------------------------------------------------------------
def _truth_rows(spark, d):
    b = table(spark, d, "benchmark")
    return b.select(F.lower(F.split_part("text", F.lit(" "), F.lit(1))).alias("question"),
                    F.concat(F.split_part("text", F.lit(" "), F.lit(2)), F.lit(" "),
                             F.split_part("text", F.lit(" "), F.lit(3))).alias("answer"),
                    F.col("item_id").alias("seq"))


@register("join_ground_truth", with_fx(f"""
  WITH truth AS (
    SELECT lower(split_part(text, ' ', 1)) AS question,
           arg_max(split_part(text, ' ', 2) || ' ' || split_part(text, ' ', 3), item_id) AS answer
    FROM benchmark GROUP BY 1),
  preds AS (
    SELECT p.item_id, lower(split_part(b.text, ' ', 1)) AS question, p.prediction
    FROM qa_pred p JOIN benchmark b USING (item_id))
  SELECT preds.item_id, preds.question, truth.answer, preds.prediction,
         CAST(CASE WHEN contains(prediction, 'answer is')
                    AND contains(lower({strip('prediction')}), 'so the final answer is')
                    AND {answer_match(QA_E, 'truth.answer')} THEN 1 ELSE 0 END AS BIGINT) AS correct
  FROM preds JOIN truth USING (question)
""", "qa_pred"))
def join_ground_truth(spark, d):
    b = table(spark, d, "benchmark").select("item_id", F.lower(F.split_part("text", F.lit(" "), F.lit(1))).alias("question"))
    preds = FX.qa_pred(spark, d).select("item_id", "prediction").join(b, "item_id")
    j = E.join_ground_truth(preds, _truth_rows(spark, d))
    return j.select("item_id", "question", "answer", "prediction",
                    S.qa_correct("prediction", "answer").alias("correct"))


# W5 / J2 -------------------------------------------------------------------
LOGGED_SQL = """
  SELECT DISTINCT split_part(cur.line, ' sum(accs)', 1) AS question
  FROM run_log cur JOIN run_log prev ON prev.line_no = cur.line_no - 1
  WHERE cur.line_no > 0 AND contains(cur.line, ' sum(accs)') AND starts_with(prev.line, '====GR====')
"""


@register("log_pairs_lag", with_fx(LOGGED_SQL, "run_log"))
def log_pairs_lag(spark, d):
    return E.logged_questions(FX.run_log(spark, d))


@register("resume_anti_join", with_fx("""
  SELECT DISTINCT 'user ' || CAST(c_custkey AS VARCHAR) AS question FROM customer
  WHERE 'user ' || CAST(c_custkey AS VARCHAR) NOT IN (SELECT question FROM logged)
""", "run_log", extra={"logged": LOGGED_SQL}))
def resume_anti_join(spark, d):
    tasks = table(spark, d, "customer").select(
        F.concat(F.lit("user "), F.col("c_custkey").cast("string")).alias("question")).distinct()
    return E.resume_anti_join(tasks, E.logged_questions(FX.run_log(spark, d)))


# A6 ------------------------------------------------------------------------
@register("accuracy_avg_any", with_fx(f"""
  WITH s AS (
    SELECT l_orderkey, {MATH_CORRECT_SQL} AS correct
    FROM (SELECT l_orderkey, replace({strip('prediction')}, ',', '') AS y,
                 {strip("split_part(answer, '####', 2)")} AS truth FROM math_raw)),
  q AS (SELECT l_orderkey, avg(correct) AS a, max(correct) AS m FROM s GROUP BY l_orderkey)
  SELECT CAST(count(*) AS BIGINT) AS n_total, CAST(count(*) AS BIGINT) AS n_scored,
         round(sum(a) / count(*), 6) AS acc_avg, round(sum(m) / count(*), 6) AS acc_any FROM q
""", "math_raw"))
def accuracy_avg_any(spark, d):
    m = FX.math_raw(spark, d).withColumn("truth", T.strip(T.after_first("answer", "####")))
    s = m.select("l_orderkey", S.math_correct("prediction", "truth").alias("correct"))
    a = E.accuracy_avg_any(s, "l_orderkey", "correct")
    return a.select("n_total", "n_scored", r6("acc_avg").alias("acc_avg"), r6("acc_any").alias("acc_any"))


@register("gated_accuracy", with_fx(f"""
  WITH truth AS (
    SELECT lower(split_part(text, ' ', 1)) AS question,
           arg_max(split_part(text, ' ', 2) || ' ' || split_part(text, ' ', 3), item_id) AS answer
    FROM benchmark GROUP BY 1),
  s AS (
    SELECT truth.question, CASE WHEN contains(prediction, 'answer is')
             AND contains(lower({strip('prediction')}), 'so the final answer is')
             AND {answer_match(QA_E, 'truth.answer')} THEN 1 ELSE 0 END AS correct
    FROM qa_pred p JOIN benchmark b USING (item_id) JOIN truth ON truth.question = lower(split_part(b.text, ' ', 1))
    WHERE contains(lower(prediction), 'the final answer is')),
  per AS (SELECT question, avg(correct) AS a, max(correct) AS m FROM s GROUP BY question),
  n AS (SELECT count(*) AS n FROM truth)
  SELECT CAST(any_value(n.n) AS BIGINT) AS n_total, CAST(count(per.question) AS BIGINT) AS n_scored,
         round(coalesce(sum(a), 0) / any_value(n.n), 6) AS acc_avg, round(coalesce(sum(m), 0) / any_value(n.n), 6) AS acc_any
  FROM n LEFT JOIN per ON true
""", "qa_pred"))
def gated_accuracy(spark, d):
    b = table(spark, d, "benchmark").select("item_id", F.lower(F.split_part("text", F.lit(" "), F.lit(1))).alias("question"))
    preds = FX.qa_pred(spark, d).select("item_id", "prediction").join(b, "item_id")
    a = E.gated_accuracy(preds, _truth_rows(spark, d), S.qa_correct)
    return a.select("n_total", "n_scored", r6("acc_avg").alias("acc_avg"), r6("acc_any").alias("acc_any"))


# A7 / A8 / W4 --------------------------------------------------------------
RESULTS_SQL = f"""
  SELECT sample_id, prompt, generated, chosen, rejected,
         {jacc('generated', 'chosen')} AS cs, {jacc('generated', 'rejected')} AS rs
  FROM pref_eval
"""


@register("preference_accuracy", with_fx("""
  SELECT CAST(count(*) AS BIGINT) AS n, CAST(coalesce(sum(CASE WHEN cs > rs THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_correct,
         round(coalesce(sum(CASE WHEN cs > rs THEN 1 ELSE 0 END) / count(*), 0.0), 6) AS accuracy
  FROM results
""", "pref_eval", extra={"results": RESULTS_SQL}))
def preference_accuracy(spark, d):
    a = E.preference_accuracy(E.preference_results(FX.pref_eval(spark, d)))
    return a.select(F.col("n").cast("bigint").alias("n"), "n_correct", r6("accuracy").alias("accuracy"))


@register("preference_results", with_fx("""
  SELECT sample_id, round(cs, 6) AS chosen_similarity, round(rs, 6) AS rejected_similarity,
         CAST(cs > rs AS INT) AS predicted_chosen, CAST(cs > rs AS INT) AS correct
  FROM results
""", "pref_eval", extra={"results": RESULTS_SQL}))
def preference_results(spark, d):
    r = E.preference_results(FX.pref_eval(spark, d))
    return r.select("sample_id", r6("chosen_similarity").alias("chosen_similarity"),
                    r6("rejected_similarity").alias("rejected_similarity"), "predicted_chosen", "correct")


def _results_with_status(spark, d):
    r = E.preference_results(FX.pref_eval(spark, d))
    pages = table(spark, d, "pages").select(F.col("page_id").alias("sample_id"), F.col("url").alias("image"))
    r = r.join(pages, "sample_id", "left")
    err = (F.when(F.col("image").isNull(), F.lit("image_missing"))
           .when(T.strip("generated") == "", F.lit("empty_generation")))
    return r.withColumn("error", err).withColumn(
        "correct", F.when(F.col("error").isNull(), F.col("correct")).otherwise(0))


@register("error_accounting", with_fx(f"""
  SELECT CAST(sum(CASE WHEN err IS NULL OR err = 'image_missing' THEN 1 ELSE 0 END) AS BIGINT) AS n_total,
         CAST(sum(CASE WHEN err IS NULL AND cs > rs THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
         CAST(sum(CASE WHEN err = 'image_missing' THEN 1 ELSE 0 END) AS BIGINT) AS n_image_missing,
         CAST(sum(CASE WHEN err IS NOT NULL AND err <> 'image_missing' THEN 1 ELSE 0 END) AS BIGINT) AS n_errors,
         round(coalesce(sum(CASE WHEN err IS NULL AND cs > rs THEN 1 ELSE 0 END)
                        / sum(CASE WHEN err IS NULL OR err = 'image_missing' THEN 1 ELSE 0 END), 0.0), 6) AS accuracy
  FROM (SELECT r.*, CASE WHEN p.page_id IS NULL THEN 'image_missing'
                         WHEN {strip('r.generated')} = '' THEN 'empty_generation' END AS err
        FROM results r LEFT JOIN pages p ON p.page_id = r.sample_id)
""", "pref_eval", extra={"results": RESULTS_SQL}))
def error_accounting(spark, d):
    a = E.error_accounting(_results_with_status(spark, d))
    return a.select("n_total", "n_correct", "n_image_missing", "n_errors", r6("accuracy").alias("accuracy"))


@register("running_accuracy", with_fx("""
  SELECT processed, round(c / processed, 6) AS running_accuracy FROM (
    SELECT row_number() OVER (ORDER BY sample_id) AS processed,
           sum(CASE WHEN cs > rs THEN 1 ELSE 0 END) OVER (ORDER BY sample_id ROWS UNBOUNDED PRECEDING) AS c
    FROM results)
  WHERE processed % 10 = 0
""", "pref_eval", extra={"results": RESULTS_SQL}))
def running_accuracy(spark, d):
    r = E.preference_results(FX.pref_eval(spark, d))
    out = E.running_accuracy(r, "sample_id")
    return out.select("processed", r6("running_accuracy").alias("running_accuracy"))
