"""Prompt queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prepare as PR
from ..operators import prompts as PM
from ..operators.ordering import seeded_key
from ..session import table
from ..sources import fixtures as FX
from .oracle_fixtures import strip, with_fx
from .q_steps import q
from .registry import register

ARABIC_TRIGGER = "The answer (arabic numerals) is "


@register("cot_prompt", f"""
  SELECT item_id, replace({q(PM.COT_TEMPLATE)}, '{{input}}', text) AS prompt FROM benchmark
""")
def cot_prompt(spark, d):
    return table(spark, d, "benchmark").select("item_id", PM.cot_prompt(F.col("text")).alias("prompt"))


@register("next_step_cue", with_fx("""
  SELECT question_id, CAST(step AS BIGINT) AS step, CAST(path_id AS BIGINT) AS path_id,
         CASE WHEN NOT contains(lower(candidate), 'step 2') THEN ' Step 2, '
              WHEN NOT contains(lower(candidate), 'step 3, so the final answer is:') THEN ' Step 3, so the final answer is: ' END AS cue
  FROM trace
""", "trace"))
def next_step_cue(spark, d):
    t = FX.trace(spark, d)
    return t.select("question_id", F.col("step").cast("bigint").alias("step"), F.col("path_id").cast("bigint").alias("path_id"),
                    PM.next_step_cue(F.col("candidate")).alias("cue"))


@register("search_cue", """
  SELECT item_id, CAST(step AS BIGINT) AS step,
         CASE WHEN step = 0 THEN 'Answer: Step 1, ' ELSE ' Step ' || CAST(step + 1 AS VARCHAR) || ', ' END ||
         CASE WHEN opt AND step = 3 THEN 'So the final answer is (' WHEN NOT opt AND step = 2 THEN 'So the final answer is: ' ELSE '' END AS cue,
         CASE WHEN step = 0 THEN 'Answer: Step 1, ' ELSE ' Step ' || CAST(step + 1 AS VARCHAR) || ', ' END ||
         CASE WHEN step = 4 THEN 'so the final answer is: ' ELSE '' END AS long_cue
  FROM (SELECT item_id, item_id % 2 = 1 AS opt, unnest(range(0, 5)) AS step FROM benchmark)
""")
def search_cue(spark, d):
    b = table(spark, d, "benchmark")
    p = b.select("item_id", F.when(F.col("item_id") % 2 == 1, F.concat("text", F.lit("\nOptions: (a) yes (b) no"))).otherwise(
        F.col("text")).alias("prompt"))
    cells = [x for k in range(5) for x in (F.lit(k).cast("bigint"), PM.search_cue(F.col("prompt"), k),
                                           PM.search_cue(F.col("prompt"), k, long_form=True))]
    return p.select("item_id", F.stack(F.lit(5), *cells).alias("step", "cue", "long_cue"))


@register("continued_prompt", with_fx("""
  SELECT question_id, CAST(step AS BIGINT) AS step, CAST(path_id AS BIGINT) AS path_id,
         'Q: ' || CASE WHEN low LIKE '%step 2%' AND low LIKE '%step 3%' AND low LIKE '%step 4%' AND low NOT LIKE '%answer (arabic numerals%'
                       THEN split_part(low, 'step 4', 1) ELSE y END ||
         CASE WHEN low NOT LIKE '%step 2%' THEN ' Step 2, ' WHEN low NOT LIKE '%step 3%' THEN ' Step 3, '
              WHEN low NOT LIKE '%step 4%' OR low NOT LIKE '%answer (arabic numerals%' THEN ' Step 4, The answer (arabic numerals) is '
              ELSE '' END AS prompt
  FROM (SELECT *, lower(y) AS low FROM (
    SELECT question_id, step, path_id,
           CASE WHEN question_id % 2 = 0 THEN candidate ELSE replace(candidate, 'the answer (arabic numerals) is ', 'it is ') END AS y
    FROM math_trace))
""", "math_trace"))
def continued_prompt(spark, d):
    y = F.col("candidate")
    y = F.when(F.col("question_id") % 2 == 0, y).otherwise(F.replace(y, F.lit("the answer (arabic numerals) is "), F.lit("it is ")))
    return FX.math_trace(spark, d).select(
        "question_id", F.col("step").cast("bigint").alias("step"), F.col("path_id").cast("bigint").alias("path_id"),
        PM.continued_prompt(F.lit("Q: "), y, math=True).alias("prompt"))


@register("judge_prompt_forms", with_fx("""
  SELECT doc_id, CASE doc_id % 3
    WHEN 0 THEN CASE WHEN done THEN 'F ' || claim || chr(10) || 'Thought Process:' || 'step 1, ' || claim || ' ' || chr(10) || 'Conclusion: ' || prediction || chr(10) || 'Evaluation Process: ' || chr(10)
                     ELSE 'S ' || claim || chr(10) || 'Thought Process: ' || y || chr(10) || 'Evaluation Process:' || chr(10) END
    WHEN 1 THEN CASE WHEN done THEN 'O ' || claim || ' Choose the best answer' || chr(10) || 'Answer: ' || split_part(lower(y), 'the final answer is: ', 2) || chr(10) || 'Evaluation Process:' || chr(10)
                     ELSE 'S ' || claim || ' Choose the best answer' || chr(10) || 'Thought Process: ' || y || chr(10) || 'Evaluation Process:' || chr(10) END
    ELSE 'M ' || 'Question: ' || claim || chr(10) || 'Thought: ' || y || chr(10) || 'Evaluation Process: ' END AS prompt
  FROM (SELECT *, 'step 1, ' || claim || CASE WHEN done THEN ' step 3, ' || prediction ELSE '' END AS y
        FROM (SELECT *, doc_id % 4 <> 0 AS done FROM fact_pred))
""", "fact_pred"))
def judge_prompt_forms(spark, d):
    """The forms for claims, for options and for math, partial and finished texts."""
    f, claim = FX.fact_pred(spark, d), F.col("claim")
    end = F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit(" step 3, "), F.col("prediction"))).otherwise(F.lit(""))
    y = F.concat(F.lit("step 1, "), claim, end)
    wording = {"step_t": "S ", "final_t": "F ", "option_t": "O "}
    kind = F.col("doc_id") % 3
    prompt = (F.when(kind == 0, PM.judge_prompt(claim, y, claim=True, **wording))
              .when(kind == 1, PM.judge_prompt(F.concat(claim, F.lit(" Choose the best answer")), y, **wording))
              .otherwise(PM.math_judge_prompt(claim, y, template="M ")))
    return f.select("doc_id", prompt.alias("prompt"))


def _demo_text(spark, d, k: int = 4, seed: int = 7):
    """Demonstrations: ``k`` parsed math rows chosen by a seeded key (top-k,
    bounded), concatenated in key order into one string (scalar subquery)."""
    m = PR.parse_math_rows(FX.math_raw(spark, d))
    key = seeded_key(seed, "_id")
    m = m.withColumn("_id", F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    cue = F.when(F.contains(F.col("explanation"), F.lit("Step 3")), F.lit("Step 4, ")).otherwise(F.lit("Step 3, "))
    txt = F.concat(F.lit("Q: "), F.col("question"), F.lit("\nA: "), F.col("explanation"), F.lit(" "), cue,
                   F.lit(ARABIC_TRIGGER), F.lit(" "), F.col("answer"), F.lit(".\n\n"))
    top = m.select(key.alias("k"), txt.alias("t")).orderBy("k", "t").limit(k)
    agg = top.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "t"))), lambda s: s["t"]), "").alias("demos"))
    return agg.scalar()


@register("math_prompt", with_fx(f"""
  WITH p AS (
    SELECT l_orderkey, l_linenumber, {strip('question')} AS question,
           {strip("regexp_replace(split_part(answer, '####', 1), '<<[^>]+>>', '', 'g')")} AS explanation,
           {strip("split_part(answer, '####', 2)")} AS answer
    FROM math_raw WHERE len(string_split(answer, '####')) = 2),
  demo AS (
    SELECT string_agg(t, '' ORDER BY k, t) AS demos FROM (
      SELECT md5('7:' || CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR)) AS k,
             'Q: ' || question || chr(10) || 'A: ' || explanation || ' ' ||
             CASE WHEN contains(explanation, 'Step 3') THEN 'Step 4, ' ELSE 'Step 3, ' END ||
             {q(ARABIC_TRIGGER)} || ' ' || answer || '.' || chr(10) || chr(10) AS t
      FROM p ORDER BY k, t LIMIT 4))
  SELECT l_orderkey, l_linenumber, (SELECT demos FROM demo) || 'Q: ' || {strip('question')} || chr(10) || 'A: ' || 'Step 1, ' AS prompt
  FROM math_raw
""", "math_raw"))
def math_prompt(spark, d):
    demos = _demo_text(spark, d)
    m = FX.math_raw(spark, d)
    return m.select("l_orderkey", "l_linenumber",
                    PM.math_prompt(demos, PR.strip(F.col("question")), F.lit(""), F.lit(0)).alias("prompt"))


@register("math_prompt_steps", with_fx(f"""
  WITH p AS (
    SELECT l_orderkey, l_linenumber, {strip('question')} AS question,
           {strip("regexp_replace(split_part(answer, '####', 1), '<<[^>]+>>', '', 'g')")} AS explanation,
           {strip("split_part(answer, '####', 2)")} AS answer
    FROM math_raw WHERE len(string_split(answer, '####')) = 2),
  demo AS (
    SELECT string_agg(t, '' ORDER BY k, t) AS demos FROM (
      SELECT md5('7:' || CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR)) AS k,
             'Q: ' || question || chr(10) || 'A: ' || explanation || ' ' ||
             CASE WHEN contains(explanation, 'Step 3') THEN 'Step 4, ' ELSE 'Step 3, ' END ||
             'The answer (arabic numerals) is ' || ' ' || answer || '.' || chr(10) || chr(10) AS t
      FROM p ORDER BY k, t LIMIT 4))
  SELECT question_id, CAST(step AS BIGINT) AS step, CAST(path_id AS BIGINT) AS path_id,
         (SELECT demos FROM demo) || 'Q: ' || CAST(question_id AS VARCHAR) || chr(10) || 'A: ' || candidate ||
         CASE WHEN step = 2 THEN 'Step 4, The answer (arabic numerals) is ' ELSE 'Step ' || CAST(step + 2 AS VARCHAR) || ', ' END AS prompt
  FROM math_trace WHERE step < 3
""", "math_raw", "math_trace"))
def math_prompt_steps(spark, d):
    """P22 for texts that hold steps already: the cue of the next step after each of them."""
    t = FX.math_trace(spark, d).where("step < 3")
    prompt = PM.math_prompt(_demo_text(spark, d), F.col("question_id").cast("string"), F.col("candidate"), F.col("step") + 1)
    return t.select("question_id", F.col("step").cast("bigint").alias("step"), F.col("path_id").cast("bigint").alias("path_id"),
                    prompt.alias("prompt"))


BOX = "'[0.' || CAST(e.vec_id % 10 AS VARCHAR) || ', 0.' || CAST(e.label % 10 AS VARCHAR) || ', 0.5, 0.5]'"


def _pref_with_box(spark, d):
    p = FX.pref_eval(spark, d)
    e = table(spark, d, "embeddings").select(
        F.col("vec_id").alias("sample_id"),
        F.concat(F.lit("[0."), (F.col("vec_id") % 10).cast("string"), F.lit(", 0."), (F.col("label") % 10).cast("string"),
                 F.lit(", 0.5, 0.5]")).alias("bbox"))
    pg = table(spark, d, "pages").select(F.col("page_id").alias("sample_id"), F.col("url").alias("image"))
    return p.join(e, "sample_id", "left").join(pg, "sample_id", "left")


@register("bbox_eval_prompt", with_fx(f"""
  SELECT p.sample_id, CASE WHEN e.vec_id IS NOT NULL THEN p.prompt || chr(10) || chr(10) || 'Focus on regions: ' || {BOX}
                           ELSE p.prompt END AS prompt
  FROM pref_eval p LEFT JOIN embeddings e ON e.vec_id = p.sample_id
""", "pref_eval"))
def bbox_eval_prompt(spark, d):
    p = _pref_with_box(spark, d)
    return p.select("sample_id", PM.bbox_eval_prompt(F.col("prompt"), F.col("bbox")).alias("prompt"))


@register("paired_answers_map", with_fx("""
  SELECT 'Question: ' || prompt || chr(10) || chr(10) || 'Answer: ' AS prompt, chosen, rejected FROM pref_eval
""", "pref_eval"))
def paired_answers_map(spark, d):
    p = FX.pref_eval(spark, d)
    return PM.paired_answers(p, question="prompt", chosen="chosen", rejected="rejected")


@register("chat_format", with_fx(f"""
  WITH b AS (
    SELECT p.*, CASE WHEN e.vec_id IS NOT NULL THEN {BOX} END AS bbox, pg.url AS image
    FROM pref_eval p LEFT JOIN embeddings e ON e.vec_id = p.sample_id LEFT JOIN pages pg ON pg.page_id = p.sample_id),
  s AS (SELECT *, {strip('prompt')} AS ps FROM b),
  a AS (SELECT *, CASE WHEN ends_with(ps, 'Answer:') THEN ps
                       ELSE regexp_replace(ps, '[\\s\\x{{0b}}\\p{{Z}}\\x{{1c}}-\\x{{1f}}\\x{{85}}]+$', '') || chr(10) || chr(10) || 'Answer:' END AS pa FROM s)
  SELECT sample_id,
         CASE WHEN bbox IS NOT NULL AND bbox <> '' THEN regexp_replace(pa, '[\\s\\x{{0b}}\\p{{Z}}\\x{{1c}}-\\x{{1f}}\\x{{85}}]+$', '') || chr(10) || chr(10) || 'Focus on region: ' || bbox
              ELSE pa END AS prompt_text,
         'user' AS prompt_role, CAST(2 AS BIGINT) AS prompt_parts, chosen AS chosen_text, 'user' AS chosen_role,
         rejected AS rejected_text, CASE WHEN image IS NOT NULL AND image <> '' THEN replace(image, '\\', '/') END AS image
  FROM a
""", "pref_eval"))
def chat_format(spark, d):
    p = _pref_with_box(spark, d)
    c = PM.chat_format(p, answer_role="user", keep=("sample_id",))
    return c.select("sample_id", F.col("prompt")[0]["content"][1]["text"].alias("prompt_text"),
                    F.col("prompt")[0]["role"].alias("prompt_role"),
                    F.size(F.col("prompt")[0]["content"]).cast("bigint").alias("prompt_parts"),
                    F.col("chosen")[0]["content"][0]["text"].alias("chosen_text"),
                    F.col("chosen")[0]["role"].alias("chosen_role"),
                    F.col("rejected")[0]["content"][0]["text"].alias("rejected_text"),
                    F.try_element_at("images", F.lit(1)).alias("image"))
