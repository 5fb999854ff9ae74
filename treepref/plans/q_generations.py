"""Model-call and generation-cleaning queries."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from ..functions.text import strip as sp
from ..operators import generations as G
from ..operators import prompts as PM
from ..operators import trace as TR
from ..session import table
from ..sources import fixtures as FX
from .oracle_fixtures import strip, with_fx
from .q_steps import q
from .q_trace import verdict_sql
from .registry import r6, register

N_SAMPLES = 3


# A stand-in for the user's model, so that the oracle can state the same texts in SQL.
def stub_generator() -> G.ModelFn:
    """Deterministic text for tests: echoes the prompt, then step lines,
    ``Input`` lines and an ``Answer`` line derived from md5(prompt:k)."""
    def fn(prompts, n):
        out = []
        for p in prompts:
            texts = []
            for k in range(n):
                h = hashlib.md5(f"{p}:{k}".encode("utf-8")).hexdigest()
                texts.append(f"{p}step {k + 1}, {h[:6]}.\nInput: {h[6:10]}\nAnswer: {h[10:14]}\n"
                             f"Input: x\noption {h[17:20]}\noption {h[20:23]}\n"
                             f"step 2, so the final answer is: {h[14:17]}.</s>")
            out.append(texts)
        return out
    return fn


def stub_judge() -> G.ModelFn:
    """Deterministic judge: one of three verdict lines chosen by md5(prompt:k)."""
    words = ("Likely", "Impossible", "sure")

    def fn(prompts, n):
        return [[f"Evaluation.\n{words[int(hashlib.md5(f'{p}:{k}'.encode('utf-8')).hexdigest()[0], 16) % 3]}"
                 for k in range(n)] for p in prompts]
    return fn


def _h(p: str, k: str) -> str:
    return f"md5({p} || ':' || CAST({k} AS VARCHAR))"


STUB_SQL = ("{p} || 'step ' || CAST({k} + 1 AS VARCHAR) || ', ' || substr({h}, 1, 6) || '.' || chr(10) || "
            "'Input: ' || substr({h}, 7, 4) || chr(10) || 'Answer: ' || substr({h}, 11, 4) || chr(10) || "
            "'Input: x' || chr(10) || 'option ' || substr({h}, 18, 3) || chr(10) || 'option ' || substr({h}, 21, 3) || chr(10) || "
            "'step 2, so the final answer is: ' || substr({h}, 15, 3) || '.</s>'")

COT_SQL = f"replace({q(PM.COT_TEMPLATE)}, '{{input}}', text)"

GEN_SQL = f"""
  SELECT item_id, prompt, CAST(k AS BIGINT) AS sample_id, {STUB_SQL.format(p='prompt', k='k', h=_h('prompt', 'k'))} AS text
  FROM (SELECT item_id, {COT_SQL} AS prompt, unnest(range(0, {N_SAMPLES})) AS k FROM benchmark)
"""


def _gen(spark, d):
    b = table(spark, d, "benchmark").select("item_id", PM.cot_prompt(F.col("text")).alias("prompt"))
    return G.batch_generate(b, "item_id", "prompt", N_SAMPLES, stub_generator)


@register("batch_generate", f"SELECT item_id, sample_id, text FROM ({GEN_SQL})")
def batch_generate(spark, d):
    return _gen(spark, d).select("item_id", "sample_id", "text")


def judge_sql(question: str, y: str) -> str:
    low = f"lower({y})"
    step_p = f"{q(PM.STEP_JUDGE)} || {question} || chr(10) || 'Thought Process: ' || {y} || chr(10) || 'Evaluation Process:' || chr(10)"
    opt_p = (f"{q(PM.OPTION_JUDGE)} || {question} || chr(10) || 'Answer: ' || replace(split_part({low}, 'the final answer is', 2), ': ', '') "
             f"|| chr(10) || 'Evaluation Process:' || chr(10)")
    fin_p = f"{q(PM.FINAL_JUDGE)} || {question} || chr(10) || {y} || chr(10) || 'Evaluation Process: ' || chr(10)"
    return (f"CASE WHEN NOT contains({low}, 'the final answer is') THEN {step_p} "
            f"WHEN contains(lower({question}), 'choose the best answer') THEN {opt_p} ELSE {fin_p} END")


JUDGE_IN = f"""
  SELECT CAST(question_id AS VARCHAR) || ':' || CAST(step AS VARCHAR) || ':' || CAST(path_id AS VARCHAR) AS cid,
         {judge_sql("'Question ' || CAST(question_id AS VARCHAR)", 'candidate')} AS prompt
  FROM trace
"""


@register("batch_judge", with_fx(f"""
  SELECT cid, round(round_even(sum(v), 3), 6) AS value FROM (
    SELECT cid, {verdict_sql("'Evaluation.' || chr(10) || CASE ('0x' || substr(" + _h('prompt', 'k') + ", 1, 1))::INT % 3 WHEN 0 THEN 'Likely' WHEN 1 THEN 'Impossible' ELSE 'sure' END")} AS v
    FROM (SELECT cid, prompt, unnest(range(0, 2)) AS k FROM ({JUDGE_IN})))
  GROUP BY cid
""", "trace"))
def batch_judge(spark, d):
    t = FX.trace(spark, d)
    cid = F.concat_ws(":", F.col("question_id").cast("string"), F.col("step").cast("string"), F.col("path_id").cast("string"))
    jp = PM.judge_prompt(F.concat(F.lit("Question "), F.col("question_id").cast("string")), F.col("candidate"))
    out = G.batch_generate(t.select(cid.alias("cid"), jp.alias("prompt")), "cid", "prompt", 2, stub_judge)
    v = TR.with_verdict_value(out.withColumnRenamed("text", "output"))
    return v.groupBy("cid").agg(r6(F.bround(F.sum("value"), 3)).alias("value"))


@register("judge_prompt", with_fx(f"SELECT cid, prompt FROM ({JUDGE_IN})", "trace"))
def judge_prompt(spark, d):
    t = FX.trace(spark, d)
    cid = F.concat_ws(":", F.col("question_id").cast("string"), F.col("step").cast("string"), F.col("path_id").cast("string"))
    jp = PM.judge_prompt(F.concat(F.lit("Question "), F.col("question_id").cast("string")), F.col("candidate"))
    return t.select(cid.alias("cid"), jp.alias("prompt"))


def _unwrap_sql(t: str, p: str) -> str:
    return f"replace(replace(replace({t}, {p}, ''), '</s>', ''), '<s>', '')"


def _two_pieces_sql(x: str) -> str:
    return (f"CASE WHEN len(string_split({x}, 'step')) > 2 THEN string_split({x}, 'step')[1] || 'step' || "
            f"string_split({x}, 'step')[2] ELSE {x} END")


def clean_gen_sql(t: str, p: str) -> str:
    x0 = f"lower({_unwrap_sql(t, p)})"
    x1 = f"CASE WHEN contains({x0}, 'question:') THEN split_part({x0}, 'question:', 1) ELSE {x0} END"
    x2 = f"CASE WHEN contains({x1}, 'claim:') THEN split_part({x1}, 'claim:', 1) ELSE {x1} END"
    x3 = f"CASE WHEN contains({x2}, 'task:') THEN split_part({x2}, 'task:', 1) ELSE {x2} END"
    x4 = _two_pieces_sql(x3)
    ph = "'so the final answer is'"
    x5 = (f"CASE WHEN len(string_split({x4}, {ph})) > 2 THEN string_split({x4}, {ph})[1] || {ph} || "
          f"string_split({x4}, {ph})[2] ELSE {x4} END")
    return (f"CASE WHEN length({strip(x3)}) >= 2 AND contains({x4}, 'step') AND length({strip(x5)}) >= 2 "
            f"THEN {strip(x5)} END")


@register("clean_generation", with_fx(f"""
  SELECT doc_id, {clean_gen_sql('text', 'prompt')} AS sample FROM gens
""", "gens"))
def clean_generation(spark, d):
    return FX.generations(spark, d).select("doc_id", G.clean_generation(F.col("text"), F.col("prompt")).alias("sample"))


def trunc_lines_sql(t: str, p: str) -> str:
    lines = f"string_split({_unwrap_sql(t, p)}, chr(10))"
    excl = ("(contains(l, 'nput') OR contains(lower(l), 'question:') OR "
            "(NOT contains(l, 'nswer') AND contains(lower(l), 'claim: ')))")
    incl = "(NOT contains(l, 'nput') AND NOT contains(lower(l), 'question:') AND contains(l, 'nswer'))"
    k = f"coalesce(list_position(list_transform({lines}, lambda l: {excl} OR {incl}), true), 0)"
    inc_k = f"list_transform({lines}, lambda l: {incl})[{k}]"
    n = f"CASE WHEN {k} = 0 THEN len({lines}) WHEN {inc_k} THEN {k} ELSE {k} - 1 END"
    return f"array_to_string({lines}[1:{n}], chr(10))"


@register("truncate_generation_lines", with_fx(f"""
  SELECT doc_id, {trunc_lines_sql('text', 'prompt')} AS sample FROM gens
""", "gens"))
def truncate_generation_lines(spark, d):
    return FX.generations(spark, d).select("doc_id", G.truncate_generation_lines(F.col("text"), F.col("prompt")).alias("sample"))


def clean_math_sql(t: str, p: str) -> str:
    x0 = f"lower(replace({_unwrap_sql(t, p)}, chr(10), ' '))"
    x1 = f"CASE WHEN contains({x0}, 'q:') THEN split_part({x0}, 'q:', 1) ELSE {x0} END"
    return f"CASE WHEN contains({x1}, 'step') THEN {_two_pieces_sql(x1)} ELSE {x1} END"


@register("clean_math_generation", with_fx(f"""
  SELECT doc_id, {clean_math_sql('text', 'prompt')} AS sample FROM gens
""", "gens"))
def clean_math_generation(spark, d):
    return FX.generations(spark, d).select("doc_id", G.clean_math_generation(F.col("text"), F.col("prompt")).alias("sample"))


@register("clean_math_answer", with_fx(f"""
  SELECT doc_id, split_part(split_part(lower({_unwrap_sql('text', 'prompt')}), 'q:', 1), chr(10) || chr(10), 1) AS sample FROM gens
""", "gens"))
def clean_math_answer(spark, d):
    return FX.generations(spark, d).select(
        "doc_id", G.clean_math_generation(F.col("text"), F.col("prompt"), search=False).alias("sample"))


@register("split_proposals", with_fx(f"""
  WITH g AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM gens),
  i AS (SELECT *, list_filter(list_transform(range(1, len(lines) + 1), lambda j: CASE WHEN contains(lines[j], 'Input') THEN j END),
                              lambda j: j IS NOT NULL) AS idx FROM g),
  b AS (SELECT doc_id, CASE WHEN len(idx) > 2 THEN lines[idx[2] + 2:idx[3] - 1] ELSE lines[idx[2] + 2:] END AS block
        FROM i WHERE len(idx) >= 2)
  SELECT doc_id, CAST(generate_subscripts(block, 1) - 1 AS BIGINT) AS line_no, unnest(block) || chr(10) AS proposal FROM b
""", "gens"))
def split_proposals(spark, d):
    return G.split_proposals(FX.generations(spark, d), keep=("doc_id",))


@register("strip_prompt_prefix", with_fx(f"""
  SELECT doc_id,
         {strip("CASE WHEN starts_with(text, prompt) THEN substr(text, length(prompt) + 1) ELSE text END")} AS by_prefix,
         {strip("substr(text, length(prompt) + 1)")} AS by_length
  FROM gens
""", "gens"))
def strip_prompt_prefix(spark, d):
    return FX.generations(spark, d).select("doc_id", G.strip_prompt_prefix(F.col("text"), F.col("prompt")).alias("by_prefix"),
                    G.strip_prompt_prefix(F.col("text"), F.col("prompt"), by_length=True).alias("by_length"))


def first_line_sql(t: str, p: str) -> str:
    lines = f"string_split({_unwrap_sql(t, p)}, chr(10))"
    s = (f"CASE WHEN contains({lines}[1], 'Steps') THEN (CASE WHEN len({lines}) > 1 THEN {lines}[1] || chr(10) || {lines}[2] || chr(10) END) "
         f"WHEN contains({lines}[1], 'Answer') THEN {lines}[1] ELSE {lines}[1] || chr(10) END")
    return f"CASE WHEN length({strip(s)}) >= 2 THEN {s} END"


@register("first_line_generation", with_fx(f"""
  SELECT doc_id, {first_line_sql('text', 'prompt')} AS sample FROM gens
""", "gens"))
def first_line_generation(spark, d):
    return FX.generations(spark, d).select("doc_id", G.first_line_generation(F.col("text"), F.col("prompt")).alias("sample"))


SPLIT_TRUTH = "split_part(answer, '####', 2)"


def _registry_sql() -> str:
    from .q_scoring import CL_E, MATH_CORRECT_SQL, QA_E, answer_match
    qa = (f"SELECT 'qa' AS task, CAST(item_id AS VARCHAR) AS id, CAST(CASE WHEN contains(prediction, 'answer is') "
          f"AND contains(lower({strip('prediction')}), 'so the final answer is') AND {answer_match(QA_E, 'ground_truth')} "
          f"THEN 1 ELSE 0 END AS BIGINT) AS correct FROM qa_pred")
    cl = (f"SELECT 'claims', CAST(doc_id AS VARCHAR), CAST(CASE WHEN contains(prediction, 'answer is') AND "
          f"{answer_match(CL_E, 'label')} THEN 1 ELSE 0 END AS BIGINT) FROM fact_pred")
    ma = (f"SELECT 'math', CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR), CAST({MATH_CORRECT_SQL} AS BIGINT) "
          f"FROM (SELECT l_orderkey, l_linenumber, replace({strip('prediction')}, ',', '') AS y, "
          f"{strip(SPLIT_TRUTH)} AS truth FROM math_raw)")
    return with_fx(f"{qa} UNION ALL {cl} UNION ALL {ma}", "qa_pred", "fact_pred", "math_raw")


@register("task_registry", _registry_sql())
def task_registry(spark, d):
    """Every task scored by the scorer its registry entry names."""
    reg = G.task_registry()
    qa = FX.qa_pred(spark, d).select(F.lit("qa").alias("task"), F.col("item_id").cast("string").alias("id"),
                                     reg["qa"].score(F.col("prediction"), F.col("ground_truth")).alias("correct"))
    cl = FX.fact_pred(spark, d).select(F.lit("claims"), F.col("doc_id").cast("string"),
                                       reg["claims"].score(F.col("prediction"), F.col("label")))
    m = FX.math_raw(spark, d)
    truth = sp(F.split_part(F.col("answer"), F.lit("####"), F.lit(2)))
    ma = m.select(F.lit("math"), F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")),
                  reg["math"].score(F.col("prediction"), truth))
    return qa.union(cl).union(ma)
