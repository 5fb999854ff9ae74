"""Pipeline C pair-side queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import steps as ST
from ..operators import trace as TR
from ..functions.text import replace_chain
from ..operators.prompts import COT_TEMPLATE, worked_prompt
from ..session import materialize, table
from ..sources import fixtures as FX
from .oracle_fixtures import strip, with_fx
from .q_trace import line_join_sql, norm_sql
from .registry import register

FINAL = "so the final answer is: "
STEP_FINAL = "step 3, so the final answer is: "
MATH_FINAL = "step 4, the answer (arabic numerals) is "
MATH_MARK = "(arabic numerals) is "
BAD_POSITIVE = "841 34."


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def chain_sql(x: str, steps) -> str:
    for st in steps:
        if st == "lower":
            x = f"lower({x})"
        elif st == "strip":
            x = strip(x)
        else:
            x = f"replace({x}, {q(st[0])}, {q(st[1])})"
    return x


def trunc_sql(x: str) -> str:
    return f"CASE WHEN ends_with({x}, '.') THEN {x} WHEN contains({x}, '.') THEN regexp_extract({x}, '(?s)^(.*\\.)', 1) END"


# --- shared fixtures: expanded search levels, vote winners, question text ---
LV_SQL = """
  WITH s0 AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY question_id ORDER BY score DESC) r FROM trace WHERE step = 0) WHERE r <= 3),
  l1 AS (SELECT t.* FROM trace t WHERE t.step = 1 AND EXISTS (
           SELECT 1 FROM s0 WHERE s0.question_id = t.question_id AND s0.path_id = floor(t.path_id / 100) * 100)),
  s1 AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY question_id ORDER BY score DESC) r FROM l1) WHERE r <= 3),
  l2 AS (SELECT t.* FROM trace t WHERE t.step = 2 AND EXISTS (
           SELECT 1 FROM s1 WHERE s1.question_id = t.question_id AND s1.path_id = floor(t.path_id / 10) * 10))
  SELECT question_id, step, path_id, candidate, score FROM trace WHERE step = 0
  UNION ALL SELECT question_id, step, path_id, candidate, score FROM l1
  UNION ALL SELECT question_id, step, path_id, candidate, score FROM l2
"""

SEL_SQL = f"""
  WITH items AS (
    SELECT question_id, item, avg(round_even(CAST(score AS DOUBLE), 3)) AS value
    FROM (SELECT question_id, score, {line_join_sql('candidate', False)} AS item FROM lv WHERE step = 2)
    WHERE item IS NOT NULL GROUP BY question_id, item),
  ans AS (SELECT *, {norm_sql(f"replace(split_part(item, '{FINAL}', 2), '.', '')")} AS answer FROM items),
  g AS (SELECT question_id, answer, round(sum(value), 9) AS s, min(value) AS m FROM ans GROUP BY question_id, answer HAVING sum(value) > 0),
  w AS (SELECT question_id, answer FROM (
          SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY s DESC, m DESC, answer) AS rn FROM g) WHERE rn = 1)
  SELECT a.question_id, a.item, a.value FROM ans a JOIN w USING (question_id, answer)
"""

QS_SQL = "SELECT doc_id AS question_id, 'Question ' || CAST(doc_id AS VARCHAR) AS question FROM documents"

ANS_SQL = f"""
  SELECT question_id, split_part(best, {q(STEP_FINAL)}, 2) AS answer FROM (
    SELECT question_id, item AS best FROM (
      SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY value DESC, item) AS rn FROM sel) WHERE rn = 1)
  WHERE contains(best, {q(STEP_FINAL)})
"""

COR_SQL = f"""
  SELECT DISTINCT question_id, cor FROM (
    SELECT s.question_id, s.item AS cor FROM sel s WHERE s.question_id IN (SELECT question_id FROM ans)
    UNION ALL
    SELECT l.question_id, l.candidate FROM lv l JOIN ans a USING (question_id)
    WHERE l.step = 2 AND contains(l.candidate, {q(STEP_FINAL)})
      AND ((p2 <> '' AND a2 <> '' AND (contains(p2, a2) OR contains(a2, p2)))
           OR (contains(lower(pre), 'yes') AND contains(lower(a.answer), 'yes'))
           OR (contains(lower(pre), 'no') AND contains(lower(a.answer), 'no'))))
"""
# p2/a2/pre are computed in a lateral projection below.
COR_SQL = COR_SQL.replace(
    "SELECT l.question_id, l.candidate FROM lv l JOIN ans a USING (question_id)",
    "SELECT l.question_id, l.candidate FROM (SELECT lv.*, split_part(candidate, "
    + q(STEP_FINAL) + ", 2) AS pre, " + strip("replace(split_part(candidate, " + q(STEP_FINAL) + ", 2), '.', '')")
    + " AS p2 FROM lv) l JOIN (SELECT ans.*, " + strip("replace(answer, '.', '')") + " AS a2 FROM ans) a USING (question_id)")

POS_SQL = f"""
  SELECT DISTINCT question_id, CAST(step AS BIGINT) AS step,
         {strip("lower('step' || segs[step + 1])")} AS pos,
         CASE WHEN step = 0 THEN '' ELSE {strip("'step' || array_to_string(segs[1:step], 'step')")} END AS prefix
  FROM (SELECT question_id, segs, unnest(range(0, 3)) AS step FROM (
          SELECT question_id, string_split({chain_sql('cor', ST.CHAIN_A)}, 'step')[2:] AS segs FROM cor)
        WHERE len(segs) >= 3 AND contains(segs[3], {q(FINAL)}))
"""

CHAIN_A_SQL = chain_sql("cor", ST.CHAIN_A)
WORKED = "Q: What is 1 + 1?\nA: Step 1, 1 + 1 = 2. Step 2, nothing is left. Step 3, so 2. Step 4, The answer (arabic numerals) is 2.\n"
NORM_B = chain_sql("candidate", ST.CHAIN_B)
NORM_C = chain_sql("candidate", ST.CHAIN_C)
X1 = "CASE WHEN step = 1 AND contains(norm, 'step 3') THEN split_part(norm, 'step 3', 1) ELSE norm END"
X2 = (f"CASE WHEN len(string_split({X1}, 'step 3')) > 2 THEN array_to_string(string_split({X1}, 'step 3')"
      f"[1:len(string_split({X1}, 'step 3')) - 1], 'step 3') ELSE {X1} END")
CUT = strip(f"replace({X2}, prefix, '')")
ANCH = (f"CASE WHEN starts_with({strip(f"replace({CUT}, 'answer: ', '')")}, 'step') THEN {CUT} "
        f"ELSE 'step' || array_to_string(string_split({CUT}, 'step')[2:], 'step') END")

NEG_SQL = f"""
  SELECT DISTINCT question_id, step, pos, prefix, neg FROM (
    SELECT question_id, step, pos, prefix,
           CASE WHEN step = 0 THEN norm WHEN contains({X2}, prefix) THEN {ANCH} END AS neg
    FROM (SELECT p.question_id, p.step, p.pos, p.prefix, l.norm
          FROM pos p JOIN (SELECT DISTINCT question_id, CAST(step AS BIGINT) AS step,
                                  CASE WHEN step = 0 THEN {NORM_B} ELSE {NORM_C} END AS norm FROM lv) l
          USING (question_id, step)))
  WHERE neg IS NOT NULL AND neg <> pos
"""

NEGD_SQL = f"""
  SELECT * FROM (SELECT question_id, step, pos, prefix, {chain_sql('neg', ST.CHAIN_D)} AS neg FROM neg) n
  WHERE NOT EXISTS (SELECT 1 FROM pos p WHERE p.question_id = n.question_id AND p.step = n.step AND p.pos = n.neg)
"""

PRE_POS = chain_sql("pos", ST.POS_CLEAN)
PRE_NEG = chain_sql("neg", ST.NEG_CLEAN)


def bare_eq(x: str) -> str:
    return f"(NOT contains({x}, '=') OR contains({x}, '-') OR contains({x}, '+') OR contains({x}, '/') OR contains({x}, '*'))"


PAIRS_SQL = f"""
  SELECT DISTINCT replace({q(COT_TEMPLATE)}, '{{input}}', qs.question) || prefix AS prompt, chosen, rejected FROM (
    SELECT question_id, prefix, pp, pn, {trunc_sql('pp')} AS chosen, {trunc_sql('pn')} AS rejected FROM (
      SELECT question_id, prefix, {PRE_POS} AS pp, {PRE_NEG} AS pn FROM negd WHERE length(neg) > 3)) x
  JOIN qs USING (question_id)
  WHERE {bare_eq('pp')} AND {bare_eq('pn')} AND NOT contains(pp, {q(BAD_POSITIVE)})
    AND chosen IS NOT NULL AND rejected IS NOT NULL AND NOT contains(rejected, '[tex]')
"""

CHAIN = dict(extra={"lv": LV_SQL, "sel": SEL_SQL, "qs": QS_SQL, "ans": ANS_SQL, "cor": COR_SQL,
                    "pos": POS_SQL, "neg": NEG_SQL, "negd": NEGD_SQL})


def _levels(spark, d):
    return TR.search(FX.trace_tree(spark, d)).drop("parent_id")


def _selected(spark, d, levels=None):
    lv = levels if levels is not None else _levels(spark, d)
    v = TR.answer_vote_value(lv.where(F.col("step") == 2).withColumnRenamed("score", "value"))
    return v.select("question_id", "item", "value")


def _questions(spark, d):
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("question_id"), F.concat(F.lit("Question "), F.col("doc_id").cast("string")).alias("question"))


def _chain(spark, d):
    # levels, winners and positives are each read by several later steps:
    # checkpoint them once instead of re-planning and re-running the search.
    lv = materialize(_levels(spark, d))
    sel = materialize(_selected(spark, d, lv))
    cor = ST.positive_expansion(lv, sel)
    pos = materialize(ST.split_reasoning_steps(cor))
    neg = ST.negatives_by_prefix(pos, lv)
    negd = ST.drop_positive_negatives(neg, pos)
    return lv, sel, cor, pos, neg, negd


@register("final_answer_extract", with_fx("SELECT question_id, answer FROM ans", "trace", **CHAIN))
def final_answer_extract(spark, d):
    return ST.best_answer(_selected(spark, d))


@register("positive_expansion", with_fx("SELECT question_id, cor FROM cor", "trace", **CHAIN))
def positive_expansion(spark, d):
    return _chain(spark, d)[2]


@register("split_reasoning_steps", with_fx("SELECT question_id, step, pos, prefix FROM pos", "trace", **CHAIN))
def split_reasoning_steps(spark, d):
    return _chain(spark, d)[3]


@register("distinct_step_positives", with_fx("""
  SELECT question_id, step, CAST(count(DISTINCT pos) AS BIGINT) AS n_pos FROM pos GROUP BY question_id, step
""", "trace", **CHAIN))
def distinct_step_positives(spark, d):
    p = _chain(spark, d)[3]
    return p.groupBy("question_id", "step").agg(F.countDistinct("pos").cast("bigint").alias("n_pos"))


@register("negatives_by_prefix", with_fx("SELECT question_id, step, pos, prefix, neg FROM neg", "trace", **CHAIN))
def negatives_by_prefix(spark, d):
    return _chain(spark, d)[4]


@register("candidate_remainder", with_fx("SELECT question_id, step, pos, prefix, neg FROM neg WHERE step >= 1",
                                         "trace", **CHAIN))
def candidate_remainder(spark, d):
    return _chain(spark, d)[4].where(F.col("step") >= 1)


@register("drop_positive_negatives", with_fx("SELECT question_id, step, pos, prefix, neg FROM negd", "trace", **CHAIN))
def drop_positive_negatives(spark, d):
    return _chain(spark, d)[5]


@register("explode_pairs", with_fx(f"""
  SELECT DISTINCT replace({q(COT_TEMPLATE)}, '{{input}}', qs.question) || prefix AS prompt, pos, neg
  FROM negd JOIN qs USING (question_id)
""", "trace", **CHAIN))
def explode_pairs(spark, d):
    negd = _chain(spark, d)[5]
    return ST.with_prompt(negd, _questions(spark, d)).select("prompt", "pos", "neg").distinct()


@register("distinct_pairs", with_fx("SELECT prompt, chosen, rejected FROM pairs", "trace",
                                    extra={**CHAIN["extra"], "pairs": PAIRS_SQL}))
def distinct_pairs(spark, d):
    negd = _chain(spark, d)[5]
    return ST.explode_pairs(negd, _questions(spark, d))


@register("empty_group_drop", with_fx("""
  SELECT question_id, CAST(count(*) AS BIGINT) AS n_positives FROM pos GROUP BY question_id
""", "trace", **CHAIN))
def empty_group_drop(spark, d):
    return _chain(spark, d)[3].groupBy("question_id").agg(F.count("*").cast("bigint").alias("n_positives"))


# P14 / P16 on whole documents ------------------------------------------------
@register("normalize_expr_text", f"""
  SELECT doc_id, {chain_sql('text', ST.CHAIN_A)} AS norm_a, {chain_sql('text', ST.CHAIN_B)} AS norm_b,
         {chain_sql('text', ST.CHAIN_C)} AS norm_c, {chain_sql('text', ST.CHAIN_D)} AS norm_d
  FROM documents
""")
def normalize_expr_text(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", ST.normalize_a(t).alias("norm_a"), ST.normalize_b(t).alias("norm_b"),
                                               ST.normalize_c(t).alias("norm_c"), ST.normalize_d(t).alias("norm_d"))


@register("clean_pair_text", f"""
  SELECT doc_id, {trunc_sql(chain_sql('text', ST.POS_CLEAN))} AS chosen,
         {trunc_sql(chain_sql('text', ST.NEG_CLEAN))} AS rejected
  FROM documents
""")
def clean_pair_text(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", ST.clean_positive(t).alias("chosen"),
                                               ST.clean_negative(t).alias("rejected"))


@register("pair_quality_filter", f"""
  SELECT doc_id, CAST(CASE WHEN length(text) > 3 AND {bare_eq(PRE_POS.replace('pos', 'text'))}
                           AND NOT contains({PRE_POS.replace('pos', 'text')}, {q(BAD_POSITIVE)})
                           AND {trunc_sql(PRE_NEG.replace('neg', 'text'))} IS NOT NULL
                           AND NOT contains({trunc_sql(PRE_NEG.replace('neg', 'text'))}, '[tex]') THEN 1 ELSE 0 END AS BIGINT) AS keep
  FROM documents
""")
def pair_quality_filter(spark, d):
    t = F.col("text")
    ok = (F.length(t) > 3) & ST.pair_kept(replace_chain(t, ST.POS_CLEAN), replace_chain(t, ST.NEG_CLEAN))
    return table(spark, d, "documents").select("doc_id", F.when(ok, 1).otherwise(0).cast("bigint").alias("keep"))


# P11 / P12 / P18 / P19 on fixtures ------------------------------------------
@register("claim_label_train", with_fx(f"""
  SELECT doc_id, label FROM (
    SELECT doc_id, CASE WHEN contains(a, 'suport') OR contains(a, 'support') THEN 'supports'
                        WHEN contains(a, 'refu') OR contains(a, 'reject') THEN 'refutes'
                        WHEN contains(a, 'not enough') OR contains(a, 'no enough') THEN 'not enough information' END AS label
    FROM (SELECT doc_id, split_part(prediction, {q(FINAL)}, 2) AS a FROM fact_pred))
  WHERE label IS NOT NULL
""", "fact_pred"))
def claim_label_train(spark, d):
    f = FX.fact_pred(spark, d).select("doc_id", ST.claim_label_train(F.split_part("prediction", F.lit(FINAL), F.lit(2))).alias("label"))
    return f.where(F.col("label").isNotNull())


@register("claim_label_vote", with_fx(f"""
  SELECT doc_id, label FROM (
    SELECT doc_id, CASE WHEN contains(a, '-') THEN NULL
                        WHEN contains(a, 'refute') OR contains(a, 'reje') THEN 'refutes'
                        WHEN contains(a, 'support') OR contains(a, 'suport') OR contains(a, 'correct') THEN 'supports'
                        WHEN contains(a, 'not enough info') OR contains(a, 'no enough info') OR contains(a, 'no evidence') THEN 'not enough info' END AS label
    FROM (SELECT doc_id, replace(split_part(prediction, {q(FINAL)}, 2), '.', '') AS a FROM fact_pred))
  WHERE label IS NOT NULL
""", "fact_pred"))
def claim_label_vote(spark, d):
    pre = F.replace(F.split_part("prediction", F.lit(FINAL), F.lit(2)), F.lit("."), F.lit(""))
    f = FX.fact_pred(spark, d).select("doc_id", F.when(~F.contains(pre, F.lit("-")), TR.claim_vote_label(pre)).alias("label"))
    return f.where(F.col("label").isNotNull())


@register("claim_pos_rewrite", with_fx("""
  SELECT doc_id, chosen FROM (
    SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN p
                        WHEN contains(p, 'not enough') OR contains(p, 'no enough') THEN 'step 3, so the final answer is: not enough information.'
                        WHEN contains(p, 'refu') OR contains(p, 'reject') THEN 'step 3, so the final answer is: refutes.'
                        WHEN contains(p, 'suport') OR contains(p, 'support') THEN 'step 3, so the final answer is: supports.' END AS chosen
    FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN prediction
                              ELSE replace(prediction, 'so the final', 'step 3, so the final') END AS p FROM fact_pred))
  WHERE chosen IS NOT NULL
""", "fact_pred"))
def claim_pos_rewrite(spark, d):
    # Final steps, and other texts that stay as they are.
    last = F.replace("prediction", F.lit("so the final"), F.lit("step 3, so the final"))
    pos = F.when(F.col("doc_id") % 4 == 0, F.col("prediction")).otherwise(last)
    f = FX.fact_pred(spark, d).select("doc_id", ST.claim_positive(pos).alias("chosen"))
    return f.where(F.col("chosen").isNotNull())


@register("math_step_filter", with_fx(f"""
  SELECT l_orderkey, l_linenumber, CAST(CASE WHEN NOT contains(pos, 'step 4') THEN 1
       WHEN contains(pos, {q(MATH_MARK)}) AND regexp_matches(replace(split_part(pos, {q(MATH_MARK)}, 2), ',', ''), '\\p{{Nd}}') THEN 1
       ELSE 0 END AS BIGINT) AS keep
  FROM (SELECT l_orderkey, l_linenumber, 'step 4, ' || lower(split_part(prediction, ', ', 2)) AS pos FROM math_raw)
""", "math_raw"))
def math_step_filter(spark, d):
    pos = F.concat(F.lit("step 4, "), F.lower(F.split_part("prediction", F.lit(", "), F.lit(2))))
    return FX.math_raw(spark, d).select("l_orderkey", "l_linenumber",
                                        F.when(ST.number_given(pos), 1).otherwise(0).cast("bigint").alias("keep"))


# The four-step form of a math task --------------------------------------------
def _math_sql() -> dict[str, str]:
    """The chain above with four steps, its own final phrase and no search."""
    sel = (SEL_SQL.replace(FINAL, "answer (arabic numerals) is ").replace("step = 2", "step = 3")
           .replace("HAVING sum(value) > 0", "HAVING sum(value) > 0 AND regexp_matches(answer, '[0-9]')"))
    pos = (POS_SQL.replace("range(0, 3)", "range(0, 4)").replace("len(segs) >= 3", "len(segs) >= 4").replace("segs[3]", "segs[4]")
           .replace(FINAL, "the answer (arabic numerals) is ").replace(CHAIN_A_SQL.replace(FINAL, "the answer (arabic numerals) is "), CHAIN_A_SQL))
    cor = COR_SQL.replace(STEP_FINAL, MATH_FINAL).replace("l.step = 2", "l.step = 3")
    number = (f"(NOT contains(pos, 'step 4') OR (contains(pos, {q(MATH_MARK)}) AND regexp_matches("
              f"replace(split_part(pos, {q(MATH_MARK)}, 2), ',', ''), '[0-9]')))")
    pairs = PAIRS_SQL.replace("FROM negd WHERE", f"FROM negd WHERE {number} AND").replace(
        f"replace({q(COT_TEMPLATE)}, '{{input}}', qs.question) || prefix", f"{q(WORKED)} || 'Q: ' || qs.question || chr(10) || 'A: ' || prefix")
    return {"lv": "SELECT * FROM math_trace", "sel": sel, "qs": "SELECT p_partkey AS question_id, p_name AS question FROM part",
            "ans": ANS_SQL.replace(STEP_FINAL, MATH_FINAL), "cor": cor, "pos": pos, "neg": NEG_SQL, "negd": NEGD_SQL, "pairs": pairs}


@register("math_step_pairs", with_fx("SELECT prompt, chosen, rejected FROM pairs", "math_trace", extra=_math_sql()))
def math_step_pairs(spark, d):
    lv = materialize(FX.math_trace(spark, d))
    final = lv.where(F.col("step") == ST.MATH_STEPS.n_steps - 1).withColumnRenamed("score", "value")
    # Read by the best answer and again by the positives.
    sel = materialize(TR.answer_vote_value(final, final_sentence=TR.MATH_FINAL_SENTENCE, math=True).select("question_id", "item", "value"))
    qs = table(spark, d, "part").select(F.col("p_partkey").alias("question_id"), F.col("p_name").alias("question"))
    return ST.step_pairs(lv, sel, qs, spec=ST.MATH_STEPS, prompt=worked_prompt(WORKED))
