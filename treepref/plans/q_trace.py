"""Pipeline C search-side queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import trace as TR
from ..session import table
from ..sources import fixtures as FX
from .oracle_fixtures import with_fx
from .q_scoring import norm_sql
from .registry import r6, register

FINAL = "so the final answer is: "


def _ints(df, *cols):
    return df.select(*[F.col(c).cast("bigint").alias(c) if c in cols else F.col(c) for c in df.columns])


def verdict_sql(out: str) -> str:
    lo = f"lower({out})"
    exact = f"list_filter(string_split({lo}, chr(10)), lambda l: l IN ('impossible', 'unlikely', 'likely', 'sure'))"
    return (f"CAST(CASE WHEN len({exact}) > 0 THEN (CASE WHEN {exact}[1] IN ('impossible', 'unlikely') THEN 0.001 ELSE 1.0 END) "
            f"WHEN contains({lo}, 'impossible') THEN 0.001 WHEN contains({lo}, 'unlikely') THEN 0.001 "
            f"WHEN contains({lo}, 'likely') THEN 1.0 WHEN contains({lo}, 'sure') THEN 1.0 ELSE 0.001 END AS DOUBLE)")


def line_join_sql(y: str, claim: bool) -> str:
    rw = f"replace(replace({y}, '\"', ''''), '  ', ' ')"
    if claim:
        rw = f"replace(replace(replace({y}, '\"', ''''), '-', ' '), '  ', ' ')"
    x = f"replace(lower(split_part({rw}, chr(10) || chr(10), 1)), 'so the final answer is ', '{FINAL}')"
    lines = f"string_split({x}, chr(10))"
    last = f"list_max(list_transform(range(1, len({lines}) + 1), lambda i: CASE WHEN contains({lines}[i], '{FINAL}') THEN i ELSE 0 END))"
    keep = f"(len({lines}) = 1 OR {last} > 1)" if claim else "TRUE"
    return (f"CASE WHEN contains({x}, '{FINAL}') AND {keep} THEN "
            f"(CASE WHEN len({lines}) = 1 THEN {x} ELSE array_to_string({lines}[1:{last}], ' ') END) END")


CV_SQL = """
  SELECT t.question_id, t.step, t.path_id, t.candidate, v.eval_id, v.output
  FROM trace t JOIN verdict v ON v.question_id = t.question_id AND v.eval_id <= (t.path_id + t.step + t.question_id) % 5
"""


def _cv(spark, d):
    return TR.candidate_verdicts(FX.trace(spark, d), FX.path_verdict(spark, d))


@register("verdict_value", with_fx(f"""
  SELECT question_id, CAST(eval_id AS BIGINT) AS eval_id, {verdict_sql('output')} AS value FROM verdict_text
""", "verdict_text"))
def verdict_value(spark, d):
    return TR.with_verdict_value(FX.verdict(spark, d)).select("question_id", F.col("eval_id").cast("bigint").alias("eval_id"),
                                                              r6("value").alias("value"))


@register("candidate_value", with_fx(f"""
  SELECT question_id, CAST(step AS BIGINT) AS step, CAST(path_id AS BIGINT) AS path_id,
         round(CASE WHEN step = 2 AND NOT contains(lower(candidate), 'the final answer is') THEN CAST(0.0 AS DOUBLE)
                    ELSE round_even(sum({verdict_sql('output')}), 3) END, 6) AS value
  FROM cv GROUP BY question_id, step, path_id, candidate
""", "trace", "verdict", extra={"cv": CV_SQL}))
def candidate_value(spark, d):
    v = TR.candidate_value(_cv(spark, d))
    return _ints(v.select("question_id", "step", "path_id", r6("value").alias("value")), "step", "path_id")


@register("candidate_value_product", with_fx(f"""
  SELECT question_id, CAST(step AS BIGINT) AS step, CAST(path_id AS BIGINT) AS path_id, round(product(s), 6) AS value
  FROM (SELECT question_id, step, path_id, candidate, eval_id % 2 AS p, sum({verdict_sql('output')}) AS s
        FROM cv GROUP BY question_id, step, path_id, candidate, eval_id % 2)
  GROUP BY question_id, step, path_id, candidate
""", "trace", "verdict", extra={"cv": CV_SQL}))
def candidate_value_product(spark, d):
    v = TR.candidate_value_product(_cv(spark, d), F.col("eval_id") % 2)
    return _ints(v.select("question_id", "step", "path_id", r6("value").alias("value")), "step", "path_id")


@register("select_greedy_ties", with_fx("""
  SELECT question_id, CAST(step AS BIGINT) AS step, CAST(path_id AS BIGINT) AS path_id, score FROM (
    SELECT *, rank() OVER (PARTITION BY question_id, step ORDER BY score DESC) AS r FROM trace) WHERE r <= 3
""", "trace"))
def select_greedy_ties(spark, d):
    s = TR.select_greedy_ties(FX.trace(spark, d))
    return _ints(s.select("question_id", "step", "path_id", "score"), "step", "path_id")


@register("rank_candidates_report", with_fx("""
  SELECT question_id, CAST(step AS BIGINT) AS step, CAST(path_id AS BIGINT) AS path_id, score,
         CAST(row_number() OVER (PARTITION BY question_id, step ORDER BY score DESC, path_id) AS BIGINT) AS rank
  FROM trace
""", "trace"))
def rank_candidates_report(spark, d):
    r = TR.rank_candidates(FX.trace(spark, d))
    return _ints(r.select("question_id", "step", "path_id", "score", "rank"), "step", "path_id")


@register("select_weighted_sample", with_fx("""
  WITH c AS (
    SELECT question_id, step, path_id, score,
           sum(score) OVER (PARTITION BY question_id, step ORDER BY path_id ROWS UNBOUNDED PRECEDING) AS hi,
           sum(score) OVER (PARTITION BY question_id, step) AS tot
    FROM trace),
  u AS (
    SELECT c.*, k.k, ('0x' || substr(md5('0:' || CAST(question_id AS VARCHAR) || ':' || CAST(step AS VARCHAR) || ':' || CAST(k.k AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0 AS u
    FROM c CROSS JOIN (SELECT unnest(range(0, 3)) AS k) k WHERE tot > 0)
  SELECT question_id, CAST(step AS BIGINT) AS step, CAST(path_id AS BIGINT) AS path_id, CAST(k AS BIGINT) AS draw
  FROM u WHERE u * tot >= hi - score AND u * tot < hi
""", "trace"))
def select_weighted_sample(spark, d):
    s = TR.select_weighted_sample(FX.trace(spark, d))
    return _ints(s.select("question_id", "step", "path_id", "draw"), "step", "path_id", "draw")


@register("tree_expand", with_fx("""
  WITH s0 AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY question_id ORDER BY score DESC) r FROM trace WHERE step = 0) WHERE r <= 3),
  l1 AS (SELECT t.* FROM trace t WHERE t.step = 1 AND EXISTS (
           SELECT 1 FROM s0 WHERE s0.question_id = t.question_id AND s0.path_id = floor(t.path_id / 100) * 100)),
  s1 AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY question_id ORDER BY score DESC) r FROM l1) WHERE r <= 3),
  l2 AS (SELECT t.* FROM trace t WHERE t.step = 2 AND EXISTS (
           SELECT 1 FROM s1 WHERE s1.question_id = t.question_id AND s1.path_id = floor(t.path_id / 10) * 10))
  SELECT question_id, CAST(step AS BIGINT) AS step, CAST(path_id AS BIGINT) AS path_id, score FROM (
    SELECT question_id, step, path_id, score FROM trace WHERE step = 0
    UNION ALL SELECT question_id, step, path_id, score FROM l1
    UNION ALL SELECT question_id, step, path_id, score FROM l2)
""", "trace"))
def tree_expand(spark, d):
    s = TR.search(FX.trace_tree(spark, d)).drop("parent_id")
    return _ints(s.select("question_id", "step", "path_id", "score"), "step", "path_id")


@register("distinct_candidates", with_fx("""
  SELECT DISTINCT question_id, CAST(step AS BIGINT) AS step, candidate FROM trace
""", "trace"))
def distinct_candidates(spark, d):
    t = FX.trace(spark, d).select("question_id", F.col("step").cast("bigint").alias("step"), "candidate")
    return t.dropDuplicates()


@register("answer_line_join", with_fx(f"""
  SELECT question_id, CAST(step AS BIGINT) AS step, CAST(path_id AS BIGINT) AS path_id, item
  FROM (SELECT *, {line_join_sql('candidate', False)} AS item FROM trace) WHERE item IS NOT NULL
""", "trace"))
def answer_line_join(spark, d):
    t = FX.trace(spark, d).select("*", TR.answer_line_join(F.col("candidate")).alias("item"))
    return _ints(t.where(F.col("item").isNotNull()).select("question_id", "step", "path_id", "item"), "step", "path_id")


@register("answer_vote_value", with_fx(f"""
  WITH items AS (
    SELECT question_id, item, avg(round_even(CAST(score AS DOUBLE), 3)) AS value
    FROM (SELECT question_id, score, {line_join_sql('candidate', False)} AS item FROM trace WHERE step = 2)
    WHERE item IS NOT NULL GROUP BY question_id, item),
  ans AS (SELECT *, {norm_sql(f"replace(split_part(item, '{FINAL}', 2), '.', '')")} AS answer FROM items),
  g AS (SELECT question_id, answer, round(sum(value), 9) AS s, min(value) AS m FROM ans GROUP BY question_id, answer HAVING sum(value) > 0),
  w AS (SELECT question_id, answer FROM (
          SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY s DESC, m DESC, answer) AS rn FROM g) WHERE rn = 1)
  SELECT a.question_id, a.answer, a.item, round(a.value, 6) AS value FROM ans a JOIN w USING (question_id, answer)
""", "trace"))
def answer_vote_value(spark, d):
    final = FX.trace(spark, d).where(F.col("step") == 2).withColumnRenamed("score", "value")
    v = TR.answer_vote_value(final)
    return v.select("question_id", "answer", "item", r6("value").alias("value"))


def _claim_final(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "n_chars")
    fp = FX.fact_pred(spark, d).select("doc_id", "prediction")
    return fp.join(docs, "doc_id").select(F.col("source").alias("question_id"), F.col("prediction").alias("candidate"),
                                          (F.col("n_chars") % 6).alias("value"))


@register("answer_vote_count", with_fx(f"""
  WITH f AS (SELECT d.source AS question_id, p.prediction AS candidate, d.n_chars % 6 AS value
             FROM fact_pred p JOIN documents d USING (doc_id)),
  items AS (
    SELECT question_id, item, avg(round_even(CAST(value AS DOUBLE), 3)) AS value
    FROM (SELECT question_id, value, {line_join_sql('candidate', True)} AS item FROM f)
    WHERE item IS NOT NULL GROUP BY question_id, item),
  lab AS (
    SELECT *, CASE WHEN contains(pre, '-') THEN NULL
                   WHEN contains(pre, 'refute') OR contains(pre, 'reje') THEN 'refutes'
                   WHEN contains(pre, 'support') OR contains(pre, 'suport') OR contains(pre, 'correct') THEN 'supports'
                   WHEN contains(pre, 'not enough info') OR contains(pre, 'no enough info') OR contains(pre, 'no evidence') THEN 'not enough info'
              END AS label
    FROM (SELECT *, replace(split_part(item, '{FINAL}', 2), '.', '') AS pre FROM items)),
  g AS (SELECT question_id, label, count(*) AS c, max(value) AS mx FROM lab WHERE label IS NOT NULL GROUP BY 1, 2),
  w AS (SELECT question_id, label FROM (
          SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY c DESC, mx DESC, label) AS rn FROM g) WHERE rn = 1)
  SELECT l.question_id, l.label, l.item, round(l.value, 6) AS value FROM lab l JOIN w USING (question_id, label)
""", "fact_pred"))
def answer_vote_count(spark, d):
    v = TR.answer_vote_count(_claim_final(spark, d))
    return v.select("question_id", "label", "item", r6("value").alias("value"))
