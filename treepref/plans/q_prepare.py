"""Preparation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prepare as PR
from ..session import table
from ..sources import fixtures as FX
from .oracle_fixtures import strip, with_fx
from .registry import r6, register

SEED = 42
KEY = "md5('42:' || CAST(doc_id AS VARCHAR))"


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang", "n_chars")


@register("first_n", """
  SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 100
""")
def first_n(spark, d):
    return PR.first_n(_docs(spark, d), "doc_id", 100)


@register("index_slice", """
  SELECT doc_id, lang, n_chars FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)
  WHERE pos >= 10 AND pos < 60
""")
def index_slice(spark, d):
    return PR.index_slice(_docs(spark, d), "doc_id", 10, 60)


@register("split_exact", f"""
  SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {KEY}, doc_id) - 1 < floor((SELECT count(*) FROM documents) * CAST(0.9 AS DOUBLE))
                      THEN 'train' ELSE 'test' END AS split
  FROM documents
""")
def split_exact(spark, d):
    return PR.split_exact(_docs(spark, d).select("doc_id"), "doc_id", SEED, 0.1)


@register("sample_fraction", f"""
  SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY {KEY}, doc_id) - 1 AS pos FROM documents)
  WHERE pos < round_even((SELECT count(*) FROM documents) * CAST(0.3 AS DOUBLE), 0)
""")
def sample_fraction(spark, d):
    return PR.sample_fraction(_docs(spark, d).select("doc_id"), "doc_id", 0.3, SEED)


@register("validate_pairs", with_fx(f"""
  SELECT TRUE AS columns_ok, CAST(count(*) AS BIGINT) AS n_rows,
         CAST(sum(CASE WHEN coalesce({strip('prompt')}, '') = '' OR coalesce({strip('chosen')}, '') = ''
                       OR coalesce({strip('rejected')}, '') = '' THEN 1 ELSE 0 END) AS BIGINT) AS n_empty,
         '' AS missing
  FROM pref_eval
""", "pref_eval"))
def validate_pairs(spark, d):
    return PR.validate_pairs(FX.pref_eval(spark, d))


@register("first_blank_rows", with_fx(f"""
  SELECT sample_id, prompt, chosen, rejected FROM (
    SELECT sample_id, prompt, split_part(chosen, chr(10), 2) AS chosen, split_part(rejected, chr(10), 2) AS rejected FROM pref_eval)
  WHERE coalesce({strip('prompt')}, '') = '' OR coalesce({strip('chosen')}, '') = '' OR coalesce({strip('rejected')}, '') = ''
  ORDER BY sample_id LIMIT 5
""", "pref_eval"))
def first_blank_rows(spark, d):
    # The second lines of the texts: some texts have none.
    lines = FX.pref_eval(spark, d, line=2).select("sample_id", "prompt", "chosen", "rejected")
    return PR.first_blank_rows(lines, "sample_id")


@register("training_plan", f"""
  WITH n AS (
    SELECT CAST(count(*) AS DOUBLE) AS n FROM (
      SELECT row_number() OVER (ORDER BY {KEY}, doc_id) - 1 AS pos FROM documents)
    WHERE pos < floor((SELECT count(*) FROM documents) * CAST(0.9 AS DOUBLE))),
  p AS (
    SELECT n, CAST(round_even(n / 16, 0) * 3 AS BIGINT) AS total,
           CAST(greatest(10, round_even(0.1 * n / 16, 0)) AS BIGINT) AS warm,
           CAST(round_even(n / 16 * 0.5, 0) AS BIGINT) AS s0 FROM n),
  q AS (SELECT *, CASE WHEN s0 % 50 <> 0 THEN (s0 // 50 + 1) * 50 ELSE s0 END AS s1 FROM p)
  SELECT CAST(n AS BIGINT) AS n_train, total AS total_steps, warm AS warmup_steps,
         CAST(least(s1, total) AS BIGINT) AS save_steps, s1 <= total AS load_best,
         CAST(greatest(1, total) AS BIGINT) AS image_total_steps,
         CAST(greatest(10, round_even(0.1 * greatest(1, total), 0)) AS BIGINT) AS image_warmup_steps,
         CAST(least(500, greatest(1, total)) AS BIGINT) AS image_save_steps
  FROM q
""")
def training_plan(spark, d):
    tr = PR.split_exact(_docs(spark, d).select("doc_id"), "doc_id", SEED, 0.1).where(F.col("split") == "train")
    agg = tr.agg(F.count("*").alias("n_train"))
    return agg.select(F.col("n_train").cast("bigint").alias("n_train"), *PR.training_plan(F.col("n_train")))


@register("parse_math_rows", with_fx(f"""
  SELECT l_orderkey, l_linenumber, {strip('question')} AS question,
         {strip("regexp_replace(split_part(answer, '####', 1), '<<[^>]+>>', '', 'g')")} AS explanation,
         {strip("split_part(answer, '####', 2)")} AS answer
  FROM math_raw WHERE len(string_split(answer, '####')) = 2
""", "math_raw"))
def parse_math_rows(spark, d):
    return PR.parse_math_rows(FX.math_raw(spark, d)).select("l_orderkey", "l_linenumber", "question", "explanation", "answer")


@register("parse_word_problems", with_fx(f"""
  SELECT l_orderkey, l_linenumber, {strip('question')} || {strip('prediction')} AS question,
         CAST(l_linenumber AS VARCHAR) AS answer
  FROM math_raw
""", "math_raw"))
def parse_word_problems(spark, d):
    m = FX.math_raw(spark, d).select("l_orderkey", "l_linenumber", F.col("question").alias("Body"),
                                     F.col("prediction").alias("Question"), F.col("l_linenumber").alias("Answer"))
    return PR.parse_word_problems(m, keep=("l_orderkey", "l_linenumber"))


BOX_SQL = """
  SELECT vec_id, CASE vec_id % 3
      WHEN 0 THEN '[[0.' || CAST(vec_id % 10 AS VARCHAR) || ', 0.' || CAST(label % 10 AS VARCHAR) || ', 0.5, 0.5]]'
      WHEN 1 THEN '((0.' || CAST(label % 10 AS VARCHAR) || ', 0.25, 0.5, 0.75), (0.1, 0.2, 0.3, 0.4))'
      ELSE 'box ' || CAST(vec_id AS VARCHAR) END AS boxes
  FROM embeddings
"""


@register("parse_boxes", f"""
  WITH b AS ({BOX_SQL}),
  j AS (SELECT vec_id, translate(boxes, '()', '[]') AS s FROM b),
  p AS (SELECT vec_id, CASE WHEN json_valid(s) THEN CAST(json_transform(s, '[["DOUBLE"]]') AS DOUBLE[][]) END AS arr FROM j)
  SELECT vec_id, CAST(coalesce(len(arr), 0) AS BIGINT) AS n_boxes,
         round(CASE WHEN len(arr) > 0 THEN arr[1][1] END, 6) AS x0,
         round(CASE WHEN len(arr) > 0 THEN list_sum(flatten(arr)) END, 6) AS total
  FROM p
""")
def parse_boxes(spark, d):
    e = table(spark, d, "embeddings")
    s = (F.when(F.col("vec_id") % 3 == 0, F.concat(F.lit("[[0."), (F.col("vec_id") % 10).cast("string"), F.lit(", 0."),
                                                   (F.col("label") % 10).cast("string"), F.lit(", 0.5, 0.5]]")))
         .when(F.col("vec_id") % 3 == 1, F.concat(F.lit("((0."), (F.col("label") % 10).cast("string"),
                                                  F.lit(", 0.25, 0.5, 0.75), (0.1, 0.2, 0.3, 0.4))")))
         .otherwise(F.concat(F.lit("box "), F.col("vec_id").cast("string"))))
    b = e.select("vec_id", PR.parse_boxes(s).alias("arr"))
    flat = F.flatten("arr")
    return b.select("vec_id", F.size("arr").cast("bigint").alias("n_boxes"),
                    r6(F.when(F.size("arr") > 0, F.col("arr")[0][0])).alias("x0"),
                    r6(F.when(F.size("arr") > 0, F.aggregate(flat, F.lit(0.0), lambda a, x: a + x))).alias("total"))
