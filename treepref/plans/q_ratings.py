"""Pipeline A queries: wide rated table -> pairs, conversations, statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ratings as R
from ..sources import fixtures as FX
from .oracle_fixtures import strip, with_fx
from ..session import materialize
from .registry import r6, register

# DuckDB rule for one rating cell: Python float() on decimal text, else 0.8
# when both tags occur, else null.
NUM = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
P_CELL = (f"CASE WHEN regexp_full_match({strip('cell')}, '{NUM}') THEN TRY_CAST({strip('cell')} AS DOUBLE) "
          "WHEN contains(cell, '<chosen:') AND contains(cell, '<reject:') THEN 0.8 END")

RATING_CTE = f"""
  SELECT conv_id, q, v, metric,
         coalesce(max(CASE WHEN rating_type = 'completion' THEN val END),
                  max(CASE WHEN rating_type = 'rm_output' THEN val END)) AS rating
  FROM (SELECT *, {P_CELL} AS val FROM rlhf_rating) GROUP BY conv_id, q, v, metric
"""

ITEMS_CTE = f"""
  SELECT a.conv_id AS row_id, a.q, a.v, {strip('a.question')} AS question, {strip('a.answer')} AS answer,
         {strip('a.question')} AS var_question, {strip('a.var_answer')} AS var_answer,
         h.rating AS helpful, o.rating AS honest, m.rating AS harmless,
         (h.rating + o.rating + m.rating) / 3 AS composite
  FROM rlhf_qa a
  LEFT JOIN rating h ON h.conv_id = a.conv_id AND h.q = a.q AND h.v = a.v AND h.metric = 'helpful'
  LEFT JOIN rating o ON o.conv_id = a.conv_id AND o.q = a.q AND o.v = a.v AND o.metric = 'honest'
  LEFT JOIN rating m ON m.conv_id = a.conv_id AND m.q = a.q AND m.v = a.v AND m.metric = 'harmless'
  WHERE a.question IS NOT NULL AND a.answer IS NOT NULL AND a.var_answer IS NOT NULL
"""

CPAIRS_CTE = """
  SELECT row_id, 'en' AS language, 'composite' AS kind, q, v, question AS prompt,
         CASE WHEN composite > 0.5 THEN var_answer ELSE answer END AS chosen,
         CASE WHEN composite > 0.5 THEN answer ELSE var_answer END AS rejected,
         question AS question_id, CAST(NULL AS VARCHAR) AS metric, CAST(NULL AS VARCHAR) AS rating_type,
         helpful, honest, harmless, composite
  FROM items WHERE composite IS NOT NULL
"""


def _slice(open_tag: str, close_tag: str, pfx: str) -> str:
    o, c = f"strpos(cell, '{open_tag}')", f"strpos(cell, '{close_tag}')"
    raw = f"CASE WHEN {c} > 0 THEN substring(cell, {o} + {len(open_tag)}, greatest({c} - {o} - {len(open_tag)}, 0)) END"
    s = strip(raw)
    return f"CASE WHEN starts_with({s}, '{pfx}') THEN {strip(f'substring({s}, 3)')} ELSE {s} END"


TPAIRS_CTE = f"""
  SELECT row_id, kind, q, v, prompt, chosen, rejected, question_id, metric, rating_type,
         CAST(CASE WHEN metric = 'helpful' THEN 0.8 ELSE 0.5 END AS DOUBLE) AS helpful,
         CAST(CASE WHEN metric = 'honest' THEN 0.8 ELSE 0.5 END AS DOUBLE) AS honest,
         CAST(CASE WHEN metric = 'harmless' THEN 0.8 ELSE 0.5 END AS DOUBLE) AS harmless, CAST(0.8 AS DOUBLE) AS composite
  FROM (
    SELECT r.conv_id AS row_id, 'text' AS kind, r.q, r.v, p.question AS prompt, p.question AS question_id,
           r.metric, r.rating_type,
           {_slice('<chosen:', '</chosen:', 'A>')} AS chosen,
           {_slice('<reject:', '</reject:', 'B>')} AS rejected
    FROM rlhf_rating r
    JOIN (SELECT DISTINCT conv_id, q, question FROM rlhf_qa WHERE question IS NOT NULL) p
      ON p.conv_id = r.conv_id AND p.q = r.q
    WHERE contains(r.cell, '<chosen:') AND contains(r.cell, '<reject:'))
  WHERE chosen <> '' AND rejected <> '' AND chosen <> 'N/A' AND rejected <> 'N/A'
"""

DECOR = """
  SELECT u.row_id, u.language, u.kind, u.q, u.v,
         CASE WHEN e.vec_id IS NOT NULL
              THEN '<image>' || chr(10) || u.prompt || chr(10) || chr(10) || 'Focus on this region: ' ||
                   '[0.' || CAST(e.vec_id % 10 AS VARCHAR) || ', 0.' || CAST(e.label % 10 AS VARCHAR) || ', 0.5, 0.5]'
              ELSE u.prompt END AS prompt,
         u.chosen, u.rejected, u.question_id, u.metric, u.rating_type,
         round(u.helpful, 6) AS helpful, round(u.honest, 6) AS honest, round(u.harmless, 6) AS harmless,
         round(u.composite, 6) AS composite,
         CASE WHEN pg.page_id IS NOT NULL THEN 'img_' || CAST(u.row_id AS VARCHAR) || '.png' END AS image,
         CASE WHEN e.vec_id IS NOT NULL THEN '[0.' || CAST(e.vec_id % 10 AS VARCHAR) || ', 0.' || CAST(e.label % 10 AS VARCHAR) || ', 0.5, 0.5]' END AS bbox
  FROM (SELECT * FROM cpairs UNION ALL SELECT row_id, 'en', kind, q, v, prompt, chosen, rejected, question_id,
                                              metric, rating_type, helpful, honest, harmless, composite FROM tpairs) u
  LEFT JOIN pages pg ON pg.page_id = u.row_id * 3
  LEFT JOIN embeddings e ON e.vec_id = u.row_id * 7
"""


def _wide(spark, d):
    """The wide rated table as pipeline A reads it: a stored table (here built
    from the fixtures once and checkpointed), so the pair builders scan it
    without re-running the fixture's shuffles for every branch."""
    return materialize(FX.wide_table(spark, d))


def _round_scores(df):
    return df.select(*[r6(c).alias(c) if c in ("helpful", "honest", "harmless", "composite") else c
                       for c in df.columns])


# S1 ------------------------------------------------------------------------
def _pivot_sql() -> str:
    sel = ["conv_id AS row_id"]
    for q in range(1, 5):
        sel.append(f"max(CASE WHEN src = 'qa' AND q = {q} THEN question END) AS \"Q{q}\"")
    for q in range(1, 5):
        sel.append(f"max(CASE WHEN src = 'qa' AND q = {q} THEN answer END) AS \"A{q}\"")
    for q in range(1, 5):
        for v in range(1, 4):
            sel.append(f"max(CASE WHEN src = 'qa' AND q = {q} AND v = {v} THEN question END) AS \"Q{q}.{v}\"")
            sel.append(f"max(CASE WHEN src = 'qa' AND q = {q} AND v = {v} THEN var_answer END) AS \"A{q}.{v}\"")
    for q in range(1, 5):
        for v in range(1, 4):
            for rt in R.RATING_TYPES:
                for m in R.METRICS:
                    sel.append(f"max(CASE WHEN src = 'r' AND q = {q} AND v = {v} AND rating_type = '{rt}' "
                               f"AND metric = '{m}' THEN cell END) AS \"QA{q}.{v}_{rt}_{m}\"")
    return f"""
      SELECT {', '.join(sel)} FROM (
        SELECT 'qa' AS src, conv_id, q, v, question, answer, var_answer, NULL AS metric, NULL AS rating_type, NULL AS cell FROM rlhf_qa
        UNION ALL
        SELECT 'r', conv_id, q, v, NULL, NULL, NULL, metric, rating_type, cell FROM rlhf_rating)
      GROUP BY conv_id
    """


WIDE_SQL = _pivot_sql()


@register("scan_wide_parquet", with_fx("""
  SELECT w.*, pg.url AS image_path, CAST(strlen(pg.html) AS BIGINT) AS image_bytes,
         CASE WHEN e.vec_id IS NOT NULL THEN '[0.' || CAST(e.vec_id % 10 AS VARCHAR) || ', 0.' || CAST(e.label % 10 AS VARCHAR) || ', 0.5, 0.5]' END AS bbox
  FROM wide w LEFT JOIN pages pg ON pg.page_id = w.row_id * 3 LEFT JOIN embeddings e ON e.vec_id = w.row_id * 7
""", "rlhf_qa", "rlhf_rating", extra={"wide": WIDE_SQL}))
def scan_wide_parquet(spark, d):
    w = FX.wide_table(spark, d, image_bytes=True)
    cols = [F.col(f"`{c}`") for c in ["row_id"] + FX.wide_columns()]
    return w.select(*cols, F.col("image.path").alias("image_path"),
                    F.length("image.bytes").cast("bigint").alias("image_bytes"), F.col(f"`{R.BOX_COLUMN}`").alias("bbox"))


@register("unpivot_qa", with_fx("""
  SELECT row_id, q, v, question, answer, var_question, var_answer FROM items
""", "rlhf_qa", "rlhf_rating", extra={"rating": RATING_CTE, "items": ITEMS_CTE}))
def unpivot_qa(spark, d):
    return R.variation_items(_wide(spark, d)).select(
        "row_id", "q", "v", "question", "answer", "var_question", "var_answer")


@register("unpivot_ratings", with_fx("""
  SELECT conv_id AS row_id, q, v, metric, round(rating, 6) AS rating FROM rating WHERE rating IS NOT NULL
""", "rlhf_rating", extra={"rating": RATING_CTE}))
def unpivot_ratings(spark, d):
    return R.unpivot_ratings(_wide(spark, d)).withColumn("rating", r6("rating"))


@register("parse_rating", with_fx(f"""
  SELECT conv_id, q, v, metric, rating_type, cell, round({P_CELL}, 6) AS rating FROM rlhf_rating
""", "rlhf_rating"))
def parse_rating(spark, d):
    r = FX.rlhf_rating(spark, d)
    return r.select("*", r6(R.parse_rating(F.col("cell"))).alias("rating"))


@register("rating_text_pairs", with_fx("""
  SELECT row_id, kind, q, v, prompt, chosen, rejected, question_id, metric, rating_type,
         helpful, honest, harmless, composite FROM tpairs
""", "rlhf_qa", "rlhf_rating", extra={"tpairs": TPAIRS_CTE}))
def rating_text_pairs(spark, d):
    return R.rating_text_pairs(_wide(spark, d))


@register("composite_score", with_fx("""
  SELECT row_id, q, v, round(helpful, 6) AS helpful, round(honest, 6) AS honest,
         round(harmless, 6) AS harmless, round(composite, 6) AS composite FROM items
""", "rlhf_qa", "rlhf_rating", extra={"rating": RATING_CTE, "items": ITEMS_CTE}))
def composite_score(spark, d):
    it = R.variation_items(_wide(spark, d))
    return _round_scores(it.select("row_id", "q", "v", "helpful", "honest", "harmless", "composite"))


@register("composite_pairs", with_fx("""
  SELECT row_id, language, kind, q, v, prompt, chosen, rejected, question_id, metric, rating_type,
         round(helpful, 6) AS helpful, round(honest, 6) AS honest, round(harmless, 6) AS harmless,
         round(composite, 6) AS composite FROM cpairs
""", "rlhf_qa", "rlhf_rating", extra={"rating": RATING_CTE, "items": ITEMS_CTE, "cpairs": CPAIRS_CTE}))
def composite_pairs(spark, d):
    return _round_scores(R.composite_pairs(_wide(spark, d)))


_PAIR_FX = dict(extra={"rating": RATING_CTE, "items": ITEMS_CTE, "cpairs": CPAIRS_CTE,
                       "tpairs": TPAIRS_CTE, "decor": DECOR})


@register("union_pairs", with_fx("SELECT * FROM decor", "rlhf_qa", "rlhf_rating", **_PAIR_FX))
def union_pairs(spark, d):
    return _round_scores(R.union_pairs(_wide(spark, d)))


@register("decorate_prompt", with_fx("""
  SELECT row_id, language, kind, q, v, metric, rating_type, prompt, image, bbox FROM decor
""", "rlhf_qa", "rlhf_rating", **_PAIR_FX))
def decorate_prompt(spark, d):
    return R.union_pairs(_wide(spark, d)).select(
        "row_id", "language", "kind", "q", "v", "metric", "rating_type", "prompt", "image", "bbox")


@register("pair_stats", with_fx("""
  SELECT CAST(count(*) AS BIGINT) AS n_pairs,
         round(count(*) / (SELECT count(DISTINCT conv_id) FROM conversations), 6) AS pairs_per_row,
         round(min(composite), 6) AS min_composite, round(max(composite), 6) AS max_composite,
         round(avg(composite), 6) AS mean_composite,
         CAST(sum(CASE WHEN chosen = '' THEN 1 ELSE 0 END) AS BIGINT) AS empty_chosen,
         CAST(sum(CASE WHEN rejected = '' THEN 1 ELSE 0 END) AS BIGINT) AS empty_rejected
  FROM decor
""", "rlhf_qa", "rlhf_rating", **_PAIR_FX))
def pair_stats(spark, d):
    w = _wide(spark, d)
    s = R.pair_stats(R.union_pairs(w), w)
    return s.select("n_pairs", r6("pairs_per_row").alias("pairs_per_row"), r6("min_composite").alias("min_composite"),
                    r6("max_composite").alias("max_composite"), r6("mean_composite").alias("mean_composite"),
                    "empty_chosen", "empty_rejected")


@register("build_conversations", with_fx(f"""
  WITH qa4 AS (
    SELECT conv_id, q, any_value(question) AS question, any_value(answer) AS answer
    FROM rlhf_qa GROUP BY conv_id, q),
  ok AS (
    SELECT conv_id FROM qa4 GROUP BY conv_id
    HAVING count(*) = 4 AND count(question) = 4 AND count(answer) = 4)
  SELECT qa4.conv_id AS row_id,
         CASE WHEN pg.page_id IS NOT NULL THEN 'img_' || CAST(qa4.conv_id AS VARCHAR) || '.png' END AS image,
         CAST(2 * (qa4.q - 1) AS BIGINT) AS pos, 'human' AS "from",
         CASE WHEN qa4.q = 1 THEN '<image>' || chr(10) ELSE '' END || {strip('qa4.question')} AS value
  FROM qa4 JOIN ok USING (conv_id) LEFT JOIN pages pg ON pg.page_id = qa4.conv_id * 3
  UNION ALL
  SELECT qa4.conv_id,
         CASE WHEN pg.page_id IS NOT NULL THEN 'img_' || CAST(qa4.conv_id AS VARCHAR) || '.png' END,
         CAST(2 * (qa4.q - 1) + 1 AS BIGINT), 'gpt', {strip('qa4.answer')}
  FROM qa4 JOIN ok USING (conv_id) LEFT JOIN pages pg ON pg.page_id = qa4.conv_id * 3
""", "rlhf_qa"))
def build_conversations(spark, d):
    c = R.build_conversations(_wide(spark, d))
    return c.select("row_id", "image", F.posexplode("conversations").alias("pos", "m")).select(
        "row_id", "image", F.col("pos").cast("bigint").alias("pos"),
        F.col("m.from").alias("from"), F.col("m.value").alias("value"))


def wide_with_twins(spark, d, lang: str = "fr"):
    """Wide table with language twins ``<col>_<lang>`` filled for rows whose
    document is in that language, plus the marker column the probe looks for."""
    w = _wide(spark, d)
    docs = FX.table(spark, d, "documents").select(F.col("doc_id").alias("row_id"), F.col("lang").alias("_lang"))
    w = w.join(docs, "row_id", "left")
    texts = [c for c in FX.wide_columns() if not c.startswith("QA")]
    twins = [F.when(F.col("_lang") == lang, F.col(f"`{c}`")).alias(f"{c}_{lang}") for c in texts]
    return w.select("*", *twins, (F.col("_lang") == lang).alias(lang)).drop("_lang")


@register("select_languages", with_fx("""
  WITH fr AS (SELECT doc_id AS row_id FROM documents WHERE lang = 'fr'),
  u AS (
    SELECT * FROM cpairs
    UNION ALL SELECT row_id, 'fr', kind, q, v, prompt, chosen, rejected, question_id, metric, rating_type,
                     helpful, honest, harmless, composite FROM cpairs WHERE row_id IN (SELECT row_id FROM fr)
    UNION ALL SELECT row_id, 'en', kind, q, v, prompt, chosen, rejected, question_id, metric, rating_type,
                     helpful, honest, harmless, composite FROM tpairs
    UNION ALL SELECT row_id, 'fr', kind, q, v, prompt, chosen, rejected, question_id, metric, rating_type,
                     helpful, honest, harmless, composite FROM tpairs)
  SELECT u.row_id, u.language, u.kind, u.q, u.v,
         CASE WHEN e.vec_id IS NOT NULL
              THEN '<image>' || chr(10) || u.prompt || chr(10) || chr(10) || 'Focus on this region: ' ||
                   '[0.' || CAST(e.vec_id % 10 AS VARCHAR) || ', 0.' || CAST(e.label % 10 AS VARCHAR) || ', 0.5, 0.5]'
              ELSE u.prompt END AS prompt,
         u.chosen, u.rejected, u.question_id, u.metric, u.rating_type,
         round(u.helpful, 6) AS helpful, round(u.honest, 6) AS honest, round(u.harmless, 6) AS harmless,
         round(u.composite, 6) AS composite,
         CASE WHEN pg.page_id IS NOT NULL THEN 'img_' || CAST(u.row_id AS VARCHAR) || '.png' END AS image,
         CASE WHEN e.vec_id IS NOT NULL THEN '[0.' || CAST(e.vec_id % 10 AS VARCHAR) || ', 0.' || CAST(e.label % 10 AS VARCHAR) || ', 0.5, 0.5]' END AS bbox
  FROM u LEFT JOIN pages pg ON pg.page_id = u.row_id * 3 LEFT JOIN embeddings e ON e.vec_id = u.row_id * 7
""", "rlhf_qa", "rlhf_rating", **_PAIR_FX))
def select_languages(spark, d):
    w = wide_with_twins(spark, d)
    return _round_scores(R.union_pairs(w, R.available_languages(w)))
