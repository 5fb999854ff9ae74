"""Pipeline A: wide rated rows -> preference pairs.

A wide row carries every question, variation and rating of one item, so all
pairs of a row are built in-row: one ``select`` creates an array of structs
from the column names and a ``stack`` generator unpacks it.  No join, no shuffle; the
only wide operation in pipeline A is the final statistics aggregate (A9),
which is a map-side partial aggregate plus a one-row merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has, strip

METRICS = ("helpful", "honest", "harmless")
RATING_TYPES = ("completion", "rm_output")
QUESTIONS = (1, 2, 3, 4)
VARIATIONS = (1, 2, 3)

# --- fixed values (must equal the reference's behaviour) -------------------
# Threshold above which the variation answer is chosen over the main answer.
COMPOSITE_THRESHOLD = 0.5
# Score given to a text-form rating cell and to the own metric of a text pair;
# other metrics of a text pair get 0.5.
TEXT_RATING_SCORE = 0.8
TEXT_OTHER_SCORE = 0.5
CHOSEN_OPEN, CHOSEN_CLOSE = "<chosen:", "</chosen:"
REJECT_OPEN, REJECT_CLOSE = "<reject:", "</reject:"
BOX_PREFIX = "<image>\n"
BOX_SUFFIX = "\n\nFocus on this region: "
# Column of the box, as texts or as numbers; tables of this library's own may call it ``bbox``.
BOX_COLUMN = "Bbox coordinates normalized (X, Y, W, H)"
# Language columns recognised by the multi-language probe.
LANGUAGE_COLUMNS = ("vn", "fr", "de", "mandarin", "korean", "japanese", "vi")

NUMERIC = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _c(df: DataFrame, name: str) -> Column:
    """Column by (dotted) name; a missing column reads as null (quirk Q3)."""
    if name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(None).cast("string")


def _suffix(lang: str) -> str:
    return "" if lang == "en" else f"_{lang}"


def parse_rating(cell: Column) -> Column:
    """Numeric cell -> its value; text cell with both tags -> 0.8; else null.

    Numbers follow Python ``float`` on decimal literals; ``nan``/``inf`` and
    underscore forms are treated as non-numeric (documented deviation).
    """
    s = strip(cell)
    num = F.when(F.regexp_like(s, F.lit(NUMERIC)), s.try_cast("double"))
    tagged = F.when(has(cell, CHOSEN_OPEN) & has(cell, REJECT_OPEN), F.lit(TEXT_RATING_SCORE))
    return F.coalesce(num, tagged)


def _box(df: DataFrame) -> Column:
    """The box of a wide row as text; null where no box column holds one."""
    cells = [_c(df, name).cast("string") for name in (BOX_COLUMN, "bbox")]
    return F.coalesce(*[F.when(strip(c) != "", c) for c in cells])


def unpivot_ratings(df: DataFrame) -> DataFrame:
    """(row_id, q, v, metric, rating) for every rated cell of a wide row: the completion
    rating, or the rm_output one where that is no rating.  Absent columns read as null."""
    cells = [x for q in QUESTIONS for v in VARIATIONS for m in METRICS
             for x in (F.lit(q).cast("bigint"), F.lit(v).cast("bigint"), F.lit(m),
                       *[_c(df, f"QA{q}.{v}_{rt}_{m}") for rt in RATING_TYPES])]
    n = F.lit(len(QUESTIONS) * len(VARIATIONS) * len(METRICS))
    rows = df.select("row_id", F.stack(n, *cells).alias("q", "v", "metric", *RATING_TYPES))
    rating = F.coalesce(*[parse_rating(F.col(rt)) for rt in RATING_TYPES])
    return rows.select("row_id", "q", "v", "metric", rating.alias("rating")).where("rating IS NOT NULL")


RAW_FIELDS = [f"{m}_{rt}" for m in METRICS for rt in RATING_TYPES]
ITEM_COLUMNS = ["q", "v", "question", "answer", "var_question", "var_answer", *RAW_FIELDS]


def variation_items(df: DataFrame, lang: str = "en", legacy_position: bool = False,
                    carry: Sequence[str] = ()) -> DataFrame:
    """P1 + P2 + P5 in one pass: one row per (row, question, present variation).

    Output: row_id, q, v, question, answer, var_question, var_answer, helpful,
    honest, harmless, composite.  A ``stack`` generator unpacks the 4 x 3
    (question, variation) cells of each wide row; each rating cell is parsed
    once per output row.  Ratings are keyed by the true variation number;
    ``legacy_position=True`` reproduces the reference, which looks them up by
    position among the present variations (quirk Q1), computed in-row.
    """
    sfx = _suffix(lang)
    args = []
    for q in QUESTIONS:
        present = [_c(df, f"Q{q}.{v}{sfx}").isNotNull() & _c(df, f"A{q}.{v}{sfx}").isNotNull() for v in VARIATIONS]
        for v in VARIATIONS:
            if legacy_position:
                pos = F.lit(1)
                for pv in present[:v - 1]:
                    pos = pos + pv.cast("int")
                cells = [F.element_at(F.array(*[_c(df, f"QA{q}.{w}_{rt}_{m}") for w in VARIATIONS]), pos)
                         for m in METRICS for rt in RATING_TYPES]
            else:
                cells = [_c(df, f"QA{q}.{v}_{rt}_{m}") for m in METRICS for rt in RATING_TYPES]
            args += [F.lit(q).cast("bigint"), F.lit(v).cast("bigint"), _c(df, f"Q{q}{sfx}"), _c(df, f"A{q}{sfx}"),
                     _c(df, f"Q{q}.{v}{sfx}"), _c(df, f"A{q}.{v}{sfx}"), *cells]
    raw = df.select("row_id", *carry, F.stack(F.lit(len(QUESTIONS) * len(VARIATIONS)), *args).alias(*ITEM_COLUMNS))
    raw = raw.where(F.col("question").isNotNull() & F.col("answer").isNotNull()
                    & F.col("var_question").isNotNull() & F.col("var_answer").isNotNull())
    ratings = [F.coalesce(*[parse_rating(F.col(f"{m}_{rt}")) for rt in RATING_TYPES]).alias(m) for m in METRICS]
    out = raw.select("row_id", *carry, "q", "v", *[strip(F.col(c)).alias(c) for c in
                                                  ("question", "answer", "var_question", "var_answer")], *ratings)
    return out.withColumn("composite", (F.col("helpful") + F.col("honest") + F.col("harmless")) / 3)


def composite_pairs(df: DataFrame, lang: str = "en", legacy_position: bool = False,
                    carry: Sequence[str] = ()) -> DataFrame:
    """Composite > 0.5 -> variation answer chosen, main rejected; else swapped.

    Pairs need all three ratings (composite not null).
    """
    it = variation_items(df, lang, legacy_position, carry).where(F.col("composite").isNotNull())
    up = F.col("composite") > COMPOSITE_THRESHOLD
    return it.select(
        "row_id", *carry, F.lit(lang).alias("language"), F.lit("composite").alias("kind"), "q", "v",
        F.col("question").alias("prompt"),
        F.when(up, F.col("var_answer")).otherwise(F.col("answer")).alias("chosen"),
        F.when(up, F.col("answer")).otherwise(F.col("var_answer")).alias("rejected"),
        F.col("question").alias("question_id"),
        F.lit(None).cast("string").alias("metric"), F.lit(None).cast("string").alias("rating_type"),
        "helpful", "honest", "harmless", "composite")


def _between(text: Column, open_tag: str, close_tag: str, prefix: str) -> Column:
    """Slice between tags, strip, drop a leading ``A>``/``B>``; null when the
    closing tag is missing (quirk Q6) or the slice is empty."""
    start = F.instr(text, open_tag) + len(open_tag)
    end = F.instr(text, close_tag)
    raw = F.when(end > 0, F.substring(text, start, F.greatest(end - start, F.lit(0))))
    s = strip(raw)
    s = F.when(F.startswith(s, F.lit(prefix)), strip(F.substr(s, F.lit(len(prefix) + 1)))).otherwise(s)
    return s


def rating_text_pairs(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Pairs written inside rating cells ``<chosen:A>..</chosen:A><reject:B>..</reject:B>``.

    The prompt is the raw (unstripped) main question; scores are 0.8 on the
    cell's own metric and 0.5 on the others, composite 0.8.  Language-free
    (quirk Q4): computed once and crossed with the language list by the caller.
    """
    args = []
    for q in QUESTIONS:
        for v in VARIATIONS:
            for m in METRICS:
                for rt in RATING_TYPES:
                    args += [F.lit(q).cast("bigint"), F.lit(v).cast("bigint"), F.lit(m), F.lit(rt),
                             _c(df, f"QA{q}.{v}_{rt}_{m}"), _c(df, f"Q{q}")]
    x = df.select("row_id", *carry, F.stack(F.lit(len(args) // 6), *args).alias(
        "q", "v", "metric", "rating_type", "cell", "prompt"))
    x = x.where(F.col("cell").isNotNull() & has("cell", CHOSEN_OPEN) & has("cell", REJECT_OPEN)
                & F.col("prompt").isNotNull())
    x = x.select("*", _between(F.col("cell"), CHOSEN_OPEN, CHOSEN_CLOSE, "A>").alias("chosen"),
                 _between(F.col("cell"), REJECT_OPEN, REJECT_CLOSE, "B>").alias("rejected"))
    x = x.where((F.col("chosen") != "") & (F.col("rejected") != "")
                & (F.col("chosen") != "N/A") & (F.col("rejected") != "N/A"))

    def score(m):
        return F.when(F.col("metric") == m, F.lit(TEXT_RATING_SCORE)).otherwise(F.lit(TEXT_OTHER_SCORE))

    return x.select("row_id", *carry, F.lit("text").alias("kind"), "q", "v", "prompt", "chosen", "rejected",
                    F.col("prompt").alias("question_id"), "metric", "rating_type",
                    score("helpful").alias("helpful"), score("honest").alias("honest"),
                    score("harmless").alias("harmless"), F.lit(TEXT_RATING_SCORE).alias("composite"))


def _decorate_cols(box_suffix: str = BOX_SUFFIX) -> list[Column]:
    has_box = F.col("bbox").isNotNull() & (F.col("bbox") != "")
    prompt = F.when(has_box, F.concat(F.lit(BOX_PREFIX), F.col("prompt"), F.lit(box_suffix), F.col("bbox"))) \
        .otherwise(F.col("prompt"))
    image = F.when(F.col("image").isNotNull(), F.concat(F.lit("img_"), F.col("row_id").cast("string"), F.lit(".png")))
    return [prompt.alias("prompt"), image.alias("image"), F.when(has_box, F.col("bbox")).alias("bbox")]


def available_languages(df: DataFrame) -> list[str]:
    """English plus every recognised language column present in the schema."""
    return ["en"] + [c for c in df.columns if c in LANGUAGE_COLUMNS]


PAIR_COLUMNS = ["row_id", "language", "kind", "q", "v", "prompt", "chosen", "rejected", "question_id",
                "metric", "rating_type", "helpful", "honest", "harmless", "composite", "image", "bbox"]


def union_pairs(wide: DataFrame, languages: Sequence[str] = ("en",), legacy_position: bool = False,
                box_suffix: str = BOX_SUFFIX) -> DataFrame:
    """U1 (+P7): composite pairs followed by rating-text pairs, per language.

    Rows are a bag (no de-duplication), as in the reference.  Image bytes are
    never carried: only a derived path string.
    """
    img = F.col("image").isNotNull() if "image" in wide.columns else F.lit(False)
    base = wide.withColumn("_img", img).withColumn("bbox", _box(wide))
    carry = ("_img", "bbox")
    allp = None
    for lang in languages:
        cp = composite_pairs(base, lang, legacy_position, carry)
        allp = cp if allp is None else allp.unionByName(cp)
    text = rating_text_pairs(base, carry).withColumn(
        "language", F.explode(F.array(*[F.lit(x) for x in languages])))
    allp = allp.unionByName(text).withColumn("image", F.when(F.col("_img"), F.lit(1)))
    keep = [c for c in PAIR_COLUMNS if c not in ("prompt", "image", "bbox")]
    return allp.select(*keep, *_decorate_cols(box_suffix))


def pair_stats(pairs: DataFrame, n_rows: DataFrame) -> DataFrame:
    """Count, pairs per source row, min/max/mean composite, empty chosen/rejected."""
    agg = pairs.agg(
        F.count("*").alias("n_pairs"),
        F.min("composite").alias("min_composite"),
        F.max("composite").alias("max_composite"),
        F.avg("composite").alias("mean_composite"),
        F.sum(F.when(strip("chosen") == "", 1).otherwise(0)).cast("bigint").alias("empty_chosen"),
        F.sum(F.when(strip("rejected") == "", 1).otherwise(0)).cast("bigint").alias("empty_rejected"))
    n = n_rows.select(F.count("*")).scalar()
    return agg.select("n_pairs", (F.col("n_pairs") / n).alias("pairs_per_row"),
                      "min_composite", "max_composite", "mean_composite", "empty_chosen", "empty_rejected")


def build_conversations(wide: DataFrame) -> DataFrame:
    """Q1..Q4/A1..A4 -> 8 messages alternating human/gpt, ``<image>\\n`` on Q1.

    A null question or answer drops the row (quirk Q8); an absent column reads
    as empty text.  Output keeps the nesting the trainer reads:
    ``row_id, image, conversations array<struct<from,value>>``.
    """
    msgs = []
    for q in QUESTIONS:
        qc = F.col(f"Q{q}") if f"Q{q}" in wide.columns else F.lit("")
        ac = F.col(f"A{q}") if f"A{q}" in wide.columns else F.lit("")
        qv = strip(qc)
        if q == 1:
            qv = F.concat(F.lit(BOX_PREFIX), qv)
        msgs.append(F.struct(F.lit("human").alias("from"), qv.alias("value")))
        msgs.append(F.struct(F.lit("gpt").alias("from"), strip(ac).alias("value")))
    conv = F.array(*msgs)
    image = F.when(F.col("image").isNotNull(), F.concat(F.lit("img_"), F.col("row_id").cast("string"), F.lit(".png"))) \
        if "image" in wide.columns else F.lit(None).cast("string")
    out = wide.select("row_id", image.alias("image"), conv.alias("conversations"))
    return out.where(F.forall("conversations", lambda m: m["value"].isNotNull()))
