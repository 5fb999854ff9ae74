"""Dataset preparation: sampling, splitting, validation, training plan, task
row parsing (W6-W9, A10, A11, P28-P30).

Sampling and splitting are exact and reproducible without any sort: rows get
a seeded key ``md5('<seed>:' || id)``, the cut is found by counting leading digits
(:func:`.ordering.radix_cut`), and the split is a filter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import after_first, before_first, has, strip
from .ordering import Cut, radix_cut, range_positions, seeded_key

# --- fixed values (must equal the reference's behaviour) -------------------
ANSWER_SPLIT = "####"
CALC_SPAN = r"<<[^>]+>>"
REQUIRED_COLUMNS = ("prompt", "chosen", "rejected")
DEFAULT_TEST_RATIO = 0.1


def first_n(df: DataFrame, seq: str, n: int) -> DataFrame:
    """The first ``n`` rows in source order (distributed top-k:
    per-partition top ``n``, then one merge of at most partitions x n rows)."""
    return df.orderBy(seq).limit(n)


def index_slice(df: DataFrame, seq: str, start: int, end: int | None = None) -> DataFrame:
    """``rows[start:end]`` by source position."""
    pos = range_positions(df, [seq])
    cond = F.col("pos") >= start
    if end is not None:
        cond = cond & (F.col("pos") < end)
    return pos.where(cond).drop("pos")


def _cut(df: DataFrame, id_col: str, seed: int, take: Callable[[int], int]) -> Cut:
    """The cut of a seeded shuffle.  Rows with equal ids are told apart by all their columns."""
    return radix_cut(df, [seeded_key(seed, id_col), F.md5(F.to_json(F.struct(*df.columns)))], take)


def _below_rate(id_col: str, seed: int, rate: float) -> Column:
    """Hash threshold: each row on its own, by the first 52 bits of its key."""
    return F.conv(F.substring(seeded_key(seed, id_col), 1, 13), 16, 10).cast("bigint") < F.lit(int(rate * 2 ** 52))


def split_exact(df: DataFrame, id_col: str, seed: int = 42, test_ratio: float = DEFAULT_TEST_RATIO,
                exact: bool = True) -> DataFrame:
    """Seeded shuffle; the first ``int(n * (1 - r))`` rows are ``train``,
    the rest ``test``.  Adds a ``split`` column.

    The cut is found by counting, so the plan is a filter on the key.  With ``exact=False``
    no row is counted: every row is ``train`` with probability ``1 - r`` by its own key, and stays
    where it is when rows are added."""
    if not exact:
        return df.withColumn("split", F.when(_below_rate(id_col, seed, 1 - test_ratio), "train").otherwise("test"))
    cut = _cut(df, id_col, seed, lambda n: int(n * (1 - test_ratio)))
    out = df.where(~cut.equal()).withColumn("split", F.when(cut.below(), "train").otherwise("test"))
    if cut.ties:  # equal rows on both sides of the cut
        same = df.where(cut.equal())
        for name, n in (("train", cut.ties), ("test", cut.tied - cut.ties)):
            out = out.unionByName(same.limit(n).withColumn("split", F.lit(name)))
    return out


def sample_fraction(df: DataFrame, id_col: str, fraction: float, seed: int = 42, exact: bool = True) -> DataFrame:
    """Exactly ``round(n * p)`` rows (half-even, as Python), chosen by the
    seeded key; with ``fraction == 1`` all rows.  ``exact=False`` as for :func:`split_exact`."""
    if fraction >= 1:
        return df
    if not exact:
        return df.where(_below_rate(id_col, seed, fraction))
    cut = _cut(df, id_col, seed, lambda n: int(round(n * fraction)))
    out = df.where(cut.below())
    return out.unionByName(df.where(cut.equal()).limit(cut.ties)) if cut.ties else out


def _blank(required: Sequence[str]) -> Column:
    """Whether any of the columns is null or holds white space only."""
    return reduce(Column.__or__, [F.coalesce(strip(F.col(c)), F.lit("")) == "" for c in required])


def validate_pairs(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """A10: one row: columns present, row count, rows with any blank field."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        return df.sparkSession.createDataFrame([(False, 0, 0, ",".join(missing))],
                                               "columns_ok boolean, n_rows long, n_empty long, missing string")
    return df.agg(F.lit(True).alias("columns_ok"), F.count("*").alias("n_rows"),
                  F.count_if(_blank(required)).alias("n_empty"), F.lit("").alias("missing"))


def first_blank_rows(df: DataFrame, seq: str, n: int = 5, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """A10 report: the first ``n`` offending rows in source order (a top-k report); rows of equal
    ``seq`` are told apart by their fields."""
    return df.where(_blank(required)).orderBy(seq, *required).limit(n)


def training_plan(n_rows: Column, batch_size: int = 4, eval_steps: int = 50, pct_warmup: float = 0.1,
                  image_save_steps: int = 500) -> list[Column]:
    """Step arithmetic from the training-set size, both variants.

    Text plan: total = round(n / 4b) * 3, warmup = max(10, round(0.1 n / 4b)),
    save = round(0.5 n / 4b) lifted to a multiple of eval and capped at total;
    ``load_best`` is false when the cap applies.  Image plan: total at least 1,
    warmup = max(10, round(pct * total)), save given, lifted, capped.
    Rounding is half-even (Python ``round``).
    """
    per = n_rows / F.lit(4 * batch_size)
    total = (F.bround(per, 0) * 3).cast("bigint")
    warm = F.greatest(F.lit(10), F.bround(F.lit(0.1) * n_rows / F.lit(4 * batch_size), 0).cast("bigint"))
    save0 = F.bround(per * 0.5, 0).cast("bigint")
    save1 = F.when(save0 % eval_steps != 0, (F.floor(save0 / eval_steps) + 1) * eval_steps).otherwise(save0).cast("bigint")
    save = F.when(save1 > total, total).otherwise(save1)
    itotal = F.greatest(F.lit(1), total)
    iwarm = F.greatest(F.lit(10), F.bround(F.lit(pct_warmup) * itotal, 0).cast("bigint"))
    isave0 = image_save_steps if image_save_steps % eval_steps == 0 else (image_save_steps // eval_steps + 1) * eval_steps
    isave = F.least(F.lit(isave0).cast("bigint"), itotal)
    return [total.alias("total_steps"), warm.alias("warmup_steps"), save.alias("save_steps"),
            (save1 <= total).alias("load_best"), itotal.alias("image_total_steps"),
            iwarm.alias("image_warmup_steps"), isave.alias("image_save_steps")]


def parse_math_rows(df: DataFrame, question: str = "question", answer: str = "answer") -> DataFrame:
    """Answer ``explanation #### result``: calculator spans removed, both
    stripped.  Rows without exactly one ``####`` are dropped (the reference
    raises on them)."""
    a = F.col(answer)
    ok = has(a, ANSWER_SPLIT) & ~has(after_first(a, ANSWER_SPLIT), ANSWER_SPLIT)
    return df.where(ok).withColumn("explanation", strip(F.regexp_replace(before_first(a, ANSWER_SPLIT), CALC_SPAN, ""))) \
        .withColumn("answer", strip(after_first(a, ANSWER_SPLIT))).withColumn(question, strip(F.col(question)))


def parse_word_problems(df: DataFrame, body: str = "Body", question: str = "Question", answer: str = "Answer",
                        keep: Sequence[str] = ()) -> DataFrame:
    """question = stripped body + stripped question (no separator)."""
    return df.select(*keep, F.concat(strip(F.col(body)), strip(F.col(question))).alias("question"),
                     strip(F.col(answer).cast("string")).alias("answer"))


def parse_boxes(c: Column) -> Column:
    """Box string -> ``array<array<double>>``; parentheses read as
    brackets; anything unparsable -> empty.  (No ``eval``.)"""
    s = F.translate(c, "()", "[]")
    parsed = F.from_json(s, "array<array<double>>")
    return F.coalesce(parsed, F.array().cast("array<array<double>>"))
