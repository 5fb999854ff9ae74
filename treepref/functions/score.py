"""Column expressions that score text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import (ARABIC_MARK, NON_WORD, after_first, after_last, col, first_number, has,
                   last_number, split_ws, strip)

# --- fixed values (must equal the reference's behaviour) -------------------
# Judge verdict words and their values; "impossible"/"unlikely" score 0.001,
# "likely"/"sure" score 1; the containment fallback tests them in this order.
VERDICT_VALUES = {"impossible": 0.001, "unlikely": 0.001, "likely": 1.0, "sure": 1.0}
VERDICT_ORDER = ("impossible", "unlikely", "likely", "sure")
VERDICT_DEFAULT = 0.001
FINAL_PHRASE = "so the final answer is"


def _lit_map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def _contains(word: str):
    return lambda ln: F.instr(ln, word) > 0


def verdict_value(output: Column | str, prompt: Column | str | None = None) -> Column:
    """A1: value of one judge output.

    The prompt echo and ``<s>``/``</s>`` are removed, then the first line whose
    whole lower-cased text is a verdict word decides; otherwise the first verdict
    word (in the fixed order) contained in any line; otherwise 0.001.
    """
    x = col(output)
    if prompt is not None:
        x = F.replace(x, col(prompt), F.lit(""))
    x = F.replace(F.replace(x, F.lit("</s>"), F.lit("")), F.lit("<s>"), F.lit(""))
    lines = F.split(F.lower(x), "\n")
    exact = F.filter(lines, lambda ln: ln.isin(*VERDICT_VALUES))
    exact_val = F.when(F.size(exact) > 0, F.element_at(_lit_map(VERDICT_VALUES), F.element_at(exact, 1)))
    contained = None
    for word in VERDICT_ORDER:
        cond = F.exists(lines, _contains(word))
        contained = (F.when(cond, F.lit(VERDICT_VALUES[word])) if contained is None
                     else contained.when(cond, F.lit(VERDICT_VALUES[word])))
    return F.coalesce(exact_val, contained.otherwise(F.lit(VERDICT_DEFAULT))).cast("double")


def _answer_match(expr: Column, truth: Column) -> Column:
    """Containment, then case-insensitive containment with non-word runs removed.

    A truth that is all punctuation (empty after cleaning) does not match.
    """
    e2 = F.lower(F.regexp_replace(expr, NON_WORD, ""))
    t2 = F.lower(F.regexp_replace(truth, NON_WORD, ""))
    return (F.instr(expr, truth) > 0) | ((t2 != "") & (F.instr(e2, t2) > 0))


def qa_correct(prediction: Column | str, truth: Column | str) -> Column:
    """1 when the text after the final phrase (to line end) holds the truth."""
    y = col(prediction)
    t = col(truth).cast("string")
    low = F.lower(strip(y))
    expr = F.replace(F.split_part(after_first(low, FINAL_PHRASE), F.lit("\n"), F.lit(1)),
                     F.lit(": "), F.lit(""))
    ok = has(y, "answer is") & has(low, FINAL_PHRASE) & _answer_match(expr, t)
    return F.when(ok, 1).otherwise(0).cast("bigint")


def claim_correct(prediction: Column | str, truth: Column | str) -> Column:
    """as F4 but split on ``answer is`` before lower-casing."""
    y = col(prediction)
    t = col(truth).cast("string")
    expr = F.replace(F.split_part(F.lower(after_first(strip(y), "answer is")), F.lit("\n"), F.lit(1)),
                     F.lit(": "), F.lit(""))
    ok = has(y, "answer is") & has(strip(y), "answer is") & _answer_match(expr, t)
    return F.when(ok, 1).otherwise(0).cast("bigint")


def math_correct(prediction: Column | str, truth: Column | str) -> Column:
    """last number of the prediction (after the last marker, commas
    removed) equals the first number of the truth.  No number on either side
    scores 0."""
    y = F.replace(strip(col(prediction)), F.lit(","), F.lit(""))
    y = F.when(has(y, "arabic numerals"), after_last(y, ARABIC_MARK)).otherwise(y)
    p = last_number(y)
    g = first_number(col(truth))
    return F.when(p.isNotNull() & g.isNotNull() & (p == g), 1).otherwise(0).cast("bigint")


def has_final_answer(c: Column | str) -> Column:
    """gate before scoring."""
    return F.instr(F.lower(col(c)), "the final answer is") > 0


def word_set(c: Column | str) -> Column:
    return F.array_distinct(split_ws(F.lower(col(c))))


def jaccard_sets(wa: Column, wb: Column) -> Column:
    """Jaccard of two distinct-word arrays; |A u B| = |A| + |B| - |A n B|."""
    na, nb = F.size(wa), F.size(wb)
    inter = F.size(F.array_intersect(wa, wb))
    j = inter / (na + nb - inter)
    return (F.when((na == 0) & (nb == 0), F.lit(1.0))
            .when((na == 0) | (nb == 0), F.lit(0.0))
            .otherwise(j).cast("double"))


def jaccard_words(a: Column | str, b: Column | str) -> Column:
    """word-set Jaccard; 1.0 when both are empty, 0.0 when one is."""
    return jaccard_sets(word_set(a), word_set(b))


def cosine_similarity(u: Column | str, v: Column | str) -> Column:
    """cosine of two float arrays, computed in double, JVM-side."""
    u, v = col(u), col(v)
    dot = F.aggregate(F.zip_with(u, v, lambda a, b: a.cast("double") * b.cast("double")),
                      F.lit(0.0), lambda acc, x: acc + x)
    nu = F.sqrt(F.aggregate(u, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    nv = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.when((nu > 0) & (nv > 0), dot / (nu * nv)).otherwise(F.lit(0.0))


def text_similarity(u: Column | str, v: Column | str, text_u: Column | str, text_v: Column | str) -> Column:
    """F7 for texts with their vectors: 1.0 when both texts are empty, 0.0 when one is, else the
    cosine.  A null text is empty; blanks are not."""
    eu, ev = (F.coalesce(col(t), F.lit("")) == "" for t in (text_u, text_v))
    return F.when(eu & ev, 1.0).when(eu | ev, 0.0).otherwise(cosine_similarity(u, v))
