"""Pipeline C, search side: judge verdicts -> values -> selection -> final vote.

Tables, not nested dicts: ``trace(question_id, step, path_id, candidate,
score)`` holds every generated candidate, ``verdicts(question_id, step,
path_id, eval_id, output)`` every judge output.  All grouping keys start with
the question, so a whole search is partitioned by question; selection uses
``rank()`` with a limit, which Spark turns into a partial ``WindowGroupLimit``
before the shuffle.  Final votes aggregate with ``min(struct(...))`` instead
of a sorted window, and full per-question rankings and cumulative sums use
per-group bucketed prefix counts, so no question's candidates are ever sorted
in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.score import verdict_value
from ..functions.text import after_first, any_contains, extract_number_last, has, normalize_answer, replace_chain
from ..session import materialize
from .ordering import grouped_positions, range_bucket, value_bucket

# --- fixed values (must equal the reference's behaviour) -------------------
FINAL_SENTENCE = "so the final answer is: "
MATH_FINAL_SENTENCE = "answer (arabic numerals) is "
# Rewrites applied to a final candidate before voting (in this order).
VOTE_REWRITES = (('"', "'"), ("  ", " "))
CLAIM_VOTE_REWRITES = (('"', "'"), ("-", " "), ("  ", " "))
FINAL_PHRASE_FIX = ("so the final answer is ", "so the final answer is: ")
# Claim labels for the vote, first match wins.
CLAIM_VOTE_LABELS = (
    ("refutes", ("refute", "reje")),
    ("supports", ("support", "suport", "correct")),
    ("not enough info", ("not enough info", "no enough info", "no evidence")),
)
DEFAULT_KEEP = 3


def candidate_verdicts(trace: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Attach judge outputs to the candidates they were made for: an equi-join on
    (question, step, path).  Every output counts, however many a candidate has; a
    candidate without outputs has no row."""
    t = trace.select("question_id", "step", "path_id", "candidate")
    v = verdicts.select("question_id", "step", "path_id", "eval_id", "output")
    return t.join(v, ["question_id", "step", "path_id"])


def with_verdict_value(df: DataFrame, output: str = "output") -> DataFrame:
    """A1 per judge output."""
    return df.withColumn("value", verdict_value(output))


def candidate_value(cv: DataFrame, final_step: int = 2) -> DataFrame:
    """A2: per candidate, the sum of its judge values rounded half-even to 3
    places; 0 at the final step when the candidate has no final answer."""
    v = with_verdict_value(cv).groupBy("question_id", "step", "path_id", "candidate").agg(
        F.sum("value").alias("value"))
    gate = (F.col("step") == final_step) & ~has(F.lower(F.col("candidate")), "the final answer is")
    return v.withColumn("value", F.when(gate, F.lit(0.0)).otherwise(F.bround("value", 3)))


def candidate_value_product(cv: DataFrame, prompt_id: Column) -> DataFrame:
    """A3: several judge prompts per candidate: product of per-prompt sums."""
    s = with_verdict_value(cv).withColumn("prompt_id", prompt_id).groupBy(
        "question_id", "step", "path_id", "candidate", "prompt_id").agg(F.sum("value").alias("s"))
    return s.groupBy("question_id", "step", "path_id", "candidate").agg(F.product("s").alias("value"))


def select_greedy_ties(cands: DataFrame, n: int = DEFAULT_KEEP, value: str = "score") -> DataFrame:
    """Per (question, step) the top ``n`` by value plus every candidate tied
    with the n-th -- exactly ``rank() <= n``."""
    w = Window.partitionBy("question_id", "step").orderBy(F.col(value).desc())
    return cands.withColumn("_r", F.rank().over(w)).where(F.col("_r") <= n).drop("_r")


def rank_candidates(cands: DataFrame, value: str = "score") -> DataFrame:
    """Every candidate with its rank by value (ties broken by path).

    Positions come from per-group bucketed prefix counts.  Buckets are cut by the quantiles of the
    value; one that holds a single value, which many candidates may share, is cut further by the
    path, so one large question is not sorted in a single task."""
    vb, alone = value_bucket(cands, value)
    r = grouped_positions(cands, ["question_id", "step"], [F.col(value).desc(), F.col("path_id")],
                          [-vb, F.when(alone, range_bucket(cands, "path_id")).otherwise(0)])
    return r.withColumn("rank", F.col("pos") + 1).drop("pos")


def _uniform(seed: int, k: Column) -> Column:
    key = F.concat(F.lit(f"{seed}:"), F.col("question_id").cast("string"), F.lit(":"),
                   F.col("step").cast("string"), F.lit(":"), k.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def select_weighted_sample(cands: DataFrame, n: int = DEFAULT_KEEP, value: str = "score",
                           seed: int = 0) -> DataFrame:
    """``n`` draws with replacement, probability value / sum per group.

    Draw ``k`` of a group is the uniform number ``md5(seed:question:step:k)``.
    Each candidate owns the interval [cum_before, cum) of the cumulative value
    (order: path_id; per-group bucketed prefix sums) and claims, in-row, the
    draws that fall in it: no join of draws with candidates.  Groups whose
    values sum to 0 draw nothing.
    """
    # Decimal sums (six places) are exact: one interval ends where the next begins, whatever the partitioning.
    c = grouped_positions(cands.withColumn("_v", F.col(value).cast("decimal(18,6)")), ["question_id", "step"],
                          ["path_id"], [range_bucket(cands, "path_id")], running=["_v"], totals=True)
    c = c.select(*cands.columns, (F.col("_v_cum") - F.col("_v")).cast("double").alias("_lo"),
                 F.col("_v_cum").cast("double").alias("_hi"), F.col("_v_total").cast("double").alias("_tot"))
    c = c.where(F.col("_tot") > 0)
    draws = F.filter(F.sequence(F.lit(0), F.lit(n - 1)),
                     lambda k: (_uniform(seed, k) * F.col("_tot") >= F.col("_lo"))
                     & (_uniform(seed, k) * F.col("_tot") < F.col("_hi")))
    return c.select("*", F.explode(draws).alias("draw")).drop("_hi", "_tot", "_lo")


def tree_expand(level: DataFrame, selected_parents: DataFrame, parent: str = "parent_id") -> DataFrame:
    """Children of the selected parents only (left semi-join on the
    question and the parent's path, which each candidate carries)."""
    p = selected_parents.select("question_id", F.col("path_id").alias(parent))
    return level.join(p, ["question_id", parent], "left_semi").select(level.columns)


def search(trace: DataFrame, n: int = DEFAULT_KEEP, value: str = "score", steps: int = 3) -> DataFrame:
    """Unrolled breadth-first search: level 0 is everything, level t keeps
    children of the greedy selection of level t-1.  ``trace`` names each
    candidate's parent in ``parent_id``, so a node may have any number of
    children.  Returns the expanded candidates of every level."""
    level = trace.where(F.col("step") == 0)
    out = level
    for t in range(1, steps):
        sel = select_greedy_ties(level, n, value)
        level = tree_expand(trace.where(F.col("step") == t), sel)
        out = out.unionByName(level)
    return out


def answer_line_join(y: Column, claim: bool = False, final_sentence: str = FINAL_SENTENCE) -> Column:
    """F8: rewrite, cut at the first blank line, lower, fix the final phrase,
    then drop trailing lines without the final phrase and join lines by a
    space.  Null when the final phrase is missing (or, for claims, when only
    one line is left of several)."""
    x = _vote_text(y, claim)
    return F.when(_has_vote(x, claim, final_sentence), _joined_lines(x, final_sentence))


def _vote_text(y: Column, claim: bool) -> Column:
    x = replace_chain(y, CLAIM_VOTE_REWRITES if claim else VOTE_REWRITES)
    return F.replace(F.lower(F.split_part(x, F.lit("\n\n"), F.lit(1))), F.lit(FINAL_PHRASE_FIX[0]), F.lit(FINAL_PHRASE_FIX[1]))


def _last_final_line(lines: Column, final_sentence: str) -> Column:
    return F.array_max(F.transform(lines, lambda ln, i: F.when(F.instr(ln, final_sentence) > 0, i + 1).otherwise(0)))


def _has_vote(x: Column, claim: bool, final_sentence: str) -> Column:
    ok = has(x, final_sentence)
    if not claim:
        return ok
    lines = F.split(x, "\n")
    return ok & ((F.size(lines) == 1) | (_last_final_line(lines, final_sentence) > 1))


def _joined_lines(x: Column, final_sentence: str) -> Column:
    """The lines up to the last one with the final phrase, which must occur."""
    lines = F.split(x, "\n")
    return F.array_join(F.slice(lines, 1, _last_final_line(lines, final_sentence)), " ")


def _vote_items(final: DataFrame, value: str, claim: bool, final_sentence: str) -> DataFrame:
    # The rewritten text has its own projection and its own test, so that neither repeats the joining.
    v = F.bround(F.col(value).cast("double"), 3).cast("decimal(18,3)").alias("v")
    it = final.select("question_id", _vote_text(F.col("candidate"), claim).alias("_x"), v)
    it = it.where(_has_vote(F.col("_x"), claim, final_sentence))
    it = it.select("question_id", _joined_lines(F.col("_x"), final_sentence).alias("item"), "v")
    return it.groupBy("question_id", "item").agg(
        F.try_divide(F.sum("v").cast("double"), F.count("v")).alias("value"))


def answer_vote_value(final: DataFrame, value: str = "value", final_sentence: str = FINAL_SENTENCE,
                      math: bool = False) -> DataFrame:
    """A4: vote over final candidates.

    Equal cleaned texts merge by mean value; texts group by their normalised
    answer; the answer with the largest sum wins, ties go to the larger
    minimum, then to the smaller answer text (quirk Q16).  Zero-sum answers are
    dropped (quirk Q15); math answers without a number are skipped.  Returns
    the winner's items with their values.
    """
    items = _vote_items(final, value, False, final_sentence)
    # Read by the vote and again by its winners.
    items = materialize(items.withColumn("answer", normalize_answer(F.replace(after_first("item", final_sentence),
                                                                                F.lit("."), F.lit("")))), "items")
    # Decimal sums do not depend on the order of the rows, so a tie is a tie in every run.
    s = F.bround(F.sum(F.col("value").cast("decimal(28,12)")), 9)
    groups = items.groupBy("question_id", "answer").agg(s.alias("s"), F.min("value").alias("m"))
    groups = groups.where(F.col("s") > 0)
    if math:
        groups = groups.where(extract_number_last(F.col("answer")) != "-1")
    best = groups.groupBy("question_id").agg(
        F.min(F.struct((-F.col("s")).alias("ns"), (-F.col("m")).alias("nm"), F.col("answer").alias("a"))).alias("b"))
    win = best.select("question_id", F.col("b.a").alias("answer"))
    return items.join(win, ["question_id", "answer"]).select("question_id", "answer", "item", "value")


def claim_vote_label(pre: Column) -> Column:
    """Claim label of a vote answer (first match), null when none."""
    out = None
    for label, keys in CLAIM_VOTE_LABELS:
        cond = any_contains(pre, keys)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def answer_vote_count(final: DataFrame, value: str = "value") -> DataFrame:
    """A5: claim vote; the label with the most distinct cleaned texts wins,
    ties to the label holding the best mean value, then label order."""
    items = _vote_items(final, value, True, FINAL_SENTENCE)
    pre = F.replace(after_first("item", FINAL_SENTENCE), F.lit("."), F.lit(""))
    items = items.withColumn("label", F.when(~has(pre, "-"), claim_vote_label(pre))).where(F.col("label").isNotNull())
    groups = items.groupBy("question_id", "label").agg(F.count("*").alias("c"), F.max("value").alias("mx"))
    best = groups.groupBy("question_id").agg(
        F.min(F.struct((-F.col("c")).alias("nc"), (-F.col("mx")).alias("nm"), F.col("label").alias("l"))).alias("b"))
    win = best.select("question_id", F.col("b.l").alias("label"))
    return items.join(win, ["question_id", "label"]).select("question_id", "label", "item", "value")
