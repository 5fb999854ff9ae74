"""Pipeline C, pair side: selected paths -> step-level preference pairs.

Inputs are two tables keyed by question: ``levels(question_id, question,
step, candidate)`` (every candidate the search generated, per level) and
``selected(question_id, item, value)`` (the paths the vote kept).  Every
join is an equi-join on the question (plus the level), with text predicates
as residuals, so a question's work stays in one partition and no bare
``contains`` join ever becomes a nested loop.

Steps: P10 answer of the best selected path -> J3 positives expanded with
agreeing final candidates -> P13 split into levels (positive, prefix) ->
J4 negatives of the same level that extend the prefix -> J5 negatives equal
to a positive removed -> J6 pairs with the prompt -> P16-P19 cleaning and
filters -> U3 distinct.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import after_first, any_contains, has, replace_chain, strip, truncate_to_last_stop
from ..session import materialize
from .prompts import cot_prompt

# --- fixed values (must equal the reference's behaviour) -------------------
STEP_FINAL = "step 3, so the final answer is: "
MATH_STEP_FINAL = "step 4, the answer (arabic numerals) is "
FINAL_TAIL = "so the final answer is: "
N_THOUGHTS = 3
# A later candidate that already holds this step is cut before it.
OVERRUN = "step 3"
QMARK = "？"  # fullwidth question mark
# String-call chains, applied in order ("lower"/"strip" mark those calls).
# A: selected paths before they are split into steps.  B: level-0 candidates.
# C: later-level candidates.  D: negatives before the positive test.
CHAIN_A = ("lower", (" * ", "*"), (" + ", "+"), (" +", "+"), ("+ ", "+"), (" = ", "="), ("= ", "="), (" - ", "-"),
           (" -", "-"), ("- ", "-"), (" x ", "x"), (" / ", "/"), ("/ ", "/"),
           (". so the final answer is", ". step 3, so the final answer is"))
CHAIN_B = ("strip", (" * ", "*"), (" + ", "+"), ("+ ", "+"), (" +", "+"), (" " + QMARK, QMARK), "lower",
           (" = ", "="), ("= ", "="), (" x ", "x"), (" - ", "-"), (" -", "-"), ("- ", "-"), ("answer: ", ""),
           ("..", "."), ("  ", " "), ('"', "'"), (" / ", "/"), ("/ ", "/"), (" " + QMARK, QMARK))
CHAIN_C = ("strip", "lower", (" * ", "*"), (" + ", "+"), ("+ ", "+"), (" +", "+"), (" " + QMARK, QMARK), (" = ", "="),
           ("= ", "="), (" - ", "-"), (" -", "-"), ("- ", "-"), ("answer: ", ""), ("  ", " "), ("..", "."), ('"', "'"),
           (" / ", "/"), ("/ ", "/"), (" " + QMARK, QMARK),
           ("therefore, the final answer is", "so the final answer is"),
           (". so the final answer is", ". step 3, so the final answer is"))
CHAIN_D = (("answer: ", ""), (" + ", "+"), ("+ ", "+"), (" +", "+"), (" / ", "/"), ("/ ", "/"), ("  ", " "),
           ("..", "."), ("= ", "="), (" - ", "-"), (" -", "-"), ("- ", "-"), (" x ", "x"), ('"', "'"),
           (" " + QMARK, QMARK), ("therefore, the final answer is", "so the final answer is"),
           (". so the final answer is", ". step 3, so the final answer is"))
# P16 cleaning of the positive and of the negative.
POS_CLEAN = (("  ", " "), "strip", ("..", "."), (" .", "."), ("..", "."), ("..", "."))
NEG_CLEAN = (("answer: ", ""), ("..", "."), "strip", (" .", "."), ("..", "."), ("..", "."))
# A known bad positive, dropped.
BAD_POSITIVE = "841 34."
# Answer keys -> canonical claim label (training side), later tests win.
CLAIM_TRAIN_LABELS = (
    ("supports", ("suport", "support")),
    ("refutes", ("refu", "reject")),
    ("not enough information", ("not enough", "no enough")),
)
CLAIM_VALID = ("supports", "refutes", "refuted", "not enough info", "not enough information")
MATH_MARK = "(arabic numerals) is "


@dataclass(frozen=True)
class StepSpec:
    """The steps of a task: how many a path has, the marker that begins the last one (``step n, ...``),
    and whether the answer after ``MATH_MARK`` must hold a number."""
    n_steps: int = N_THOUGHTS
    final: str = STEP_FINAL
    number: bool = False

    @property
    def tail(self) -> str:
        """What the last step holds after its number."""
        return self.final.split(", ")[1]

    @property
    def last(self) -> str:
        """Name of the last step."""
        return self.final.split(", ")[0]


QA_STEPS = StepSpec()
MATH_STEPS = StepSpec(4, MATH_STEP_FINAL, number=True)


def normalize_a(c: Column) -> Column:
    return replace_chain(c, CHAIN_A)


def normalize_b(c: Column) -> Column:
    return replace_chain(c, CHAIN_B)


def normalize_c(c: Column) -> Column:
    return replace_chain(c, CHAIN_C)


def normalize_d(c: Column) -> Column:
    return replace_chain(c, CHAIN_D)


def claim_label_train(pre: Column, last_wins: bool = False) -> Column:
    """Claim label by key containment, null when no key occurs.

    On the best answer the tests run on the rewritten text, so the first match
    wins (P11); on a positive they all test the original text, so the last
    match wins (P19)."""
    if last_wins:
        out = F.lit(None).cast("string")
        for label, keys in CLAIM_TRAIN_LABELS:
            out = F.when(any_contains(pre, keys), F.lit(label)).otherwise(out)
        return out
    out = None
    for label, keys in CLAIM_TRAIN_LABELS:
        cond = any_contains(pre, keys)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def best_answer(selected: DataFrame, claim: bool = False, spec: StepSpec = QA_STEPS) -> DataFrame:
    """P10: answer after the final marker of the best selected path (highest
    value, then smallest text); questions whose best path lacks the marker are
    dropped.  Claims map the answer to a label and drop unknown labels."""
    best = selected.groupBy("question_id").agg(
        F.min(F.struct((-F.col("value")).alias("nv"), F.col("item").alias("item"))).alias("b"))
    b = best.select("question_id", F.col("b.item").alias("best"))
    b = b.where(has("best", spec.final)).withColumn("answer", after_first("best", spec.final))
    if claim:
        lab = F.coalesce(claim_label_train(F.col("answer")), F.col("answer"))
        b = b.withColumn("answer", lab).where(strip(F.replace(F.col("answer"), F.lit("."), F.lit(""))).isin(*CLAIM_VALID))
    return b.select("question_id", "answer")


def _agree(pre: Column, ans: Column, claim: bool) -> Column:
    p2 = strip(F.replace(pre, F.lit("."), F.lit("")))
    a2 = strip(F.replace(ans, F.lit("."), F.lit("")))
    if claim:
        return (((a2 == "supports") & has(pre, "support"))
                | (a2.isin("refutes", "refuted") & has(pre, "refute"))
                | (a2.isin("not enough info", "not enough information") & has(pre, "not enough")))
    both_text = (p2 != "") & (a2 != "") & ((F.instr(p2, a2) > 0) | (F.instr(a2, p2) > 0))
    yes = has(F.lower(pre), "yes") & has(F.lower(ans), "yes")
    no = has(F.lower(pre), "no") & has(F.lower(ans), "no")
    return both_text | yes | no


def positive_expansion(levels: DataFrame, selected: DataFrame, claim: bool = False,
                       spec: StepSpec = QA_STEPS) -> DataFrame:
    """Selected paths plus final-level candidates whose answer agrees with
    the best answer (containment either way after removing ``.``; both say
    yes; both say no -- a substring test, quirk Q11; claims: same label key).
    Empty answers never agree (quirk Q12).  Equi-join on the question with the
    agreement as residual; distinct union."""
    ans = best_answer(selected, claim, spec)
    fin = levels.where((F.col("step") == spec.n_steps - 1) & has("candidate", spec.final)).select(
        "question_id", F.col("candidate").alias("cor"), after_first("candidate", spec.final).alias("pre"))
    j = fin.join(ans, "question_id").where(_agree(F.col("pre"), F.col("answer"), claim)).select("question_id", "cor")
    sel = selected.join(ans.select("question_id"), "question_id", "left_semi").select(
        "question_id", F.col("item").alias("cor"))
    return sel.unionByName(j).dropDuplicates(["question_id", "cor"])


def split_reasoning_steps(correct: DataFrame, spec: StepSpec = QA_STEPS) -> DataFrame:
    """P13 + U4: each correct path -> one row per level with the step text
    (``pos``) and the earlier steps joined back (``prefix``); paths need at
    least ``spec.n_steps`` steps and the final phrase in the last one.  Distinct
    on (question, level, pos, prefix) (quirk Q10)."""
    segs = F.slice(F.split(normalize_a(F.col("cor")), "step"), 2, 1 << 20)
    c = correct.select("question_id", segs.alias("segs")).where(
        (F.size("segs") >= spec.n_steps) & has(F.get("segs", spec.n_steps - 1), spec.tail))
    lv = c.select("question_id", "segs", F.explode(F.sequence(F.lit(0), F.lit(spec.n_steps - 1))).alias("step"))
    pos = strip(F.lower(F.concat(F.lit("step"), F.element_at("segs", F.col("step") + 1))))
    prefix = F.when(F.col("step") == 0, F.lit("")).otherwise(
        strip(F.concat(F.lit("step"), F.array_join(F.slice("segs", 1, F.col("step")), "step"))))
    return lv.select("question_id", F.col("step").cast("bigint").alias("step"), pos.alias("pos"),
                     prefix.alias("prefix")).dropDuplicates()


def _matchable(df: DataFrame, choice: str = "norm", step: str = "step", out: str = "whole") -> DataFrame:
    """P15, first half: the candidate without what overruns its level, the text that a prefix is sought in.
    Each intermediate is its own projection (each is read several times), so every split runs once per row."""
    c, st = F.col(choice), F.col(step)
    d = df.withColumn("_x1", F.when((st == 1) & has(c, OVERRUN), F.split_part(c, F.lit(OVERRUN), F.lit(1))).otherwise(c))
    d = d.withColumn("_p3", F.split(F.col("_x1"), OVERRUN))
    d = d.withColumn(out, F.when(F.size("_p3") > 2, F.array_join(F.slice("_p3", 1, F.size("_p3") - 1), OVERRUN))
                     .otherwise(F.col("_x1")))
    return d.drop("_x1", "_p3")


def _with_remainder(df: DataFrame, whole: str = "whole", prefix: str = "prefix", out: str = "neg") -> DataFrame:
    """P15, second half: the candidate minus a prefix that it holds, re-anchored at ``step``."""
    d = df.withColumn("_cut", strip(F.replace(F.col(whole), F.col(prefix), F.lit(""))))
    anchored = F.when(F.startswith(strip(F.replace(F.col("_cut"), F.lit("answer: "), F.lit(""))), F.lit("step")),
                      F.col("_cut")).otherwise(
        F.concat(F.lit("step"), F.array_join(F.slice(F.split(F.col("_cut"), "step"), 2, 1 << 20), "step")))
    return d.withColumn(out, anchored).drop("_cut")


def _once(df: DataFrame, keep: list[str], **texts: Column) -> DataFrame:
    """Columns ``keep`` and the named texts, each computed once a row: a filter on the output of a
    one-row generator is not pushed below it, where it would compute the text again."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(name) for name, c in texts.items()]))))


def negatives_by_prefix(positives: DataFrame, levels: DataFrame) -> DataFrame:
    """Per (positive, prefix) the candidates of the same level that hold the
    prefix and differ from the positive.

    A prefix begins with ``step``, so it can only lie at one of a candidate's step
    marks.  A candidate emits, for each mark and each length that the prefixes of
    its (question, level) have, the hash of the text there; prefixes meet
    candidates in an equi-join on (question, level, hash) and are verified on the
    text.  So a question's candidates spread over tasks by their own beginnings,
    and no candidate is compared with a prefix that it does not hold.  Positives
    that share a prefix are joined once the candidates of the prefix are known.
    Level 0 has no prefix: there all candidates answer, and the join is on the level.
    A null prefix meets nothing.
    """
    key, cols = ["question_id", "step"], ["question_id", "step", "pos", "prefix", "neg"]
    lv = _once(levels.select("question_id", F.col("step").cast("bigint").alias("step"), "candidate"), key,
               norm=F.when(F.col("step") == 0, normalize_b(F.col("candidate"))).otherwise(normalize_c(F.col("candidate"))))
    lv = lv.dropDuplicates()
    # Distinct positives that meet distinct negatives give distinct rows.
    distinct = positives.select(*cols[:4]).dropDuplicates()
    first = distinct.where("step = 0").join(lv.where("step = 0").withColumnRenamed("norm", "neg"), key)

    later = _matchable(lv.where("step > 0")).where(has("whole", "step"))
    prefixes = positives.where("step > 0").select(*key, "prefix").dropDuplicates()
    lengths = prefixes.groupBy(*key).agg(F.collect_set(F.length("prefix")).alias("lengths"))
    # A prefix can begin at the k-th "step" of a text.
    marks = later.join(lengths, key).select(*key, "whole", "lengths", F.explode(
        F.sequence(F.lit(1), F.size(F.split("whole", "step")) - 1)).alias("k"))
    at = F.length(F.call_function("substring_index", "whole", F.lit("step"), "k")) + 1
    places = marks.select(*key, "whole", F.length("whole").alias("size"), at.alias("at"), F.explode("lengths").alias("n"))
    places = places.where(F.col("at") + F.col("n") - 1 <= F.col("size"))
    held = places.select(*key, "whole", F.xxhash64(F.substring("whole", F.col("at"), F.col("n"))).alias("hash"))
    met = held.join(prefixes.withColumn("hash", F.xxhash64("prefix")), [*key, "hash"])
    met = met.where(F.instr("whole", F.col("prefix")) > 0).select(*key, "prefix", "whole")
    found = _once(_with_remainder(met, out="_neg"), [*key, "prefix"], neg=F.col("_neg")).dropDuplicates()
    rest = distinct.where("step > 0").join(found, [*key, "prefix"])
    out = first.select(*cols).unionByName(rest.select(*cols))
    return out.where(F.col("neg").isNotNull() & (F.col("neg") != F.col("pos")))


def drop_positive_negatives(negs: DataFrame, positives: DataFrame) -> DataFrame:
    """Rewrite negatives (chain D) and drop those equal to any positive of
    the same question and level (``left_anti``)."""
    n = _once(negs, [c for c in negs.columns if c != "neg"], neg=normalize_d(F.col("neg")))
    p = positives.select("question_id", "step", F.col("pos").alias("neg")).dropDuplicates()
    return n.join(p, ["question_id", "step", "neg"], "left_anti")


def clean_positive(pos: Column) -> Column:
    return truncate_to_last_stop(replace_chain(pos, POS_CLEAN))


def clean_negative(neg: Column) -> Column:
    return truncate_to_last_stop(replace_chain(neg, NEG_CLEAN))


def _no_bare_equals(x: Column) -> Column:
    return ~has(x, "=") | any_contains(x, ("-", "+", "/", "*"))


def claim_positive(pos: Column, spec: StepSpec = QA_STEPS) -> Column:
    """A final claim step is rewritten to its label (the last match wins); null, which drops
    the pair, where no label matches (Q32).  Other steps stay."""
    lab = claim_label_train(pos, last_wins=True)
    return F.when(has(pos, spec.final), F.when(lab.isNotNull(), F.concat(F.lit(spec.final), lab, F.lit(".")))).otherwise(pos)


def number_given(pos: Column, spec: StepSpec = MATH_STEPS) -> Column:
    """The last step must hold the answer's marker and a number after it."""
    after = F.replace(after_first(pos, MATH_MARK), F.lit(","), F.lit(""))
    return ~has(pos, spec.last) | (has(pos, MATH_MARK) & F.regexp_like(after, F.lit(r"\p{Nd}")))


def pair_kept(pos: Column, neg: Column) -> Column:
    """P17 on the texts that P16 has cleaned, before they are cut at their last stop."""
    rejected = truncate_to_last_stop(neg)
    return (_no_bare_equals(pos) & _no_bare_equals(neg) & ~has(pos, BAD_POSITIVE)
            & truncate_to_last_stop(pos).isNotNull() & rejected.isNotNull() & ~has(rejected, "[tex]"))


def with_prompt(negs: DataFrame, questions: DataFrame, prompt: Callable[[Column, Column], Column] = cot_prompt) -> DataFrame:
    """One row per (positive, negative) with the prompt of its question and earlier steps."""
    j = negs.join(questions, "question_id")
    return j.withColumn("prompt", prompt(F.col("question"), F.col("prefix")))


def explode_pairs(negs: DataFrame, questions: DataFrame, claim: bool = False, spec: StepSpec = QA_STEPS,
                  prompt: Callable[[Column, Column], Column] = cot_prompt) -> DataFrame:
    """J6 + P16-P19 + U3: one pair per (positive, negative) with the prompt,
    cleaned and filtered, distinct on (prompt, chosen, rejected)."""
    j = with_prompt(negs.where(F.length("neg") > 3), questions, prompt)
    j = j.withColumn("chosen_raw", claim_positive(F.col("pos"), spec) if claim else F.col("pos")).where(F.col("chosen_raw").isNotNull())
    if spec.number:
        j = j.where(number_given(F.col("chosen_raw"), spec))
    j = _once(j, ["prompt"], pre_pos=replace_chain(F.col("chosen_raw"), POS_CLEAN), pre_neg=replace_chain(F.col("neg"), NEG_CLEAN))
    j = j.where(pair_kept(F.col("pre_pos"), F.col("pre_neg")))
    return j.select("prompt", truncate_to_last_stop("pre_pos").alias("chosen"),
                    truncate_to_last_stop("pre_neg").alias("rejected")).distinct()


def step_pairs(levels: DataFrame, selected: DataFrame, questions: DataFrame, claim: bool = False,
               spec: StepSpec = QA_STEPS, prompt: Callable[[Column, Column], Column] = cot_prompt) -> DataFrame:
    """Whole pair side of pipeline C."""
    correct = positive_expansion(levels, selected, claim, spec)
    # Read by the negatives and again by the test against all positives.
    positives = materialize(split_reasoning_steps(correct, spec), "positives")
    negs = drop_positive_negatives(negatives_by_prefix(positives, levels), positives)
    return explode_pairs(negs, questions, claim, spec, prompt)
