"""Pipeline D: scoring predictions and preference evaluation.

Per-row scoring is pure column expressions; the only shuffles are the
question-keyed lookup join, the per-question aggregate and the final one-row
aggregates (partial aggregation map-side, one tiny merge).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.score import has_final_answer, jaccard_sets, word_set
from .ordering import range_positions

# --- fixed values (must equal the reference's behaviour) -------------------
# Log layout of the evaluation run: a ground-truth line, then a line
# "<question> sum(accs) <n> cnt_avg <x> cnt_any <y>".
LOG_TRUTH_PREFIX = "====GR===="
LOG_ACC_MARK = " sum(accs)"
REPORT_EVERY = 10


def latest_answer(truth: DataFrame, key: str = "question", answer: str = "answer",
                  seq: str = "seq") -> DataFrame:
    """J1 part 1: question -> answer, the last occurrence (by ``seq``) wins.

    ``max_by`` aggregates partially before the shuffle, so a question repeated
    across a third of the rows still ships one row per map task.
    """
    return truth.groupBy(key).agg(F.max_by(answer, seq).alias(answer))


def join_ground_truth(preds: DataFrame, truth: DataFrame, key: str = "question",
                      answer: str = "answer", seq: str = "seq") -> DataFrame:
    """Attach the ground truth to each prediction (inner equi-join on the
    question).  The truth side has one row per question after
    :func:`latest_answer`; AQE broadcasts it when small and splits skewed
    partitions of the prediction side otherwise."""
    return preds.join(latest_answer(truth, key, answer, seq), key)


def logged_questions(log: DataFrame, line_no: str = "line_no", line: str = "line", file: str = "file") -> DataFrame:
    """Questions already scored in a run log.

    A line counts when it holds `` sum(accs)`` and the line before it starts
    with ``====GR====``; the first line never counts.  The previous line is found
    with an equi-join on ``line_no - 1`` (line numbers are dense), not a
    whole-file window, so one long log spreads over all tasks.  Where the log
    has a ``file`` column, the line before is one of the same file.
    """
    same = [file, line_no] if file in log.columns else [line_no]
    cur = log.where(F.instr(F.col(line), LOG_ACC_MARK) > 0).where(F.col(line_no) > 0)
    prev = log.where(F.startswith(F.col(line), F.lit(LOG_TRUTH_PREFIX))).withColumn(
        line_no, F.col(line_no) + 1).select(*same)
    hit = cur.join(prev, same, "left_semi")
    return hit.select(F.split_part(F.col(line), F.lit(LOG_ACC_MARK), F.lit(1)).alias("question")).distinct()


def resume_anti_join(tasks: DataFrame, done: DataFrame, key: str = "question") -> DataFrame:
    """Tasks not yet logged or written (``left_anti`` on the question)."""
    return tasks.join(done.select(key).distinct(), key, "left_anti")


def accuracy_avg_any(scored: DataFrame, question: str, correct: str,
                     loaded: DataFrame | None = None) -> DataFrame:
    """Per question mean and any of the correctness flags, then their sums
    divided by the number of questions in ``loaded`` (quirk Q19: skipped questions
    stay in the denominator; without ``loaded``, the scored ones).  Without
    questions both shares are 0."""
    per_q = scored.groupBy(question).agg(F.avg(correct).alias("_avg"), F.max(correct).alias("_any"))
    agg = per_q.agg(F.count("*").alias("n_scored"), F.sum("_avg").alias("_s_avg"), F.sum("_any").alias("_s_any"))
    n = F.col("n_scored") if loaded is None else loaded.agg(F.countDistinct(question)).scalar()

    def share(c):
        return F.coalesce(F.try_divide(F.col(c).cast("double"), F.col("n_total")), F.lit(0.0))

    agg = agg.withColumn("n_total", n.cast("bigint"))
    return agg.select("n_total", "n_scored", share("_s_avg").alias("acc_avg"), share("_s_any").alias("acc_any"))


def preference_results(df: DataFrame, similarity=None) -> DataFrame:
    """A9-shape result rows: similarity of the generation to chosen and rejected,
    and whether chosen wins (strictly).  By default word-set Jaccard, with each
    text's word set built once (its own projection) and shared by both scores."""
    if similarity is None:
        sets = df.select("*", *[word_set(c).alias(f"_w_{c}") for c in ("generated", "chosen", "rejected")])
        out = sets.select(*df.columns, jaccard_sets(F.col("_w_generated"), F.col("_w_chosen")).alias("chosen_similarity"),
                          jaccard_sets(F.col("_w_generated"), F.col("_w_rejected")).alias("rejected_similarity"))
    else:
        out = df.select("*", similarity("generated", "chosen").alias("chosen_similarity"),
                        similarity("generated", "rejected").alias("rejected_similarity"))
    win = F.col("chosen_similarity") > F.col("rejected_similarity")
    return out.withColumn("predicted_chosen", win.cast("int")).withColumn("correct", win.cast("int"))


def preference_metrics() -> list[Column]:
    """The counts of A7 as aggregates, for a report or for the pass that writes the results."""
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("correct"), F.lit(0)).cast("bigint").alias("n_correct")]


def preference_accuracy(results: DataFrame) -> DataFrame:
    """Share of results where chosen wins; 0 when there are none."""
    return results.agg(*preference_metrics()).select(
        "n", "n_correct", F.coalesce(F.try_divide(F.col("n_correct"), F.col("n")), F.lit(0.0)).alias("accuracy"))


def error_metrics(status_col: str = "error") -> list[Column]:
    """The counts of A8 as aggregates."""
    st = F.col(status_col)
    counted = st.isNull() | (st == "image_missing")
    return [F.count_if(counted).alias("n_total"), F.count_if(st.isNull() & (F.col("correct") == 1)).alias("n_correct"),
            F.count_if(st == "image_missing").alias("n_image_missing"),
            F.count_if(st.isNotNull() & (st != "image_missing")).alias("n_errors")]


def error_accounting(results: DataFrame, image: str = "image", status_col: str = "error") -> DataFrame:
    """A missing image is a wrong answer that counts; other errors are
    listed (``n_errors``) but excluded from the denominator."""
    return results.agg(*error_metrics(status_col)).select(
        "*", F.coalesce(F.try_divide(F.col("n_correct"), F.col("n_total")), F.lit(0.0)).alias("accuracy"))


def running_accuracy(results: DataFrame, seq: str, correct: str = "correct",
                     every: int = REPORT_EVERY) -> DataFrame:
    """Cumulative accuracy after each result, reported every ``every`` rows.

    Positions and running sums come from :func:`range_positions`: the results are scored and
    sorted once, by ranges, and not in a single-partition window.
    """
    pos = range_positions(results.select(seq, F.col(correct).cast("bigint").alias("_c")), [seq], running=["_c"])
    rep = pos.where((F.col("pos") + 1) % every == 0)
    return rep.select((F.col("pos") + 1).alias("processed"),
                      (F.col("_c_cum") / (F.col("pos") + 1)).alias("running_accuracy"))


def gate_final_answer(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """F9 as a filter: predictions without a final answer are skipped."""
    return df.where(has_final_answer(prediction))


def gated_accuracy(preds: DataFrame, truth: DataFrame, score: Callable[[Column, Column], Column], key: str = "question",
                   answer: str = "answer", seq: str = "seq", prediction: str = "prediction", gate: bool = True) -> DataFrame:
    """J1, F9, scoring and A6 in one: predictions without a final answer are skipped (``gate``, which
    math tasks do without), the others are scored against the last truth of their question, and both shares
    are over all questions of ``truth``."""
    kept = gate_final_answer(preds, prediction) if gate else preds
    scored = join_ground_truth(kept.select(key, prediction), truth, key, answer, seq).select(
        key, score(F.col(prediction), F.col(answer)).alias("correct"))
    return accuracy_avg_any(scored, key, "correct", loaded=truth)
