"""Model calls and generation cleaning.

The model is a user-supplied callable ``fn(prompts: list[str], n: int) ->
list[list[str]]``, created once per task by a zero-argument factory and fed
Arrow batches through ``mapInPandas``.  Everything after the call is column
expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import before_first, has, strip
from .steps import MATH_STEPS, QA_STEPS, StepSpec

ModelFn = Callable[[list, int], list]

# --- fixed values (must equal the reference's behaviour) -------------------
SPECIAL_TOKENS = ("</s>", "<s>")
CUT_MARKERS = ("question:", "claim:", "task:")
MATH_CUT = "q:"
FINAL_PHRASE = "so the final answer is"


# --- model surface ----------------------------------------------------------
def batch_generate(df: DataFrame, id_col: str, prompt_col: str, n: int,
                   make_model: Callable[[], ModelFn]) -> DataFrame:
    """``n`` outputs per prompt -> rows ``(id, prompt, sample_id, text)``.

    The model is built once per task (inside the partition iterator) and called
    on whole Arrow batches; only the id and prompt columns are shipped.
    """
    schema = f"{id_col} {dict(df.dtypes)[id_col]}, prompt string, sample_id bigint, text string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for b in batches:
            prompts = b[prompt_col].tolist()
            outs = model(prompts, n)
            rows = [(i, p, k, t) for i, p, ts in zip(b[id_col].tolist(), prompts, outs) for k, t in enumerate(ts)]
            yield pd.DataFrame(rows, columns=[id_col, "prompt", "sample_id", "text"])

    return df.select(id_col, F.col(prompt_col).alias(prompt_col)).mapInPandas(run, schema)


@dataclass(frozen=True)
class Task:
    """One task = how to read it, prompt it, judge it and score it, all as
    column functions (no per-row objects)."""
    name: str
    source: Callable[[SparkSession, str], DataFrame]
    steps: StepSpec
    final_sentence: str
    prompt: Callable[..., Column]
    judge: Callable[..., Column]
    score: Callable[[Column, Column], Column]


def task_registry(math_demos: str = "") -> dict[str, Task]:
    """The tasks; ``math_demos`` are the worked examples before a math question."""
    from ..functions.score import claim_correct, math_correct, qa_correct
    from ..sources.readers import scan_claims_jsonl, scan_flat_qa_json
    from .prepare import parse_math_rows
    from .prompts import cot_prompt, judge_prompt, math_judge_prompt, worked_prompt
    return {
        "qa": Task("qa", scan_flat_qa_json, QA_STEPS, "so the final answer is: ", cot_prompt, judge_prompt, qa_correct),
        "claims": Task("claims", scan_claims_jsonl, QA_STEPS, "so the final answer is: ", cot_prompt,
                       lambda q, y: judge_prompt(q, y, claim=True), claim_correct),
        "math": Task("math", lambda spark, path: parse_math_rows(scan_flat_qa_json(spark, path)), MATH_STEPS,
                     "answer (arabic numerals) is ", worked_prompt(math_demos), math_judge_prompt, math_correct),
    }


# --- cleaning ---------------------------------------------------------------
def _unwrap(text: Column, prompt: Column | None) -> Column:
    x = text if prompt is None else F.replace(text, prompt, F.lit(""))
    for t in SPECIAL_TOKENS:
        x = F.replace(x, F.lit(t), F.lit(""))
    return x


def _keep_two_step_pieces(x: Column) -> Column:
    parts = F.split(x, "step")
    return F.when(F.size(parts) > 2, F.concat(parts[0], F.lit("step"), parts[1])).otherwise(x)


def clean_generation(text: Column, prompt: Column | None = None, y: Column | None = None) -> Column:
    """Drop the prompt echo and special tokens, lower-case, cut at the next
    question/claim/task, keep through the second ``step`` piece, cut a repeated
    final phrase, strip; null when shorter than 2 characters or without
    ``step`` (quirk Q18).  The partial answer ``y`` is prefixed."""
    x = F.lower(_unwrap(text, prompt))
    for m in CUT_MARKERS:
        x = before_first(x, m)
    ok1 = F.length(strip(x)) >= 2
    x = _keep_two_step_pieces(x)
    ph = F.split(x, FINAL_PHRASE)
    x = F.when(F.size(ph) > 2, F.concat(ph[0], F.lit(FINAL_PHRASE), ph[1])).otherwise(x)
    out = strip(x)
    res = F.when(ok1 & has(x, "step") & (F.length(out) >= 2), out)
    return res if y is None else F.concat(y, res)


def truncate_generation_lines(text: Column, prompt: Column | None = None) -> Column:
    """P25: keep lines until one has ``nput``, ``question:`` or ``claim: ``;
    a line with ``nswer`` is kept and ends the text."""
    lines = F.split(_unwrap(text, prompt), "\n")

    def stop_excl(ln):
        return has(ln, "nput") | has(F.lower(ln), "question:") | (~has(ln, "nswer") & has(F.lower(ln), "claim: "))

    def stop_incl(ln):
        return ~has(ln, "nput") & ~has(F.lower(ln), "question:") & has(ln, "nswer")

    k = F.array_position(F.transform(lines, lambda ln: stop_excl(ln) | stop_incl(ln)), True)
    incl = F.when(k > 0, stop_incl(F.element_at(lines, F.greatest(k, F.lit(1)).cast("int"))))
    n = F.when(k == 0, F.size(lines)).when(incl, k).otherwise(k - 1)
    return F.array_join(F.slice(lines, 1, n.cast("int")), "\n")


def clean_math_generation(text: Column, prompt: Column | None = None, y: Column | None = None,
                          search: bool = True) -> Column:
    """Newlines to spaces, lower-case, cut at ``q:``, keep through the
    second ``step`` piece.  Without ``search`` (a whole answer, no single step): lines and steps
    stay, and the text is cut at ``q:`` and at the first empty line."""
    x = _unwrap(text, prompt)
    if search:
        x = _keep_two_step_pieces(before_first(F.lower(F.replace(x, F.lit("\n"), F.lit(" "))), MATH_CUT))
    else:
        x = before_first(before_first(F.lower(x), MATH_CUT), "\n\n")
    return x if y is None else F.concat(y, x)


def split_proposals(df: DataFrame, text: str = "text", y: Column | None = None, keep=()) -> DataFrame:
    """The proposal lines between the second ``Input`` line (+2) and the
    third (or the end); each prefixed with the partial answer and ending in a
    newline.  Texts with fewer than two ``Input`` lines give nothing."""
    lines = F.split(F.col(text), "\n")
    idx = F.filter(F.transform(lines, lambda ln, i: F.when(has(ln, "Input"), i)), lambda i: i.isNotNull())
    start = F.element_at(idx, 2) + 3  # 1-based position of lines[i1 + 2]
    stop = F.when(F.size(idx) > 2, F.element_at(idx, 3) + 1).otherwise(F.size(lines) + 1)
    block = F.when(F.size(idx) >= 2, F.slice(lines, start.cast("int"), F.greatest(stop - start, F.lit(0)).cast("int")))
    out = df.select(*keep, F.posexplode(block).alias("line_no", "line"))
    pre = y if y is not None else F.lit("")
    return out.select(*keep, F.col("line_no").cast("bigint").alias("line_no"),
                      F.concat(pre, F.col("line"), F.lit("\n")).alias("proposal"))


def strip_prompt_prefix(text: Column, prompt: Column, by_length: bool = False) -> Column:
    """Remove the prompt from the front of the generation (if it is a
    prefix, or blindly by its length), then strip."""
    if by_length:
        return strip(F.substr(text, F.length(prompt) + 1))
    return strip(F.when(F.startswith(text, prompt), F.substr(text, F.length(prompt) + 1)).otherwise(text))


def first_line_generation(text: Column, prompt: Column | None = None, y: Column | None = None) -> Column:
    """Two lines if the first has ``Steps``, the first if it has
    ``Answer``, else the first plus a newline; null when shorter than 2."""
    lines = F.split(_unwrap(text, prompt), "\n")
    first = lines[0]
    second = F.element_at(lines, 2)
    s = (F.when(has(first, "Steps"), F.when(F.size(lines) > 1, F.concat(first, F.lit("\n"), second, F.lit("\n"))))
         .when(has(first, "Answer"), first).otherwise(F.concat(first, F.lit("\n"))))
    res = F.when(F.length(strip(s)) >= 2, s)
    return res if y is None else F.concat(y, res)
