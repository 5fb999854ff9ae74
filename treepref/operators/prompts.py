"""Prompt assembly as column expressions.

Templates are parameters with short default wordings of our own; only the
structural markers the pipelines parse later (step cues, final phrase, box
suffixes) are fixed values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WS_CLASS, after_first, before_first, has, strip

# --- fixed values (must equal the reference's behaviour) -------------------
INPUT_SLOT = "{input}"
FINAL_CUE = "so the final answer is: "
STEP3_CUE = " Step 3, so the final answer is: "
STEP2_CUE = " Step 2, "
MATH_STEP_CUE = " Step 4, The answer (arabic numerals) is "
CHOOSE_MARK = "choose the best answer"
CLAIM_SPLIT = "step 3, "
FIRST_CUE = "Answer: Step 1, "
OPTIONS_MARK = "Options:"
OPTION_CUE = "So the final answer is ("
REGION_SUFFIX = "\n\nFocus on region: "
REGIONS_SUFFIX = "\n\nFocus on regions: "
ANSWER_CUE = "Answer:"
PAIRED_PREFIX, PAIRED_SUFFIX = "Question: ", "\n\nAnswer: "

# Default wordings (parameters, not fixed values).
COT_TEMPLATE = ("Answer the question in numbered steps and finish with "
                "'so the final answer is: '.\nQuestion: {input}\n")
STEP_JUDGE = "Judge whether this partial reasoning moves toward the answer (sure/likely/impossible).\nQuestion: "
FINAL_JUDGE = "Judge whether this final answer is right (sure/likely/impossible).\nQuestion: "
MATH_JUDGE = "Judge whether this step of the calculation is right (sure/likely/impossible).\n"
OPTION_JUDGE = "Judge whether this option is the best answer (sure/likely/impossible).\nQuestion: "


def cot_prompt(question: Column, partial: Column | None = None, template: str | None = None) -> Column:
    """P20: the template with ``{input}`` replaced by the question, then the
    partial answer appended."""
    p = F.replace(F.lit(template or COT_TEMPLATE), F.lit(INPUT_SLOT), question)
    return p if partial is None else F.concat(p, partial)


def judge_prompt(question: Column, y: Column, claim: bool = False, step_t: str = STEP_JUDGE,
                 final_t: str = FINAL_JUDGE, option_t: str = OPTION_JUDGE) -> Column:
    """Step template while there is no final answer; option template when
    the question asks to choose the best answer; otherwise the final template.
    Claim tasks split the candidate at ``step 3, `` into thought and conclusion."""
    low = F.lower(y)
    no_final = ~has(low, "the final answer is")
    step_p = F.concat(F.lit(step_t), question, F.lit("\nThought Process: "), y, F.lit("\nEvaluation Process:\n"))
    if claim:
        final_p = F.concat(F.lit(final_t), question, F.lit("\nThought Process:"), before_first(y, CLAIM_SPLIT),
                           F.lit("\nConclusion: "), after_first(y, CLAIM_SPLIT), F.lit("\nEvaluation Process: \n"))
        return F.when(no_final, step_p).otherwise(final_p)
    option_p = F.concat(F.lit(option_t), question, F.lit("\nAnswer: "),
                        F.replace(after_first(low, "the final answer is"), F.lit(": "), F.lit("")),
                        F.lit("\nEvaluation Process:\n"))
    final_p = F.concat(F.lit(final_t), question, F.lit("\n"), y, F.lit("\nEvaluation Process: \n"))
    return (F.when(no_final, step_p).when(has(F.lower(question), CHOOSE_MARK), option_p).otherwise(final_p))


def math_judge_prompt(question: Column, y: Column, template: str = MATH_JUDGE) -> Column:
    """P21 for math: one form for all steps."""
    return F.concat(F.lit(template), F.lit("Question: "), question, F.lit("\nThought: "), y, F.lit("\nEvaluation Process: "))


def search_cue(prompt: Column, step: int, long_form: bool = False) -> Column:
    """P23, search side: what a search adds to the prompt before it generates step ``step`` (from 0).

    The step's number; before the last step also the final phrase, which opens a bracket where the
    prompt lists options.  ``long_form`` is for tasks of five steps, whose phrase comes with the fifth."""
    cue = F.lit(FIRST_CUE if step == 0 else f" Step {step + 1}, ")
    if long_form:
        return F.concat(cue, F.lit(FINAL_CUE)) if step == 4 else cue
    options = F.instr(prompt, OPTIONS_MARK) > 0
    if step == 3:
        return F.when(options, F.concat(cue, F.lit(OPTION_CUE))).otherwise(cue)
    if step == 2:
        return F.when(options, cue).otherwise(F.concat(cue, F.lit("So the final answer is: ")))
    return cue


def next_step_cue(y: Column, math: bool = False) -> Column:
    """Which continuation a partial answer needs; null when it is done."""
    low = F.lower(y)
    if math:
        return (F.when(~has(low, "step 2"), F.lit(STEP2_CUE))
                .when(~has(low, "step 3"), F.lit(" Step 3, "))
                .when(~has(low, "step 4"), F.lit(MATH_STEP_CUE))
                .when(~has(low, "answer (arabic numerals"), F.lit(MATH_STEP_CUE)))
    return (F.when(~has(low, "step 2"), F.lit(STEP2_CUE))
            .when(~has(low, "step 3, so the final answer is:"), F.lit(STEP3_CUE)))


def continued_prompt(prompt: Column, y: Column, math: bool = False) -> Column:
    """The prompt of the next call for a text generated so far: prompt, text and cue; without
    a cue when the text is done.  A math text that reached step 4 without its answer goes on
    from before that step."""
    cue = F.coalesce(next_step_cue(y, math), F.lit(""))
    if not math:
        return F.concat(prompt, y, cue)
    low = F.lower(y)
    unanswered = has(low, "step 2") & has(low, "step 3") & has(low, "step 4") & ~has(low, "answer (arabic numerals")
    return F.concat(prompt, F.when(unanswered, before_first(low, "step 4")).otherwise(y), cue)


def worked_prompt(demos: str) -> Callable[[Column, Column], Column]:
    """Prompt of a math pair: worked examples, the question and the earlier steps."""
    return lambda question, partial: F.concat(F.lit(demos), F.lit("Q: "), question, F.lit("\nA: "), partial)


def math_prompt(demos: Column, question: Column, y: Column, step: Column) -> Column:
    """Demonstrations + ``Q: .. \\nA: ..`` + the cue of the next step."""
    cue = F.when(step == 3, F.lit("Step 4, The answer (arabic numerals) is ")).otherwise(
        F.concat(F.lit("Step "), (step + 1).cast("string"), F.lit(", ")))
    return F.concat(demos, F.lit("Q: "), question, F.lit("\nA: "), y, cue)


def paired_answers(df: DataFrame, question: str = "question", chosen: str = "response_j",
                   rejected: str = "response_k") -> DataFrame:
    """``Question: q\\n\\nAnswer: `` with the two responses; other columns dropped."""
    return df.select(F.concat(F.lit(PAIRED_PREFIX), F.col(question), F.lit(PAIRED_SUFFIX)).alias("prompt"),
                     F.col(chosen).alias("chosen"), F.col(rejected).alias("rejected"))


def bbox_eval_prompt(prompt: Column, boxes: Column, suffix: str = REGIONS_SUFFIX) -> Column:
    """Append the region list when present."""
    return F.when(boxes.isNotNull() & (boxes != ""), F.concat(prompt, F.lit(suffix), boxes)).otherwise(prompt)


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, f"{WS_CLASS}+$", "")


def chat_format(df: DataFrame, prompt: str = "prompt", chosen: str = "chosen", rejected: str = "rejected",
                image: str = "image", bbox: str = "bbox", answer_role: str = "assistant",
                suffix: str = REGION_SUFFIX, keep=()) -> DataFrame:
    """Strip the prompt, make it end with ``Answer:`` (adding a blank
    line before it), append the region when a box is given, normalise path
    separators and wrap the texts as chat messages; the prompt message carries
    an image slot.  The reference gives chosen/rejected the role ``user``
    (quirk Q31): pass ``answer_role='user'`` for parity."""
    p = strip(F.coalesce(F.col(prompt), F.lit("")))
    p = F.when(F.endswith(p, F.lit(ANSWER_CUE)), p).otherwise(F.concat(rstrip(p), F.lit("\n\n" + ANSWER_CUE)))
    has_box = F.col(bbox).isNotNull() & (F.col(bbox) != "")
    p = F.when(has_box, F.concat(rstrip(p), F.lit(suffix), F.col(bbox))).otherwise(p)

    def msg(text: Column, role: str, with_image: bool) -> Column:
        parts = [F.struct(F.lit(None).cast("string").alias("text"), F.lit("image").alias("type"))] if with_image else []
        parts.append(F.struct(text.alias("text"), F.lit("text").alias("type")))
        return F.array(F.struct(F.array(*parts).alias("content"), F.lit(role).alias("role")))

    has_img = F.col(image).isNotNull() & (F.col(image) != "")
    img = F.replace(F.col(image), F.lit("\\"), F.lit("/"))
    return df.select(*keep, msg(p, "user", True).alias("prompt"),
                     msg(F.coalesce(F.col(chosen), F.lit("")), answer_role, False).alias("chosen"),
                     msg(F.coalesce(F.col(rejected), F.lit("")), answer_role, False).alias("rejected"),
                     F.when(has_img, F.array(img)).otherwise(F.array().cast("array<string>")).alias("images"))
