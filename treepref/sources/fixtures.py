"""Input shapes of the reference built from the driver's tables (FIXTURES part B).

Every builder reads the given parquet tables and derives its rows with integer
arithmetic on keys, so the work grows with the tables.  Small constant fan-outs
(variations 1..3, metrics, judge samples) are ``explode`` generators on each
row, not cross joins.  Matching DuckDB text lives in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ratings import BOX_COLUMN
from ..session import dealt, table

METRICS = ("helpful", "honest", "harmless")
RATING_TYPES = ("completion", "rm_output")


def _s(c):
    return F.col(c).cast("string")


def rlhf_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: main and variation answers per (conversation, question, variation)."""
    conv = table(spark, sf_dir, "conversations").where(F.col("role").isin("user", "assistant"))
    w = Window.partitionBy("conv_id", "role").orderBy("turn")
    # row_number <= 4 lets Spark insert a partial WindowGroupLimit before the
    # shuffle, so a huge conversation ships at most 4 rows per role per task.
    t = conv.select("conv_id", "role", "text", F.row_number().over(w).alias("q")).where("q <= 4")
    qa = t.groupBy("conv_id", "q").agg(
        F.max(F.when(F.col("role") == "user", F.col("text"))).alias("question"),
        F.max(F.when(F.col("role") == "assistant", F.col("text"))).alias("answer"))
    bench = table(spark, sf_dir, "benchmark")
    n_items = bench.select(F.count("*")).scalar()
    qv = qa.select("*", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("v"))
    qv = qv.withColumn("bkey", (F.col("conv_id") * 3 + F.col("q") * 5 + F.col("v")) % n_items)
    b = bench.select(F.col("item_id").alias("bkey"), F.col("text").alias("btext"))
    j = qv.join(b, "bkey")
    return j.select(
        "conv_id", F.col("q").cast("bigint").alias("q"), F.col("v").cast("bigint").alias("v"),
        "question", "answer",
        F.when((F.col("conv_id") + F.col("q") + F.col("v")) % 9 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("btext")).alias("var_answer"))


def rlhf_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: one rating cell per (conversation, q, v, metric, rating type)."""
    c = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    args = [F.lit(x) for q in range(1, 5) for v in range(1, 4)
            for m, metric in enumerate(METRICS, 1) for r, rt in enumerate(RATING_TYPES, 1)
            for x in (q, v, m, metric, r, rt)]
    k = c.select("conv_id", F.stack(F.lit(72), *args).alias("q", "v", "m", "metric", "r", "rating_type"))
    h = (F.col("conv_id") * 31 + F.col("q") * 17 + F.col("v") * 13 + F.col("m") * 7 + F.col("r") * 3)
    k = k.withColumn("h", h)
    cell = (F.when(F.col("h") % 11 == 0, F.lit(None).cast("string"))
            .when(F.col("h") % 13 == 0, F.lit("<chosen:A>N/A</chosen:A><reject:B>x</reject:B>"))
            .when(F.col("h") % 3 == 0,
                  F.concat(F.lit("<chosen:A> good "), _s("h"), F.lit(" </chosen:A><reject:B> bad "),
                           (F.col("q") + F.col("v")).cast("string"), F.lit("</reject:B>")))
            .when(F.col("h") % 7 == 0, F.lit("N/A"))
            .otherwise(F.concat(F.lit("0."), (F.col("h") % 10).cast("string"))))
    return k.select("conv_id", F.col("q").cast("bigint").alias("q"), F.col("v").cast("bigint").alias("v"),
                    "metric", "rating_type", cell.alias("cell"))


def trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search-tree candidates with scores, 4 + 12 + 24 per question.

    Every document is a question; entities and facts are words of its text, with
    whatever quotes, marks and line ends they have, and one in seven final candidates
    lacks the final phrase."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("d"), F.coalesce("text", F.lit("")).alias("text"))
    # A few words from the middle and the end of the whole text.  What is left of a question is small, becomes
    # 40 rows, and is dealt by question, which the windows, joins and aggregates after it ask for anyhow.
    d = d.select("d", F.split("text", " ").alias("parts"))
    d = dealt(d.select("d", F.transform(F.sequence(F.lit(0), F.lit(8)), lambda k: F.get(
        "parts", F.floor((F.size("parts") - 1) * k / 8).cast("int"))).alias("w")), "d")
    l0 = d.select("d", "w", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("j0"))
    l0 = l0.withColumn("y", F.concat(F.lit("step 1, find entity "), F.get("w", ((F.col("d") * 7 + F.col("j0")) % 5).cast("int")), F.lit(".")))
    l1 = l0.select("d", "w", "j0", "y", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("j1"))
    l1 = l1.withColumn("y", F.concat(F.col("y"), F.lit(" step 2, use fact "),
                                     F.get("w", (5 + (F.col("d") + F.col("j0") * 3 + F.col("j1")) % 4).cast("int")),
                                     F.lit(".")))
    l2 = l1.select("d", "w", "j0", "j1", "y", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("j2"))
    pick = F.get("w", ((F.col("d") + F.col("j0") * 2 + F.col("j1") + F.col("j2")) % 3).cast("int"))
    ends = (F.col("d") + F.col("j0") + F.col("j1") * 2 + F.col("j2")) % 7 == 3
    l2 = l2.withColumn("y", F.concat(
        F.col("y"), F.when(ends, F.lit(" step 3, no answer, item ")).otherwise(F.lit(" step 3, so the final answer is: item ")),
        pick, F.lit(".")))
    s0 = l0.select(F.col("d").alias("question_id"), F.lit(0).alias("step"),
                   (F.col("j0") * 100).alias("path_id"), F.col("y").alias("candidate"),
                   ((F.col("d") * 3 + F.col("j0") * 5) % 6).alias("score"))
    s1 = l1.select("d", F.lit(1), F.col("j0") * 100 + F.col("j1") * 10, "y",
                   (F.col("d") * 5 + F.col("j0") * 7 + F.col("j1") * 3) % 6)
    s2 = l2.select("d", F.lit(2), F.col("j0") * 100 + F.col("j1") * 10 + F.col("j2"), "y",
                   (F.col("d") * 7 + F.col("j0") + F.col("j1") * 5 + F.col("j2") * 2) % 6)
    return s0.union(s1).union(s2)


def trace_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 with ``parent_id``, from the numbering of the paths above."""
    step, path = F.col("step"), F.col("path_id")
    parent = F.when(step == 1, F.floor(path / 100) * 100).when(step == 2, F.floor(path / 10) * 10)
    return trace(spark, sf_dir).withColumn("parent_id", parent.cast("int"))


VERDICT_TEXTS = (
    "The thought helps.\nLikely",
    "Impossible",
    "So this is unlikely to help.",
    "I am sure of it",
    "no verdict at all",
    "likely, or impossible",
)


def verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five raw judge outputs per question, each with the document's whole text before its verdict."""
    c = table(spark, sf_dir, "documents").select("doc_id", "text")
    e = c.select("doc_id", "text", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("eval_id"))
    k = (F.col("doc_id") * 3 + F.col("eval_id")) % 6
    out = F.element_at(F.array(*[F.lit(t) for t in VERDICT_TEXTS]), (k + 1).cast("int"))
    out = F.concat(F.coalesce("text", F.lit("")), F.lit("\n"), out)
    return e.select(F.col("doc_id").alias("question_id"), "eval_id", out.alias("output"))


def math_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-step candidates of a sum about every part, 2 + 4 + 8 + 16 per question; one final step in five
    names no number."""
    size = F.col("p_size").cast("int")
    # A part is a few bytes and becomes 30 candidates.
    rows = dealt(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("d"), size.alias("v")), "d")
    rows = rows.select("*", F.lit(0).alias("path"), F.lit("").alias("y"))
    out = None
    for step in range(4):
        rows = rows.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("j"))
        v, k = F.col("v").cast("string"), F.col("j") + 1
        if step < 3:
            op, nxt = ((" + ", F.col("v") + k), (" * ", F.col("v") * k), (" - ", F.col("v") - k))[step]
            text = F.concat(F.lit(f"step {step + 1}, take "), v, F.lit(op), k.cast("string"), F.lit(" = "), nxt.cast("string"), F.lit("."))
        else:
            nxt = F.col("v")
            none = (F.col("d") + F.col("path") + F.col("j")) % 5 == 0
            text = F.concat(F.lit("step 4, the answer (arabic numerals) is "), F.when(none, F.lit("unknown")).otherwise(
                F.concat(F.when(F.col("j") == 1, F.lit("1,")).otherwise(F.lit("")), v)), F.lit("."))
        y = F.when(F.col("y") == "", text).otherwise(F.concat(F.col("y"), F.lit(" "), text))
        rows = rows.select("d", nxt.alias("v"), (F.col("path") * 2 + F.col("j")).alias("path"), y.alias("y"))
        level = rows.select(F.col("d").alias("question_id"), F.lit(step).alias("step"), F.col("path").alias("path_id"),
                            F.col("y").alias("candidate"), ((F.col("d") * 3 + F.col("path") * 5 + step) % 6).alias("score"))
        out = level if out is None else out.unionByName(level)
    return out


def path_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4 for each candidate of B3: one to five judge outputs of the question."""
    t = trace(spark, sf_dir).select("question_id", "step", "path_id")
    e = t.select("*", F.explode(F.sequence(F.lit(0), ((F.col("path_id") + F.col("step") + F.col("question_id")) % 5).cast("int")))
                 .alias("eval_id"))
    out = F.get(F.array(*[F.lit(x) for x in VERDICT_TEXTS]), ((F.col("question_id") * 3 + F.col("eval_id")) % 6).cast("int"))
    return e.withColumn("output", out)


def math_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Math questions, answers with calculator spans, and predictions."""
    li = table(spark, sf_dir, "lineitem")
    qi = F.col("l_quantity").cast("int")
    q2 = (qi * 2).cast("string")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("  Order "), _s("l_orderkey"), F.lit(" line "), _s("l_linenumber"), F.lit("? ")).alias("question"),
        F.concat(F.lit("Take <<"), qi.cast("string"), F.lit("*2="), q2, F.lit(">> it. #### "), q2).alias("answer"),
        F.concat(F.lit("Step 3, The answer (arabic numerals) is "),
                 F.when(F.col("l_orderkey") % 4 == 0, F.lit("unknown."))
                 .when(F.col("l_orderkey") % 4 == 1, F.concat(F.lit("1,"), qi.cast("string"), F.lit(".")))
                 .otherwise(F.concat(q2, F.lit(" units.")))).alias("prediction"))


def qa_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-text answers that quote the whole item, against a ground truth."""
    b = table(spark, sf_dir, "benchmark")
    thought = F.concat(F.lit("step 1, "), F.col("text"), F.lit("\n"))

    def part(i):
        return F.split_part(F.col("text"), F.lit(" "), F.lit(i))

    return b.select(
        "item_id", F.concat(F.lit("Q"), _s("item_id"), F.lit(": "), F.col("text")).alias("question"),
        F.concat(part(2), F.lit(" "), part(3)).alias("ground_truth"),
        F.concat(thought, F.when(F.col("item_id") % 5 == 0, F.lit("step 2, no conclusion."))
                 .when(F.col("item_id") % 5 == 1, F.concat(F.lit("step 3, so the final answer is: "), part(4), F.lit(".")))
                 .otherwise(F.concat(F.lit('Step 3, So the final answer is: "'), F.lower(part(2)), F.lit("-"),
                                     part(3), F.lit('".')))).alias("prediction"))


def generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's whole text as a generation, in seven forms by its id: bare, with the prompt
    echoed and steps, with a next question, as input lines, with final phrases, as steps and answer lines,
    and as four steps around an empty line."""
    t, nl = F.coalesce("text", F.lit("")), F.lit("\n")
    prompt = F.concat(F.lit("Question: document "), _s("doc_id"), nl)
    mark = F.get(F.array(*[F.lit(x) for x in ("Question: ", "Claim: ", "Task: ")]), (F.col("doc_id") % 3).cast("int"))

    def each(old, new):
        return F.replace(t, F.lit(old), F.lit(new))

    forms = [
        t,
        F.concat(prompt, F.lit("<s>Step 1, "), each(". ", ". Step 2, "), F.lit("</s>")),
        F.concat(prompt, F.lit("Step 1, "), t, nl, mark, t),
        F.concat(F.lit("Input: "), F.replace(each("\n", "\nInput: "), F.lit(". "), F.lit(".\n"))),
        F.concat(prompt, F.lit("Step 1, "), each(", ", ", so the final answer is: "), F.lit(" Q: "), t),
        F.concat(F.lit("Steps: "), t, nl, F.lit("Answer: "), t),
        F.concat(F.lit("Step 1, "), t, F.lit(" Step 2, so. Step 3, "), t, F.lit(" Step 4, it.\n\n"), t)]
    text = forms[0]
    for k, form in enumerate(forms[1:], 1):
        text = F.when(F.col("doc_id") % len(forms) == k, form).otherwise(text)
    return table(spark, sf_dir, "documents").select("doc_id", prompt.alias("prompt"), text.alias("text"))


def pref_eval(spark: SparkSession, sf_dir: str, line: int | None = None) -> DataFrame:
    """Generated / chosen / rejected texts (equi-joins on shifted keys), or the given line of each,
    taken before the joins so that whole texts are not shuffled for it."""
    docs = table(spark, sf_dir, "documents")
    if line:
        docs = docs.withColumn("text", F.split_part("text", F.lit("\n"), F.lit(line)))
    # Hash-partition the driving side on the join key: the joins need exactly
    # this distribution when they shuffle (large inputs), and when AQE
    # broadcasts the other sides the per-row text work still spreads over tasks.
    a = docs.select(F.col("doc_id").alias("sample_id"), F.col("lang").alias("prompt"),
                    F.col("text").alias("generated")).repartition("sample_id")
    b = docs.select((F.col("doc_id") - 1).alias("sample_id"), F.col("text").alias("chosen"))
    c = docs.select((F.col("doc_id") - 2).alias("sample_id"), F.col("text").alias("rejected"))
    return a.join(b, "sample_id").join(c, "sample_id")


def pref_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B7 vector form: generated / chosen / rejected embeddings."""
    e = table(spark, sf_dir, "embeddings")
    a = e.select(F.col("vec_id").alias("sample_id"), F.col("embedding").alias("generated")).repartition("sample_id")
    b = e.select((F.col("vec_id") - 1).alias("sample_id"), F.col("embedding").alias("chosen"))
    c = e.select((F.col("vec_id") - 2).alias("sample_id"), F.col("embedding").alias("rejected"))
    return a.join(b, "sample_id").join(c, "sample_id")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation log lines with line numbers."""
    ev = table(spark, sf_dir, "events")
    gr = ev.select((F.col("event_id") * 2).alias("line_no"),
                   F.when(F.col("event_type") == "error", F.lit("noise"))
                   .otherwise(F.concat(F.lit("====GR===="), F.col("event_type"), F.lit("====Pre====x"))).alias("line"))
    acc = ev.select((F.col("event_id") * 2 + 1).alias("line_no"),
                    F.concat(F.lit("user "), _s("user_id"), F.lit(" sum(accs) "),
                             (F.col("event_id") % 2).cast("string"), F.lit(" cnt_avg 0 cnt_any 0")).alias("line"))
    return gr.union(acc)


CLAIM_LABELS = ("SUPPORTS", "REFUTES", "NOT ENOUGH INFO")
CLAIM_ANSWERS = ("suports", "it is rejected", "refutes", "not enough info", "no enough info", "correct", "maybe")


def fact_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-way claim labels and free-text predictions; claims and predictions hold the document's whole text."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lab = F.element_at(F.array(*[F.lit(x) for x in CLAIM_LABELS]), (F.col("doc_id") % 3 + 1).cast("int"))
    ans = F.element_at(F.array(*[F.lit(x) for x in CLAIM_ANSWERS]), (F.col("doc_id") % 7 + 1).cast("int"))
    return d.select("doc_id", F.concat(F.lit("Claim "), _s("doc_id"), F.lit(": "), F.col("text")).alias("claim"), lab.alias("label"),
                    F.concat(F.lit("step 1, "), F.col("text"), F.lit("\nso the final answer is: "), ans, F.lit(".")).alias("prediction"))


# ---------------------------------------------------------------------------
# A1: the wide rated table (one row per conversation) built from B1 + B2.

def wide_columns() -> list[str]:
    cols = [f"Q{q}" for q in range(1, 5)] + [f"A{q}" for q in range(1, 5)]
    cols += [f"{p}{q}.{v}" for q in range(1, 5) for v in range(1, 4) for p in ("Q", "A")]
    cols += [f"QA{q}.{v}_{rt}_{m}" for q in range(1, 5) for v in range(1, 4)
             for rt in RATING_TYPES for m in METRICS]
    return cols


def wide_table(spark: SparkSession, sf_dir: str, image_bytes: bool = False) -> DataFrame:
    """A1 wide rated table: ``row_id, Q1..A4, Qq.v, Aq.v, QAq.v_type_metric, image`` and the box column.

    The long fixtures become (name, value) entries, collected into one map per
    row (one shuffle on the row id) and read out column by column.
    Images come from ``pages`` (page_id = 3 * row_id) and the box string from
    ``embeddings`` (vec_id = 7 * row_id); rows without a match get null.  The
    image holds its bytes only on request: the pair builders need its path.
    """
    qa = rlhf_qa(spark, sf_dir)
    rt = rlhf_rating(spark, sf_dir)
    q, v = F.col("q").cast("string"), F.col("v").cast("string")

    def kv(k, val):
        return F.struct(k.alias("k"), val.alias("val"))

    first_v = F.col("v") == 1  # main question/answer once per (row, q): keys stay unique
    e1 = qa.select("conv_id", F.explode(F.array(
        F.when(first_v, kv(F.concat(F.lit("Q"), q), F.col("question"))),
        F.when(first_v, kv(F.concat(F.lit("A"), q), F.col("answer"))),
        kv(F.concat(F.lit("Q"), q, F.lit("."), v), F.col("question")),
        kv(F.concat(F.lit("A"), q, F.lit("."), v), F.col("var_answer")))).alias("e"))
    e2 = rt.select("conv_id", kv(F.concat(F.lit("QA"), q, F.lit("."), v, F.lit("_"), F.col("rating_type"),
                                          F.lit("_"), F.col("metric")), F.col("cell")).alias("e"))
    entries = e1.unionByName(e2).where(F.col("e").isNotNull() & F.col("e.val").isNotNull())
    # One aggregate per row id; a row holds at most 104 entries with distinct
    # names by construction, so the collected list is bounded.
    m = entries.groupBy(F.col("conv_id").alias("row_id")).agg(
        F.map_from_entries(F.collect_list("e")).alias("m"))
    wide = m.select("row_id", *[F.col("m")[c].alias(c) for c in wide_columns()])
    payload = [F.col("html").cast("binary").alias("bytes")] if image_bytes else []
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("img_key"), F.struct(*payload, F.col("url").alias("path")).alias("image"))
    emb = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("box_key"),
        F.concat(F.lit("[0."), (F.col("vec_id") % 10).cast("string"), F.lit(", 0."),
                 (F.col("label") % 10).cast("string"), F.lit(", 0.5, 0.5]")).alias(BOX_COLUMN))
    out = wide.join(pages, wide["row_id"] * 3 == pages["img_key"], "left")
    out = out.join(emb, out["row_id"] * 7 == emb["box_key"], "left")
    return out.drop("img_key", "box_key")
