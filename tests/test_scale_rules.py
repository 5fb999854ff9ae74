"""Rules of the core at scale: cuts without sorts, even ranges, open steps, reports in the writing pass."""

import csv
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from treepref.functions.score import verdict_value
from treepref.operators import evaluate, ordering, prepare, prompts, steps, trace
from treepref.session import dealt, materialize, scratch_path
from treepref.sources import fixtures, readers, sinks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- W8, W9


def test_cut_needs_no_sort_and_no_window(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    for out in (prepare.split_exact(df, "k"), prepare.sample_fraction(df, "k", 0.3)):
        assert not re.search("Sort|Window|Exchange", plan(out))


@pytest.mark.parametrize("ratio", [0.0, 0.1, 0.37, 1.0])
def test_split_equals_a_sort_of_the_keys(spark, ratio):
    df = spark.range(3000).withColumnRenamed("id", "k")
    order = [r[0] for r in df.orderBy(ordering.seeded_key(7, "k")).collect()]
    train = {r["k"] for r in prepare.split_exact(df, "k", 7, ratio).where("split = 'train'").collect()}
    assert train == set(order[:int(3000 * (1 - ratio))])


def test_cut_among_repeated_ids_and_rows(spark):
    rows = [(1, "a")] * 40 + [(1, "b")] * 30 + [(2, "c")] * 30
    df = spark.createDataFrame(rows, "k long, v string")
    for ratio in (0.15, 0.5, 0.85):
        out = prepare.split_exact(df, "k", 3, ratio).collect()
        assert len(out) == 100 and sum(r["split"] == "train" for r in out) == int(100 * (1 - ratio))
        assert sorted((r["k"], r["v"]) for r in out) == sorted(rows)
    assert prepare.sample_fraction(df, "k", 0.33).count() == 33


def test_cut_of_an_empty_table(spark):
    df = spark.range(0).withColumnRenamed("id", "k")
    assert prepare.split_exact(df, "k").count() == 0 and prepare.sample_fraction(df, "k", 0.5).count() == 0


def test_cut_of_ten_million_ids(spark):
    df = spark.range(0, 10_000_000, 1, 8).withColumnRenamed("id", "k")
    cut = ordering.radix_cut(df, [ordering.seeded_key(42, "k")], lambda n: n // 10)
    assert (cut.n, cut.taken, cut.ties) == (10_000_000, 1_000_000, 0)
    assert df.where(cut.below()).count() == 1_000_000


def test_hash_threshold_keeps_rows_where_they_are(spark):
    few, many = (prepare.split_exact(spark.range(n).withColumnRenamed("id", "k"), "k", exact=False) for n in (2000, 9000))
    small = {r["k"]: r["split"] for r in few.collect()}
    large = {r["k"]: r["split"] for r in many.collect()}
    assert small.items() <= large.items()
    assert abs(sum(x == "train" for x in large.values()) / 9000 - 0.9) < 0.02


# --- W3, W4, W7


def test_clustered_ids_leave_ranges_even(spark):
    # Nearly all ids lie within a millionth of the range from least to most.
    ids = [(k, 1) for k in range(20_000)] + [(10**12 + k, 1) for k in range(3)]
    df = spark.createDataFrame(ids, "seq long, c long").repartition(6)
    b = df.groupBy(ordering.range_bucket(df, "seq", 64).alias("b")).count().collect()
    sizes = sorted(r["count"] for r in b)
    assert len(b) > 50 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    out = ordering.range_positions(df, ["seq"], ["c"]).collect()
    assert [(r.pos, r.c_cum) for r in sorted(out, key=lambda r: r.seq)] == [(k, k + 1) for k in range(len(ids))]


def test_ranks_over_continuous_and_shared_values(spark):
    rows = [(1, 0, k, (k * 7919 % 1000) / 997.0 if k % 3 else 0.5) for k in range(1500)]
    df = spark.createDataFrame(rows, "question_id long, step int, path_id int, score double")
    got = {r.path_id: r["rank"] for r in trace.rank_candidates(df).collect()}
    order = sorted(rows, key=lambda r: (-r[3], r[2]))
    assert got == {r[2]: k + 1 for k, r in enumerate(order)}
    code, alone = ordering.value_bucket(df, "score", 32)
    parts = df.select(code.alias("b"), alone.alias("a"), "score").groupBy("b", "a").agg(
        F.count("*").alias("n"), F.countDistinct("score").alias("d")).collect()
    assert all(r.d == 1 for r in parts if r.a) and max(r.n for r in parts if not r.a) < 150


# --- S7, P9


@pytest.mark.parametrize("legacy", [True, False])
def test_any_step_survives_a_round_trip(spark, legacy):
    lv = spark.createDataFrame([('Q "1"', s, p, f"y{s}{p} \n é\"", float(p)) for s in (0, 3, 4, 7, 11) for p in (2, 1)],
                               "question string, step int, path_id int, candidate string, value double")
    sel = spark.createDataFrame([('Q "1"', "best, \"so\"")], "question string, item string")
    path = sinks.sink_trace_json(sinks.trace_records(lv, sel), scratch_path(spark, "t"), legacy=legacy)
    back = readers.explode_trace(readers.scan_trace_json(spark, path, legacy=legacy)).collect()
    assert {r.question for r in back} == {'Q "1"'}
    assert sorted((r.step, r.idx, r.candidate, r.value) for r in back if r.step is not None) == sorted(
        (s, p - 1, f"y{s}{p} \n é\"", float(p)) for s in (0, 3, 4, 7, 11) for p in (1, 2))
    assert [(r.idx, r.candidate) for r in back if r.step is None] == [(0, "best, \"so\"")]


def test_a_broken_record_is_returned_with_its_text(spark):
    path = scratch_path(spark, "t")
    good = json.dumps({"q": {"0": {"candiate": ["a"], "values": [1]}, "7": {"candiate": ["b"], "values": [0.5]}, "correct": [], "x": 1}})
    spark.createDataFrame([(good,), ('{"q2": {"0": {"candi',)], "value string").coalesce(1).write.text(path)
    got = readers.scan_trace_json(spark, path, legacy=False).collect()
    assert sorted(r.corrupt or "" for r in got) == ["", '{"q2": {"0": {"candi']
    rows = readers.explode_trace(readers.scan_trace_json(spark, path, legacy=False)).collect()
    assert sorted((r.step, r.candidate, r.value) for r in rows) == [(0, "a", 1.0), (7, "b", 0.5)]


# --- A2, A3


def test_every_judge_output_counts_for_its_own_candidate(spark):
    t = spark.createDataFrame([(1, 0, 0, "a"), (1, 0, 9, "b")], "question_id long, step int, path_id int, candidate string")
    v = spark.createDataFrame([(1, 0, 0, 40, "sure"), (1, 0, 0, 41, "likely"), (1, 0, 9, 0, "impossible"), (2, 0, 0, 0, "sure")],
                              "question_id long, step int, path_id int, eval_id int, output string")
    got = {r.path_id: r.value for r in trace.candidate_value(trace.candidate_verdicts(t, v)).collect()}
    assert got == {0: 2.0, 9: 0.001}
    assert spark.range(1).select(verdict_value(F.lit("sure"))).first()[0] == 1.0


# --- S12, A7, A8


def test_report_equals_results_that_are_scored_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def score(x):
        seen.add(1)
        return x % 3
    df = spark.range(0, 600, 1, 3).select("id", (F.udf(score, "int")("id") == 0).cast("int").alias("correct"))
    path = sinks.sink_eval_report(df, evaluate.preference_metrics(), scratch_path(spark, "r"))
    report = spark.read.json(f"{path}/report").first()
    assert seen.value == 600
    assert (report["n"], report["n_correct"], report["accuracy"]) == (600, 200, 200 / 600)
    back = spark.read.parquet(report["results_path"])
    assert evaluate.preference_accuracy(back).first()["n_correct"] == 200


def test_report_of_nothing_and_of_errors(spark):
    none = spark.createDataFrame([], "correct int, error string")
    report = spark.read.json(sinks.sink_eval_report(none, evaluate.preference_metrics(), scratch_path(spark, "r")) + "/report").first()
    assert (report["n"], report["n_correct"], report["accuracy"]) == (0, 0, 0.0)
    df = spark.createDataFrame([(1, None), (0, None), (0, "image_missing"), (0, "timeout")], "correct int, error string")
    path = sinks.sink_eval_report(df, evaluate.error_metrics(), scratch_path(spark, "r"), total="n_total")
    report = spark.read.json(f"{path}/report").first().asDict()
    want = evaluate.error_accounting(df).first().asDict()
    assert {k: report[k] for k in want} == want and want["n_total"] == 3 and want["n_errors"] == 1


# --- P10, P13, P18, P23: step specification


def test_five_steps_split_by_their_specification(spark):
    spec = steps.StepSpec(5, "step 5, so it is: ")
    path = " ".join(f"step {k}, do {k}." for k in range(1, 5)) + " step 5, so it is: done."
    lv = spark.createDataFrame([(1, k, path if k == 4 else f"step 1, do {k}.") for k in range(5)], "question_id long, step int, candidate string")
    sel = spark.createDataFrame([(1, path, 1.0)], "question_id long, item string, value double")
    pos = steps.split_reasoning_steps(steps.positive_expansion(lv, sel, spec=spec), spec).collect()
    assert [r.pos for r in sorted(pos, key=lambda r: r.step)] == [f"step {k}, do {k}." for k in range(1, 5)] + ["step 5, so it is: done."]
    assert max(pos, key=lambda r: r.step).prefix == "step 1, do 1. step 2, do 2. step 3, do 3. step 4, do 4."
    assert steps.split_reasoning_steps(steps.positive_expansion(lv, sel), steps.QA_STEPS).count() == 0


def test_claim_and_math_rules_in_pairs(spark):
    negs = spark.createDataFrame([(1, 2, "step 3, so the final answer is: it supports that.", "", "step 3, no idea."),
                                  (1, 2, "step 3, so the final answer is: maybe.", "", "step 3, no idea.")],
                                 "question_id long, step long, pos string, prefix string, neg string")
    qs = spark.createDataFrame([(1, "Q?")], "question_id long, question string")
    assert [r.chosen for r in steps.explode_pairs(negs, qs, claim=True).collect()] == ["step 3, so the final answer is: supports."]
    sums = spark.createDataFrame([(1, 3, p, "", "step 4, no number.") for p in (
        "step 4, the answer (arabic numerals) is 1,200.", "step 4, the answer (arabic numerals) is many.", "step 4, it is 7.", "step 2, fine.")],
        "question_id long, step long, pos string, prefix string, neg string")
    got = {r.chosen for r in steps.explode_pairs(sums, qs, spec=steps.MATH_STEPS, prompt=prompts.worked_prompt("D\n")).collect()}
    assert got == {"step 4, the answer (arabic numerals) is 1,200.", "step 2, fine."}


def test_search_cues(spark):
    df = spark.createDataFrame([("Q: a Options: (a) x",), ("Q: b",)], "p string")
    cues = [[r[0] for r in df.select(prompts.search_cue(F.col("p"), k)).collect()] for k in range(4)]
    assert cues == [["Answer: Step 1, "] * 2, [" Step 2, "] * 2, [" Step 3, ", " Step 3, So the final answer is: "],
                    [" Step 4, So the final answer is (", " Step 4, "]]
    assert df.select(prompts.search_cue(F.col("p"), 4, long_form=True)).first()[0] == " Step 5, so the final answer is: "


def test_materialized_table_is_read_back_whole(spark):
    assert materialize(spark.range(10)).count() == 10


# --- tables whose rows become many


def test_rows_are_dealt_by_their_number(spark):
    out = dealt(spark.range(1000), "id", 100)
    assert out.groupBy(F.spark_partition_id()).count().count() == 10 and out.distinct().count() == 1000


def test_traces_are_not_folded_into_one_task(spark, tmp_path):
    d = str(tmp_path)
    spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b c "), "id").alias("text")).coalesce(1).write.parquet(f"{d}/documents.parquet")
    spark.range(400).select(F.col("id").alias("p_partkey"), F.lit(7).alias("p_size")).coalesce(1).write.parquet(f"{d}/part.parquet")
    for t, each in ((fixtures.trace(spark, d), 40), (fixtures.math_trace(spark, d), 30)):
        tasks = [r[1] for r in t.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(tasks) == 400 * each and max(tasks) < 200 * each


# --- J4


def _held_prefixes(positives, levels):
    """Negatives by comparing every positive with every candidate of its level."""
    norm = F.when(F.col("step") == 0, steps.normalize_b(F.col("candidate"))).otherwise(steps.normalize_c(F.col("candidate")))
    lv = levels.select("question_id", F.col("step").cast("bigint").alias("step"), norm.alias("norm"))
    j = steps._with_remainder(steps._matchable(positives.join(lv, ["question_id", "step"])))
    neg = F.when(F.col("step") == 0, F.col("norm")).when(F.instr("whole", F.col("prefix")) > 0, F.col("neg"))
    j = j.withColumn("neg", neg).where("neg <> pos")
    return {tuple(r) for r in j.select("question_id", "step", "pos", "prefix", "neg").distinct().collect()}


def test_negatives_by_prefix_equal_the_pairwise_test(spark):
    draw = random.Random(5)
    part = lambda: "step" + draw.choice([" 1, a", " 1, ab", " 2, a b", "", " ste", "s", ", x. "])
    text = lambda n: draw.choice(["", "so ", "st"]) + "".join(part() for _ in range(n))
    pos = [(draw.randrange(4), k, part().strip(), "".join(part() for _ in range(k)).strip()) for k in (0, 1, 2) for _ in range(40)]
    pos.append((1, 1, "step 2", None))
    cand = [(draw.randrange(5), k, text(draw.choice([k, k + 1, k + 2]))) for k in (0, 1, 2) for _ in range(60)] + [(1, 1, None), (1, 2, "")]
    p = spark.createDataFrame(pos, "question_id long, step long, pos string, prefix string").distinct()
    c = spark.createDataFrame(cand, "question_id long, step int, candidate string")
    got = [tuple(r) for r in steps.negatives_by_prefix(p, c).collect()]
    assert len(got) == len(set(got)) and set(got) == _held_prefixes(p, c)
    assert sum(r[1] > 0 for r in got) > 50
    assert steps.negatives_by_prefix(p.where("false"), c).count() == steps.negatives_by_prefix(p, c.where("false")).count() == 0


def test_chains_run_once_a_row(spark, tmp_path):
    # A filter on a rewritten text, or a null test of a join key, must not repeat the rewriting below a shuffle.
    rows = [(1, k, f"step 1, x. step {k + 1}, y {j}.") for k in (0, 1) for j in range(3)]
    spark.createDataFrame(rows, "question_id long, step int, candidate string").write.parquet(f"{tmp_path}/c")
    spark.createDataFrame([(1, 0, "p.", ""), (1, 1, "p.", "step 1, x."), (1, 1, "p.", "step 1, x.")],
                          "question_id long, step long, pos string, prefix string").write.parquet(f"{tmp_path}/p")
    p, c = spark.read.parquet(f"{tmp_path}/p"), spark.read.parquet(f"{tmp_path}/c")
    qs = spark.createDataFrame([(1, "why?")], "question_id long, question string")
    runs = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("therefore, the final answer is,")
    negs = steps.negatives_by_prefix(p, c)
    assert negs.count() == negs.distinct().count() == 6 and runs(negs) == 2  # level 0, later levels
    assert runs(steps.drop_positive_negatives(negs, p).where("length(neg) > 3")) == runs(negs) + 1
    pairs = steps.explode_pairs(steps.drop_positive_negatives(negs, p), qs)
    assert pairs.count() == 6 and runs(pairs) == runs(negs) + 1


def test_vote_rewrites_an_item_once(spark):
    c = spark.range(6).selectExpr("id % 2 question_id", "'So the final answer is: The ' || (id % 3) || '.' candidate", "1 value")
    v = trace.answer_vote_value(c)
    assert "lower(" not in plan(v) and {(r.question_id, r.answer) for r in v.collect()} == {(0, "0"), (1, "0")}


# --- S3


@pytest.mark.parametrize("split", [37, 400, 1 << 27])
def test_csv_records_over_splits(spark, tmp_path, split):
    draw = random.Random(split)
    cell = lambda: "".join(draw.choice(["a", '"', "\n", ",", "é", "b c", "\r\n", "xyz"]) for _ in range(draw.choice([1, 3, 20])))
    rows = [(cell().strip(), cell().strip()) for _ in range(150)] + [("x" * 300 + "\n" + "y" * 300, "long"), ("", "empty")]
    for k, part in enumerate((rows[:90], rows[90:], [])):
        with open(tmp_path / f"{k}.csv", "w", newline="") as f:
            w = csv.writer(f, quoting=csv.QUOTE_ALL, lineterminator="\r\n" if k else "\n")
            w.writerows([("Answer", "other", "Question"), *((a, "1", q) for q, a in part)])
            f.write("\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        assert split > 1000 or spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 8
        got = readers.scan_task_csv(spark, str(tmp_path)).orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r.question, r.answer) for r in got] == rows


def test_csv_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Question,Answer\n1,2\n3\n")
    assert {(r.question, r.answer) for r in readers.scan_task_csv(spark, str(tmp_path)).collect()} == {("1", "2"), ("3", None)}
    (tmp_path / "b.csv").write_text("Answer,Question\n1,2\n")
    with pytest.raises(ValueError):
        readers.scan_task_csv(spark, str(tmp_path))
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text("")
    assert readers.scan_task_csv(spark, str(tmp_path / "c")).count() == 0
