"""Hand-made edge rows for the text rules, with the results that the written rules give."""

import pytest
from pyspark.sql import functions as F

from treepref.functions import score as S
from treepref.functions import text as T
from treepref.operators import evaluate as EV
from treepref.operators import prepare as PR
from treepref.operators import ratings as R
from treepref.operators import steps as ST
from treepref.operators import trace as TR
from treepref.sources.readers import scan_flat_qa_json, scan_task_csv


def one(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


WS_CASES = ["  a b  ", " x　", "\tq\n", "\x0bz\x1c", "", "no-space", "  mid  "]


def test_strip_matches_python(spark):
    assert one(spark, WS_CASES, T.strip) == [s.strip() for s in WS_CASES]


def test_split_ws_matches_python(spark):
    assert one(spark, WS_CASES, T.split_ws) == [s.split() for s in WS_CASES]


NORMAL = {"The  Cat, a dog!": "cat dog", "An apple": "apple", "the": "", "Mr. Smith's  house": "mr smiths house",
          "théâtre an": "théâtre", "“the” cat": "“ ” cat", "the—end": "—end"}


def test_normalize_answer(spark):
    assert one(spark, list(NORMAL), T.normalize_answer) == list(NORMAL.values())


QA = [("Paris", "step 3, so the final answer is: Paris."), ("New York", "So the final answer is: new-york"),
      ("!!", "so the final answer is: anything"), ("x", "the answer is x"), ("Rome", "so the final answer is rome\nmore"),
      ("Bern", "nothing here")]


def test_qa_correct(spark):
    df = spark.createDataFrame(QA, "gt string, y string")
    got = [r[0] for r in df.select(S.qa_correct("y", "gt")).collect()]
    assert got == [1, 1, 0, 0, 1, 0]  # 0: a truth of punctuation only (Q22), no final phrase (Q24)


MATH = [("The answer (arabic numerals) is 1,234.", "1234"), ("answer (arabic numerals) is 5 then 6", "6"),
        ("no number", "7"), ("no number", "none"), ("(arabic numerals) is 3 (arabic numerals) is 4", "4")]


def test_math_correct(spark):
    df = spark.createDataFrame(MATH, "y string, t string")
    assert [r[0] for r in df.select(S.math_correct("y", "t")).collect()] == [1, 1, 0, 0, 1]


VERDICTS = ["Likely", "so\nSURE", "It is unlikely", "likely or impossible", "nothing", "<s>sure</s>", "unlikely\nlikely"]


def test_verdict_value(spark):
    assert one(spark, VERDICTS, S.verdict_value) == pytest.approx([1, 1, 0.001, 0.001, 0.001, 1, 0.001])


CELLS = ["0.7", " 1 ", "-2.5e1", "N/A", "<chosen:A>x</chosen:A><reject:B>y</reject:B>", "abc", None, ".5"]


def test_parse_rating(spark):
    assert one(spark, CELLS, R.parse_rating) == [0.7, 1.0, -25.0, None, 0.8, None, None, 0.5]


def test_rating_text_slices(spark):
    cells = ["<chosen:A> good </chosen:A><reject:B>B> bad</reject:B>",      # one tag prefix dropped per side
             "<chosen:A>N/A</chosen:A><reject:B>x</reject:B>",              # N/A side drops the pair
             "<chosen:A>ok<reject:B>no closing tags"]                      # quirk Q6: dropped
    df = spark.createDataFrame([(i, "Q?", c) for i, c in enumerate(cells)], "row_id long, Q1 string, `QA1.1_completion_helpful` string")
    got = R.rating_text_pairs(df).select("row_id", "chosen", "rejected").collect()
    assert [(r.row_id, r.chosen, r.rejected) for r in got] == [(0, "good", "B> bad")]


def test_claim_labels_first_vs_last(spark):
    vals = ["supports but refuted", "not enough, reject", "maybe"]
    first = one(spark, vals, ST.claim_label_train)
    last = one(spark, vals, lambda c: ST.claim_label_train(c, last_wins=True))
    assert first == ["supports", "refutes", None]
    assert last == ["refutes", "not enough information", None]


JOIN = ["Step 1, x.\nSo the final answer is Paris.\ntrailing", "no final", "a\nb\nso the final answer is: c\n\nignored"]


def test_answer_line_join(spark):
    assert one(spark, JOIN, TR.answer_line_join) == [
        "step 1, x. so the final answer is: paris.", None, "a b so the final answer is: c"]


def test_tree_expand_many_children_and_levels(spark):
    """15 children for each node and a fourth level: each keeps its own parent."""
    rows = [(1, 0, k, None, f"c{k}", k) for k in range(15)]
    for step in (1, 2, 3):
        best = max(r[2] for r in rows if r[1] == step - 1 and r[4] != "orphan")
        rows += [(1, step, 1000 * step + k, best, f"c{step}.{k}", k) for k in range(15)]
        rows += [(1, step, 1000 * step + 500 + k, -1, "orphan", 99) for k in range(3)]
    t = spark.createDataFrame(rows, "question_id long, step int, path_id int, parent_id int, candidate string, score int")
    got = TR.search(t, n=1, steps=4)
    assert sorted((r.step, r.candidate) for r in got.collect()) == sorted((r[1], r[4]) for r in rows if r[4] != "orphan")


def test_logged_questions_stay_within_a_file(spark):
    lines = [("a", 0, "x"), ("a", 1, "====GR==== y"), ("b", 2, "q1 sum(accs) 1"), ("b", 3, "====GR==== y"), ("b", 4, "q2 sum(accs) 1")]
    log = spark.createDataFrame(lines, "file string, line_no long, line string")
    assert [r[0] for r in EV.logged_questions(log).collect()] == ["q2"]


def test_sample_of_everything_needs_no_sort(spark):
    df = spark.range(50)
    assert PR.sample_fraction(df, "id", 1.0) is df


def test_source_order_over_files(spark, tmp_path):
    # The larger file comes last by name; Spark deals large files out first.
    (tmp_path / "a.json").write_text('{"question": "a0", "answer": "x"}\n')
    (tmp_path / "b.json").write_text("".join(f'{{"question": "b{i}", "answer": "{"y" * 500}"}}\n' for i in range(40)))
    got = [r["question"] for r in scan_flat_qa_json(spark, str(tmp_path)).orderBy("seq").collect()]
    assert got == ["a0", *[f"b{i}" for i in range(40)]]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "t.csv").write_text("Question,Answer\nq1,a1\n\"q\n2\",a2\n")
    assert [r["question"] for r in scan_task_csv(spark, str(tmp_path / "c")).orderBy("seq").collect()] == ["q1", "q\n2"]
