"""Rules of single operators on hand-made rows: boxes, empty texts, denominators, reports, prompts, files."""

import pytest
from pyspark.sql import functions as F

from treepref.functions import score as S
from treepref.operators import evaluate as EV
from treepref.operators import generations as G
from treepref.operators import ordering as OR
from treepref.operators import prepare as PR
from treepref.operators import prompts as PM
from treepref.operators import ratings as R
from treepref.sources import readers as RD


def wide(spark, box_columns, row):
    """One wide row with a rated variation, and box columns of the given names."""
    names = ["row_id", "Q1", "A1", "Q1.1", "A1.1", *[f"QA1.1_completion_{m}" for m in R.METRICS], *box_columns]
    kinds = {"row_id": "long"} | dict(box_columns)
    schema = ", ".join(f"`{n}` {kinds.get(n, 'string')}" for n in names)
    return spark.createDataFrame([(1, "q", "a", "q", "b", "0.9", "0.9", "0.9", *row)], schema)


BOX = R.BOX_COLUMN


@pytest.mark.parametrize("columns,row,want", [
    ({BOX: "string"}, ("[1, 2]",), "[1, 2]"),
    ({BOX: "array<double>"}, ([0.5, 1.0],), "[0.5, 1.0]"),
    ({"bbox": "string"}, ("[3]",), "[3]"),
    ({BOX: "string", "bbox": "string"}, (None, "[4]"), "[4]"),
    ({BOX: "string", "bbox": "string"}, ("[5]", "[6]"), "[5]"),
    ({BOX: "string"}, (" ",), None),
    ({}, (), None)])
def test_box_of_a_wide_row(spark, columns, row, want):
    pairs = R.union_pairs(wide(spark, columns, row)).collect()
    assert pairs and {r["bbox"] for r in pairs} == {want}
    assert all((r["prompt"].endswith(f"region: {want}")) == (want is not None) for r in pairs)


def test_unpivot_ratings_takes_the_second_type_and_missing_columns(spark):
    df = spark.createDataFrame([(1, "N/A", "0.25"), (2, "<chosen:A>x</chosen:A><reject:B>y</reject:B>", "0.1"), (3, None, None)],
                               "row_id long, `QA2.3_completion_honest` string, `QA2.3_rm_output_honest` string")
    got = sorted(tuple(r) for r in R.unpivot_ratings(df).collect())
    assert got == [(1, 2, 3, "honest", 0.25), (2, 2, 3, "honest", 0.8)]
    assert R.unpivot_ratings(df.limit(0)).count() == 0


def test_similarity_of_empty_texts(spark):
    rows = [("", ""), (None, ""), ("a", ""), ("", "b"), (" ", "b"), ("a", "b")]
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0], a, b) for a, b in rows], "u array<float>, v array<float>, a string, b string")
    assert [r[0] for r in df.select(S.text_similarity("u", "v", "a", "b")).collect()] == [1.0, 1.0, 0.0, 0.0, 1.0, 1.0]


def test_accuracy_over_all_loaded_questions(spark):
    truth = spark.createDataFrame([("q1", "old", 0), ("q1", "x", 1), ("q2", "y", 2), ("q3", "z", 3), ("q4", "z", 4)],
                                  "question string, answer string, seq long")
    preds = spark.createDataFrame([
        ("q1", "so the final answer is: x."), ("q1", "so the final answer is: old."), ("q2", "so the final answer is: no."),
        ("q3", "step 1, z"), ("q5", "so the final answer is: z.")], "question string, prediction string")
    assert tuple(EV.gated_accuracy(preds, truth, S.qa_correct).first()) == (4, 2, 0.125, 0.25)
    # Without the gate the unfinished text counts as wrong.
    assert tuple(EV.gated_accuracy(preds, truth, S.qa_correct, gate=False).first()) == (4, 3, 0.125, 0.25)
    assert tuple(EV.gated_accuracy(preds.limit(0), truth, S.qa_correct).first()) == (4, 0, 0.0, 0.0)
    assert tuple(EV.gated_accuracy(preds, truth.limit(0), S.qa_correct).first()) == (0, 0, 0.0, 0.0)


def test_report_of_blank_rows(spark):
    rows = [(i, "p", "c", "r" if i % 2 else " \n") for i in range(20)] + [(0, None, "c", "r")]
    df = spark.createDataFrame(rows, "seq long, prompt string, chosen string, rejected string").repartition(5)
    got = [(r["seq"], r["prompt"]) for r in PR.first_blank_rows(df, "seq").collect()]
    assert got == [(0, None), (0, "p"), (2, "p"), (4, "p"), (6, "p")]
    assert tuple(PR.validate_pairs(df).first()) == (True, 21, 11, "")
    assert tuple(PR.validate_pairs(df.limit(0)).first()) == (True, 0, 0, "")
    assert tuple(PR.validate_pairs(df.drop("chosen")).first()) == (False, 0, 0, "chosen")


CONTINUED = [
    ("Step 1, a.", "P:Step 1, a. Step 2, "),
    ("Step 2, b.", "P:Step 2, b. Step 3, "),
    ("Step 2, Step 3, c.", "P:Step 2, Step 3, c. Step 4, The answer (arabic numerals) is "),
    ("Step 2, Step 3, Step 4, it.", "P:step 2, step 3,  Step 4, The answer (arabic numerals) is "),
    ("Step 2, Step 3, Step 4, The answer (arabic numerals) is 5.", "P:Step 2, Step 3, Step 4, The answer (arabic numerals) is 5.")]


def test_prompt_of_the_next_math_call(spark):
    df = spark.createDataFrame([(y,) for y, _ in CONTINUED], "y string")
    assert [r[0] for r in df.select(PM.continued_prompt(F.lit("P:"), F.col("y"), math=True)).collect()] == [w for _, w in CONTINUED]


def test_prompt_of_the_next_question_call(spark):
    rows = ["a", "Step 2, b", "Step 2, Step 3, so the final answer is: x"]
    df = spark.createDataFrame([(y,) for y in rows], "y string")
    assert [r[0] for r in df.select(PM.continued_prompt(F.lit("P:"), F.col("y"))).collect()] == [
        "P:a Step 2, ", "P:Step 2, b Step 3, so the final answer is: ", "P:" + rows[2]]


def test_math_text_of_a_whole_answer(spark):
    rows = [("P: <s>Step 1, A\nStep 2, B\n\nmore</s>", "step 1, a\nstep 2, b"), ("X Q: next\n\ny", "x "), ("", ""), (None, None)]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string")
    got = [r[0] for r in df.select(G.clean_math_generation(F.col("t"), F.lit("P: "), search=False)).collect()]
    assert got == [w for _, w in rows]


def test_manifest_of_files(spark, tmp_path):
    heads = {"a.png": bytes.fromhex("89504E470D0A1A0A") + b"x" * 100_000, "sub/b.jpg": b"\xff\xd8\xff\xe0abcd", "sub/c.bin": b"hi",
             "sub/deep/d.png": b"", "note.txt": b"BM"}
    for name, data in heads.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    rows = {r["file"].rsplit("/", 1)[1]: (r["n_bytes"], r["format"]) for r in RD.image_manifest_files(spark, str(tmp_path)).collect()}
    assert rows == {"a.png": (100_008, "png"), "b.jpg": (8, "jpeg"), "c.bin": (2, "unknown"), "note.txt": (2, "bmp")}
    listed = RD.image_manifest_files(spark, str(tmp_path), pattern="*.png", sniff=False)
    assert sorted((r["n_bytes"], r["format"]) for r in listed.collect()) == [(100_008, None)]
    # The listing alone opens no file: the scan reads no content.
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    (tmp_path / "empty").mkdir()
    assert RD.image_manifest_files(spark, str(tmp_path / "empty")).count() == 0


def test_positions_over_many_buckets(spark):
    n = 3000
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 7).alias("x"))
    out = OR.global_positions(df, ["k"], F.floor(F.col("k") / 3), running=["x"])
    total = 0
    for pos, r in enumerate(out.orderBy("k").collect()):
        total += r["x"]
        assert (r["pos"], r["x_cum"]) == (pos, total)
    # Offsets come from ranges of buckets, and no window takes all buckets in one task.
    offsets = OR.global_positions(df, ["k"], F.floor(F.col("k") / 3))._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket ASC NULLS FIRST], specifiedwindowframe" not in offsets
