"""Property checks from the survey's test strategy."""

from pyspark.sql import functions as F

from treepref.operators import prepare as PR
from treepref.operators import ratings as R
from treepref.operators import steps as ST
from treepref.operators import trace as TR
from treepref.session import table
from treepref.sources import fixtures as FX

SMALL = "/root/testdata/sf0.001"


def test_split_disjoint_and_complete(spark):
    docs = table(spark, SMALL, "documents").select("doc_id")
    s = PR.split_exact(docs, "doc_id", seed=3, test_ratio=0.25)
    n = docs.count()
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts["train"] == int(n * 0.75) and counts["train"] + counts["test"] == n
    assert s.select("doc_id").distinct().count() == n


def test_sample_fraction_exact(spark):
    docs = table(spark, SMALL, "documents").select("doc_id")
    n = docs.count()
    assert PR.sample_fraction(docs, "doc_id", 0.35, seed=1).count() == round(n * 0.35)


def test_greedy_selection_never_short(spark):
    t = FX.trace(spark, SMALL)
    sel = TR.select_greedy_ties(t, n=3).groupBy("question_id", "step").count()
    sizes = t.groupBy("question_id", "step").count().withColumnRenamed("count", "size")
    bad = sel.join(sizes, ["question_id", "step"]).where(F.col("count") < F.least(F.lit(3), F.col("size")))
    assert bad.count() == 0


def test_distinct_pairs_idempotent(spark):
    from treepref.plans import q_steps
    pairs = q_steps.distinct_pairs(spark, SMALL)
    assert pairs.count() == pairs.distinct().count()


def test_composite_swap_symmetry(spark):
    wide = FX.wide_table(spark, SMALL)
    it = R.variation_items(wide).where(F.col("composite").isNotNull())
    p = R.composite_pairs(wide)
    j = p.join(it.select("row_id", "q", "v", "answer", "var_answer"), ["row_id", "q", "v"])
    # exactly one of the two answers is chosen and the other rejected
    ok = ((F.col("chosen") == F.col("answer")) & (F.col("rejected") == F.col("var_answer"))) | (
        (F.col("chosen") == F.col("var_answer")) & (F.col("rejected") == F.col("answer")))
    assert j.where(~ok).count() == 0 and j.count() == it.count()


def test_steps_have_prefix_structure(spark):
    from treepref.plans import q_steps
    pos = q_steps.split_reasoning_steps(spark, SMALL)
    assert pos.where((F.col("step") == 0) & (F.col("prefix") != "")).count() == 0
    assert pos.where((F.col("step") > 0) & ~F.startswith("prefix", F.lit("step"))).count() == 0
    assert ST.N_THOUGHTS == 3
