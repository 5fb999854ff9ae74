"""Plan-shape checks for the scale-sensitive operators."""

import __spark_entry__ as E

SMALL = "/root/testdata/sf0.001"
Q = E.queries()


def plan(spark, name):
    return Q[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_greedy_selection_limits_before_shuffle(spark):
    assert "WindowGroupLimit" in plan(spark, "select_greedy_ties")


def test_pairs_from_stored_wide_rows_do_not_shuffle(spark):
    assert "Exchange" not in plan(spark, "union_pairs")


def test_scans_are_pruned(spark):
    p = plan(spark, "normalize_answer")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p
