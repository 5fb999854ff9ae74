"""Each stage of the pipeline on its own input, and as a whole."""

import re

import pytest

from tests.conftest import SMALL

pytest.importorskip("public_tokenizers")

import corpus_pipeline as P  # noqa: E402
from tests.llm.test_operators import brute_groups, brute_quality  # noqa: E402
from treepref.session import materialize  # noqa: E402


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in P.STAGES:
        out = materialize(stage(spark, docs, SMALL), name)
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name != "packing":
            assert out.columns == docs.columns
            after = {r["doc_id"]: r["text"] for r in out.collect()}
            assert set(after) <= set(before) and len(after) == out.count()
        if name == "quality_rules":
            for i, t in before.items():
                q = brute_quality(t)
                if q[0] < 50 or 2 * q[4] > q[0]:
                    assert i not in after
                elif q[4] == 0:
                    assert i in after
        elif name == "near_dedup":
            assert set(after) == {c for _, c in brute_groups(before.items(), 5).values()}
        elif name == "pii":
            assert set(after) == set(before)
            assert not [i for i, t in before.items() for m in re.findall(r"\S+@\S+\w|\d{16}", t) if m in after[i]]
        elif name == "packing":
            assert {r[0] for r in out.select("doc_id").collect()} == set(before)
            assert {"sequence_id", "offset", "length"} <= set(out.columns)
        docs = out


def test_stages_on_odd_rows_and_empty_tables(spark, odd, none):
    for df in (odd, none):
        for _, stage in P.STAGES:
            assert stage(spark, df, SMALL).count() >= 0
    kept = P.near_dedup(spark, odd, SMALL)
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and None in ids
