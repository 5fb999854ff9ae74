"""Operators 11 to 13 against brute force and DuckDB."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tools.check import digest

pytest.importorskip("public_tokenizers")

from treepref.llm import collocations, importance, licenses, queries  # noqa: E402

UPPER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


@pytest.mark.parametrize("name", ["op11_debruijn_collocations", "op12_importance_resampling", "op13_license_diagonals"])
def test_registered_query_equals_its_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(queries.ORACLE[name])
    cols, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(df.columns)
    assert len(got) == len(want) and digest(df.columns, got) == digest(cols, want)


# --- op11


def runs_of(text, longest=4):
    for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
        w = re.findall(r"[^\x20\x09]+", p)
        for m in range(1, longest + 1):
            for i in range(len(w) - m + 1):
                yield m, " ".join(w[i:i + m])


def brute_counts(rows, longest=4):
    f = defaultdict(Counter)
    for lang, text in rows:
        f["und" if lang is None else lang].update(g for _, g in runs_of(text, longest))
    return f


def brute_collocations(rows, least, top, held):
    out = []
    for lang, f in brute_counts(rows).items():
        n = sum(c for g, c in f.items() if " " not in g)
        cand = {g: c for g, c in f.items() if " " in g and c >= least}
        for g, a in cand.items():
            w = g.split(" ")
            if any(f" {g} " in f" {h} " and len(h) > len(g) and 100 * c >= held * a for h, c in cand.items()):
                continue
            cuts = []
            for k in range(1, len(w)):
                left, right = f[" ".join(w[:k])], f[" ".join(w[k:])]
                cuts.append((2_000_000 * a // (left + right), k, left, right))
            s, _, left, right = min(cuts)
            out.append((lang, (-s, -a, g.encode()), g, a, left, right, n, s))
    out.sort()
    place, rank = Counter(), []
    for lang, _, g, a, left, right, n, s in out:
        place[lang] += 1
        if place[lang] <= top:
            rank.append((lang, place[lang], g, a, left, right, n, s))
    return rank


@pytest.fixture(scope="module")
def prose():
    r = random.Random(5)
    vocab = ["a", "b", "The", "the", "é", "Été", "x y", "漢", "q\x01", "q"]
    rows = []
    for k in range(300):
        parts = [r.choice(vocab) for _ in range(r.randrange(0, 30))]
        if k % 3 == 0:
            parts += "one two three four five six seven".split()
        text = "".join(w + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " \r\n"]) for w in parts)
        rows.append((r.choice(["en", "fr", None, ""]), text))
    rows += [("en", None), (None, ""), ("en", " \t \n..,;"), ("en", "the the the the the"), ("e\tn", "b b b b")]
    rows += rows[:20]
    return rows


def test_op11_counts_equal_brute_force(spark, prose):
    df = spark.createDataFrame(prose, "lang string, text string").repartition(7)
    got = {(r.lang, r.m, r.gram): r.f for r in collocations.frequent(df, least=3).collect()}
    want = {}
    for lang, f in brute_counts(prose).items():
        want |= {(lang, g.count(" ") + 1, g): c for g, c in f.items() if c >= 3}
        if f:
            want[lang, 0, ""] = sum(c for g, c in f.items() if " " not in g)
    assert got == want


@pytest.mark.parametrize("top,held", [(2000, 80), (5, 80), (2000, 101)])
def test_op11_equals_brute_force(spark, prose, top, held):
    df = spark.createDataFrame([(*x, 1, "p") for x in prose], "lang string, text string, m int, phrase string")
    out = collocations.collocations(df, least=3, top=top, held_percent=held)
    got = sorted(tuple(r)[:8] for r in out.collect())
    assert got == sorted(brute_collocations(prose, 3, top, held))


def test_op11_ranges_are_in_the_order_of_the_runs_and_make_the_runs_once(spark, prose):
    r = np.random.default_rng(4)
    some = sorted({b" ".join(r.choice([b"a", b"aaaa", b"the", b"then", "é".encode(), b"b" * 40, b"x"], r.integers(1, 9))) + b" " for _ in range(900)})
    ends = np.cumsum([len(x) for x in some])
    starts, buf = ends - [len(x) for x in some], np.frombuffer(b"".join(some), np.uint8)
    for n in (0, 1, 40):
        bounds = np.unique(np.array(some[5::20][:n], f"S{collocations.BOUND_BYTES}"))
        got = collocations.ranges(buf, starts, ends, bounds)
        cut = [x[:collocations.BOUND_BYTES] for x in some]
        assert got.tolist() == [sum(b <= x for b in bounds.tolist()) for x in cut] and (np.diff(got) >= 0).all()
    df = spark.createDataFrame(prose, "lang string, text string")
    assert "rangepartitioning" not in collocations.frequent(df, least=3)._jdf.queryExecution().toString().lower()


def test_op11_compacts_a_long_passage(spark):
    passage = " ".join(f"w{k}" for k in range(90))
    df = spark.createDataFrame([("en", f"{k} {passage} {k + 1}") for k in range(40)], "lang string, text string")
    got = collocations.collocations(df).collect()
    assert {r.passage for r in got} == {passage}
    assert len(got) == 87 and {r.score for r in got} == {1_000_000}


def test_op11_empty_table_and_odd_rows(spark, odd, none):
    assert collocations.collocations(none).count() == 0
    got = collocations.collocations(odd, least=2).collect()
    assert {r.lang for r in got} == {"en"}
    assert [(r.a, r.n) for r in got if r.phrase == "two three"] == []
    assert max(r.a for r in got) >= 4000 - 1


# --- op12


def brute_scores(rows, target, order=1, buckets=10_000):
    def feats(t):
        w = words(t)
        return [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, order + 1) for i in range(len(w) - k + 1)]
    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(feats(x))
    for x in target:
        t.update(feats(x))
    sn, tn, out = sum(s.values()), sum(t.values()), []
    for i, x in rows:
        g = [math.floor(1000 * math.log((t[b] + 1) * (sn + buckets) / ((s[b] + 1) * (tn + buckets)))) for b in feats(x)]
        w = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(g), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(x))))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_op12_equals_brute_force(spark, odd, order):
    target = ["one two", None, "Lorem ipsum 漢字 x", ""]
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(k, f"word{k % 7} " * (k % 50) + "two") for k in range(100, 260)]
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, score int").repartition(5)
    want = brute_scores(rows, target, order)
    able = sorted((-s, i is not None, i or 0, n, w) for i, n, w, s, c in want if c >= 20)
    k = 10 * len(able) // 100
    place = {(i if flag else None, -s): r + 1 for r, (s, flag, i, n, w) in enumerate(able[:k])}
    out = importance.resample(df, spark.createDataFrame([(x,) for x in target], "text string"), order=order, block=8, last=1)
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:4])
    got = sorted([tuple(r) for r in out.collect()], key=key)
    assert [r[:4] for r in got] == sorted([r[:4] for r in want], key=key)
    assert {(r[0], r[3]): r[4] for r in got if r[4]} == place


@pytest.mark.parametrize("block,last", [(1, 1), (7, 1), (64, 30)])
def test_selection_finds_every_place(spark, block, last, monkeypatch):
    monkeypatch.setattr(importance, "SHRINK", 2)
    r = np.random.default_rng(1)
    keys = [tuple(int(x) for x in k) for k in r.integers(0, 4, (60, 4))]
    df = spark.createDataFrame(keys, "k0 long, k1 long, k2 long, k3 long").repartition(3)
    for k in (1, 2, 30, 59, 60):
        assert importance.kth_key(df, k, block, last) == sorted(keys)[k - 1]


def test_op12_ties_draw_the_exact_number(spark):
    df = spark.createDataFrame([(5, "same words " * 20)] * 40, "doc_id long, text string")
    out = importance.resample(df, df.limit(1), block=4, last=1)
    assert sorted(r.rank for r in out.collect() if r.rank) == [1, 2, 3, 4] and out.count() == 40


def test_op12_empty_tables(spark, odd, none):
    assert importance.resample(none, odd).count() == 0
    got = importance.resample(odd, none).collect()
    assert len(got) == 13 and all(r.rank is None for r in got if r.n_features < 20)


def test_crc32_of_spans():
    parts = [b"", b"a", b"abc" * 50, "é漢".encode(), b"x" * 63, b"y" * 64, b"z" * 65]
    buf = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    assert importance.crc32(buf, starts, ends).tolist() == [zlib.crc32(p) for p in parts]


# --- op13


def test_op13_base_places_equal_brute_force(spark, odd):
    texts = [r.text for r in odd.collect()] + ["CC-BY, cc by; all rights reserved. ALL rights reserved", "cc", "xcc by", "cc by-nc 4.0",
                                               "The GNU General  Public\nLicense", "é cc by"]
    df = spark.createDataFrame([(k, t, "x", 2.0) for k, t in enumerate(texts)], "doc_id long, text string, labels string, score double")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        w = words(t)
        at = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        r = got[k]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(at), ",".join(sorted({x for _, x in at})))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and (r.score == 1.0 or not at)


def test_op13_finds_edited_notices_and_leaves_other_text_alone(spark):
    mit = "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
    full = mit + " the Software to deal in the Software without restriction"
    put_in = full.replace("any person", "any kind person").replace("associated ", "")
    texts = {1: f"intro {full} end", 2: f"{put_in}", 3: mit[:60], 4: "released under the mit license", 5: "released under the same terms",
             6: "this license of mit is under released", 7: "Released under the MIT License. " * 30, 8: "x " * 3000 + full}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert {k for k, r in got.items() if r.labels == "mit"} == {1, 2, 4, 7, 8}
    assert all(not got[k].labels and got[k].score < 0.8 for k in (3, 5, 6))
    assert got[1].score == 1.0 and 0.8 <= got[2].score < 1.0
    spans = licenses.spans(df).where("id = 8 and label = 'mit'").collect()
    assert [(s["first"], s["last"]) for s in spans] == [(3000, 3000 + len(words(full)) - 1)]


def test_op13_repeated_rows_and_null_ids(spark, none):
    rows = [(None, "Released under the MIT License"), (None, "Released under the MIT License"), (1, "Released under the MIT License"),
            (1, "other text"), (1, None), (None, "")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.labels, r.score) for r in got) == [
        (0, "", 0.0), (0, "mit", 1.0), (0, "mit", 1.0), (1, "", 0.0), (1, "", 0.0), (1, "mit", 1.0)]
    assert licenses.scan(none).count() == 0


def test_op13_votes_do_not_grow_with_repeated_rows(spark):
    text = "Released under the MIT License"
    one = licenses.spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    many = licenses.spans(spark.createDataFrame([(1, text)] * 9, "doc_id long, text string")).collect()
    assert one == many


def test_op13_runs_no_python(spark):
    plan = queries.QUERIES["op13_license_diagonals"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_op13_refuses_notices_too_many_to_broadcast(spark, odd, monkeypatch):
    monkeypatch.setattr(licenses, "MOST_POSITIONS", 3)
    with pytest.raises(ValueError):
        licenses.scan(odd)


def test_lower_ascii_changes_nothing_else(spark):
    text = "ABC xyz ÀÉ İı ΣΑΣ Ⅷ"
    df = spark.createDataFrame([(text,), ("ABC Z",)], "t string")
    assert [r[0] for r in df.select(licenses.lower_ascii(F.col("t"))).collect()] == [text.translate(UPPER), "abc z"]
