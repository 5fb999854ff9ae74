"""Operators of treepref.llm against brute force, libraries, round trips and held-out labels."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL

public = pytest.importorskip("public_tokenizers")

from treepref.llm import (  # noqa: E402
    bpe, htmltext, huffman, neardup, packing, pii, quality, queries, sketch, tokens, toxicity, warc)
from treepref.llm import textkernel as K  # noqa: E402
from treepref.session import scratch_path  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r[0]: r[1] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


# --- op1


def library_ids(name, text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public.path(name))
    t.encode_special_tokens = True
    return t.encode(text, add_special_tokens=False).ids


def test_op1_reads_back_what_the_library_encodes(spark, texts):
    got = rows(queries.op1(spark, SMALL), "doc_id", "start", "n_tokens", "ids_crc32")
    want, start = [], 0
    for i in sorted(texts):
        ids = np.array(library_ids("word_bpe_49k.json", texts[i] or "") + [2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(got) == want


def test_huffman_lengths_are_a_full_code_within_the_limit():
    counts = np.array([2 ** min(k, 40) for k in range(60)] + [0, 0])
    n = huffman.code_lengths(counts, 12)
    assert n.max() <= 12 and (n[-2:] == 0).all()
    assert sum(2.0 ** -float(x) for x in n if x) == 1.0
    free = huffman.code_lengths(np.array([5, 9, 12, 13, 16, 45]), 20)
    assert (free * np.array([5, 9, 12, 13, 16, 45])).sum() == 224  # the textbook optimum


@pytest.mark.parametrize("size", [0, 1, 5, huffman.BLOCK, 3 * huffman.BLOCK + 7])
def test_huffman_file_round_trip(size):
    ids = np.random.default_rng(size).zipf(1.3, size) % 500
    n = huffman.code_lengths(np.bincount(ids, minlength=500))
    docs, counts, back = huffman.read_bytes(huffman.file_bytes([7, None], np.array([size, 0]), ids, n))
    assert docs == [7, None] and counts.tolist() == [size, 0] and back.tolist() == ids.tolist()


def test_op1_odd_rows_and_empty_table(spark, odd, none):
    for df, n in ((odd, 13), (none, 0)):
        folder = scratch_path(spark, "t")
        huffman.write_archive(df, folder, public.path("word_bpe_49k.json"), 2, 49408, file_ids=50)
        got = huffman.read_archive(spark, folder).orderBy("start").collect()
        assert len(got) == n
        assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:k]) for k in range(n)]
        ids = [r["doc_id"] for r in got]
        assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_units_agree_with_the_library(name, kind, texts):
    enc = tokens.UnitEncoder(public.path(name), kind)
    odd = ["", " ", "\n\n a  b \n c", "a\x1cb c", "Don't 'so we'll  ", "İ ΣΑΣ ½Ⅷ é", "a\tb\r\nc d", "<|endoftext|>", "_a_1 --- "]
    some = odd + list(texts.values())[:60]
    for t, got in zip(some, enc.encode(some)):
        assert np.frombuffer(got, "<u2").tolist() == library_ids(name, t)


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_columns_agree_with_the_library_and_look_a_unit_up_once(name, kind, texts):
    odd = [None, "", " ", "\n\n a  b \n c", "a\x1cb c", "Don't 'so we'll, it's.  ", "İ ΣΑΣ ½Ⅷ é, E\u0301, a=\u0338b", "a\tb\r\nc d",
           "x\u2003y z\xa0", "<|endoftext|> a<|endoftext|>b", "_a_1 --- ''s 2'5's,ok... (a.b):c\nD'S end.", "\x01 a\x00b", "\n"]
    some = odd + list(texts.values())[:8] + odd + ["Plain words, plain words.\nOnce more"]
    library = tokens.UnitEncoder(public.path(name), kind).tokenizer
    want = [library.encode(t or "", add_special_tokens=False).ids + [7] for t in some]
    for limit in (1, 300, tokens.COLUMN_BYTES):
        enc, got = tokens.UnitEncoder(public.path(name), kind, cache=2000), []
        for first, ids, ends in enc.column(pa.array(some), b"\7\0", limit):
            assert first == len(got)
            got += [x.tolist() for x in np.split(ids, ends[:-1])]
        assert got == want
    enc, asked, learn = tokens.UnitEncoder(public.path(name), kind), [], tokens.UnitEncoder._learn
    enc._learn = lambda units: (asked.extend(units), learn(enc, units))
    assert len(list(enc.column(pa.array(["one two, three.\nfour one", "two, one three"] * 1000), b"\7\0"))) == 1
    assert len(asked) == len(set(asked)) < 12
    assert not list(enc.column(pa.array([], pa.string()), b"\7\0"))


def test_packing_with_a_small_cache_leaves_no_tokenizer_in_the_workers(spark, odd):
    assert packing.pack(odd, public.path("byte_bpe_50k.json")).count() >= 13

    def left(batches):
        for _ in batches:
            n = sum(k[2] == tokens.SMALL_CACHE for k in tokens._ENCODERS)
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    got = spark.range(64).repartition(16).mapInArrow(left, "n long").collect()
    assert got and not any(r["n"] for r in got)


# --- op2


def test_op2_finds_held_out_toxic_texts(spark):
    sf = SMALL.replace("0.001", "0.01")
    got = queries.op2(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    every = queries.op2(spark, sf)
    assert every.count() == 1000 and every.where("score between 0 and 1").count() == 1000
    held = got[got.held_out]
    assert (held.held_out == held.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    clean = held[held.toxic == 0]
    assert (clean.predicted == 0).mean() > 0.95
    assert got[got.toxic == 1].score.mean() > got[got.toxic == 0].score.mean() + 0.15


def test_nnpu_learns_marker_words_without_negatives():
    r = np.random.default_rng(0)
    words = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(400)]
    text = lambda bad: " ".join([*r.choice(words, 80), *(["vile", "awful"] if bad else [])])
    model = toxicity.fit([text(True) for _ in range(150)], [text(k % 10 == 0) for k in range(1500)], 0.1)
    test = [text(k % 2 == 0) for k in range(200)] + [""]
    wanted = tuple(w != 0 for w, _, _ in model)
    got = np.concatenate([toxicity.logits(b, o, model, wanted) for _, _, b, o in K.chunks(pa.array(test))]) > 0
    assert got[0:200:2].all() and not got[1:200:2].any() and not got[200]


def test_op2_learns_and_scores_beyond_the_beginning_of_a_text(spark):
    r = np.random.default_rng(3)
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(500)]
    rows, marks = [], []
    for k in range(600):
        bad = k % 5 == 0
        rows.append((k, " ".join([*r.choice(words, 6000 if k % 3 == 0 else 80), *(["vile", "awful", "dreadful"] if bad else [])])))
        marks.append((k, int(bad)))
    marks += [(0, 0), (0, 1), (None, 1)]
    df, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    fold = F.col("id") % 7 != 0
    for least_z in (toxicity.LEAST_Z, None):
        got = {x["doc_id"]: x["score"] for x in toxicity.score(df, toxicity.train(df, labels, training=fold, least_z=least_z)).collect()}
        held = [k for k in got if k % 7 == 0]
        caught = [got[k] >= 0.5 for k in held if k % 5 == 0]
        clean = [got[k] < 0.5 for k in held if k % 5]
        assert np.mean(caught) >= (1 if least_z else 0.9) and np.mean(clean) >= 0.95


def test_op2_odd_rows_empty_table_no_positives(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 0)], "doc_id long, toxic int")
    for df, n in ((odd, 13), (none, 0)):
        got = toxicity.score(df, toxicity.train(df, labels)).collect()
        assert len(got) == n and all(0 <= r["score"] <= 1 for r in got)


# --- op3

PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var x="</p><p>no";</script></head><body><nav><ul><li>m</li></ul></nav>
<div class="cookie-notice">we use</div><article><header><h1>A &amp; B</h1><p>by</p></header><p>one <b>two<br>three<p>fo&ouml;
 five<aside>no</aside><form>no<p>no</form><div id="comments"><p>no</p></div></article><footer>f</footer>"""


def test_op3_blocks_and_article():
    got = [t for role, t in htmltext.blocks(PAGE) if role == htmltext.ARTICLE]
    assert got == ["A & B", "one two three", "foö five"]
    assert htmltext.blocks("") == [] and htmltext.blocks("<p title='a>b'>q</p><!-- x") == [(htmltext.OTHER, "q")]


def test_op3_repeated_runs_go_where_there_is_no_article(spark):
    boiler = "all rights reserved by the owners of this very fine site"
    unique = ["first page talks about apples and pears at great length today", "second page is on boats",
              "third page has trains running through hills and valleys all night long"]
    pages = [(k, f"http://h.example/{k}", f"<div>{u}</div><div>{boiler}</div>") for k, u in enumerate(unique)]
    pages += [(7, "http://h.example/a", f"<article><p>{boiler}</article>"), (8, None, None), (9, "", ""), (8, None, None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = sorted(rows(htmltext.main_text(df), "page_id", "text", "n_chars"))
    assert [g[1] for g in got] == [*unique, boiler, "", "", ""] and all(len(t) == n for _, t, n in got)
    assert htmltext.main_text(df.where("false")).count() == 0


def test_suffix_array_counts_pages_of_each_run():
    r = np.random.default_rng(1)
    streams = [r.integers(0, 3, n).astype(np.uint64) for n in (0, 5, 40, 60, 40)]
    want = Counter()
    for s in streams:
        want.update(set(map(int, htmltext.window_keys(s))))
    keys, pages = htmltext.suffix_runs(streams)
    assert dict(zip(keys.tolist(), pages.tolist())) == dict(want)


def test_op3_runs_decide_beside_an_article_too(spark):
    notice = "we publish a new story every day of the week at noon"
    pages = [(k, "http://h.org/x", f"<div>{notice}</div><div>Lead {k} of the story</div><article><p>{notice}</p><p>Body {k}</p></article>")
             for k in range(3)]
    pages.append((3, "http://h.org/y", "<nav>menu</nav><article><p>alone</p></article>"))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = dict(rows(htmltext.main_text(df), "page_id", "text"))
    # The repeated block goes, in the article it stays; what one page alone says stays, in page order.
    assert got == {**{k: f"Lead {k} of the story\n{notice}\nBody {k}" for k in range(3)}, 3: "alone"}


def test_op3_registered_query(spark):
    got = queries.op3(spark, SMALL)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert got.count() == spark.read.parquet(f"{SMALL}/pages.parquet").count() and got.where("n_chars = 0").count() == 0


@pytest.mark.parametrize("page, kept", [
    ("<main class='with-sidebar'><p>a b</p></main>", "a b"),
    ("<article class='post comments-open'><p>a b</p></article>", "a b"),
    ("<article><h2 id='search'>Search</h2><p data-id='ad'>a b</p></article>", "Search\na b"),
    ("<article><section id='social-history'><p>a b</p></section></article>", "a b"),
    ("<article><p>a <math><mi>x</mi></math> b</p></article>", "a x b"),
    ("<div class='layout sidebar-right'><main><p>a b</p></main></div>", "a b"),
    ("<article><p>a b</p><section class='comments'><article class='comment'>no</article></section></article>", "a b"),
    ("<article><p>a b</p><div id='site-footer'>no</div><div class='share-buttons'>no</div></article>", "a b"),
    ("<nav><main><p>no</p></main></nav><article class='comment'>no</article><main><p>a b</p></main>", "a b"),
    ("<main><p>a b</p><div id='cookie-banner'>no</div><aside class='open'>no</aside><div role='search'>no</div></main>", "a b"),
])
def test_op3_names_of_state_and_anchors_are_no_furniture(page, kept):
    assert "\n".join(t for role, t in htmltext.blocks(page) if role == htmltext.ARTICLE) == kept


# --- op4


def test_op4_replaces_consistently_and_distinctly(spark):
    n = 400
    data = [(k, f"mail u{k % 200}@corp.com or U{k % 200}@CORP.COM from 10.0.{k % 200}.7, Mrs Anna Berg{'abcdefghij'[k % 10]}a") for k in range(n)]
    data += [(n, None), (n + 1, ""), (n + 2, "version 2.0.1 has 3 parts, see page 12")]
    got = dict(rows(pii.pseudonymise(spark.createDataFrame(data, "doc_id long, text string"), "k"), "doc_id", "text"))
    assert len(got) == n + 3 and got[n] is None and got[n + 1] == "" and got[n + 2] == data[-1][1]
    mails, ips, names = {}, {}, {}
    for k in range(n):
        m = re.fullmatch(r"mail (\S+) or (\S+) from (\S+), Mrs (\S+) (\S+)", got[k])
        assert m[1].lower() == m[2].lower() and m[1] != f"u{k % 200}@corp.com"
        assert mails.setdefault(k % 200, m[1]) == m[1] and ips.setdefault(k % 200, m[3]) == m[3]
        assert m[4].lower() in [x.lower() for x in pii._NAMES["LATIN", "f"]]
        assert names.setdefault(k % 10, m[5]) == m[5]
    assert all(len(set(x.values())) == len(x) for x in (mails, ips, names))


def test_op4_keeps_formats():
    text = "pay 4111 1111 1111 1111 or call +1 (377) 555-0271, г-жа Анна Иванова, 078-05-1120"
    known = {(kind, form): pii.surrogate(b"k", kind, form, 0) for _, _, kind, form in pii.find(text)}
    new, count = pii.replace(text, known)
    m = re.fullmatch(r"pay (\d{4} \d{4} \d{4} \d{4}) or call \+1 \(\d{3}\) \d{3}-\d{4}, г-жа ([А-Я]\w+) ([А-Я]\w+а), \d{3}-\d{2}-\d{4}", new)
    assert count == 5 and pii._luhn(m[1].replace(" ", "")) == 0 and new != text


def test_op4_names_without_title(spark):
    data = [(0, "Mrs Anna Weber called. Weber said that Anna, WEBER's and Weber-Kurz's friend, webers Weber2 weber@x.org"),
            (1, "Dr Anna Weber wrote"), (2, "Weber went out"), (3, "Prof Maria Lund wrote; Mr Lund, 12 Lund_1")]
    got = dict(rows(pii.pseudonymise(spark.createDataFrame(data, "doc_id long, text string"), "k"), "doc_id", "text"))
    m = re.fullmatch(r"Mrs (\w+) (\w+) called\. (\w+) said that (\w+), (\w+)'s and (\w+)-Kurz's friend, webers Weber2 \S+", got[0])
    first, last = m[1], m[2]
    assert first.lower() in [x.lower() for x in pii._NAMES["LATIN", "f"]] and "Weber" not in (last, first)
    assert (m[3], m[4], m[5], m[6]) == (last, first, last.upper(), last)
    assert got[1] == f"Dr {first} {last} wrote" and got[2] == data[2][1]
    m = re.fullmatch(r"Prof (\w+) (\w+) wrote; Mr (\w+), 12 Lund_1", got[3])
    assert m[1] in pii._NAMES["LATIN", "f"] and m[2] == m[3] != "Lund"


def test_op4_space_of_surrogates_grows(spark):
    def word(k, chars):
        return "".join(chars[k // len(chars) ** j % len(chars)] for j in range(3))
    data = [f"Mrs Q{word(k, 'abcdefghijklm')} Z{word(k, 'nopqrstuvwxyz')} came" for k in range(600)]
    data += [f"г-жа Щ{word(k, 'бвгджзклмн')}а Щ{word(k, 'прстфхцчшщ')}ова" for k in range(100)]
    data += [f"mail {c}@mail.example.org" for c in "abcdefghijklmnopqrstuvwxyz"]
    got = dict(rows(pii.pseudonymise(spark.createDataFrame(list(enumerate(data)), "doc_id long, text string"), "k"),
                    "doc_id", "text"))
    latin = [got[k].split() for k in range(600)]
    cyrillic = [got[k].split() for k in range(600, 700)]
    mails = [got[k].split()[1] for k in range(700, 726)]
    for names, kind in ((latin, "LATIN"), (cyrillic, "CYRILLIC")):
        for x in names:
            for part, of in ((x[1], "f"), (x[2], "s")):
                base = part[:-1] if (kind, of) == ("CYRILLIC", "s") else part
                assert base in pii._NAMES[kind, of] or base.endswith(tuple(pii._ENDINGS[kind, of])), part
    assert all(x[2].endswith("а") for x in cyrillic)
    every = [p for x in latin + cyrillic for p in x[1:3]]
    assert len(set(every)) == len(every) and len(set(mails)) == 26
    assert not set(mails) & {x.split()[1] for x in data[700:]} and all(x.endswith("@mail.example.org") for x in mails)


def test_op4_odd_rows(spark, odd, none):
    got = pii.pseudonymise(odd, "k")
    assert got.columns == odd.columns and sorted(map(str, got.collect())) == sorted(map(str, odd.collect()))
    assert pii.pseudonymise(none, "k").count() == 0


# --- op5


def test_op5_contract(spark, texts):
    got = {r["doc_id"]: r for r in queries.op5(spark, SMALL).collect()}
    order = sorted(texts)
    for k, i in enumerate(order):
        t, nxt = texts[i], texts[order[(k + 1) % len(order)]]
        e = t[:len(t) - len(t) // 4] + nxt[:len(t) // 4]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
    assert np.mean([r["near_edited"] for r in got.values()]) > 0.6 > 0.1 > np.mean([r["near_next"] for r in got.values()])


def test_op5_ranges_do_not_change_the_next(spark, odd, none, monkeypatch):
    whole = sorted(map(str, sketch.with_next(odd).collect()))
    monkeypatch.setattr(sketch, "RANGE_BYTES", 1000)
    assert sorted(map(str, sketch.with_next(odd).collect())) == whole
    assert sketch.fingerprints(none).count() == 0 and sketch.fingerprints(odd).count() == 13
    assert "Python" not in sketch.fingerprints(odd)._jdf.queryExecution().toString()


def test_op5_containment_of_unequal_texts(spark):
    words = [f"w{k}" for k in range(6000)]
    df = spark.createDataFrame([(" ".join(words), " ".join(words[1000:1800] + words[:200]))], "a string, b string")
    near = df.select(sketch.likeness(sketch.sketch(F.col("a")), sketch.sketch(F.col("b")))).first()[0]
    assert near > 0.9


def brute_shingles(text):
    w = WORD.findall(text or "")
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_op5_likeness_against_brute_force(spark, texts):
    """Short texts are compared exactly, long ones within the error of a sample of their shingles."""
    got = {r["doc_id"]: r for r in queries.op5(spark, SMALL).collect()}
    order, short, off = sorted(texts), 0, []
    for k, i in enumerate(order):
        t, nxt = texts[i], texts[order[(k + 1) % len(order)]]
        for other, near in ((t[:len(t) - len(t) // 4] + nxt[:len(t) // 4], "near_edited"), (nxt, "near_next")):
            a, b = brute_shingles(t), brute_shingles(other)
            least = min(len(a), len(b))
            exact = len(a & b) / least if least else float(a == b)
            if max(len(a), len(b)) <= sketch.WHOLE:
                short += 1
                assert got[i][near] == pytest.approx(exact)
            elif least > sketch.WHOLE:
                off.append(got[i][near] - exact)
    assert short > 20 and abs(np.mean(off)) < 0.03 and np.std(off) < 0.15


def test_op5_short_texts_and_merging(spark):
    w = [f"w{k}" for k in range(2000)]
    t = lambda a, b: " ".join(w[a:b])
    cases = [(t(3, 8), t(0, 60), 1.0), (t(0, 12), t(0, 12), 1.0), (t(0, 12), t(20, 40), 0.0), ("", t(0, 9), 0.0), ("", " ", 1.0),
             (t(0, 2), t(0, 2), 1.0), ("a " * 900, "a " * 900, 1.0), (t(0, 100), t(0, 1500), 1.0)]
    df = spark.createDataFrame([(a, b, c) for a, b, c in cases], "a string, b string, c double")
    s = sketch.sketch
    for r in df.select("c", sketch.likeness(s(F.col("a")), s(F.col("b"))).alias("n"),
                       sketch.likeness(s(F.col("b")), s(F.col("a"))).alias("m")).collect():
        assert r["n"] == r["m"] == r["c"]
    # Overlapping halves: merged sketches equal the sketch of the whole, short or long.
    for n in (60, 125, 2000):
        one = spark.createDataFrame([(t(0, n // 2 + 4), t(n // 2, n), t(0, n))], "a string, b string, c string")
        r = one.select(sketch.merge(s(F.col("a")), s(F.col("b"))).alias("m"), s(F.col("c")).alias("s")).first()
        assert r["m"] == r["s"] and r["m"]["whole"] == (n < 130)


# --- op6


def test_op6_agrees_with_tiktoken_and_decodes(texts):
    import tiktoken
    path = public.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    ref = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    enc = bpe.RankEncoder(path, public.PATTERN)
    some = ["", "\x1c a\x1d", "=" * 3000, "ab" * 900, "İ ½Ⅷ é 漢字 😀", " \n \n x"] + list(texts.values())[:80]
    for t, got in zip(some, enc.encode(some)):
        assert np.frombuffer(got, "<u4").tolist() == ref.encode_ordinary(t) and enc.decode(got) == t.encode()


def test_perfect_hash_is_minimal_and_perfect():
    words = [f"key{k}".encode() for k in range(5000)]
    h = bpe.PerfectHash(words)
    assert h.find(words).tolist() == list(range(5000)) and sorted(h.word_at.tolist()) == list(range(5000))


def test_op6_odd_rows(spark, odd, none):
    path = public.path("byte_bpe_50k.tiktoken")
    back = bpe.decode(bpe.encode(odd, path, public.PATTERN), path, public.PATTERN).collect()
    assert sorted(bytes(r["data"]) for r in back) == sorted((r["text"] or "").encode() for r in odd.collect())
    assert bpe.encode(none, path, public.PATTERN).count() == 0


# --- op7


def brute_quality(text):
    w = WORD.findall(text or "")
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)

    def covered(n):
        grams = Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
        return {j for i in range(len(w) - n + 1) if grams[tuple(w[i:i + n])] > 1 for j in range(i, i + n)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, len(covered(3)),
            *[sum(len(w[j]) for j in covered(n)) for n in quality.NGRAM_SHARES])


def test_op7_against_brute_force(spark, texts, odd, none):
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *[f"dup_chars_{n}" for n in quality.NGRAM_SHARES])
    got = {r[0]: r[1:] for r in rows(queries.op7(spark, SMALL), "doc_id", *cols)}
    assert got == {i: brute_quality(t) for i, t in texts.items()}
    small = quality.repetition_quality(odd.where("doc_id is null or doc_id <> 6"))
    want = [brute_quality(r["text"]) for r in odd.collect() if r["doc_id"] != 6]
    assert sorted(r for r in rows(small, *cols)) == sorted(want)
    assert quality.repetition_quality(none).count() == 0
    bad = queries.op7(spark, SMALL).where("base_failed <> (n_words < 50 or 100 * n_repeat_words > 50 * n_words) or (base_failed and kept)")
    assert bad.count() == 0


# --- op8


def brute_groups(pairs, size):
    def grams(t):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return frozenset(zip(*[w[k:] for k in range(size)])) if len(w) >= size else frozenset([tuple(w)] if w else [])
    sets, root = {i: grams(t) for i, t in pairs}, {i: i for i, _ in pairs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_op8_against_brute_force(spark, texts):
    got = {r[0]: r[1:] for r in rows(queries.op8(spark, SMALL), "doc_id", "n_shingles", "component_id")}
    assert got == brute_groups(texts.items(), 2)


def test_op8_group_of_near_copies_with_strays(spark, monkeypatch):
    """A group whose texts differ from a hidden base by up to a third: leaders alone do not join it."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "SET_BYTES", 20_000)
    r = np.random.default_rng(5)
    base = [f"b{k}" for k in range(120)]
    data = []
    for k in range(150):
        w, n = list(base), int(r.integers(0, 16))
        for j in r.choice(120, n, replace=False):
            w[j] = f"x{k}_{j}"
        data.append((k, " ".join(w)))
    got = neardup.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), shingle=2)
    assert {r[0]: r[1:] for r in rows(got, "doc_id", "n_shingles", "component_id")} == brute_groups(data, 2)


def test_op8_pair_hidden_behind_third_leaders(spark):
    """Every list that holds both texts of a pair is led by a text that is alike to neither."""
    common = ["q0", "q1", "q2"]
    data = [" ".join(f"w{j}" for j in range(10)), " ".join(f"w{j}" for j in range(11))]
    data += [f"w{j} {q}" for j in range(10) for q in common]
    data += [f"{q} x{j}{q}" for j in range(60) for q in common]
    data = list(enumerate(data))
    got = neardup.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), shingle=1)
    want = brute_groups(data, 1)
    assert want[1] == (11, 0)
    assert {r[0]: r[1:] for r in rows(got, "doc_id", "n_shingles", "component_id")} == want


def test_op8_odd_rows(spark, odd, none):
    got = rows(neardup.near_duplicates(odd, shingle=2), "doc_id", "n_shingles", "component_id")
    by = {g[0]: g for g in got}
    assert len(got) == 13 and by[0] == (0, 0, 0) and by[5][2] == 4 and by[10][2] == 9 and by[None][2] is None
    assert neardup.near_duplicates(none).count() == 0


# --- op9


def check_packing(got, texts):
    seqs, docs = {}, {}
    for d, start, length, crc, total, seq, offset in got:
        ids = np.array(library_ids("byte_bpe_50k.json", texts[d] or "") + [0], "<u4")
        assert total == len(ids) and crc == zlib.crc32(ids[start:start + length].tobytes())
        seqs.setdefault(seq, []).append((offset, length))
        docs.setdefault(d, []).append((start, length, total))
    for parts in seqs.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(x[1] for x in parts[:k]) for k in range(len(parts))]
        assert sum(x[1] for x in parts) <= 1024
    for parts in docs.values():
        parts.sort()
        assert [p[0] for p in parts] == [sum(x[1] for x in parts[:k]) for k in range(len(parts))]
        assert sum(p[1] for p in parts) == parts[0][2]
    return seqs, docs


COLS9 = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def test_op9_pieces_cover_every_id_once_with_little_padding(spark, texts):
    seqs, docs = check_packing(rows(queries.op9(spark, SMALL), *COLS9), texts)
    assert set(docs) == set(texts)
    used = sum(x[1] for s in seqs.values() for x in s)
    assert used > 0.97 * 1024 * len(seqs)


def test_op9_odd_rows_and_plan(spark, odd, none):
    once = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_packing(rows(packing.pack(once, public.path("byte_bpe_50k.json")), *COLS9), {r["doc_id"]: r["text"] for r in once.collect()})
    assert packing.pack(odd, public.path("byte_bpe_50k.json")).where("doc_id is null").count() == 1
    assert packing.pack(none, public.path("byte_bpe_50k.json")).count() == 0
    h = np.zeros(17, np.int64)
    h[[4, 6, 10, 12, 16]] = [50, 30, 30, 50, 9]
    table = packing.plan(h, 16)
    assert table[:, 2].max() < 89 and len({(a, b) for a, b, _, _ in table.tolist()}) == len(table)


# --- op10


def test_op10_archive_round_trip(spark):
    html = [None, "", "<p>x</p>", "<p>x</p>", "é" * 90_000, "<p>x</p>"] + [f"<html>page {k}</html>" * 20 for k in range(40)]
    df = spark.createDataFrame([(k, None if k == 3 else f"http://h/{k}\r\n", h, 1) for k, h in enumerate(html)],
                               "page_id long, url string, html string, payload_bytes int")
    folder = scratch_path(spark, "t")
    warc.write_warcs(df, folder, file_bytes=20_000)
    got = {r["page_id"]: r for r in warc.read_warcs(spark, folder).collect()}
    assert len(got) == len(html)
    for k, h in enumerate(html):
        data = (h or "").encode()
        same = max(j for j, x in enumerate(html) if (x or "") == (h or ""))
        assert got[k]["payload_bytes"] == len(data)
        assert got[k]["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (got[k]["record_type"], got[k]["refers_to"]) == (("response", None) if same == k else ("revisit", same))
    empty = scratch_path(spark, "t")
    warc.write_warcs(df.where("false"), empty)
    assert warc.read_warcs(spark, empty).count() == 0


def test_op10_repeated_rows_and_null_ids_give_one_record_each(spark):
    data = [(1, "a"), (1, "a"), (2, "a"), (5, "b"), (5, "b"), (5, "b"), (5, "c"), (None, "a"), (None, "z"), (None, "z"), (7, None), (None, None)]
    df = spark.createDataFrame([(p, "http://h/", h) for p, h in data], "page_id long, url string, html string").repartition(4)
    folder = scratch_path(spark, "t")
    warc.write_warcs(df, folder)
    got = warc.read_warcs(spark, folder).collect()
    name = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    want = Counter({(1, name("a"), "revisit", 2): 2, (2, name("a"), "response", None): 1, (5, name("b"), "response", None): 1,
                    (5, name("b"), "revisit", 5): 2, (5, name("c"), "response", None): 1, (None, name("a"), "revisit", 2): 1,
                    (None, name("z"), "response", None): 2, (7, name(""), "response", None): 1, (None, name(""), "revisit", 7): 1})
    assert Counter((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in got) == want


def test_op10_shuffles_the_pages_once(spark):
    df = spark.createDataFrame([(1, "u", "h")], "page long, url string, html string")
    plan = warc._with_roles(df, 0, 5)._jdf.queryExecution().executedPlan().toString()
    wide = [x for x in plan.splitlines() if "Exchange" in x and "REPARTITION_BY_NUM" in x]
    assert len(wide) == 1 and "REPARTITION_BY_NUM" in plan


def test_op10_files_begin_with_the_dictionary():
    import zstandard
    samples = [warc.record(k, "http://h/", b"<p>some text here</p>" * 30, "D" * 32, None) for k in range(300)]
    d = warc.train(samples)
    c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d))
    data = warc.frame(d) + b"".join(c.compress(s) for s in samples)
    assert data[:4] == b"\x5d\x2a\x4d\x18" and list(warc.records(data)) == samples
    assert warc.parse(samples[3])[0]["WARC-Page-Id"] == "3"
