"""Operator 11, phrase collocation mining: weighted de Bruijn graph.

Nodes are runs of three words within a piece of text, an edge is a run of four
that leads from its first three words to its last three.

1. Every piece gives one row for each of its words: an edge where four words
   begin, and else the piece's last three, two or one words (piece ends).
   Equal rows of a stretch of text are summed in the task.
2. One shuffle sorts the rows by ranges, whose bounds come from the runs of some texts; these
   bounds decide on the tasks' sizes alone.  A shorter run's count is the flow out of
   its node: the counts of the edges that begin with it, plus the pieces that end
   in it.  In sorted rows these follow one another, so one pass gives the counts of all
   lengths; what lies on the border of a stretch is added up by an aggregate.
   Only runs that reach the least count go on.
3. A node whose one edge in and one edge out have its own count has no other
   neighbour and no piece end: it is unary.  Edges that meet in unary nodes are
   compacted into paths by doubling pointers; a path never closes a circle, since
   every piece ends.  A unary node lies in longer runs of the same count, so it
   is no candidate and only the edges of paths and the branching nodes go on.
4. A run of m words joins the two runs of m - 1 words that it overlaps, whose
   parts' counts it takes over, so that all cuts are scored within the row.

Joins are on (lang, run): the side that is looked up holds each key once.
The strongest of each language come from two rounds of limited ranks.

Defined results: a null or empty text has no words; a null language is ``und``;
repeated rows count as often as they occur; equal scores and counts are ordered by the
phrase's bytes; an empty table gives an empty result; further columns are
ignored.  A text's words are read whole.  Counts are whole numbers of 64 bits,
scores are computed with decimals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from treepref.llm import textkernel as K
from treepref.session import drop_path, materialize, scratch_path

#: Words of an edge.
LONGEST = 4
LEAST = 30
TOP = 2000
#: A candidate goes if a longer one holds so many percent of its occurrences.
HELD_PERCENT = 80
SCALE = 2_000_000
#: Bytes of text whose equal runs are counted together, and rows of a batch sent.
STRETCH = 1 << 19
SENT = 50_000
#: Texts and runs for each range from which the bounds of the ranges are taken, most runs, and bytes of a bound.
BOUND_TEXTS = 20
BOUND_RUNS = 50
BOUND_MOST = 100_000
BOUND_BYTES = 32
#: Parts of a language in the first round of ranks.
PARTS = 64
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
#: Bytes that end a piece.
_CUT = np.zeros(256, bool)
_CUT[list(b".,;:!?\n\x0b\x0c\r")] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _first(gram: Column, n: int) -> Column:
    return F.substring_index(gram, " ", n)


def _last(gram: Column, n: int) -> Column:
    return F.substring_index(gram, " ", -n)


def _texts(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Byte spans as an Arrow text column."""
    size = ends - starts
    offs = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offs[1:])
    data = buf[np.arange(int(offs[-1])) + np.repeat(starts - offs[:-1], size)]
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offs), pa.py_buffer(data)).cast(pa.string())


def runs(buf: np.ndarray, offs: np.ndarray, lang: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of all words of some texts, equal ones counted: (bytes, starts, ends, texts' numbers, counts).

    A run is the ``longest`` words from a word on, or fewer at the piece's end, each with a space after it."""
    buf = K.LOWER[buf]
    starts, ends, doc = K.runs(buf, offs, ~(_BLANK | _CUT)[buf])
    if not len(starts):
        z = np.zeros(0, np.int64)
        return buf, z, z, z, z
    # The words alone, with one space after each.
    size = ends - starts + 1
    first = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=first[1:])
    flat = np.full(int(first[-1]), 0x20, np.uint8)
    at = np.ones(int(first[-1]), bool)
    at[first[1:] - 1] = False
    inside = np.zeros(len(buf), bool)
    inside[:] = ~(_BLANK | _CUT)[buf]
    flat[at] = buf[inside]
    # Whether the next word is in the same piece.
    cuts = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(_CUT[buf], out=cuts[1:])
    goes = np.zeros(len(starts), bool)
    goes[:-1] = (doc[1:] == doc[:-1]) & (cuts[starts[1:]] == cuts[ends[:-1]])
    words = K.span_hashes(buf, starts, ends), K.span_hashes(~buf, starts, ends)
    m = np.ones(len(starts), np.int64)
    key = [K.mix(w + lang[doc] * _STEP) for w in words]
    on = np.arange(len(starts))
    for k in range(1, longest):
        on = on[goes[on + k - 1]]
        m[on] += 1
        for h, w in zip(key, words):
            h[on] = K.mix(h[on] * _STEP + w[on + k])
    # Equal runs by a hash of 128 bits: sorted by half of it, told apart by both.
    order = np.argsort(key[0])
    new = np.ones(len(order), bool)
    new[1:] = (key[0][order[1:]] != key[0][order[:-1]]) | (key[1][order[1:]] != key[1][order[:-1]])
    place = np.flatnonzero(new)
    one = order[place]
    return flat, first[one], first[one + m[one]], doc[one], np.diff(np.append(place, len(order)))


def _beginnings(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int = BOUND_BYTES) -> np.ndarray:
    """The first ``size`` bytes of spans, shorter ones filled with zeros: a row each."""
    at = starts[:, None] + np.arange(size)
    return np.where(at < ends[:, None], buf[np.minimum(at, len(buf) - 1)], 0).astype(np.uint8)


def ranges(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each span the number of ``bounds`` (sorted, of type S) that are not above its first bytes."""
    if not len(bounds):
        return np.zeros(len(starts), np.int32)
    first = lambda x: np.ascontiguousarray(x[:, :8]).view(">u8").ravel().astype(np.uint64)
    keys = first(bounds.view(np.uint8).reshape(len(bounds), BOUND_BYTES))
    head = first(_beginnings(buf, starts, ends, 8))
    out = np.searchsorted(keys, head, side="right")
    # Spans that share a bound's first eight bytes are compared further.
    tied = np.flatnonzero(np.searchsorted(keys, head) < out)
    more = _beginnings(buf, starts[tied], ends[tied]).view(bounds.dtype).ravel()
    out[tied] = np.searchsorted(bounds, more, side="right")
    return out.astype(np.int32)


def _bounds(df: DataFrame, longest: int, parts: int) -> np.ndarray:
    """Bounds of ``parts`` ranges of about equally many runs, from the runs of some texts."""
    texts, there = BOUND_TEXTS * parts, df.count()
    some = df.sample(min(1.0, texts / there), seed=11) if there > texts else df
    runs = some.mapInArrow(_counted(longest, np.zeros(0, f"S{BOUND_BYTES}")), _COUNTED).orderBy(F.xxhash64("run", "lang"))
    runs = runs.select(F.substring("run", 1, BOUND_BYTES).alias("run")).limit(min(BOUND_RUNS * parts, BOUND_MOST))
    got = np.sort(np.array([r["run"].encode() for r in runs.collect()], f"S{BOUND_BYTES}"))
    return np.unique(got[np.arange(1, parts) * len(got) // parts]) if len(got) else got


_COUNTED = "lang string, run string, f long, part int"


def _counted(longest: int, bounds: np.ndarray):
    """Counts of the runs of each stretch of texts, with the number of their range."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column(0).fill_null("und").dictionary_encode()
            code, names = langs.indices.to_numpy(zero_copy_only=False).astype(np.uint64), langs.dictionary
            for i, j, buf, offs in K.chunks(b.column(1), STRETCH):
                flat, starts, ends, doc, n = runs(buf, offs, code[i:j], longest)
                for k in range(0, len(starts), SENT):
                    part = slice(k, k + SENT)
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array(code[i:j][doc[part]].astype(np.int64))), _texts(flat, starts[part], ends[part]),
                         pa.array(n[part]), pa.array(ranges(flat, starts[part], ends[part], bounds))], ["lang", "run", "f", "part"])
    return rows


def _flows(longest: int, least: int):
    """Flow out of every node of a sorted stretch of rows: the sum of the rows that begin with its words.

    A node whose rows may go on in the stretch before or after is sent whatever its sum, any other if it reaches
    the least count; m = 0 has the sum of all rows."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            langs = b.column(0).dictionary_encode()
            code, names = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64), langs.dictionary
            text, f = b.column(1).cast(pa.large_string()), b.column(2).to_numpy()
            _, where, data = text.buffers()
            offs = np.frombuffer(where, np.int64, len(text) + 1, text.offset * 8)
            buf, offs = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]
            ends = np.flatnonzero(buf == 0x20)
            starts = np.concatenate([[0], ends[:-1] + 1])
            word = np.searchsorted(starts, offs[:-1])
            m = np.diff(np.append(word, len(starts)))
            h = K.span_hashes(buf, starts, ends)
            key = K.mix(code.astype(np.uint64) * _STEP)
            total = np.bincount(code, weights=f, minlength=len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(np.zeros(len(names), np.int32)), pa.array([""] * len(names)), pa.array(total)], ["lang", "m", "gram", "f"])
            # The rows of each language in their order.
            on = np.argsort(code, kind="stable")
            for k in range(1, longest + 1):
                on = on[m[on] >= k]
                if not len(on):
                    break
                key[on] = K.mix(key[on] * _STEP + h[word[on] + k - 1])
                new = np.ones(len(on), bool)
                new[1:] = key[on[1:]] != key[on[:-1]]
                place = np.flatnonzero(new)
                flow = np.add.reduceat(f[on], place)
                # The first and the last node of each language.
                other = np.flatnonzero(np.diff(code[on[place]])) + 1
                sent = flow >= least
                sent[[0, -1, *other, *(other - 1)]] = True
                at = on[place[sent]]
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(code[at])), pa.array(np.full(len(at), k, np.int32)),
                     _texts(buf, offs[at], ends[word[at] + k - 1]), pa.array(flow[sent])], ["lang", "m", "gram", "f"])
    return rows


def frequent(df: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(lang, m, gram, f): runs of m = 1 to ``longest`` words with count f >= least, and with m = 0 each language's words."""
    texts, parts = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.mapInArrow(_counted(longest, _bounds(texts, longest, parts)), _COUNTED)
    # In the order of the runs the edges out of a node and the pieces that end in it follow one another.
    # The run comes first in the order, since sorting compares the first bytes of the first column.
    # Ranges by bounds of our own, as ``repartitionByRange`` would make all runs twice to find its bounds.
    rows = rows.repartitionById(parts, "part").select("lang", "run", "f").sortWithinPartitions("run", "lang")
    rows = rows.mapInArrow(_flows(longest, least), "lang string, m int, gram string, f long")
    rows = rows.groupBy("lang", "m", "gram").agg(F.sum("f").alias("f"))
    return rows.where((F.col("f") >= least) | (F.col("m") == 0))


def _with_parts(longer: DataFrame, shorter: DataFrame, m: int) -> DataFrame:
    """Runs of m words with the counts of all their first and last parts, taken from the two runs they overlap."""
    a = shorter.select("lang", F.col("gram").alias("head"), F.col("firsts").alias("a"))
    b = shorter.select("lang", F.col("gram").alias("tail"), F.col("lasts").alias("b"))
    out = longer.withColumns({"head": _first(F.col("gram"), m - 1), "tail": _last(F.col("gram"), m - 1)})
    out = out.join(a, ["lang", "head"]).join(b, ["lang", "tail"])
    return out.select("lang", "gram", "f", F.concat("a", F.array("f")).alias("firsts"), F.concat("b", F.array("f")).alias("lasts"))


def _scored(runs: DataFrame, m: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) by the lowest-scoring cut."""
    cuts = [F.struct(F.expr(f"cast(f as decimal(20, 0)) * {SCALE} div cast(firsts[{k - 1}] + lasts[{m - k - 1}] as decimal(20, 0))")
                     .alias("score"), F.lit(k).alias("k"), F.col("firsts")[k - 1].alias("l"), F.col("lasts")[m - k - 1].alias("r"))
            for k in range(1, m)]
    cut = F.array_min(F.array(*cuts))
    return runs.withColumn("cut", cut).select("lang", F.col("gram").alias("phrase"), F.col("f").alias("a"), F.col("cut.l").alias("l"),
                                              F.col("cut.r").alias("r"), F.col("cut.score").cast("long").alias("score"))


def links(edges: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, node, gram, next): edges that meet in a unary node.  ``edges`` has the counts of its parts."""
    n = longest - 1
    into = edges.where(F.col("f") == F.col("lasts")[n - 1]).select("lang", _last(F.col("gram"), n).alias("node"), "gram")
    out = edges.where(F.col("f") == F.col("firsts")[n - 1]).select("lang", _first(F.col("gram"), n).alias("node"), F.col("gram").alias("next"))
    return into.join(out, ["lang", "node"])


def compacted(meets: DataFrame) -> DataFrame:
    """(lang, gram, head, place): the edges that follow another in a path, the path's first edge and their place from 1.

    ``meets`` are the links, a written table.  Pointers double, so the rounds are the
    logarithm of the longest path, which no text's words exceed."""
    spark, path = meets.sparkSession, scratch_path(meets.sparkSession, "paths")
    at = materialize(meets.select("lang", F.col("next").alias("gram"), F.col("gram").alias("head"), F.lit(1).cast("long").alias("place")),
                     path=path)
    while True:
        up = at.select("lang", F.col("gram").alias("head"), F.col("head").alias("top"), F.col("place").alias("steps"))
        before, path = path, scratch_path(spark, "paths")
        nxt = materialize(at.join(up, ["lang", "head"], "left").select(
            "lang", "gram", F.coalesce("top", "head").alias("head"), (F.col("place") + F.coalesce("steps", F.lit(0))).alias("place"),
            F.col("top").isNotNull().alias("moved")), path=path)
        drop_path(spark, before)
        at = nxt.drop("moved")
        if nxt.where("moved").isEmpty():
            return at


def paths(at: DataFrame) -> DataFrame:
    """(lang, head, passage): the words of every compacted path.  A path lies within one piece of a text."""
    rest = at.groupBy("lang", "head").agg(F.array_sort(F.collect_list(F.struct("place", _last(F.col("gram"), 1).alias("word")))).alias("w"))
    return rest.select("lang", "head", F.concat_ws(" ", F.col("head"), F.array_join(F.col("w.word"), " ")).alias("passage"))


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST,
                 top: int = TOP, held_percent: int = HELD_PERCENT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, passage): the strongest phrases of each language.

    ``passage`` is the compacted path that a phrase of ``longest`` words lies in, if it lies in one."""
    spark = df.sparkSession
    found = materialize(frequent(df, text, lang, longest, least), "runs")
    total = found.where("m = 0").select("lang", F.col("f").alias("n"))
    runs = found.where("m = 1").select("lang", "gram", "f", F.array("f").alias("firsts"), F.array("f").alias("lasts"))
    by_length = {1: runs}
    for m in range(2, longest + 1):
        runs = materialize(_with_parts(found.where(F.col("m") == m).select("lang", "gram", "f"), runs, m), "parts")
        by_length[m] = runs
    meets = materialize(links(runs, longest), "links")
    at = compacted(meets)
    out = None
    for m in range(2, longest + 1):
        some = by_length[m]
        if m == longest - 1:
            some = some.join(meets.select("lang", F.col("node").alias("gram")), ["lang", "gram"], "left_anti")
        if m < longest:
            # The most that a run one word longer holds of it; runs longer still hold no more than those.
            above = by_length[m + 1]
            above = above.select("lang", _first(F.col("gram"), m).alias("gram"), F.col("f").alias("g")).unionByName(
                above.select("lang", _last(F.col("gram"), m).alias("gram"), F.col("f").alias("g")))
            above = above.groupBy("lang", "gram").agg(F.max("g").alias("g"))
            dec = lambda c: F.col(c).cast("decimal(20, 0)")
            some = some.join(above, ["lang", "gram"], "left").where(
                F.col("g").isNull() | (dec("g") * 100 < dec("f") * held_percent)).drop("g")
        out = _scored(some, m) if out is None else out.unionByName(_scored(some, m))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    best = out.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = best.where(F.col("rank") <= top).drop("part")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    best = materialize(best.join(total, "lang"), "best")
    # The paths of these phrases; an edge without a row in ``at`` may be the first of a path.
    edge = best.select("lang", F.col("phrase").alias("gram"))
    held = at.join(edge, ["lang", "gram"], "left_semi").select("lang", "gram", "head")
    heads = at.select("lang", F.col("head").alias("gram"), "head").join(edge, ["lang", "gram"], "left_semi").distinct()
    held = held.unionByName(heads)
    named = paths(at.join(held.select("lang", "head").distinct(), ["lang", "head"], "left_semi"))
    held = held.join(named, ["lang", "head"]).select("lang", F.col("gram").alias("phrase"), "passage")
    out = best.join(held, ["lang", "phrase"], "left")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "passage")
