"""Operator 8, MinHash near-dedup: signature-coordinate inverted join.

Texts become sets of word shingles; equal sets form a class.  Each class has a
MinHash signature and is posted under (coordinate, value) pairs.

* Prefix: two signatures that agree in at least ``t`` of ``k`` coordinates share
  a pair among the ``k - t + 1`` rarest of either (rarest by global counts), so
  only those are posted; pairs held by one class need no posting at all.
* Skip: the other coordinates are not merged list by list; once two classes
  meet in a posting, their signatures are compared in full and those with fewer
  than ``t`` agreements are skipped.
* Pairs that remain are confirmed on full shingle sets.

A list first ties its members to one leader, the member whose pairs are the
most common (the consensus text of a group), which is linear in the list.  Lists
that still hold several groups are compared across them in blocks of bounded
size; each member names its few closest partners there, and this is repeated
until no list names any.  So groups are closed under the match threshold, while a
list of near copies yields about as many pairs as it has members.  Leader pairs
are confirmed first; inside a group, whatever they leave unlinked is compared in
full with the rest of the group, again in blocks.  No pair above the match
threshold stays untested unless its two texts are already in one component.

``t`` is set from the binomial law: a pair at the similarity threshold agrees in
fewer than ``t`` coordinates with probability below ``miss``.

Defined results: null, empty or blank texts have empty sets and are linked with
nothing (their component is their own id); fewer words than a shingle make one
shingle of the whole sequence; rows with one id twice count as two texts of that
id; a null id is ignored when the smallest id is taken; an empty table gives an
empty result.  Shingles are compared by 54-bit and sets by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from treepref.llm import textkernel as K
from treepref.llm.components import components
from treepref.session import drop_path, materialize, scratch_path

COORDINATES = 48
MISS = 1e-5
#: Members of a block; two blocks at most are compared in one group.
BLOCK = 1024
#: Partners that a member of a list names in a round.
BEST = 4
#: About so many bytes of shingle sets make a block of the exact check.
SET_BYTES = 4 << 20
#: Tasks that the members of one group are dealt to before their blocks are known.
SALTS = 64
_BITS = np.uint64(10)


def match_threshold(k: int, similarity: float, miss: float) -> int:
    """Largest t with P(Binomial(k, similarity) < t) <= miss."""
    total, t = 0.0, 0
    while t < k:
        total += math.comb(k, t) * similarity ** t * (1 - similarity) ** (k - t)
        if total > miss:
            return t
        t += 1
    return k


def _coefficients(k: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.Generator(np.random.PCG64(20240611))
    a = r.integers(1, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, r.integers(0, 2**63, k, dtype=np.uint64)


def _sets(buf: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every text: (texts with any, first index, number, sorted hashes)."""
    buf = K.LOWER[buf]
    starts, ends, doc = K.words(buf, offs)
    h = K.span_hashes(buf, starts, ends)
    n = np.bincount(doc, minlength=len(offs) - 1)
    at, x = K.windows(h, doc, size)
    group = doc[at]
    for m in range(1, size):  # texts of m words: one shingle
        if (few := n[doc] == m).any():
            i, y = K.windows(h[few], doc[few], m)
            group, x = np.concatenate([group, doc[few][i]]), np.concatenate([x, y + np.uint64(m)])
    keys = np.sort((group.astype(np.uint64) << np.uint64(54)) | (K.mix(x) >> _BITS))
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    group = (keys >> np.uint64(54)).astype(np.int64)
    texts, first, number = np.unique(group, return_index=True, return_counts=True)
    return texts, first, number, keys & np.uint64((1 << 54) - 1)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _class_keys(x: np.ndarray, first: np.ndarray, number: np.ndarray) -> np.ndarray:
    return _signed(K.mix(np.add.reduceat(K.mix(x + np.uint64(7)), first) + number.astype(np.uint64)))


def _signatures(docs: DataFrame, size: int, k: int) -> DataFrame:
    """(id, n, cls, sig) of every row of (id, text); the values of a signature have 64 bits."""
    mult, add = _coefficients(k)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, offs in K.chunks(b.column(1), rows=1000):
                texts, first, number, x = _sets(buf, offs, size)
                n, cls, sig = np.zeros(j - i, np.int64), np.zeros(j - i, np.int64), np.zeros((j - i, k), np.int64)
                if len(texts):
                    n[texts], cls[texts] = number, _class_keys(x, first, number)
                    for c in range(k):
                        sig[texts, c] = _signed(np.minimum.reduceat(x * mult[c] + add[c], first))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i + 1) * k, k, dtype=np.int32)),
                                                pa.array(sig.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(n), pa.array(cls), flat],
                                                 ["id", "n", "cls", "sig"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(rows, f"id {kind}, n long, cls long, sig array<long>")


def _full_sets(docs: DataFrame, size: int) -> DataFrame:
    """(cls, grams) of (id, text) rows with words: sorted hashes as 64-bit little-endian integers."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, buf, offs in K.chunks(b.column(1), rows=1000):
                texts, first, number, x = _sets(buf, offs, size)
                if len(texts):
                    grams = [x[f:f + m].tobytes() for f, m in zip(first, number)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_class_keys(x, first, number)), pa.array(grams, pa.binary())], ["cls", "grams"])

    return docs.mapInArrow(rows, "cls long, grams binary")


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def _alike(pairs: DataFrame, classes: DataFrame, k: int, t: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes allow the similarity and whose signatures agree in t coordinates."""
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("cls").alias(side), F.col("n").alias(f"n{side}"),
                                          F.col("sig").alias(f"s{side}")), side)
    pairs = pairs.where(_sizes_fit("na", "nb", percent)).select("a", "b", "sa", "sb")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            same = (_matrix(x.column(2), k) == _matrix(x.column(3), k)).sum(axis=1) >= t
            yield x.select([0, 1]).filter(pa.array(same))

    return pairs.mapInArrow(rows, "a long, b long")


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) by the full sets."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("cls").alias(side), F.col("grams").alias(f"g{side}")), side)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            linked = np.zeros(x.num_rows, bool)
            for i, (p, q) in enumerate(zip(x.column(2), x.column(3))):
                p, q = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                linked[i] = 100 * both >= percent * (len(p) + len(q) - both)
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), pa.array(linked)], ["a", "b", "linked"])

    return pairs.select("a", "b", "ga", "gb").mapInArrow(rows, "a long, b long, linked boolean")


def _postings(classes: DataFrame, k: int, t: int) -> DataFrame:
    """(token, cls, weight): the prefix of each class in order of rarity, without tokens of one class.

    A token is a hash of the coordinate and the whole 64-bit value: with fewer bits,
    unrelated classes would share values, more of them the more classes there are.
    weight: how common the tokens of the class are; the same for all its rows.
    """
    tokens = classes.select("cls", F.posexplode("full").alias("c", "v")).select("cls", F.xxhash64("c", "v").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    w = Window.partitionBy("cls")
    held = tokens.join(shared, "token").select(
        "cls", "token", "df", F.row_number().over(w.orderBy("df", "token")).alias("place"),
        F.count("*").over(w).alias("held"), F.sum(F.log2("df")).over(w).alias("weight"))
    # The tokens of one class come first in the order and use up their part of the prefix.
    return held.where(F.col("place") <= F.lit(k - t + 1) - (F.lit(k) - F.col("held"))).select("token", "cls", "weight")


def _across(lists: DataFrame, k: int, t: int, percent: int) -> DataFrame:
    """Pairs (token, a, b) of one list and different roots that agree in t coordinates.

    lists: (token, size, cls, root, n, sig).  A long list is cut into blocks by a
    hash of the class, and every two blocks form a group of their own.  Each
    member names ``BEST`` partners of a group at most, its closest; a list that
    holds any such pair names at least one.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("cls", "token"), blocks.cast("long")).cast("int")
    dealt = lists.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    groups = dealt.groupBy("token", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")).agg(
        F.collect_list(F.struct("cls", "root", "n", "sig")).alias("m"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            got = []
            for token, m in zip(x.column(0).to_pylist(), x.column(1)):
                v = m.values
                cls, root, n = (v.field(f).to_numpy(zero_copy_only=False) for f in ("cls", "root", "n"))
                sig = _matrix(v.field("sig"), k)
                names, inverse, count = np.unique(root, return_inverse=True, return_counts=True)
                # Pairs inside the largest root need no test, so its members only serve as partners.
                ask = np.flatnonzero(inverse != np.argmax(count))
                for f in range(0, len(ask) if len(names) > 1 else 0, 32):
                    p = ask[f:f + 32]
                    same = (sig[p][:, None, :] == sig[None]).sum(axis=2, dtype=np.int16)
                    lo, hi = np.minimum(n[p][:, None], n), np.maximum(n[p][:, None], n)
                    same[(root[p][:, None] == root) | (100 * lo < percent * hi)] = 0
                    if same.shape[1] > BEST:
                        near = np.argpartition(same, -BEST, axis=1)[:, -BEST:]
                        r, c = np.nonzero(np.take_along_axis(same, near, axis=1) >= t)
                        c = near[r, c]
                    else:
                        r, c = np.nonzero(same >= t)
                    got.append((np.full(len(r), token), np.minimum(cls[p[r]], cls[c]), np.maximum(cls[p[r]], cls[c])))
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(y)) for y in zip(*got)], ["token", "a", "b"])

    return groups.select("token", "m").mapInArrow(rows, "token long, a long, b long")


def _within(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join different link components of one group, by full sets.

    members: (cls, grp, link, n, grams).  The members outside the group's largest
    link component ask; asks and members are dealt into blocks of about
    ``SET_BYTES`` of sets, and every ask block meets every member block once.
    Shared shingles are counted through the block's own postings.  Links that a
    group's earlier links already imply are left out, so it returns fewer links
    than it has members.
    """
    held = members.groupBy("grp", "link").agg(F.count("*").alias("c"), F.sum("n").alias("grams"))
    groups = held.groupBy("grp").agg(F.max(F.struct("c", "link")).alias("top"), F.count("*").alias("links"),
                                     F.sum("grams").alias("grams")).where(
        "links > 1").join(held.select("grp", F.col("link").alias("l"), F.col("grams").alias("g")), "grp")
    groups = groups.where("l <> top.link").groupBy("grp", "top", "grams").agg(F.sum("g").alias("asks"))
    per = lambda c: F.ceil(F.col(c) * 8 / SET_BYTES).cast("int")
    block = lambda c: F.pmod(F.xxhash64("cls", F.lit(c)), F.col(c).cast("long")).cast("int")
    # A group's line is copied to each salt, so that its members, with their sets, meet it in many tasks.
    sizes = groups.select("grp", F.col("top.link").alias("main"), per("grams").alias("mb"), per("asks").alias("ab"),
                          F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = members.withColumn("salt", F.pmod(F.xxhash64("cls", "link"), F.lit(SALTS)).cast("int"))
    full = salted.join(sizes, ["grp", "salt"]).drop("salt")
    key = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    every = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    asks = full.where("link <> main").withColumn("i", block("ab")).withColumn("j", F.explode(every("mb")))
    rest = full.withColumn("j", block("mb")).withColumn("i", F.explode(every("ab")))
    both = asks.withColumn("ask", F.lit(True)).unionByName(rest.withColumn("ask", F.lit(False)))
    # Dealt by block too: a join on the group alone would leave all blocks of a group in one task.
    dealt = both.repartition("grp", "i", "j").groupBy("grp", "i", "j").agg(F.collect_list(F.struct("ask", "cls", "link", "grams")).alias("m"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            got_a, got_b = [], []
            for m in x.column(0):
                v = m.values
                ask, cls, link = (v.field(f).to_numpy(zero_copy_only=False) for f in ("ask", "cls", "link"))
                sets = [np.frombuffer(g.as_buffer(), np.uint64) for g in v.field("grams")]
                _block_links(ask, cls, link, sets, percent, got_a, got_b)
            if got_a:
                yield pa.RecordBatch.from_arrays([pa.array(got_a, pa.int64()), pa.array(got_b, pa.int64())], ["a", "b"])

    return dealt.select("m").mapInArrow(rows, "a long, b long")


def _block_links(ask: np.ndarray, cls: np.ndarray, link: np.ndarray, sets: list[np.ndarray], percent: int,
                 got_a: list, got_b: list) -> None:
    """Append the links of the asks to the members of another link component."""
    member = np.flatnonzero(~ask)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(member)), size[member])
    grams = np.concatenate([sets[i] for i in member])
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    parent = {x: x for x in link.tolist()}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for q in np.flatnonzero(ask):
        lo, hi = np.searchsorted(grams, sets[q], "left"), np.searchsorted(grams, sets[q], "right")
        n = hi - lo
        first = np.cumsum(n) - n
        at = np.arange(int(n.sum())) - np.repeat(first - lo, n)
        both = np.bincount(owner[at], minlength=len(member))
        hit = 100 * both >= percent * (size[member] + size[q] - both)
        for c in member[hit & (link[member] != link[q])]:
            x, y = root(int(link[q])), root(int(link[c]))
            if x != y:
                parent[x] = y
                got_a.append(int(cls[q]))
                got_b.append(int(cls[c]))


def _merged(nodes: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """Components (node, root) after the links (a, b) are added; nodes not named so far are their own roots."""
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("root").alias("r")), side, "left").select(
            F.coalesce("r", side).alias(side), *[c for c in ("a", "b") if c != side])
    step = components(pairs, "a", "b").withColumnsRenamed({"node": "old", "root": "new"})
    new = step.select(F.col("old").alias("node")).join(nodes, "node", "left_anti")
    every = nodes.select("node", "root").unionByName(new.select("node", F.col("node").alias("root")))
    return materialize(every.join(step, every["root"] == step["old"], "left").select(
        "node", F.coalesce("new", "root").alias("root")), name)


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80,
                    coordinates: int = COORDINATES, miss: float = MISS) -> DataFrame:
    """(id, n_shingles, component_id) of every row; linked: 100 * |A and B| >= percent * |A or B|.

    Shingles are ``shingle`` words of the text with A-Z lower-cased.
    """
    spark = df.sparkSession
    k, t = coordinates, match_threshold(coordinates, percent / 100, miss)
    docs = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    sigs = materialize(_signatures(docs, shingle, k), "sigs")
    paths = {x: scratch_path(spark, x) for x in ("classes", "posts", "star")}
    classes = materialize(sigs.where("n > 0").groupBy("cls").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("full")).withColumn(
        # Comparisons of signatures need their upper halves only.
        "sig", F.transform("full", lambda v: F.shiftright(v, 32).cast("int"))), path=paths["classes"])
    posts = materialize(_postings(classes, k, t), path=paths["posts"])

    lead = posts.groupBy("token").agg(F.max(F.struct("weight", "cls")).getField("cls").alias("a"),
                                      F.count("*").alias("size")).where("size > 1").select("token", "a")
    star = posts.join(lead, "token").where("a <> cls").select(
        F.least("a", "cls").alias("a"), F.greatest("a", "cls").alias("b")).distinct()
    star = materialize(_alike(star, classes, k, t, percent), path=paths["star"])

    # Groups: everything that agrees in t coordinates, over as many steps.
    alike = materialize(components(star, "a", "b"), "alike")
    lists = posts
    while True:
        rooted = lists.join(alike, lists["cls"] == alike["node"], "left").select(
            "token", "cls", F.coalesce("root", "cls").alias("root"))
        mixed = rooted.groupBy("token").agg(F.count("*").alias("size"), F.min("root").alias("lo"),
                                            F.max("root").alias("hi")).where("size > 2 and lo <> hi")
        held = rooted.join(mixed.select("token", "size"), "token").join(classes.select("cls", "n", "sig"), "cls")
        found = materialize(_across(held, k, t, percent), "across")
        if found.isEmpty():
            break
        alike = _merged(alike, found.select("a", "b").distinct(), "alike")
        # Roots only merge, so a list that named no pair never will.
        lists = posts.join(found.select("token").distinct(), "token", "left_semi")

    # Full sets of the classes in groups, from their texts.
    wanted = classes.join(alike, F.col("cls") == alike["node"], "left_semi").select(F.col("id").alias("wid"), "cls")
    texts = docs.join(wanted.select("wid").distinct(), docs["id"].eqNullSafe(F.col("wid")), "left_semi")
    paths["sets"] = scratch_path(spark, "sets")
    sets = materialize(_full_sets(texts, shingle).join(wanted.select("cls"), "cls", "left_semi")
                       .dropDuplicates(["cls"]), path=paths["sets"])
    nodes = materialize(components(_confirm(star, sets, percent).where("linked"), "a", "b"), "nodes")
    members = alike.select(F.col("node").alias("cls"), F.col("root").alias("grp")).join(
        nodes.select(F.col("node").alias("cls"), F.col("root").alias("link")), "cls", "left").withColumn(
        "link", F.coalesce("link", "cls")).join(sets, "cls").withColumn("n", F.octet_length("grams") / 8)
    nodes = _merged(nodes, materialize(_within(members, percent), "links"), "nodes")

    named = classes.select("cls", "id").join(nodes, F.col("cls") == nodes["node"], "left").select(
        "cls", "id", F.coalesce("root", "cls").alias("root"))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    of = materialize(named.join(least, "root").select("cls", "component_id"), "named")
    for x in paths.values():
        drop_path(spark, x)
    own = sigs.where("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    rest = sigs.where("n > 0").select("id", "n", "cls").join(of, "cls").select("id", F.col("n").alias("n_shingles"),
                                                                                "component_id")
    return rest.unionByName(own).withColumnRenamed("id", id)
