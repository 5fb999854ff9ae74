"""Operator 5, document fingerprints: threshold-scaled sketch.

A sketch holds every shingle hash of a text below a fixed fraction of the hash
range.  The fraction does not depend on the text, so sketches merge by union and
a text's containment in a very long one is estimated as well as that of two
equals.  A text of at most ``WHOLE`` distinct shingles, of which the fraction
would leave few or none, keeps them all, and its sketch says so.  Two such
sketches are compared exactly, any other two on the fraction that both hold.

All of it is DataFrame expressions: words, shingle hashes and sketches are
higher-order functions on arrays within a row.

``with_next`` pairs every document with the next by ascending id in one shuffle
of the texts: ids are dealt into ranges by quantiles, the first text of the
following range is put at the end of each range as a copy, and a window within
the range looks one row ahead.

Defined results: a null or empty text (and one of white space) has an empty
sketch, likeness 1 to another empty one and 0 to any other; a short text without
a hash below the fraction has likeness 0 to long ones, which tell nothing about
its hashes, and equal sketches have likeness 1; fewer words than a
shingle make one shingle; equal ids are ordered by text; null ids come first;
one document alone is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHINGLE = 5
#: One hash of so many is retained.
SCALE = 8
#: Distinct shingles up to which a text keeps all its hashes.
WHOLE = 128
#: About so many bytes of text form a range of ids.
RANGE_BYTES = 8 << 20
#: Most ranges; beyond them ranges grow, and their windows spill.
MOST_RANGES = 100_000


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Runs of characters other than space and \\t \\n \\v \\f \\r."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """64-bit hashes of all word shingles, repeated ones included."""
    def body(h: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(h) - size),
                              lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))
        return F.when(F.size(h) >= size, windows).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(
            F.array().cast("array<bigint>"))
    return _let(F.transform(words(text), lambda w: F.xxhash64(w)), body)


def _limit(scale: int) -> Column:
    return F.lit(-(1 << 63) + (1 << 64) // scale).cast("bigint")


def _low(hashes: Column, scale: int) -> Column:
    return F.filter(hashes, lambda x: x < _limit(scale))


def _pack(hashes: Column, scale: int, whole: int) -> Column:
    """Sketch of all the distinct hashes of a text."""
    all_ = F.size(hashes) <= whole
    return F.struct(all_.alias("whole"), F.array_sort(F.when(all_, hashes).otherwise(_low(hashes, scale))).alias("hashes"))


def sketch(text: Column, size: int = SHINGLE, scale: int = SCALE, whole: int = WHOLE) -> Column:
    """(whole, hashes): sorted distinct hashes in the lowest ``1 / scale`` of the range, or all of
    them if there are at most ``whole``."""
    return _let(F.array_distinct(shingle_hashes(text, size)), lambda s: _pack(s, scale, whole))


def merge(a: Column, b: Column, scale: int = SCALE, whole: int = WHOLE) -> Column:
    """Sketch of two texts' shingles together, equal to that of their union."""
    both = F.array_union(a["hashes"], b["hashes"])
    rest = F.struct(F.lit(False).alias("whole"), F.array_sort(_low(both, scale)).alias("hashes"))
    return F.when(a["whole"] & b["whole"], _pack(both, scale, whole)).otherwise(rest)


def likeness(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Containment of the smaller sketch in the larger, from 0 to 1, on the range that both hold."""
    def body(p: Column) -> Column:
        x, y = p["x"], p["y"]
        least = F.least(F.size(x), F.size(y))
        return F.when(least > 0, F.size(F.array_intersect(x, y)) / least).otherwise(F.when(a == b, 1.0).otherwise(0.0))
    exact = a["whole"] == b["whole"]
    held = lambda s: F.when(exact, s["hashes"]).otherwise(_low(s["hashes"], scale))
    return _let(F.struct(held(a).alias("x"), held(b).alias("y")), body).cast("double")


def printed(s: Column) -> Column:
    """A sketch as text: its hashes in hexadecimal, after ``all`` if it holds every hash of the text."""
    hashes = F.transform(s["hashes"], lambda x: F.lower(F.hex(x)))
    return F.array_join(F.when(s["whole"], F.concat(F.array(F.lit("all")), hashes)).otherwise(hashes), " ")


def _ranges(docs: DataFrame) -> Column:
    """Number of the id's range, ascending with the id."""
    rows, size = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    n = min(max(1, math.ceil((size or 0) / RANGE_BYTES)), max(1, rows), MOST_RANGES)
    if n == 1:
        return F.when(F.col("id").isNull(), -1).otherwise(0)
    cuts = docs.agg(F.percentile_approx("id", [k / n for k in range(1, n)], max(10_000, 20 * n))).first()[0] or []
    cuts = sorted(set(cuts))
    # Two levels of bounds, so that a row is compared with about 2 sqrt(n) of them.
    step = max(1, math.isqrt(len(cuts)))
    tops = cuts[step - 1::step]
    groups = [cuts[k:k + step] for k in range(0, len(cuts), step)] + [[]]
    below = lambda bounds: F.size(F.filter(bounds, lambda b: b <= F.col("id")))
    longs = lambda x: F.lit(x).cast("array<bigint>") if x else F.array().cast("array<bigint>")
    top = below(longs(tops))
    return F.when(F.col("id").isNull(), F.lit(-1)).otherwise(
        _let(top, lambda t: t * step + below(F.get(F.array(*[longs(g) for g in groups]), t))))


def with_next(df: DataFrame, id: str = "doc_id", text: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """(id, text, next_text) and, for each (name, expression on ``text``) of ``extra``, name and next_name."""
    docs = df.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = docs.withColumn("range", _ranges(docs).cast("int"))
    # The first id of each range; as many as there are bounds, which the driver has drawn.
    least = sorted(dealt.groupBy("range").agg(F.min("id")).collect())
    follows = df.sparkSession.createDataFrame(
        [(r, least[k - 1][0]) for k, (r, _) in enumerate(least)], "range int, goes_to int")
    first = F.col("id").isin([i for _, i in least if i is not None]) | F.col("id").isNull()
    heads = dealt.where(first).join(follows, "range").select("range", "id", "text", "goes_to")
    heads = heads.withColumn("k", F.row_number().over(Window.partitionBy("range").orderBy("text"))).where("k = 1")
    every = dealt.select(F.lit(0).alias("copy"), "range", "id", "text").unionByName(
        heads.select(F.lit(1).alias("copy"), F.col("goes_to").alias("range"), "id", "text"))
    extra = extra or {}
    every = every.withColumns(extra)
    w = Window.partitionBy("range").orderBy("copy", "id", "text")
    ahead = every.withColumns({f"next_{c}": F.lead(c).over(w) for c in ("text", *extra)})
    return ahead.where("copy = 0").drop("copy", "range").withColumnRenamed("id", id)


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter replaced by the first as many characters of the next."""
    n = F.length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - quarter), F.substring(following, F.lit(1), quarter))


def fingerprints(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    rows = with_next(df, id, text, {"sketch": sketch(F.col("text"))})
    rows = rows.select(id, F.length("text").cast("long").alias("n_chars"), "sketch", "next_sketch",
                       edited(F.col("text"), F.col("next_text")).alias("edited"))
    rows = rows.select(id, "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), "sketch", "next_sketch",
                       sketch(F.col("edited")).alias("edited_sketch"))
    return rows.select(id, "n_chars", "edited_sha256", printed(F.col("sketch")).alias("fingerprint"),
                       printed(F.col("edited_sketch")).alias("edited_fingerprint"),
                       likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                       likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
