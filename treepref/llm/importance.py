"""Operator 12, target-distribution importance resampling.

Features of a text are its runs of 1 to ``order`` consecutive words, hashed into
buckets.  Counts of all documents and of all target texts give every bucket a
gain; a document's weight is the floored mean of its features' gains, taken by
array look-up, and its score is the weight plus Gumbel noise keyed by the id.
The documents of highest score are the sample.

The cutoff is found by weighted median-of-medians selection: every block of at
most ``BLOCK`` keys of a task gives its median and its number of keys; the median
of those medians, weighted by the numbers, has at least a quarter of the keys
on either side, so each round discards a guaranteed fraction.  A round is one
pass over the keys left, which are written anew whenever they have shrunk by a
factor of ``SHRINK``; the driver sees a row for each block.  Only the winners
are sorted, by ranges.

Defined results: a null or empty text (or one without words) has no features and
weight 0; the words of a text are taken from the whole text; a null id is an empty
string in the noise's key and comes first among equal scores; rows that share an
id are separate documents, and of rows equal in score and id those with fewer
features come first; ``score`` does not depend on ``least_words``; an empty table
gives an empty result; empty target texts give gains against the smoothing alone.
Ids are whole numbers.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treepref.llm import textkernel as K
from treepref.session import drop_path, materialize, scratch_path

BUCKETS = 10_000
#: Keys of a block, whose median is one row for the driver.
BLOCK = 1 << 20
#: Keys are written anew when fewer than one in so many are left.
SHRINK = 8
#: So few keys left are sorted at once.
LAST = 4096
#: Winners of a range of the final sort.
RANGE_ROWS = 200_000

#: Words are runs of digits, a-z and everything beyond ASCII.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x30:0x3A] = True
_IN_WORD[0x61:0x7B] = True
_IN_WORD[0x80:] = True


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = (c >> np.uint32(1)) ^ np.where(c & 1, np.uint32(0xEDB88320), np.uint32(0)).astype(np.uint32)
    return c


_CRC = _crc_table()
#: Spans beyond so many bytes go to zlib one by one.
_LONG = 64


def crc32(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of byte spans, a byte of all spans at a time."""
    n = ends - starts
    order = np.argsort(-n, kind="stable")
    at, n = starts[order], n[order]
    c = np.full(len(n), 0xFFFFFFFF, np.uint32)
    live = len(n) - np.searchsorted(n[::-1], np.arange(min(int(n[0]), _LONG) if len(n) else 0), side="right")
    for j, m in enumerate(live):
        c[:m] = _CRC[(c[:m] ^ buf[at[:m] + j]) & np.uint32(255)] ^ (c[:m] >> np.uint32(8))
    c = ~c
    for k in range(int(np.searchsorted(-n, -_LONG))):
        c[k] = zlib.crc32(buf[at[k]:at[k] + n[k]])
    out = np.empty_like(c)
    out[order] = c
    return out


def features(buf: np.ndarray, offs: np.ndarray, order: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket and text number of every feature, number of words of every text)."""
    buf = K.LOWER[buf]
    starts, ends, doc = K.runs(buf, offs, _IN_WORD[buf])
    n_words = np.bincount(doc, minlength=len(offs) - 1)
    found, docs = [crc32(buf, starts, ends) % np.uint32(buckets)], [doc]
    if order > 1 and len(starts):
        # The words with one space after each, so that a run of words is a span.
        size = ends - starts + 1
        first = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=first[1:])
        flat = np.full(int(first[-1]), 0x20, np.uint8)
        pos = np.arange(int(first[-1])) - np.repeat(first[:-1], size)
        inside = pos < np.repeat(size - 1, size)
        flat[inside] = buf[(np.repeat(starts, size) + pos)[inside]]
        for k in range(2, order + 1):
            at = np.arange(len(starts) - k + 1)
            at = at[doc[at] == doc[at + k - 1]]
            found.append(crc32(flat, first[at], first[at + k] - 1) % np.uint32(buckets))
            docs.append(doc[at])
    return np.concatenate(found).astype(np.int64), np.concatenate(docs), n_words


def bucket_counts(df: DataFrame, text: str = "text", order: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Number of features of all texts in each bucket; tasks send a row for each bucket at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, buf, offs in K.chunks(b.column(0)):
                total += np.bincount(features(buf, offs, order, buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    rows = df.select(F.col(text).alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect()
    out = np.zeros(buckets, np.int64)
    for k, n in rows:
        out[k] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed ratio of shares, by bucket."""
    s, t, n = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((int(b) + 1) * (s + n) / ((int(a) + 1) * (t + n))))
                     for a, b in zip(corpus, target)], np.int64)


def scored(df: DataFrame, gain: np.ndarray, id: str = "doc_id", text: str = "text", order: int = 1,
           seed: int | str = 2024) -> DataFrame:
    """(id, n_features, n_words, weight, score) of every document."""
    buckets = len(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, offs in K.chunks(b.column(1)):
                bucket, doc, n_words = features(buf, offs, order, buckets)
                n = np.bincount(doc, minlength=j - i)
                weight = K.per_group(gain[bucket], doc, j - i) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(n), pa.array(n_words), pa.array(weight)],
                    ["id", "n_features", "n_words", "weight"])

    rows = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    rows = rows.mapInArrow(weigh, "id long, n_features long, n_words long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h.cast("long") + 0.5) / 4294967296.0)))
    return rows.withColumn("score", F.col("weight") + noise)


#: A key in the order of the draw: high scores first, then null ids, then small ids.  As numbers that ascend.
Key = tuple[int, int, int, int]
KEY = ("k0", "k1", "k2", "k3")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"k0": -F.col("score"), "k1": F.col("id").isNotNull().cast("long"),
                             "k2": F.coalesce("id", F.lit(0)), "k3": F.col("n_features")})


def _below(key: Key, names: tuple[str, ...] = KEY) -> Column:
    """Whether a row's key comes before the given one."""
    out = F.lit(False)
    for name, value in reversed(list(zip(names, key))):
        out = (F.col(name) < value) | ((F.col(name) == value) & out)
    return out


def _same(key: Key, names: tuple[str, ...] = KEY) -> Column:
    out = F.lit(True)
    for name, value in zip(names, key):
        out &= F.col(name) == value
    return out


def _halves(df: DataFrame, pivot: Key | None, block: int) -> list[tuple[int, int, int, Key | None, Key | None]]:
    """For each block of keys: how many come before the pivot, equal it and come after it, and the medians of the
    first and the last of these.  Without a pivot all keys come before."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> pa.RecordBatch:
            k = np.concatenate(held, axis=1)
            k = k[:, np.lexsort(k[::-1])]
            a, e = k.shape[1], 0
            if pivot is not None:
                less, same = np.zeros(k.shape[1], bool), np.ones(k.shape[1], bool)
                for line, value in zip(k, pivot):
                    less |= same & (line < value)
                    same &= line == value
                a, e = int(less.sum()), int(same.sum())
            b = k.shape[1] - a - e
            low = k[:, (a - 1) // 2].tolist() if a else None
            high = k[:, a + e + (b - 1) // 2].tolist() if b else None
            return pa.RecordBatch.from_arrays(
                [pa.array([a]), pa.array([e]), pa.array([b]), pa.array([low], pa.list_(pa.int64())),
                 pa.array([high], pa.list_(pa.int64()))], ["a", "e", "b", "low", "high"])

        held, n = [], 0
        for x in batches:
            for f in range(0, x.num_rows, block):
                part = x.slice(f, block)
                if n + part.num_rows > block:
                    yield told()
                    held, n = [], 0
                held.append(np.stack([c.to_numpy() for c in part.columns]))
                n += part.num_rows
        if n:
            yield told()

    got = df.mapInArrow(rows, "a long, e long, b long, low array<long>, high array<long>").collect()
    return [(r[0], r[1], r[2], tuple(r[3]) if r[3] else None, tuple(r[4]) if r[4] else None) for r in got]


def weighted_median(medians: list[tuple[Key, int]]) -> Key:
    """The key at which half of all weight is reached."""
    medians = sorted(medians)
    half, run = sum(w for _, w in medians) / 2, 0
    for key, w in medians:
        run += w
        if run >= half:
            return key
    return medians[-1][0]


def kth_key(keys: DataFrame, k: int, block: int = BLOCK, last: int = LAST) -> Key:
    """The k-th key (from 1) of a written table of keys, which has at least k rows."""
    spark, path = keys.sparkSession, None
    low, high, pivot = None, None, None
    stored = left = None
    while True:
        active = keys
        if low is not None:
            active = active.where(~_below(low) & ~_same(low))
        if high is not None:
            active = active.where(_below(high))
        if left is not None and left <= last:
            out = tuple(sorted(active.collect())[k - 1])
            break
        if left is not None and left * SHRINK < stored:
            before, path = path, scratch_path(spark, "keys")
            keys = active = materialize(active, path=path)
            if before:
                drop_path(spark, before)
            stored = left
        blocks = _halves(active, pivot, block)
        a, e, b = (sum(x[i] for x in blocks) for i in range(3))
        if stored is None:
            stored = a
        if pivot is not None and a < k <= a + e:
            out = pivot
            break
        if k <= a:
            high, left = pivot, a
            pivot = weighted_median([(x[3], x[0]) for x in blocks if x[0]])
        else:
            low, left, k = pivot, b, k - a - e
            pivot = weighted_median([(x[4], x[2]) for x in blocks if x[2]])
    if path:
        drop_path(spark, path)
    return tuple(int(x) for x in out)


def _ranked(winners: DataFrame, n: int) -> DataFrame:
    """The winners with ``rank`` from 1, sorted by ranges; no task holds more than a range."""
    spark = winners.sparkSession
    parts = max(1, math.ceil(n / RANGE_ROWS))
    order = [F.col("score").desc(), F.col("id").asc_nulls_first(), F.col("n_features")]
    sort = winners.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The number of the partition in the upper bits, the row's place in it in the lower 33.
    sort = materialize(sort.withColumn("place", F.monotonically_increasing_id()), "winners")
    part = F.shiftright("place", 33)
    sizes = sorted(sort.groupBy(part.alias("part")).count().collect())
    starts = np.concatenate([[0], np.cumsum([c for _, c in sizes])])
    offsets = spark.createDataFrame([(p, int(s)) for (p, _), s in zip(sizes, starts)], "part long, before long")
    out = sort.withColumn("part", part).join(offsets, "part")
    return out.withColumn("rank", F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1).drop("part", "before", "place")


def resample(df: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", target_text: str = "text",
             order: int = 1, buckets: int = BUCKETS, percent: int = 10, least_words: int = 20, seed: int | str = 2024,
             block: int = BLOCK, last: int = LAST) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; rank is null for those not drawn."""
    gain = gains(bucket_counts(df, text, order, buckets), bucket_counts(target, target_text, order, buckets))
    rows = materialize(scored(df, gain, id, text, order, seed), "scored")
    able = F.col("n_words") >= least_words
    k = percent * rows.where(able).count() // 100
    shown = [F.col("id").alias(id), "n_features", "weight", "score"]
    if not k:
        return rows.select(*shown, F.lit(None).cast("long").alias("rank"))
    keyed = _keyed(rows)
    cut = kth_key(keyed.where(able).select(*KEY), k, block, last)
    drawn = able & (_below(cut) | _same(cut))
    ranked = _ranked(keyed.where(drawn).drop(*KEY), k)
    # More rows than one may equal the cutoff key.
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    rest = keyed.where(~drawn).select(*shown, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*shown, "rank").unionByName(rest)
