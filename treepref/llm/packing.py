"""Operator 9, packing by non-negative least squares.

Documents are encoded and cut into full windows and one rest.  The histogram of
rest lengths, at most one count a length, is all that the driver sees.  Shallow
combinations of lengths that fill a window exactly (one, two or three pieces)
are the columns of a non-negative least-squares problem whose right side is the
histogram; rounded down, its solution says how often each combination is used.
What is left is packed greedily, the longest piece first and then the longest
that still fits.  Combinations become intervals of ranks within a length, so
each task looks up the place of its pieces in a table whose size depends on the
window alone.

Defined results: a null or empty text is its end id alone; repeated rows are
documents of their own; a null id stays null; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from treepref.llm import tokens as T
from treepref.session import materialize

ROUNDS = 400


def combinations(window: int, lengths: np.ndarray) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c >= 0, of present lengths that add up to the window."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    there[0] = True
    a, b = np.meshgrid(np.arange(1, window + 1), np.arange(window + 1), indexing="ij")
    c = window - a - b
    ok = (b <= a) & (c >= 0) & (c <= b)
    a, b, c = a[ok], b[ok], c[ok]
    ok = there[a] & there[b] & there[c]
    return np.stack([a[ok], b[ok], c[ok]], axis=1)


def solve(columns: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """x >= 0 that nearly minimises |A x - histogram|, by accelerated projected gradients.

    Column j of A counts the lengths in ``columns[j]``; length 0 counts for nothing.
    """
    n = len(histogram)

    def times(x: np.ndarray) -> np.ndarray:
        y = sum(np.bincount(columns[:, k], weights=x, minlength=n) for k in range(columns.shape[1]))
        y[0] = 0
        return y

    def back(r: np.ndarray) -> np.ndarray:
        r[0] = 0
        return r[columns].sum(axis=1)

    v = np.ones(len(columns))
    for _ in range(30):
        v = back(times(v))
        v /= (norm := np.linalg.norm(v))
    h = histogram.astype(float)
    h[0] = 0
    x = y = np.zeros(len(columns))
    t = 1.0
    for _ in range(rounds):
        nxt = np.maximum(0, y - back(times(y) - h) / norm)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = nxt + (t - 1) / t2 * (nxt - x)
        x, t = nxt, t2
    return x


def plan(histogram: np.ndarray, window: int) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset): from that rank on, pieces of the length
    lie at the offset of consecutive sequences.  Sorted by length and rank."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    rank, sequence, out = np.zeros(window + 1, np.int64), 0, []

    def use(parts: list[int], times: int) -> None:
        nonlocal sequence
        offset = 0
        for p in parts:
            out.append((p, int(rank[p]), sequence, offset))
            rank[p] += times
            left[p] -= times
            offset += p
        sequence += times

    if left.any():
        columns = combinations(window, np.flatnonzero(left))
        x = np.floor(solve(columns, left) + 1e-6).astype(np.int64) if len(columns) else np.zeros(0, np.int64)
        for j in np.argsort(-x, kind="stable")[:int((x > 0).sum())]:
            parts = [int(p) for p in columns[j] if p]
            times = min([int(x[j])] + [int(left[p]) // parts.count(p) for p in parts])
            if times > 0:
                use(parts, times)
    while (top := np.flatnonzero(left)).size:
        parts, space, free = [], window, left.copy()
        while (fit := top[(top <= space) & (free[top] > 0)]).size:
            parts.append(int(fit[-1]))
            free[fit[-1]] -= 1
            space -= int(fit[-1])
        use(parts, min(int(left[p]) // parts.count(p) for p in set(parts)))
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def _pieces(docs: DataFrame, path: str, kind: str, end: int, window: int, cache: int) -> DataFrame:
    """Pieces of every (id, text), with the task and the place among its pieces of that length."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task = T.encoder(path, kind, cache), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        tail = np.array([end], enc.type).tobytes()
        for b in batches:
            for first, ids, ends in enc.column(b.column(1), tail):
                total = np.diff(ends, prepend=0)
                raw = memoryview(ids.astype("<u4").tobytes())
                several = -(-total // window)
                doc = np.repeat(np.arange(len(total)), several)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(several) - several, several)) * window
                size = np.minimum(window, total[doc] - start)
                at = 4 * ((ends - total)[doc] + start)
                crc = [zlib.crc32(raw[f:t]) for f, t in zip(at.tolist(), (at + 4 * size).tolist())]
                order = np.argsort(size, kind="stable")
                names, begin, count = np.unique(size[order], return_index=True, return_counts=True)
                place = np.empty(len(size), np.int64)
                place[order] = np.arange(len(size)) - np.repeat(begin, count) + np.repeat(seen[names], count)
                seen[names] += count
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(first + doc)), pa.array(start), pa.array(size),
                     pa.array(crc, pa.int64()), pa.array(total[doc]),
                     pa.array(np.full(len(size), task, np.int64)), pa.array(place)],
                    ["id", "start", "length", "ids_crc32", "doc_tokens", "task", "place"])
        if cache <= T.SMALL_CACHE:
            T.let_go()

    kind_of = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(rows, f"id {kind_of}, start long, length long, ids_crc32 long, doc_tokens long, "
                                 "task long, place long")


def pack(df: DataFrame, path: str, end: int = 0, window: int = 1024, kind: str = "byte", id: str = "doc_id",
         text: str = "text", cache: int = T.SMALL_CACHE) -> DataFrame:
    """A row for each piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    cache: bytes of a generation of a worker's token cache; more saves encoding and changes no row.  A cache
    of at most ``tokens.SMALL_CACHE`` bytes is let go with its tokenizer at the end of a task, for jobs whose workers
    go on with other stages.
    """
    docs = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    pieces = materialize(_pieces(docs, path, kind, end, window, cache), "pieces")
    counts = materialize(pieces.groupBy("length", "task").agg(F.count("*").alias("c")), "counts")
    histogram = np.zeros(window + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("c").alias("c")).collect():  # at most a row for each length
        histogram[r["length"]] = r["c"]
    table = plan(histogram, window)
    key = (table[:, 0] << 44) + table[:, 1]

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    ranked = pieces.join(ranks, ["length", "task"]).select(
        "id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("place")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(k).to_numpy() for k in (2, 5))
            at = np.searchsorted(key, (length << 44) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(table[at, 2] + rank - table[at, 1]), pa.array(table[at, 3])],
                [*b.schema.names[:5], "sequence_id", "offset"])

    kind_of = docs.schema["id"].dataType.simpleString()
    return ranked.mapInArrow(place, f"id {kind_of}, start long, length long, ids_crc32 long, doc_tokens long, "
                                    "sequence_id long, offset long").withColumnRenamed("id", id)
