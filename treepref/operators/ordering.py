"""Global order without a single-partition window.

Spark's ``row_number() OVER (ORDER BY k)`` without ``PARTITION BY`` moves every
row into one task.  Three ways round it:

* :func:`radix_cut` finds the k-th smallest of a hex key by counting its leading
  digits, a few at a time, so that a cut is a filter: no sort and no window;
* :func:`range_positions` sorts by sampled ranges of equal size, writes the
  result and adds each range's offset, whatever the distribution of the key;
* :func:`global_positions` and :func:`grouped_positions` number rows within
  buckets that are monotone in the sort key and add the counts of the buckets
  before.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Parts that quantiles cut a column into.
DEFAULT_BUCKETS = 1024


@dataclass(frozen=True)
class Cut:
    """Where a table of ``n`` rows is cut: ``taken`` rows have a key below ``at``, or equal it
    and are among ``ties`` of the ``tied`` rows that do."""
    n: int
    taken: int
    key: Column
    at: str | None
    ties: int = 0
    tied: int = 0

    def below(self) -> Column:
        """Whether a row lies below the cut; rows that equal it, which only repeated rows do, do not."""
        if self.taken >= self.n:
            return F.lit(True)
        return F.lit(False) if self.at is None else self.key < F.lit(self.at)

    def equal(self) -> Column:
        return self.key == F.lit(self.at) if self.ties else F.lit(False)


def radix_cut(df: DataFrame, keys: Sequence[Column], take: Callable[[int], int], digits: int = 3) -> Cut:
    """The cut that leaves ``take(number of rows)`` rows below it, in the order of ``keys``,
    hex texts of 32 digits that are read one after another.

    Every round counts the next digits of the rows that share the digits found so far: a partial
    aggregate with at most ``16 ** digits`` rows.  A round divides the rows left by about 4096, so
    four of them settle 10**14 rows; a later key is only read where all earlier ones are equal."""
    prefix, used, n, need = "", 1, 0, 0
    while True:
        key = keys[0] if used == 1 else F.concat(*keys[:used])
        rows = df.where(F.startswith(key, F.lit(prefix))) if prefix else df
        cells = sorted(rows.groupBy(F.substring(key, len(prefix) + 1, digits).alias("d")).count().collect())
        if not prefix:
            n = sum(c for _, c in cells)
            need = min(max(take(n), 0), n)
            if need in (0, n):
                return Cut(n, need, key, None)
            taken = need
        for d, c in cells:
            if need == 0:
                return Cut(n, taken, key, prefix + d)
            if need < c:
                prefix += d
                break
            need -= c
        if len(prefix) == 32 * used:
            if used == len(keys):
                return Cut(n, taken, key, prefix, need, c)
            used += 1


def quantiles(df: DataFrame, col: str, n: int = DEFAULT_BUCKETS) -> list:
    """At most ``n - 1`` distinct values that cut the rows into parts of about equal size."""
    got = df.agg(F.percentile_approx(col, [k / n for k in range(1, n)], 20 * n)).first()[0] or []
    return sorted(set(got))


def _n_not_above(col: Column, bounds: list, kind: str) -> Column:
    """How many of the sorted bounds do not exceed the value; about 2 sqrt(n) comparisons."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    lists = lambda x: F.lit(x).cast(f"array<{kind}>") if x else F.array().cast(f"array<{kind}>")
    groups = F.array(*[lists(bounds[k:k + step]) for k in range(0, len(bounds), step)], lists([]))
    count = lambda b: F.size(F.filter(b, lambda x: x <= col))
    top = count(lists(bounds[step - 1::step]))
    return F.transform(F.array(top), lambda t: t * step + count(F.get(groups, t)))[0]


def range_bucket(df: DataFrame, col: str, n_buckets: int = DEFAULT_BUCKETS) -> Column:
    """Bucket of a number by the quantiles of its column, so that clustered values are spread as well."""
    kind = df.schema[col].dataType.simpleString()
    return _n_not_above(F.col(col), quantiles(df, col, n_buckets), kind).cast("bigint")


def value_bucket(df: DataFrame, col: str, n_buckets: int = DEFAULT_BUCKETS) -> tuple[Column, Column]:
    """(bucket by quantiles, whether all rows of the bucket have one value): a value that many rows
    share is a quantile and gets a bucket of its own, which a second key may cut further."""
    kind, bounds = df.schema[col].dataType.simpleString(), quantiles(df, col, n_buckets)
    at = _n_not_above(F.col(col), bounds, kind)
    alone = F.coalesce(F.get(F.lit(bounds).cast(f"array<{kind}>"), at - 1) == F.col(col), F.lit(False)) if bounds else F.lit(False)
    return (2 * at + F.when(alone, 0).otherwise(1)).cast("bigint"), alone


def range_positions(df: DataFrame, order_by: Sequence[Column | str], running: Sequence[str] = ()) -> DataFrame:
    """Add ``pos`` (0-based position) and inclusive running sums ``<c>_cum``.

    Rows are dealt into ranges by bounds that Spark samples, sorted within and written once; a row's
    position is its place in the range plus the sizes of the ranges before, one row for each range."""
    sort = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    # The range in the upper bits of the number, the place in the range in the lower 33.
    sort = materialize(sort.withColumn("_place", F.monotonically_increasing_id()), "ranges")
    sort = sort.withColumn("_part", F.shiftright("_place", 33))
    stats = sort.groupBy("_part").agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_s_{c}") for c in running])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offs = stats.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                        *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in running])
    out = sort.join(offs, "_part").withColumn("pos", F.col("_off") + F.col("_place").bitwiseAND((1 << 33) - 1))
    w = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for c in running:
        out = out.withColumn(f"{c}_cum", F.col(f"_off_{c}") + F.sum(c).over(w))
    return out.drop("_part", "_place", "_off", *[f"_off_{c}" for c in running])


def global_positions(df: DataFrame, order_by: Sequence[str], bucket: Column,
                     running: Sequence[str] = ()) -> DataFrame:
    """Add ``pos`` (0-based position in ``order_by``) and inclusive running sums
    ``<c>_cum`` for each column in ``running``.

    ``bucket`` must be non-decreasing in the sort order.  The buckets may grow in number with the
    data: their offsets are running sums by ranges of buckets (:func:`range_positions`), and the
    join of the offsets is left to AQE.
    """
    b = df.withColumn("_bucket", bucket)
    sums = {"_off": "_n", **{f"_off_{c}": f"_s_{c}" for c in running}}
    stats = b.groupBy("_bucket").agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_s_{c}") for c in running])
    offs = range_positions(stats, ["_bucket"], running=list(sums.values())).select(
        "_bucket", *[(F.col(f"{c}_cum") - F.col(c)).alias(name) for name, c in sums.items()])
    j = b.join(offs, "_bucket")
    w = Window.partitionBy("_bucket").orderBy(*order_by)
    wr = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = j.withColumn("pos", (F.col("_off") + F.row_number().over(w) - 1).cast("bigint"))
    for c in running:
        out = out.withColumn(f"{c}_cum", F.col(f"_off_{c}") + F.sum(c).over(wr))
    return out.drop("_bucket", "_off", *[f"_off_{c}" for c in running])


def seeded_key(seed: int | str, id_col: str) -> Column:
    """Deterministic shuffle key ``md5('<seed>:' || id)`` (same text in DuckDB)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def grouped_positions(df: DataFrame, keys: Sequence[str], order_by: Sequence, buckets: Sequence[Column],
                      running: Sequence[str] = (), totals: bool = False) -> DataFrame:
    """Per-group positions and running sums without sorting a group in one task.

    Within each group (``keys``) rows are cut by ``buckets`` (columns whose
    lexicographic order is non-decreasing in ``order_by``).  Counts and sums per
    (group, bucket) -- at most one row per bucket per group, whatever the
    group's size -- give the offsets; the window that finishes the positions is
    partitioned by (group, bucket), so a group holding a third of all rows is
    spread over its buckets.  Adds ``pos`` (0-based), ``<c>_cum`` (inclusive)
    and, with ``totals``, ``<c>_total`` per group.
    """
    bcols = [f"_gb{i}" for i in range(len(buckets))]
    b = df
    for name, e in zip(bcols, buckets):
        b = b.withColumn(name, e)
    stats = b.groupBy(*keys, *bcols).agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_s_{c}") for c in running])
    before = Window.partitionBy(*keys).orderBy(*bcols).rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")]
    cols += [F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in running]
    if totals:
        cols += [F.sum(f"_s_{c}").over(Window.partitionBy(*keys)).alias(f"{c}_total") for c in running]
    offs = stats.select(*keys, *bcols, *cols)
    # With small groups the offsets are as many as the rows, and no table to broadcast; the window asks for this shuffle anyhow.
    j = b.join(offs.hint("merge"), [*keys, *bcols])
    w = Window.partitionBy(*keys, *bcols).orderBy(*order_by)
    wr = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = j.withColumn("pos", (F.col("_off") + F.row_number().over(w) - 1).cast("bigint"))
    for c in running:
        out = out.withColumn(f"{c}_cum", F.col(f"_off_{c}") + F.sum(c).over(wr))
    return out.drop(*bcols, "_off", *[f"_off_{c}" for c in running])
