"""Connected components by alternating local contraction and star steps.

A local step reads the written edges in tasks of about ``chunk`` edges and
replaces those of each task by a spanning forest of depth one, without a shuffle
and in bounded memory.  What spans tasks is tied by a large-star and a small-star
step: each is a min-aggregate and an equi-join on (node), so a hub with millions
of neighbours is a partial aggregate and a skew-splittable join, never one task's
list.  Every step is written to the shared folder and the edge set stays on the
executors; the driver sees counts only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treepref.session import drop_path, materialize, scratch_path

#: Edges of a task of a local step.
CHUNK = 1 << 18


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it reaches) for all nodes that reach a smaller one."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    rest = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[rest], nodes[label[rest]]


def _contract(e: DataFrame, chunk: int) -> DataFrame:
    """The edges of every task as stars, about ``chunk`` at a time.  e is a written table, whose count reads no rows."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stars() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(us[0]), pa.array(vs[0])], ["u", "v"])

        us, vs, n = [], [], 0
        for x in batches:
            us.append(x.column(0).to_numpy())
            vs.append(x.column(1).to_numpy())
            n += x.num_rows
            if n >= chunk:
                u, v = forest(np.concatenate(us), np.concatenate(vs))
                us, vs, n = [u], [v], len(u)
                if 2 * n >= chunk:
                    yield stars()
                    us, vs, n = [], [], 0
        if n:
            u, v = forest(np.concatenate(us), np.concatenate(vs))
            us, vs = [u], [v]
            yield stars()

    return e.coalesce(e.count() // chunk + 1).mapInArrow(rows, "u long, v long")


def _both(e: DataFrame) -> DataFrame:
    return e.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
                    .alias("e")).select("e.u", "e.v")


def _large(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    n = _both(e)
    m = n.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return n.join(m, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them.  Here u > v in every edge."""
    m = e.groupBy("u").agg(F.min("v").alias("m"))
    tied = e.join(m, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(m.select("u", F.col("m").alias("v"))).distinct()


def _tied(e: DataFrame) -> bool:
    """Whether the edges are stars: a node with a smaller neighbour has no other.  An edge may be held twice."""
    end = lambda c, low, high: F.struct(F.col(c).alias("node"), low.alias("low"), F.lit(high).alias("high"))
    ends = e.select(F.explode(F.array(end("u", F.col("v"), 0), end("v", F.lit(None).cast("long"), 1))).alias("x")).select("x.*")
    held = ends.groupBy("node").agg(F.min("low").alias("lo"), F.max("low").alias("hi"), F.max("high").alias("high"))
    # A node without smaller neighbours has no lo, and the condition is null.
    return held.agg(F.count_if((F.col("lo") < F.col("hi")) | (F.col("lo").isNotNull() & (F.col("high") > 0)))).first()[0] == 0


def components(edges: DataFrame, a: str, b: str, chunk: int = CHUNK) -> DataFrame:
    """(node, root) for every node of ``edges`` (long ids), root being the smallest node it reaches.

    Edges may repeat and point either way; loops are ignored.  No edges: no rows.
    """
    spark = edges.sparkSession
    path = scratch_path(spark, "cc")
    e = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v"), path=path)

    def written(nxt: DataFrame) -> DataFrame:
        nonlocal path
        before, path = path, scratch_path(spark, "cc")
        nxt = materialize(nxt, path=path)
        drop_path(spark, before)
        return nxt

    while True:
        e = written(_contract(e, chunk))
        if _tied(e):
            break
        e = written(_small(_large(e).distinct()))
    # Now every edge goes from a node to the root of its star; several tasks may hold the same one.
    pair = lambda c: F.struct(F.col(c).alias("node"), F.col("v").alias("root"))
    return e.select(F.explode(F.array(pair("u"), pair("v"))).alias("x")).select("x.*").distinct()
