"""Connected components against union-find."""

import random

import numpy as np
import pytest

from treepref.llm.components import components, forest


def roots(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


RNG = random.Random(1)
GRAPHS = {
    "empty": [], "loop": [(1, 1)], "repeats": [(1, 2), (2, 1), (1, 2)], "star": [(0, i) for i in range(1, 200)],
    "chain": [(i, i + 1) for i in range(300)], "random": [(RNG.randrange(400), RNG.randrange(400)) for _ in range(250)],
}


@pytest.mark.parametrize("chunk", [2, 1 << 20])
@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name, chunk):
    """Small chunks leave the joining of pieces to the star steps."""
    got = components(spark.createDataFrame(GRAPHS[name], "a long, b long"), "a", "b", chunk)
    assert {r["node"]: r["root"] for r in got.collect()} == roots(GRAPHS[name])


@pytest.mark.parametrize("seed", range(20))
def test_forest(seed):
    r = random.Random(seed)
    n = r.choice([5, 60, 400])
    edges = [(r.randrange(n) - n // 2, r.randrange(n) - n // 2) for _ in range(r.choice([1, n // 2, n, 3 * n]))]
    node, low = forest(*(np.array(x, np.int64) for x in zip(*edges)))
    want = roots(edges)
    assert dict(zip(node.tolist(), low.tolist())) == {x: y for x, y in want.items() if x != y}
