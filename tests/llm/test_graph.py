from __future__ import annotations

import random

import pytest

from uidloom.llm import graph
from uidloom.llm.graph import components


def expected(edges):
    above = {x: x for e in edges for x in e}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        above[max(a, b)] = min(a, b)
    return {x: root(x) for x in above}


@pytest.mark.parametrize(
    "edges",
    [
        [(k, k + 1) for k in range(60)],
        [(0, k) for k in range(1, 50)] + [(100, 101)],
        [(random.Random(k).randrange(200), random.Random(k + 1).randrange(200)) for k in range(0, 260, 2)],
        [(-5, 7), (7, -5), (3, 3), (9, 7)],
    ],
)
@pytest.mark.parametrize("small", [0, 5, 10**6])
def test_components(spark, monkeypatch, small, edges):
    monkeypatch.setattr(graph, "SMALL", small)
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    real = expected([e for e in edges if e[0] != e[1]])
    assert {r["node"]: r["component"] for r in found} == real
    assert len(found) == len(real)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
