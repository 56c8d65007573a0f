"""Components against union-find."""

import random

import pytest

from larkspur.llm import graph


def plain(edges):
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = find(u), find(v)
            top[max(a, b)] = min(a, b)
    return {x: find(x) for x in top}


def some(nodes, links):
    rng = random.Random(nodes + links)
    return [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(links)]


CASES = {
    "none": [],
    "self": [(3, 3)],
    "repeated": [(1, 2), (2, 1), (1, 2)],
    "path": [(i, i + 1) for i in range(60)],
    "star of the least": [(0, i) for i in range(1, 800)],
    "star of the greatest": [(999, i) for i in range(800)],
    "sparse": some(300, 280),
    "dense": some(300, 700),
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    found = [tuple(r) for r in graph.components(spark.createDataFrame(CASES[name], "u bigint, v bigint")).collect()]
    assert len(found) == len(dict(found)) and dict(found) == plain(CASES[name])
