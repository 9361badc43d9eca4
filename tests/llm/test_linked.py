"""Connected components by contraction against union-find."""

import random

import pytest

from harborlens.llm import linked


def brute(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {x: find(x) for x in up}


def shapes():
    g = random.Random(9)
    chain = [(i, i + 1) for i in range(-20, 60)]
    g.shuffle(chain)
    star = [(1000, 1001 + i) for i in range(40)] + [(2040 - i, 2041 - i) for i in range(40)]
    loose = [(3000 + g.randint(0, 80), 3000 + g.randint(0, 80)) for _ in range(50)]
    ring = [(5000 + i, 5000 + (i + 7) % 30) for i in range(30)]
    return chain + star + loose + ring + [(1, 1), (9000, 9000), (5, 4), (4, 5)]


@pytest.mark.parametrize("jumps", [1, 2])
def test_components(spark, monkeypatch, jumps):
    monkeypatch.setattr(linked, "JUMPS", jumps)
    edges = shapes()
    got = {r.s: r.c for r in linked.components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()}
    want = brute([e for e in edges if e[0] != e[1]])
    assert got == want
    assert linked.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_classes_joined_by_more_links(spark):
    g = random.Random(4)
    edges = [(a, b) for a, b in shapes() if a != b]
    g.shuffle(edges)
    first, second = edges[::2], edges[1::2]
    classes = linked.components(spark.createDataFrame(first, "a long, b long"))
    got = {r.s: r.c for r in linked.joined(classes, spark.createDataFrame(second, "a long, b long")).collect()}
    assert got == brute(edges)
    same = linked.joined(classes, spark.createDataFrame([], "a long, b long"))
    assert {r.s: r.c for r in same.collect()} == brute(first)
