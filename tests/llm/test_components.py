"""Components of stars against a plain union of sets."""

from __future__ import annotations

import random

import pytest

from postroom.llm.components import components, star_components


def plain(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def shapes():
    draw = random.Random(3)
    chain = [(k + 1, k) for k in range(40)]
    star = [(k, k % 3) for k in range(100, 400)] + [(400, 1), (400, 2), (401, 0), (401, 1)]
    loose = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(160)]
    up = [(k, k + 1) for k in range(500, 530)]
    return {"chain": chain, "star": star, "loose": loose, "up": up, "none": []}


@pytest.mark.parametrize("shape", ["chain", "star", "loose", "up", "none"])
def test_same_groups(spark, shape):
    edges = [(a, b) for a, b in shapes()[shape] if a != b]
    df = spark.createDataFrame(edges, "node long, leader long")
    got = {r["node"]: r["root"] for r in star_components(df).collect()}
    want = plain(edges)
    assert len(got) == len(want)
    # Groups are the same; which member names a group may differ.
    names = {}
    for node, root in got.items():
        assert names.setdefault(root, want[node]) == want[node]
    assert len(names) == len(set(want.values()))
    by_pairs = components(df.selectExpr("node AS a", "leader AS b")).collect()
    assert {r["node"]: r["root"] for r in by_pairs} == want
