import random

import pytest

from barframe.llm import components
from barframe.llm.components import connected_components


def brute(links):
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return sorted((i, root(i)) for i in parent)


@pytest.mark.parametrize(
    "links",
    [
        [],
        [(1, 1), (None, 2), (3, None)],
        [(i, i + 1) for i in range(100)],
        [(0, i) for i in range(1, 60)] + [(99, 50)],
        [(r.randrange(300), r.randrange(300)) for r in [random.Random(1)] for _ in range(180)],
    ],
)
def test_components(spark, links):
    got = connected_components(spark.createDataFrame(links, "a long, b long"))
    assert sorted((r["node"], r["component"]) for r in got.collect()) == brute(links)


@pytest.mark.parametrize("links_of_hub", [1, 3, 256])
@pytest.mark.parametrize(
    "links",
    [
        [(0, i) for i in range(1, 400)] + [(1000, i) for i in range(300, 700)],  # the least and the largest id
        [(500, i) for i in range(400)] + [(500, 900), (900, 901), (950, 951)],
        [(r.randrange(8), r.randrange(8, 600)) for r in [random.Random(2)] for _ in range(900)],
    ],
)
def test_hubs(spark, monkeypatch, links, links_of_hub):
    monkeypatch.setattr(components, "HUB_LINKS", links_of_hub)
    got = connected_components(spark.createDataFrame(links, "a long, b long"))
    assert sorted((r["node"], r["component"]) for r in got.collect()) == brute(links)


def test_hub_rows_are_not_shuffled(spark):
    edges = spark.range(1, 5000).selectExpr("id AS u", "0L AS v").unionByName(spark.range(5000, 5010).selectExpr("id AS u", "id - 4999 AS v"))
    moved = components._star(edges, True, 256)
    assert {(r["u"], r["v"]) for r in moved.collect()} == {(i, 0) for i in range(1, 5000)} | {(5000 + i, 0) for i in range(10)}
    assert "BroadcastHashJoin" in moved._jdf.queryExecution().toString()
