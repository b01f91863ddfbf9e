import math

import numpy as np
import pytest

from barframe.llm import covertree

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    ok = {}
    for at, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[at] = np.float32(v).astype(np.float64)
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ok:
        for b in ok:
            if b < a and rows[a][2] == rows[b][2] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / (np.linalg.norm(ok[a]) * np.linalg.norm(ok[b])) >= cosine:
                links[a] += 1
                links[b] += 1
                parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for at, (i, _, _) in enumerate(rows):
        if i is not None:
            least[root(at)] = min(i, least.get(root(at), i))
    return sorted((str(i), links[at], str(least[root(at)] if i is not None else None)) for at, (i, _, _) in enumerate(rows))


def found(spark, rows, **more):
    got = covertree.link_vectors(spark.createDataFrame(rows, SCHEMA), **more).collect()
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)
    return sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in got)


def clusters(seed, groups, each, d, spread):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.standard_normal(d)
        for _ in range(rng.integers(1, each)):
            rows.append((len(rows), (rng.uniform(0.5, 2) * (centre + spread * rng.standard_normal(d))).astype(np.float32).tolist(), g % 2))
    return rows


@pytest.mark.parametrize(("piece", "spread"), [(2048, 0.05), (16, 0.05), (16, 0.11), (8, 0.15)])
def test_links_as_brute_force(spark, piece, spread):
    rows = clusters(piece, 25, 14, 8, spread)
    assert found(spark, rows, piece=piece) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [], 1)]
    rows += [(10, [1.0, 0.0], 2), (None, [1.0, 0.0], 1), (12, [1.0, 0.0, 0.0], 1), (16, [2.0, 0.0, 0.0], 1), (17, [2.0], 1), (13, [1.0, 0.0], 1), (13, [1.0, 0.0], 1), (14, [0.0, 1.0], 1)]
    assert found(spark, rows) == brute(rows)
    assert covertree.link_vectors(spark.createDataFrame(rows, SCHEMA).limit(0)).count() == 0
    assert found(spark, [(1, None, 1), (2, [0.0], 1)]) == [("1", 0, "1"), ("2", 0, "2")]


def test_extra_columns_with_clashing_names(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as class", "'x' as vector", "2 as raw", "3 as weight", "4 as cell")
    assert sorted((r["vec_id"], r["n_links"]) for r in covertree.link_vectors(df).collect()) == [(1, 1), (2, 1)]


def test_tree_covers_and_halves():
    rng = np.random.default_rng(1)
    points = rng.standard_normal((300, 4))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    tree = covertree.build_tree(points)
    assert sorted(tree.members(0)) == list(range(300))
    for node in range(len(tree.centre)):
        far = np.linalg.norm(points[tree.members(node)] - points[tree.centre[node]], axis=1)
        assert far.max() <= tree.radius[node] + 1e-12
        for child in tree.children[node]:
            assert tree.radius[child] <= tree.radius[node] / 2 + 2 * covertree.MARGIN or tree.radius[child] <= 2.0 ** math.floor(math.log2(tree.radius[node])) + covertree.MARGIN
