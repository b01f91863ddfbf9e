import hashlib

import numpy as np
import pytest

from barframe.llm import meansearch as ms

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k=16, rounds=3, d=64):
    """Whole numbers of Python, every distance."""
    kept = [(i, [int(np.floor(64.0 * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == d and all(x is not None and np.isfinite(x) for x in v)]
    drawn = sorted(((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None))[:k]
    centroids = [v for _, v in drawn]
    if not centroids:
        return []

    def near(v):
        gaps = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
        return gaps.index(min(gaps)), min(gaps)

    for _ in range(rounds):
        found = [(near(v)[0], v) for _, v in kept]
        for c in {c for c, _ in found}:
            mine = [v for e, v in found if e == c]
            centroids[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    last = [(i, *near(v)) for i, v in kept]
    sums = {c: sum(g for _, e, g in last if e == c) for _, c, _ in last}
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(str((i, c, g, sums[c], sum(sums.values()), text[c])) for i, c, g in last)


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


def points(seed, n, d=64, spread=0.3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(9, d))
    return [[float(x) for x in centres[draw.integers(9)] * draw.uniform(0.2, 2) + draw.normal(size=d) * spread] for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rows = list(enumerate(points(seed, 300)))
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], VECTORS).repartition(5)
    assert rows_of(ms.cluster_vectors(df)) == brute(rows)


@pytest.mark.parametrize("d", [1, 2, 5, 64])
def test_search_is_exact_and_saves_distances(d):
    draw = np.random.default_rng(d)
    vectors = draw.integers(-9, 9, size=(800, d)) * draw.integers(1, 4, size=(800, 1))
    centroids = [list(map(int, c)) for c in draw.integers(-9, 9, size=(16, d))]
    centroids[5] = centroids[3]  # a tie
    number, distance, computed = ms.nearest_centroids(vectors, centroids)
    gaps = ((vectors[:, None] - np.array(centroids)) ** 2).sum(axis=2)
    assert number.tolist() == gaps.argmin(axis=1).tolist() and distance.tolist() == gaps.min(axis=1).tolist()
    assert computed <= len(vectors) * len(centroids) and (d > 5 or computed < 0.7 * len(vectors) * len(centroids))


def test_odd_rows(spark):
    good = points(1, 20)
    nan, inf = float("nan"), float("inf")
    rows = list(enumerate(good)) + [(50, None), (51, []), (52, [1.0] * 63), (53, [None] + [1.0] * 63), (54, [nan] * 64), (55, [inf] * 64), (56, [0.0] * 64), (56, [0.0] * 64), (None, good[0]), (57, [-0.0] * 64)]
    df = spark.createDataFrame([(i, v, None) for i, v in rows], VECTORS).selectExpr("*", "1 as vector", "2 as cluster", "3 as n", "4 as sums", "5 as distance")
    assert rows_of(ms.cluster_vectors(df)) == brute(rows)
    assert rows_of(ms.cluster_vectors(df.where("vec_id < 5"))) == brute(rows[:5])  # fewer vectors than centroids
    for none in (df.limit(0), df.where("vec_id between 50 and 55"), df.where("vec_id is null")):
        got = ms.cluster_vectors(none)
        assert got.collect() == [] and got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_large_components(spark):
    rows = [(i, [float(v * 10_000) for v in p]) for i, p in enumerate(points(2, 30))] + [(99, [3e5] * 64), (98, [-3e5] * 64), (97, [1e7] + [0.5] * 63)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], VECTORS)
    assert rows_of(ms.cluster_vectors(df)) == brute(rows)
