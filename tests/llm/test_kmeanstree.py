import numpy as np
from pyspark.sql import functions as F

from barframe.llm import kmeanstree

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(ids, points, queries, k=10):
    """Neighbours of each query in double precision, other ids only, ties to the smaller id."""
    out = {}
    for q in queries:
        best = {}
        for i, x in zip(ids, points, strict=True):
            if i != ids[q]:
                gap = float(np.sqrt(((points[q] - x) ** 2).sum()))
                best[i] = min(gap, best.get(i, gap))
        out[ids[q]] = sorted((s, i) for i, s in best.items())[:k]
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((20, 16))
    points = np.concatenate([centres[rng.integers(0, 20, 2000)] + 0.4 * rng.standard_normal((2000, 16)), rng.standard_normal((1000, 16))]).astype(np.float32)
    df = spark.createDataFrame([(i, p.tolist(), 0) for i, p in enumerate(points)], SCHEMA)
    got = {}
    for r in kmeanstree.search(df, F.col("vec_id") % 100 == 0, sample_rows=1000).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(list(range(3000)), points.astype(np.float64), range(0, 3000, 100))
    assert set(got) == set(want)
    hits = 0
    for q, rows in got.items():
        rows.sort()
        assert [r for r, _, _ in rows] == list(range(1, 11))
        truth = {i: s for s, i in want[q]}
        hits += len(truth.keys() & {i for _, i, _ in rows})
        assert all(abs(truth[i] - s) < 1e-12 for _, i, s in rows if i in truth)
        assert [(s, i) for _, i, s in rows] == sorted((s, i) for _, i, s in rows)
    assert hits / (10 * len(want)) >= 0.9


def test_few_rows_ties_and_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [0.5, 1.0], 1), (3, [1.5, 1.0], 1), (2, [1.5, 1.0], 1), (5, [-0.5, 1.0], 1), (100, [0.5, 1.0], 1), (7, [0.0, 0.0], 1), (8, None, 1), (9, [nan, 1.0], 1), (10, [None, 1.0], 1), (200, [0.0, 0.0], 1), (11, [1.0], 1), (None, [0.5, 1.0], 1), (2, [9.0, 9.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as leaf", "2 as raw", "3 as is_query", "4 as vector")
    got = sorted(tuple(r) for r in kmeanstree.every_hundredth(df).collect())
    assert [(q, r, i) for q, r, i, _ in got] == [(0, 1, 100), (0, 2, 2), (0, 3, 3), (0, 4, 5), (100, 1, 0), (100, 2, 2), (100, 3, 3), (100, 4, 5)]
    assert [s for *_, s in got[:4]] == [0.0, 1.0, 1.0, 1.0]
    assert kmeanstree.every_hundredth(df.limit(0)).count() == 0
    mixed = spark.createDataFrame([*rows, (300, [1.0], 1), (301, [3.0], 1), (302, [1.0, 2.0, 3.0], 1)], SCHEMA)
    got = [tuple(r)[:3] for r in kmeanstree.every_hundredth(mixed).collect() if r["query_id"] == 300]
    assert sorted(got) == [(300, 1, 11), (300, 2, 301)]
    assert kmeanstree.every_hundredth(df.where("vec_id = 100")).count() == 0
    assert kmeanstree.every_hundredth(df.where("vec_id % 100 <> 0")).count() == 0


def test_blocks_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, rng.standard_normal(4).tolist(), 0) for i in range(600)], SCHEMA)
    want = sorted(map(tuple, kmeanstree.every_hundredth(df).collect()))
    monkeypatch.setattr(kmeanstree, "BLOCK", 4)
    assert sorted(map(tuple, kmeanstree.every_hundredth(df).collect())) == want


def test_rows_go_to_the_nearest_leaf_and_cells_are_runs():
    rng = np.random.default_rng(4)
    points = rng.standard_normal((3000, 8))
    tree = kmeanstree.build_tree(points[:500])
    centres = {leaf: tree.centres[node] for node, leaf in enumerate(tree.leaf) if leaf >= 0}
    table = np.array([centres[i] for i in range(tree.leaves)])
    filed = kmeanstree.file_rows(tree, points)
    assert filed.tolist() == ((points[:, None] - table) ** 2).sum(axis=2).argmin(axis=1).tolist()
    held = np.bincount(filed, minlength=tree.leaves)
    cells = kmeanstree.cells_of(held)
    assert (np.diff(cells) >= 0).all() and np.diff(cells).max() == 1 and cells[0] == 0
    room = -(-3000 // kmeanstree.CELLS)
    assert all(held[cells == c].sum() <= room or (cells == c).sum() == 1 for c in range(cells[-1] + 1))
    assert sorted(kmeanstree.best_bins(tree, points[0])) == list(range(tree.leaves))


def test_only_wanted_leaves_are_compared():
    rng = np.random.default_rng(5)
    points, queries = rng.standard_normal((400, 6)), rng.standard_normal((9, 6))
    ids, leaves = np.arange(400), rng.integers(0, 12, 400)
    wanted = [np.flatnonzero(rng.random(12) < 0.4) for _ in queries]
    q, i, s = kmeanstree.nearest(queries, np.arange(1000, 1009), points, ids, 5, leaves, wanted)
    for row, leaf in enumerate(wanted):
        mine = np.flatnonzero(np.isin(leaves, leaf))
        gaps = np.sqrt(((points[mine] - queries[row]) ** 2).sum(axis=1))
        best = np.lexsort((mine, gaps))[:5]
        assert i[q == 1000 + row].tolist() == mine[best].tolist() and np.allclose(s[q == 1000 + row], gaps[best])
