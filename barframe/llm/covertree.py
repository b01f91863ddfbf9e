"""Near-duplicate vectors by dual traversal of cover trees.

A cover tree has nested levels of centres with halving radii. Two trees are walked together: a pair
of nodes whose centres are farther apart than their covering radii and the threshold is dropped, one
that lies inside the threshold as a whole links all its members at once, and any other is opened.
The result is the exact set of links, counted per vector and spanned by a forest, never listed pair
by pair.

Among many vectors the first levels of the tree, built on a bounded sample, cut each label into
cells with measured covering radii; cells that are still large are cut in pieces by a hash. A task
holds two pieces that can hold links.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.components import connected_components
from barframe.llm.vectors import dimensions, pack, unpack, usable
from barframe.session import stored

COSINE = 0.98
PIECE = 2048  # vectors of one side of a task
SAMPLE = 4096  # vectors that the centres of the first levels are chosen from, over all labels
SPLIT_LABELS = 256  # labels cut by centres, the largest ones; others are cut by a hash alone
CENTRES = 64  # cells of a label at most
LEAF = 8  # members of a node that is not split further
MARGIN = 1e-7  # rounding of distances of unit vectors
ROWS = 256  # rows of a block of distances


@dataclass
class Tree:
    """Nodes over the rows of ``points`` (unit vectors); a node's members are ``order[start:end]``."""

    points: np.ndarray
    order: np.ndarray
    centre: list[int] = field(default_factory=list)
    radius: list[float] = field(default_factory=list)
    start: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)

    def add(self, centre: int, radius: float, start: int, end: int) -> int:
        self.centre.append(centre)
        self.radius.append(radius)
        self.start.append(start)
        self.end.append(end)
        self.children.append([])
        return len(self.centre) - 1

    def members(self, node: int) -> np.ndarray:
        return self.order[self.start[node] : self.end[node]]

    def opened(self, node: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Centres, radii and nodes one step down; -1 stands for a single member."""
        if self.children[node]:
            below = self.children[node]
            return np.array([self.centre[c] for c in below]), np.array([self.radius[c] for c in below]), below
        members = self.members(node)
        return members, np.zeros(len(members)), [-1] * len(members)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def greedy_net(points: np.ndarray, first: int, members: np.ndarray, radius: float, most: int | None = None) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Centres of ``members``, each with what it covers within ``radius`` and the distances;
    ``first`` is a centre. With ``most`` centres the last one takes whatever is left."""
    groups, left, centre = [], members, first
    while len(left):
        far = distances(points[left], points[centre : centre + 1])[:, 0]
        near = far <= radius
        near |= left == centre
        if most is not None and len(groups) == most - 1:
            near[:] = True
        groups.append((centre, left[near], far[near]))
        left = left[~near]
        centre = int(left[0]) if len(left) else -1
    return groups


def build_tree(points: np.ndarray) -> Tree:
    tree = Tree(points, np.arange(len(points)))
    if not len(points):
        return tree
    far = distances(points, points[:1])[:, 0]
    waiting = [tree.add(0, float(far.max()) + MARGIN, 0, len(points))]
    while waiting:
        node = waiting.pop()
        members = tree.members(node)
        if len(members) <= LEAF or tree.radius[node] <= 4 * MARGIN:
            continue
        level = 2.0 ** math.floor(math.log2(tree.radius[node]))
        level = level / 2 if level >= tree.radius[node] else level
        while True:
            groups = greedy_net(points, tree.centre[node], members, level)
            if len(groups) > 1:
                break
            level /= 2  # the centre covers all members at this radius too
            if level < MARGIN:
                break
        if len(groups) == 1:
            continue
        at = tree.start[node]
        for centre, covered, far in groups:
            tree.order[at : at + len(covered)] = covered
            radius = float(far.max()) + MARGIN if len(covered) > 1 else 0.0
            child = tree.add(centre, radius, at, at + len(covered))
            tree.children[node].append(child)
            waiting.append(child)
            at += len(covered)
    return tree


class Links:
    """Weighted link counts and a spanning forest over the rows of one task."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.counts = np.zeros(len(weights), dtype=np.int64)
        self.parent = list(range(len(weights)))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, rows: Iterable[int], other: int) -> None:
        for i in rows:
            a, b = self.root(i), self.root(other)
            if a != b:
                self.parent[max(a, b)] = min(a, b)

    def all_with_all(self, x: np.ndarray, y: np.ndarray) -> None:
        self.counts[x] += self.weights[y].sum()
        self.counts[y] += self.weights[x].sum()
        self.join([*x.tolist(), *y.tolist()], int(x[0]))

    def within(self, x: np.ndarray) -> None:
        self.counts[x] += self.weights[x].sum() - self.weights[x]
        self.join(x.tolist(), int(x[0]))

    def block(self, x: np.ndarray, y: np.ndarray, linked: np.ndarray) -> None:
        """Links between rows ``x`` and ``y`` where the matrix is true."""
        self.counts[x] += linked @ self.weights[y]
        self.counts[y] += self.weights[x] @ linked
        rows = np.flatnonzero(linked.any(axis=1))
        if not len(rows):
            return
        # least label over links, to and fro until nothing changes
        sub = linked[rows]
        columns = np.flatnonzero(sub.any(axis=0))
        sub = sub[:, columns]
        a, b = x[rows], y[columns]
        top = np.array([self.root(int(i)) for i in a])
        side = np.array([self.root(int(i)) for i in b])
        big = len(self.weights)
        while True:
            new_side = np.minimum(side, np.where(sub, top[:, None], big).min(axis=0))
            new_top = np.minimum(top, np.where(sub, new_side[None, :], big).min(axis=1))
            if (new_top == top).all() and (new_side == side).all():
                break
            top, side = new_top, new_side
        for i, r in zip([*a.tolist(), *b.tolist()], [*top.tolist(), *side.tolist()], strict=True):
            self.join([i], r)


def link_trees(x: Tree, y: Tree, x_rows: np.ndarray, y_rows: np.ndarray, links: Links, cosine: float, raw: np.ndarray) -> None:
    """Find all links between the points of two trees (``x is y``: inside one). ``x_rows`` and
    ``y_rows`` give the row of ``links`` and ``raw`` that a point stands for."""
    reach = math.sqrt(2 - 2 * cosine)
    if not x.centre or not y.centre:
        return
    waiting = [(0, 0)]
    while waiting:
        p, q = waiting.pop()
        same = x is y and p == q
        if same and 2 * x.radius[p] <= reach - MARGIN:
            links.within(x_rows[x.members(p)])
            continue
        cx, rx, nx = x.opened(p)
        cy, ry, ny = (cx, rx, nx) if same else y.opened(q)
        for begin in range(0, len(cx), ROWS):
            block = slice(begin, begin + ROWS)
            dot = x.points[cx[block]] @ y.points[cy].T
            apart = np.sqrt(np.maximum(2 - 2 * dot, 0))
            slack = rx[block][:, None] + ry[None, :]
            near = apart <= slack + reach + MARGIN
            if same:
                near &= np.arange(len(cx))[block][:, None] < np.arange(len(cy))[None, :]
            points = near & (slack == 0)
            linked = points & (dot >= cosine)
            for i, j in np.argwhere(points & (np.abs(dot - cosine) <= 1e-9)).tolist():
                u, v = raw[x_rows[cx[begin + i]]], raw[y_rows[cy[j]]]
                linked[i, j] = (u * v).sum() / (math.sqrt((u * u).sum()) * math.sqrt((v * v).sum())) >= cosine
            if linked.any():
                links.block(x_rows[cx[block]], y_rows[cy], linked)
            for i, j in np.argwhere(near & (slack > 0)).tolist():
                a, b = nx[begin + i], ny[j]
                mine = x.members(a) if a >= 0 else cx[begin + i : begin + i + 1]
                theirs = y.members(b) if b >= 0 else cy[j : j + 1]
                if apart[i, j] + slack[i, j] <= reach - MARGIN:
                    links.all_with_all(x_rows[mine], y_rows[theirs])
                else:
                    # a single member opens as a node of its own
                    waiting.append((a if a >= 0 else _single(x, int(cx[begin + i])), b if b >= 0 else _single(y, int(cy[j]))))
        if same:
            waiting += [(c, c) for c in nx if c >= 0 and x.end[c] - x.start[c] > 1]


def _single(tree: Tree, point: int) -> int:
    at = int(np.flatnonzero(tree.order == point)[0])
    return tree.add(point, 0.0, at, at + 1)


# ---- over a table -----------------------------------------------------------------------


def choose_centres(sample: np.ndarray, labels: list, wanted: dict) -> dict:
    """Unit centres per label: the net of the first halving radius that has as many centres as
    wanted, cut to that number."""
    found = {}
    for label, k in wanted.items():
        points = sample[[i for i, x in enumerate(labels) if x == label]]
        if k < 2 or len(points) < 2:
            continue
        radius = 1.0
        while True:
            groups = greedy_net(points, 0, np.arange(len(points)), radius, k)
            if len(groups) >= min(k, len(points)) or radius < MARGIN:
                break
            radius /= 2
        found[label] = points[[c for c, _, _ in groups]]
    return found


def link_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, piece: int = PIECE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row of ``df``.

    Rows of equal, non-null label link when the cosine of their vectors is at least ``cosine`` in
    double precision. Null, empty or zero vectors and those with a null or non-finite component link
    with nothing. Vectors of different length have no cosine and do not link; each length in the
    table is joined by itself. Equal vectors of a label are one class with a weight. ``n_links`` counts the other rows linked directly, ``component_id`` is the least
    id reachable, ``kept`` says that it is the row's own. Rows without an id count as links of
    others but get no component. Other columns are ignored.
    """
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("vector"), F.col(f"`{label}`").cast("string").alias("label"))
    good = F.col("label").isNotNull() & usable("vector")
    result = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    for d in dimensions(rows.where("label is not null"), "vector"):
        result = _link_usable(rows.where(good & (F.size("vector") == d)), d, cosine, piece).unionByName(result)
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _link_usable(rows: DataFrame, d: int, cosine: float, piece: int) -> DataFrame:
    spark = rows.sparkSession
    classes = stored(rows.groupBy("label", "vector").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("weight")).withColumn("class", F.monotonically_increasing_id()), "vector-classes")
    sizes = {r["label"]: r["count"] for r in classes.groupBy("label").count().where(F.col("count") > piece).orderBy(F.col("count").desc(), "label").limit(SPLIT_LABELS).collect()}
    centres: dict[str, np.ndarray] = {}
    if sizes:
        large = classes.where(F.col("label").isin(list(sizes)))
        drawn = large.orderBy(F.xxhash64("vector"), "label").limit(SAMPLE).select("label", "vector").toArrow()
        sample = np.array(drawn["vector"].to_pylist(), dtype=np.float64).reshape(-1, d)
        sample /= np.linalg.norm(sample, axis=1, keepdims=True)
        centres = choose_centres(sample, drawn["label"].to_pylist(), {k: min(CENTRES, -(-n // piece)) for k, n in sizes.items()})
    reach = math.sqrt(2 - 2 * cosine)
    given = spark.sparkContext.broadcast(centres)  # at most SAMPLE vectors

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = given.value
        for batch in batches:
            raw = np.array(batch.column(3).to_pylist(), dtype=np.float64).reshape(-1, d)
            unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
            labels = batch.column(2).to_pylist()
            cell, far = np.zeros(len(raw), np.int32), np.zeros(len(raw))
            away: list = [None] * len(raw)
            for name in set(labels) & set(cells):
                at = np.array([i for i, x in enumerate(labels) if x == name])
                gaps = distances(unit[at], cells[name])
                cell[at], far[at] = gaps.argmin(axis=1), gaps.min(axis=1)
                for i, g in zip(at.tolist(), gaps, strict=True):
                    away[i] = g
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pack(raw), pa.array(cell), pa.array(far), pa.array(away, pa.list_(pa.float64()))], names=["class", "weight", "label", "raw", "cell", "far", "away"]
            )

    placed = stored(classes.select("class", "weight", "label", "vector").mapInArrow(place, "class long, weight long, label string, raw binary, cell int, far double, away array<double>"), "vector-cells")
    cells = placed.groupBy("label", "cell").agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n")).withColumn("pieces", F.ceil(F.col("n") / piece).cast("int"))
    # one row per label: its cells (at most CENTRES) with radius and number of pieces
    shapes = cells.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("cell", "radius", "pieces"))).alias("cells"))
    met = placed.join(shapes, "label")
    reaches = F.filter("cells", lambda c: (c["cell"] == F.col("cell")) | (F.get("away", c["cell"]) <= c["radius"] + F.lit(reach + 1e-6)))
    own_pieces = F.element_at(F.filter("cells", lambda c: c["cell"] == F.col("cell")), 1)["pieces"]
    tasks = (
        met.withColumn("own", F.pmod(F.col("class"), own_pieces).cast("int"))
        .withColumn("other", F.explode(reaches))
        .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("other.pieces") - 1)))
        .withColumn("mine", F.struct("cell", F.col("own").alias("piece")))
        .withColumn("theirs", F.struct(F.col("other.cell").alias("cell"), F.col("q").alias("piece")))
        .select("label", F.least("mine", "theirs").alias("left"), F.greatest("mine", "theirs").alias("right"), "mine", "class", "weight", "raw")
        .select("label", F.col("left.cell").alias("a"), F.col("left.piece").alias("b"), F.col("right.cell").alias("c"), F.col("right.piece").alias("e"), (F.col("mine") == F.col("left")).alias("first"), "class", "weight", "raw")
    )

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([("first", "descending"), ("class", "ascending")])
        ids, raw = table["class"].to_numpy(), unpack(table["raw"], d)
        unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
        k = int(table["first"].to_numpy(zero_copy_only=False).sum())
        links = Links(table["weight"].to_numpy())
        rows, x = np.arange(len(ids)), build_tree(unit[:k])
        if table["a"][0] == table["c"][0] and table["b"][0] == table["e"][0]:
            link_trees(x, x, rows, rows, links, cosine, raw)
        else:
            link_trees(x, build_tree(unit[k:]), rows[:k], rows[k:], links, cosine, raw)
        some = np.flatnonzero(links.counts)
        root = np.array([links.root(int(i)) for i in some], dtype=np.int64)
        return pa.table({"class": ids[some], "other": ids[root] if len(some) else np.zeros(0, np.int64), "links": links.counts[some]})

    found = stored(tasks.groupBy("label", "a", "b", "c", "e").applyInArrow(work, "class long, other long, links long"), "vector-links")
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    groups = connected_components(found, "class", "other")
    known = classes.select("label", "vector", "class", "weight", "low").join(counts, "class", "left").join(groups, F.col("class") == F.col("node"), "left").withColumn("group", F.coalesce("component", "class"))
    least = known.groupBy("group").agg(F.min("low").alias("component_id"))
    per_class = known.join(least, "group").select(F.col("label").alias("l"), F.col("vector").alias("v"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    return rows.join(per_class, (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v"))).select(
        "vec_id", "n_links", F.when(F.col("vec_id").isNotNull(), F.col("component_id")).alias("component_id")
    )
