"""Nearest neighbours by a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample, and every row is then filed in the leaf with the nearest
centre. A query walks the tree with a priority queue: the node whose centre is nearest opens first, so
leaves come in the order in which they promise neighbours. How many leaves to visit is calibrated:
for some queries the true neighbours among all rows are found by brute force, and the visits widen
until the wanted share of them lies in visited leaves. Neighbouring leaves share a cell; a query goes
to a cell once, with the leaves it visits there, and only their rows are compared. Large cells and
many queries are cut in blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barframe.llm.vectors import dimensions, matrix, pack, unpack, usable
from barframe.session import stored

SAMPLE = 20_000  # rows that the tree is fitted on
BRANCH = 16  # children of a node
LEAF = 16  # sample rows of a leaf that is not split
TARGET = 0.94  # recall to calibrate for; at least 0.9 is promised
CALIBRATION = 256  # queries whose true neighbours are found by brute force
BLOCK = 20_000  # rows, or queries, of a cell that meet in one task
CELLS = 64  # cells of a table that needs fewer for its size
FILED = 1024  # rows filed together


@dataclass
class Tree:
    centres: np.ndarray  # of every node; node 0 is the root
    children: list[list[int]]
    leaf: list[int]  # number of the leaf, -1 for inner nodes

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1


def k_means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """The cluster of each point."""
    centres = points[rng.choice(len(points), k, replace=False)]
    near = np.zeros(len(points), dtype=np.int64)
    for _ in range(rounds):
        near = ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
        for c in range(k):
            if (near == c).any():
                centres[c] = points[near == c].mean(axis=0)
    return near


def build_tree(points: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = 5) -> Tree:
    """The tree over a sample; without points it is a single leaf."""
    rng = np.random.default_rng(seed)
    centres = [points.mean(axis=0) if len(points) else np.zeros(points.shape[1])]
    children: list[list[int]] = [[]]
    waiting = [(0, np.arange(len(points)))]
    while waiting:
        node, members = waiting.pop()
        if len(members) <= leaf:
            continue
        near = k_means(points[members], min(branch, len(members)), rng)
        groups = [members[near == c] for c in np.unique(near)]
        if len(groups) < 2:
            continue
        for group in groups:
            centres.append(points[group].mean(axis=0))
            children.append([])
            children[node].append(len(centres) - 1)
            waiting.append((len(centres) - 1, group))
    leaf_of, numbered, stack = [-1] * len(centres), 0, [0]
    while stack:  # depth first, so that leaves next to each other have numbers next to each other
        node = stack.pop()
        if children[node]:
            stack += children[node]
        else:
            leaf_of[node], numbered = numbered, numbered + 1
    return Tree(np.array(centres), children, leaf_of)


def file_rows(tree: Tree, points: np.ndarray) -> np.ndarray:
    """The leaf with the nearest centre of each point, of all leaves: going down the tree child by child
    ends in another one for rows between two branches, and queries would look for them in vain."""
    centres = np.empty((tree.leaves, tree.centres.shape[1]))
    for node, leaf in enumerate(tree.leaf):
        if leaf >= 0:
            centres[leaf] = tree.centres[node]
    squares, found = (centres**2).sum(axis=1), np.zeros(len(points), dtype=np.int32)
    for row in range(0, len(points), FILED):
        found[row : row + FILED] = (squares - 2 * points[row : row + FILED] @ centres.T).argmin(axis=1)
    return found


def best_bins(tree: Tree, query: np.ndarray) -> Iterator[int]:
    """Leaves in the order of a best-bin-first walk."""
    queue = [(0.0, 0)]
    while queue:
        _, node = heapq.heappop(queue)
        below = tree.children[node]
        if not below:
            yield tree.leaf[node]
        else:
            gaps = ((tree.centres[below] - query) ** 2).sum(axis=1)
            for gap, child in zip(gaps.tolist(), below, strict=True):
                heapq.heappush(queue, (gap, child))


def nearest(
    queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, leaves: np.ndarray | None = None, wanted: list[np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query id, id, distance)`` of the ``k`` nearest points of each query, other ids only,
    ties to the smaller id. Distances are those of the differences in double precision. With
    the ``leaves`` of the points, a query is compared with those in its ``wanted`` ones only."""
    order = np.argsort(ids, kind="stable") if leaves is None else np.lexsort((ids, leaves))
    points, ids = points[order], ids[order]
    if leaves is None:
        edges, wants = [0, len(points)], np.ones((len(queries), 1), dtype=bool)
    else:
        names, first = np.unique(leaves[order], return_index=True)
        edges, wants = [*first.tolist(), len(points)], np.zeros((len(queries), len(names)), dtype=bool)
        for row, leaf in enumerate(wanted):
            wants[row] = np.isin(names, leaf)
    found = [], [], []
    squares = (points**2).sum(axis=1)
    step = max(1, (1 << 21) // max(1, len(points)))
    for begin in range(0, len(queries), step):
        block = queries[begin : begin + step]
        rough = np.full((len(block), len(points)), np.inf)
        for j, (s, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            asked = np.flatnonzero(wants[begin : begin + step, j])
            if len(asked):
                rough[asked, s:e] = squares[s:e] - 2 * block[asked] @ points[s:e].T + (block[asked] ** 2).sum(axis=1)[:, None]
        for row, query, query_id in zip(rough, block, query_ids[begin : begin + step].tolist(), strict=True):
            row[ids == query_id] = np.inf
            some = np.flatnonzero(np.isfinite(row))
            if len(some) > k:
                kth = np.partition(row[some], k - 1)[k - 1]
                some = some[row[some] <= kth + 1e-9 * (1 + abs(kth))]
            gaps = np.sqrt(((points[some] - query) ** 2).sum(axis=1))
            best = np.lexsort((ids[some], gaps))[:k]
            found[0].append(np.full(len(best), query_id))
            found[1].append(ids[some][best])
            found[2].append(gaps[best])
    return tuple(np.concatenate(f) if f else np.zeros(0, t) for f, t in zip(found, (np.int64, np.int64, np.float64), strict=True))


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of ``(query_id, vec_id, score)`` per query, ranked."""
    one = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = one.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _rows(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, leaves: np.ndarray | None = None, wanted: list[np.ndarray] | None = None) -> pa.Table:
    q, i, s = nearest(queries, query_ids, points, ids, k, leaves, wanted)
    return pa.table({"query_id": q, "vec_id": i, "score": s})


def exact_neighbours(rows: DataFrame, sample: pa.Table, d: int, k: int) -> DataFrame:
    """Brute force for a bounded table of queries: every task gives its best, which are merged."""
    given = rows.sparkSession.sparkContext.broadcast((sample["vec_id"].to_numpy(), unpack(sample["raw"], d)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = given.value
        for batch in batches:
            yield from _rows(queries, query_ids, unpack(batch.column(1), d), batch.column(0).to_numpy(), k).to_batches()

    return _best(rows.select("vec_id", "raw").mapInArrow(run, "query_id long, vec_id long, score double"), k)


def search(df: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = 10, target: float = TARGET, calibration: int = CALIBRATION, sample_rows: int = SAMPLE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row with ``is_query`` its ``k`` nearest other rows.

    Nearness is Euclidean distance in double precision, ties go to the smaller id, and ranks begin
    at 1. The tree is fitted on at most ``sample_rows`` rows; all rows are searched, and recall is
    calibrated on at most ``calibration`` queries. Leaves are visited beyond the calibrated number
    until they hold ``k`` rows besides the query's, so a query gets fewer only when there are fewer.
    Null, empty or zero vectors, those with a null or non-finite component, and rows without an id
    take no part. Vectors of different length have no distance; each length among the queries is
    searched by itself. An id with several rows is as near as its nearest. Other columns are ignored.
    """
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = rows.where(usable("vector") & F.col("vec_id").isNotNull())
    result = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for d in dimensions(rows.where("is_query"), "vector"):
        result = _search_length(rows.where(F.size("vector") == d), d, k, target, calibration, sample_rows).unionByName(result)
    return result


def cells_of(held: np.ndarray) -> np.ndarray:
    """The cell of each leaf: runs of leaves with up to ``BLOCK`` rows, or a share of a small table."""
    room = max(1, min(BLOCK, -(-int(held.sum()) // CELLS)))
    cells, number, filled = np.zeros(len(held), dtype=np.int64), 0, 0
    for leaf, n in enumerate(held.tolist()):
        if filled and filled + n > room:
            number, filled = number + 1, 0
        cells[leaf] = number
        filled += n
    return cells


def _search_length(rows: DataFrame, d: int, k: int, target: float, calibration: int, sample_rows: int) -> DataFrame:
    spark = rows.sparkSession
    drawn = rows.select("vec_id", "vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toArrow()
    order = np.lexsort((drawn["vec_id"].to_numpy(),))
    tree = build_tree(matrix(drawn["vector"], d)[order])
    given = spark.sparkContext.broadcast(tree)  # of at most sample_rows rows

    def file(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = matrix(batch.column(2), d)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pack(raw), pa.array(file_rows(given.value, raw))], names=["vec_id", "is_query", "raw", "leaf"])

    filed = stored(rows.select("vec_id", "is_query", "vector").mapInArrow(file, "vec_id long, is_query boolean, raw binary, leaf int"), "leaves")
    held = np.zeros(tree.leaves, dtype=np.int64)
    for r in filed.groupBy("leaf").count().collect():  # at most one row per leaf
        held[r["leaf"]] = r["count"]
    queries = filed.where("is_query").select("vec_id", "raw")
    some = queries.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(calibration).toArrow()
    visits = _calibrated(tree, filed, some, d, k, target)
    cell_of = cells_of(held)
    counts = spark.sparkContext.broadcast((held, cell_of))

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cell_of = counts.value
        for batch in batches:
            ids, vectors, cells, lists = [], [], [], []
            for query_id, raw, query in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), unpack(batch.column(1), d), strict=True):
                leaves, found = [], 0
                for leaf in best_bins(given.value, query):
                    if len(leaves) >= visits and found > k:
                        break
                    leaves.append(leaf)
                    found += held[leaf]
                visited = np.sort(np.array([x for x in leaves if held[x]], dtype=np.int32))
                own = cell_of[visited]
                for cell in np.unique(own).tolist():
                    ids.append(query_id)
                    vectors.append(raw)
                    cells.append(cell)
                    lists.append(visited[own == cell])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(vectors, pa.binary()), pa.array(cells, pa.int64()), pa.array(lists, pa.list_(pa.int32()))], names=["query_id", "raw", "cell", "leaves"]
            )

    probes = queries.mapInArrow(walk, "query_id long, raw binary, cell long, leaves array<int>")
    blocks = F.lit((-(-np.bincount(cell_of, weights=held).astype(np.int64) // BLOCK)).tolist()).cast("array<int>")
    row_blocks = lambda cell: F.greatest(F.get(blocks, cell.cast("int")), F.lit(1))
    query_blocks = max(1, -(-queries.count() // BLOCK))
    own_cell = F.get(F.lit(cell_of.tolist()).cast("array<long>"), F.col("leaf"))
    points = (
        filed.withColumn("cell", own_cell)
        .withColumn("r", F.pmod(F.xxhash64("vec_id"), row_blocks(F.col("cell"))).cast("int"))
        .withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
        .select("cell", "r", "q", "vec_id", "raw", "leaf")
    )
    asked = (
        probes.withColumn("q", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int"))
        .withColumn("r", F.explode(F.sequence(F.lit(0), row_blocks(F.col("cell")) - 1)))
        .select("cell", "r", "q", "query_id", "raw", "leaves")
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        wanted = [np.array(x, dtype=np.int32) for x in left["leaves"].to_pylist()]
        return _rows(unpack(left["raw"], d), left["query_id"].to_numpy(), unpack(right["raw"], d), right["vec_id"].to_numpy(), k, right["leaf"].to_numpy(), wanted)

    met = asked.groupBy("cell", "r", "q").cogroup(points.groupBy("cell", "r", "q")).applyInArrow(meet, "query_id long, vec_id long, score double")
    return _best(met, k)


def _calibrated(tree: Tree, filed: DataFrame, some: pa.Table, d: int, k: int, target: float) -> int:
    """The fewest leaves to visit so that ``target`` of the sample queries' true neighbours are met."""
    if not some.num_rows:
        return 1
    truth = exact_neighbours(filed, some, d, k).join(filed.select("vec_id", "leaf").dropDuplicates(["vec_id"]), "vec_id").select("query_id", "leaf").collect()
    place = {i: {leaf: n for n, leaf in enumerate(best_bins(tree, q))} for i, q in zip(some["vec_id"].to_pylist(), unpack(some["raw"], d), strict=True)}
    needed = np.sort([place[r["query_id"]][r["leaf"]] + 1 for r in truth])
    return int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)]) if len(needed) else 1


def every_hundredth(df: DataFrame) -> DataFrame:
    """Neighbours of the rows whose id is divisible by 100."""
    return search(df, F.col("vec_id") % 100 == 0)
