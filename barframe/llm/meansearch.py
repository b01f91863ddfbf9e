"""Centroid clustering in whole numbers by equal-average equal-variance search.

For vectors of ``d`` components with sums ``S`` and spreads ``V = sqrt(d * sum(x^2) - S^2)``,
``d * distance^2 >= (S_x - S_c)^2 + (V_x - V_c)^2``. Centroids are put in order of their sums; a
vector starts at its own sum and goes outward to both sides. Once the sums alone are too far
apart, all centroids beyond are too and the vector is done; a centroid whose spread is too far
off is passed over; only the others cost a distance. Bounds may err by rounding only on the side
of keeping a centroid, and distances are whole numbers, so the nearest one is exact.

A round is one pass over the vectors: tasks add up their vectors per centroid, and ``k * d`` sums
reach the driver, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barframe.llm.vectors import matrix
from barframe.session import stored

SCALE = 64  # a component x counts as floor(64 x)
ROOM = 1 << 30  # components below ROOM / d keep every product of the search within 64 bits
CHUNK = 4096  # vectors searched together


def measurable(vector: str, d: int) -> Column:
    """Whether a vector has exactly ``d`` components, none null or non-finite."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce((F.size(v) == d) & finite, F.lit(False))


def whole(points: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` of finite doubles; Python numbers where 64 bits could be too few."""
    with np.errstate(over="ignore"):
        floored = np.floor(points * scale)
    if floored.size == 0 or np.abs(floored).max() * points.shape[1] < ROOM:
        return floored.astype(np.int64)
    exact = [[(scale * n) // q for n, q in (x.as_integer_ratio() for x in row)] for row in points.tolist()]
    return np.array(exact, dtype=object)


def _plain(vectors: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid by all distances, in Python numbers."""
    gaps = np.array([[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids] for v in vectors.tolist()], dtype=object)
    near = np.array([min(range(len(centroids)), key=row.__getitem__) for row in gaps.tolist()], dtype=np.int64)
    return near, gaps[np.arange(len(near)), near]


def _spreads(sums: np.ndarray, squares: np.ndarray, d: int) -> np.ndarray:
    return np.sqrt(d * squares - sums * sums)


def nearest_centroids(vectors: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, int]:
    """``(number, squared distance)`` of the nearest centroid of each vector, ties to the smaller
    number, and how many distances were computed."""
    if not len(vectors):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    d = vectors.shape[1]
    if vectors.dtype == object or max(abs(x) for c in centroids for x in c) * d >= ROOM:
        near, gaps = _plain(vectors, centroids)
        return near, gaps, len(vectors) * len(centroids)
    table = np.array(centroids, dtype=np.int64)
    order = np.argsort(table.sum(axis=1), kind="stable")
    table = table[order]
    c_sums = table.sum(axis=1)
    c_spreads = _spreads(c_sums, (table * table).sum(axis=1), d)
    sums, squares = vectors.sum(axis=1), (vectors * vectors).sum(axis=1)
    spreads = _spreads(sums, squares, d)
    k, n, computed = len(table), len(vectors), 0
    right = np.searchsorted(c_sums, sums)
    left = right - 1
    best, number = np.full(n, np.iinfo(np.int64).max // d), np.full(n, k)
    open_ = np.arange(n)
    far = np.iinfo(np.int64).max
    for _ in range(k):
        a, b = left[open_], right[open_]
        gap_left = np.where(a >= 0, sums[open_] - c_sums[np.maximum(a, 0)], far)
        gap_right = np.where(b < k, c_sums[np.minimum(b, k - 1)] - sums[open_], far)
        to_left = gap_left <= gap_right
        gap = np.minimum(gap_left, gap_right)
        inside = (gap < far) & (np.minimum(gap, 1 << 31) ** 2 <= d * best[open_])
        open_, gap, to_left = open_[inside], gap[inside], to_left[inside]
        if not len(open_):
            break
        at = np.where(to_left, left[open_], right[open_])
        left[open_[to_left]] -= 1
        right[open_[~to_left]] += 1
        apart = np.maximum(np.abs(spreads[open_] - c_spreads[at]) - 1e-6, 0.0)
        near = (gap.astype(np.float64) ** 2 + apart**2) * (1 - 1e-12) <= d * best[open_].astype(np.float64)
        rows, at = open_[near], at[near]
        difference = vectors[rows] - table[at]
        distance = np.einsum("ij,ij->i", difference, difference)
        computed += len(rows)
        better = (distance < best[rows]) | ((distance == best[rows]) & (order[at] < number[rows]))
        best[rows[better]], number[rows[better]] = distance[better], order[at[better]]
    return number, best, computed


def _chunks(batches: Iterable[pa.RecordBatch], place: int, d: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for row in range(0, batch.num_rows, CHUNK):
            part = batch.slice(row, CHUNK)
            yield part, whole(matrix(part.column(place), d), scale)


def first_centroids(rows: DataFrame, k: int, seed: int, d: int, scale: int) -> list[list[int]]:
    """The ``k`` vectors whose ``seed:id`` has the smallest sha256, in that order; rows without an
    id are not drawn, and of equal ids the smaller vector comes first."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    drawn = rows.where("vec_id is not null").select(key.alias("key"), "vector").orderBy("key", "vector").limit(k).collect()
    return whole(np.array([r["vector"] for r in drawn], dtype=np.float64).reshape(-1, d), scale).tolist()


def moved(rows: DataFrame, centroids: list[list[int]], d: int, scale: int) -> list[list[int]]:
    """One round: the floor of the mean of each centroid's vectors; empty ones stay."""
    k = len(centroids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, d), dtype=object), np.zeros(k, dtype=np.int64)
        for _, vectors in _chunks(batches, 0, d, scale):
            near, _, _ = nearest_centroids(vectors, centroids)
            for c in np.unique(near):
                mine = vectors[near == c]
                total[c] += mine.sum(axis=0)
                count[c] += len(mine)
        held = np.flatnonzero(count)
        sums = pa.array([[int(x) for x in total[c]] for c in held], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(count[held], pa.int64()), sums], names=["cluster", "n", "sums"])

    sums = rows.select("vector").mapInArrow(run, "cluster int, n long, sums array<long>")
    added = sums.select("cluster", "n", F.posexplode("sums")).groupBy("cluster", "pos").agg(F.sum("n").alias("n"), F.sum("col").alias("total"))
    table = [list(c) for c in centroids]
    for r in added.collect():  # k * d rows at most
        table[r["cluster"]][r["pos"]] = r["total"] // r["n"]
    return table


def cluster_vectors(
    df: DataFrame, k: int = 16, rounds: int = 3, d: int = 64, scale: int = SCALE, seed: int = 1, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every vector
    with exactly ``d`` components, none null or non-finite; other rows take no part.

    Components count as ``floor(scale * x)``, distances are squared and whole. Centroids start as
    ``first_centroids`` (fewer than ``k`` where there are fewer vectors with an id; without any the
    result is empty), move ``rounds`` times, and every vector is assigned once more. ``distance``
    is added up over the cluster in ``cluster_inertia`` and over all in ``inertia``; the digest is of
    the final centroid's components, joined by commas. Repeated rows count each, a null id stays
    null, and other columns are ignored. Distances and sums beyond the range of a long are an error.
    """
    good = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("vector")).where(measurable("vector", d))
    rows = stored(good, "vectors")
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    centroids = first_centroids(rows, k, seed, d, scale)
    if not centroids:
        return df.sparkSession.createDataFrame([], result)
    for _ in range(rounds):
        centroids = moved(rows, centroids, d, scale)
    final = centroids

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, vectors in _chunks(batches, 1, d, scale):
            near, gaps, _ = nearest_centroids(vectors, final)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(near, pa.int32()), pa.array(gaps.tolist(), pa.int64())], names=["vec_id", "cluster", "distance"])

    assigned = stored(rows.mapInArrow(run, "vec_id long, cluster int, distance long"), "assigned")
    sums = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in final]
    facts = df.sparkSession.createDataFrame(
        [(c, sums[c], sum(sums.values()), digests[c]) for c in sums], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return assigned.join(F.broadcast(facts), "cluster").select(*[c.split()[0] for c in result.split(", ")])  # k rows


def _round_sql(i: int) -> str:
    """Assignment to the centroids ``cent{i}`` as ``near{i}``."""
    return f"""
near{i} AS MATERIALIZED (
    SELECT rid, c, g FROM (
        SELECT v.rid, t.c, CAST(sum((v.x - t.x) * (v.x - t.x)) AS BIGINT) AS g FROM comps v JOIN cent{i} t ON v.pos = t.pos GROUP BY v.rid, t.c
    ) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY g, c) = 1
)"""


def _move_sql(i: int) -> str:
    """The centroids after a round as ``cent{i + 1}``."""
    return f"""
mean{i} AS (
    SELECT n.c, v.pos, sum(v.x) AS s, count(*) AS n FROM near{i} n JOIN comps v ON v.rid = n.rid GROUP BY n.c, v.pos
), cent{i + 1} AS MATERIALIZED (
    SELECT t.c, t.pos, CAST(coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, t.x) AS BIGINT) AS x
    FROM cent{i} t LEFT JOIN mean{i} m ON m.c = t.c AND m.pos = t.pos
)"""


CLUSTER_SQL = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), comps AS MATERIALIZED (
    SELECT rid, pos, CAST(floor(64 * v[pos]) AS BIGINT) AS x FROM kept, range(1, 65) p(pos)
), starts AS MATERIALIZED (
    SELECT rid, row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c FROM kept WHERE vec_id IS NOT NULL
    ORDER BY c LIMIT 16
), cent0 AS MATERIALIZED (
    SELECT s.c, k.pos, k.x FROM starts s JOIN comps k ON k.rid = s.rid
), {", ".join(part for i in range(3) for part in (_round_sql(i), _move_sql(i)))}, {_round_sql(3)}, digests AS (
    SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256 FROM cent3 GROUP BY c
)
SELECT k.vec_id, CAST(n.c AS INTEGER) AS cluster, n.g AS distance, CAST(sum(n.g) OVER (PARTITION BY n.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(n.g) OVER () AS BIGINT) AS inertia, d.centroid_sha256
FROM near3 n JOIN kept k ON k.rid = n.rid JOIN digests d ON d.c = n.c
"""
