"""N-gram Jaccard join of texts with signature trees.

A text is its set of word shingles (64-bit hashes). Texts with the same set are one class. Two
classes whose similarity reaches the threshold share a shingle among the first few of each in any
common order; the order used puts rare shingles first, so a passage that many texts share is no
such key. A cell holds the classes with one key and comparable sizes. In every cell a tree is
built: its leaves are classes with a token bitmap, its nodes hold the OR of the bitmaps below and
their range of sizes. A dual traversal drops node pairs whose largest possible overlap is too
small. Of the pairs that are left, first up to ``NEAREST`` per class and cell are verified on the
whole sets; where a cell has more, the others are verified unless their classes have become
connected by then. So a group of near copies costs a few pairs per member and loses no link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barframe.llm.arrays import byte_sums, lower_ascii, mix, small_batches, span_hashes, text_chunks, tidy, word_spans
from barframe.llm.components import connected_components
from barframe.session import stored

COUNTER_BITS = 22  # counters of the sketch that orders shingles, 4 MB whatever the input
COUNTER_ROWS = 256  # pieces of the sketch while it is summed
NEAREST = 8  # pairs per class and cell that are verified at once
FILTER_BITS = (20, 27)  # bits of the filter on ids, as a power of two: 16 MB at most
CELL = 4096  # classes of a cell that meet in one tree; larger cells are cut in pieces that meet in pairs
FAN = 8  # children of a tree node
FRONTIER_BYTES = 1 << 24  # bitmaps of the node pairs compared at a time
BUFFER_BYTES = 1 << 23  # rows whose cells are processed together

_MUL = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Likeness:
    """Jaccard similarity of at least ``num / den`` over shingles of ``words`` words."""

    words: int = 3
    num: int = 90
    den: int = 100

    def least(self, n: np.ndarray) -> np.ndarray:
        """The shingles that a set of ``n`` shares with any that is similar to it."""
        return -(-self.num * n // self.den)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` lower-case words, text by text, and where each text's begin
    (rows + 1 places). A text of fewer words has its whole sequence as one run."""
    rows = len(offsets) - 1
    starts, ends, owner = word_spans(data, offsets)
    words = span_hashes(byte_sums(lower_ascii(data)), starts, ends)
    count = np.bincount(owner, minlength=rows)
    first = np.concatenate([[0], np.cumsum(count)])
    made = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    cuts = np.concatenate([[0], np.cumsum(made)])
    at = np.repeat(first[:-1] - cuts[:-1], made) + np.arange(cuts[-1])
    length = np.repeat(np.minimum(count, k), made)
    total = length.astype(np.uint64)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    for i in range(k):
        total = np.where(i < length, mix(total * _MUL + padded[at + i]), total)
    return total, cuts


def _octave(n: int) -> int:
    return max(n, 1).bit_length() - 1


def signature_bits(octave: int) -> int:
    """Bits of the signatures that meet in cells of sizes ``2**octave`` to twice that."""
    return max(64, 1 << (octave + 1))


def wide_bits(octave: int) -> int:
    """Bits of the signatures of crowded cells, in which few tokens share a bit."""
    return 8 * signature_bits(octave)


def signature(tokens: np.ndarray, bits: int) -> bytes:
    """A bitmap with the bit of every token set; halves of a wider one OR to a narrower one."""
    found = np.zeros(bits, dtype=bool)
    found[(tokens >> np.uint64(16)) & np.uint64(bits - 1)] = True
    return np.packbits(found, bitorder="little").tobytes()


# ---- the order of shingles ------------------------------------------------------------


def frequency_sketch(docs: DataFrame, text: str, k: int) -> np.ndarray:
    """How common shingles are, by bucket of their hash: one byte each on a log scale.

    Every task counts its texts in counters of a fixed number and gives them in pieces, which are
    summed piece by piece. The counts only choose an order, any of which gives the same links.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTER_BITS, dtype=np.uint8)
        waiting: list[np.ndarray] = []
        held = 0

        def add() -> None:
            counted = np.bincount(np.concatenate(waiting), minlength=1 << COUNTER_BITS)
            np.minimum(counted + total, 255, out=total, casting="unsafe")
            waiting.clear()

        for batch in batches:
            for _, _, data, at in text_chunks(batch.column(0)):
                hashes, _ = shingle_hashes(data, at, k)
                waiting.append((hashes >> np.uint64(64 - COUNTER_BITS)).astype(np.int32))
                held += len(hashes)
                if held > 1 << COUNTER_BITS:
                    add()
                    held = 0
        if waiting:
            add()
        if total.any():
            pieces = total.reshape(COUNTER_ROWS, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(COUNTER_ROWS), pa.int32()), pa.array([p.tobytes() for p in pieces], pa.binary())], names=["piece", "counts"])

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(np.frombuffer(c.as_buffer(), dtype=np.uint8).astype(np.int64) for b in batches for c in b.column("counts"))
        level = np.minimum(8 * np.log2(1 + total), 255).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([level.tobytes()], pa.binary())], names=["piece", "levels"])

    small_batches(docs.sparkSession)
    counted = docs.select(F.col(text).alias("text")).mapInArrow(tidy(count), "piece int, counts binary")
    rows = counted.groupBy("piece").applyInArrow(merge, "piece int, levels binary").collect()  # 256 rows, 4 MB
    width = (1 << COUNTER_BITS) // COUNTER_ROWS
    levels = np.zeros((COUNTER_ROWS, width), dtype=np.uint8)
    for row in rows:
        levels[row["piece"]] = np.frombuffer(row["levels"], dtype=np.uint8)
    return levels.reshape(-1)


def in_order(tokens: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Sorted tokens in the common order: rare ones first, then by hash."""
    level = levels[(tokens >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
    return tokens[np.argsort(level, kind="stable")]


# ---- sets and classes -------------------------------------------------------------------


def shingle_sets(docs: DataFrame, doc_id: str, text: str, like: Likeness, levels: np.ndarray) -> DataFrame:
    """``(doc_id, n, digest, prefix, sig)`` of every row: size and digest of its set, the shingles
    one of which any similar set shares, and the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in batches:
            for row, end, data, at in text_chunks(batch.column(1)):
                hashes, cuts = shingle_hashes(data, at, like.words)
                sizes, digests, prefixes, sigs = [], [], [], []
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    tokens = np.unique(hashes[a:b])
                    n = len(tokens)
                    sizes.append(n)
                    digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if n else None)
                    prefixes.append(in_order(tokens, order)[: n - int(like.least(n)) + 1].view(np.int64) if n else None)
                    octave = _octave(n)
                    reaches = like.den * n >= like.num << (octave + 1)
                    sigs.append(signature(tokens, signature_bits(octave + reaches)) if n else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, end - row),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array(prefixes, pa.list_(pa.int64())),
                        pa.array(sigs, pa.binary()),
                    ],
                    names=["doc_id", "n", "digest", "prefix", "sig"],
                )

    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return source.mapInArrow(tidy(run), "doc_id long, n long, digest binary, prefix array<long>, sig binary")


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bitmap with the bit of every id of ``ids (doc_id)``, of bounded size: a Bloom filter of one hash."""
    low, high = FILTER_BITS
    bits = 1 << min(high, max(low, (16 * ids.count()).bit_length()))

    def mark(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(bits // COUNTER_ROWS, dtype=bool)
        for batch in batches:
            found[batch.column("place").to_numpy() // COUNTER_ROWS] = True
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(found).tobytes()], pa.binary())], names=["piece", "found"])

    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    placed = ids.select(place.alias("place"), (place % COUNTER_ROWS).cast("int").alias("piece")).distinct()
    filled = np.zeros((bits // COUNTER_ROWS, COUNTER_ROWS), dtype=bool)
    for row in placed.groupBy("piece").applyInArrow(mark, "piece int, found binary").collect():  # 256 rows
        filled[:, row["piece"]] = np.unpackbits(np.frombuffer(row["found"], dtype=np.uint8))
    return filled.reshape(-1)


def token_sets(docs: DataFrame, like: Likeness, ids: DataFrame) -> DataFrame:
    """``(doc_id, tokens)``: the whole sorted sets of the rows of ``docs (doc_id, text)`` with one of
    ``ids``, and of some others that share a bit of the filter; texts are not shuffled."""
    wanted = id_filter(ids)
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(wanted))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(len(wanted)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = whole.column(2).to_numpy()
            hit = (shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
            batch = whole.filter(pa.array(hit == 1))
            for row, end, data, at in text_chunks(batch.column(1)):
                hashes, cuts = shingle_hashes(data, at, like.words)
                sets = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "tokens"])

    return docs.where("doc_id is not null").select("doc_id", "text", place.alias("place")).mapInArrow(tidy(run), "doc_id long, tokens array<long>")


def wide_signatures(docs: DataFrame, like: Likeness, ids: DataFrame) -> DataFrame:
    """``(class_id, n, sig)`` with wide bitmaps of the rows of ``docs`` with one of ``ids``, and of some others."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.array(t.values, dtype=np.int64).view(np.uint64) for t in batch.column(1)]
            octaves = [_octave(len(t)) + (like.den * len(t) >= like.num << (_octave(len(t)) + 1)) for t in sets]
            sigs = [signature(t, wide_bits(o)) for t, o in zip(sets, octaves, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in sets], pa.int64()), pa.array(sigs, pa.binary())], names=["class_id", "n", "sig"])

    return token_sets(docs, like, ids).mapInArrow(tidy(run), "class_id long, n long, sig binary").distinct()


# ---- signature trees --------------------------------------------------------------------


@dataclass
class Level:
    bits: np.ndarray  # nodes x words, the OR of what is below
    low: np.ndarray  # least and largest size below
    high: np.ndarray
    spare: np.ndarray  # most by which a size below exceeds the bits of its own bitmap
    first: np.ndarray  # children: places first[i] to first[i + 1] of the level below


def build_forest(cells: np.ndarray, sizes: np.ndarray, bits: np.ndarray) -> list[Level]:
    """Trees over rows that lie cell by cell; level 0 are the rows, the last level one root per cell."""
    places = np.arange(len(sizes) + 1)
    levels = [Level(bits, sizes, sizes, sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64), places)]
    owner = cells
    while True:
        below = levels[-1]
        new_cell = np.concatenate([[True], owner[1:] != owner[:-1]])
        begin = np.flatnonzero(new_cell)
        inside = np.arange(len(owner)) - np.repeat(begin, np.diff(np.append(begin, len(owner))))
        first = np.flatnonzero(inside % FAN == 0)
        levels.append(
            Level(
                np.bitwise_or.reduceat(below.bits, first, axis=0),
                np.minimum.reduceat(below.low, first),
                np.maximum.reduceat(below.high, first),
                np.maximum.reduceat(below.spare, first),
                np.append(first, len(owner)),
            )
        )
        owner = owner[first]
        if len(owner) == len(begin):
            return levels


def may_match(level: Level, x: np.ndarray, y: np.ndarray, like: Likeness) -> np.ndarray:
    """Whether anything below node ``x`` can be similar to anything below node ``y``."""
    fits = (level.high[x] * like.den >= level.low[y] * like.num) & (level.high[y] * like.den >= level.low[x] * like.num)
    at = np.flatnonzero(fits)
    x, y = x[at], y[at]
    most = np.bitwise_count(level.bits[x] & level.bits[y]).sum(axis=1, dtype=np.int64) + np.minimum(level.spare[x], level.spare[y])
    fits[at] = most * (like.num + like.den) >= like.num * (level.low[x] + level.low[y])
    return fits


def rows_match(level: Level, x: np.ndarray, y: np.ndarray, like: Likeness) -> np.ndarray:
    """As ``may_match`` for two rows, whose own bits are known: each bit that only one of them has
    is a token the other lacks."""
    a, b = level.low[x], level.low[y]
    fits = (a * like.den >= b * like.num) & (b * like.den >= a * like.num)
    at = np.flatnonzero(fits)
    p, q = level.bits[x[at]], level.bits[y[at]]
    both = np.bitwise_count(p & q).sum(axis=1, dtype=np.int64)
    lacks_p = np.bitwise_count(q).sum(axis=1, dtype=np.int64) - both
    lacks_q = np.bitwise_count(p).sum(axis=1, dtype=np.int64) - both
    most = np.minimum(a[at] - lacks_q, b[at] - lacks_p)
    fits[at] = most * (like.num + like.den) >= like.num * (a[at] + b[at])
    return fits


def dual_traversal(levels: list[Level], like: Likeness) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (``x < y``) of the same cell that no bound excludes."""
    roots = np.arange(len(levels[-1].low))
    most = max(1, FRONTIER_BYTES // (levels[0].bits.itemsize * levels[0].bits.shape[1] * FAN * FAN))
    waiting = [(len(levels) - 1, roots, roots)]
    while waiting:
        depth, x, y = waiting.pop()
        if len(x) > most:
            half = len(x) // 2
            waiting += [(depth, x[:half], y[:half]), (depth, x[half:], y[half:])]
            continue
        first = levels[depth].first
        nx, ny = first[x + 1] - first[x], first[y + 1] - first[y]
        many = nx * ny
        pair = np.repeat(np.arange(len(x)), many)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)
        i, j = first[x][pair] + k // ny[pair], first[y][pair] + k % ny[pair]
        keep = (i < j) if depth == 1 else (i <= j)
        keep |= x[pair] != y[pair]
        i, j = i[keep], j[keep]
        below = levels[depth - 1]
        if depth == 1:
            found = rows_match(below, i, j, like)
            if found.any():
                yield i[found], j[found]
        else:
            found = may_match(below, i, j, like)
            if found.any():
                waiting.append((depth - 1, i[found], j[found]))


class Nearest:
    """Of each row its partners of smallest id, at most ``k``, and whether it has more."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.row, self.partner = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.more = np.zeros(len(ids), dtype=bool)

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        row, partner = np.concatenate([self.row, x, y]), np.concatenate([self.partner, self.ids[y], self.ids[x]])
        order = np.lexsort((partner, row))
        row, partner = row[order], partner[order]
        own = np.ones(len(row), dtype=bool)
        own[1:] = (row[1:] != row[:-1]) | (partner[1:] != partner[:-1])
        row, partner = row[own], partner[own]
        first = np.concatenate([[0], np.flatnonzero(row[1:] != row[:-1]) + 1]) if len(row) else np.zeros(0, np.int64)
        rank = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        self.more[row[rank >= self.k]] = True
        self.row, self.partner = row[rank < self.k], partner[rank < self.k]


CELL_KEYS = ("octave", "token", "i", "j")


def cell_pairs(cells: DataFrame, like: Likeness, nearest: int | None, bits: Callable[[int], int] = signature_bits) -> DataFrame:
    """``(a, b, octave, token, i, j)`` of what the trees leave of ``cells (octave, token, i, j, n,
    class_id, sig, component)``: pairs of classes of different components.

    Of each class up to ``nearest`` pairs of a cell are given, and a row with the keys of the cell
    and neither ``a`` nor ``b`` says that it has more; without ``nearest`` all are given. Rows of a
    cell are brought together in order of size; a task holds a few cells at a time.
    """
    keys = list(CELL_KEYS)

    def rows(a: np.ndarray, b: np.ndarray, places: list[np.ndarray] | None = None) -> pa.RecordBatch:
        n, types = len(a) if places is None else len(places[0]), (pa.int32(), pa.int64(), pa.int32(), pa.int32())
        pair = [pa.array(a, pa.int64()), pa.array(b, pa.int64())] if places is None else [pa.nulls(n, pa.int64())] * 2
        where = [pa.nulls(n, t) for t in types] if places is None else [pa.array(p, t) for p, t in zip(places, types, strict=True)]
        return pa.RecordBatch.from_arrays([*pair, *where], names=["a", "b", *keys])

    def pairs(part: pa.Table, octave: int, cell: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, groups, sigs = part["class_id"].to_numpy(), part["component"].to_numpy(), part["sig"].to_pylist()
        width = bits(octave) // 8
        raw = np.empty((len(sigs), width), dtype=np.uint8)
        for r, sig in enumerate(sigs):
            found = np.frombuffer(sig, dtype=np.uint8)
            raw[r] = found if len(found) == width else found[:width] | found[width:]
        best = Nearest(ids, nearest) if nearest else None
        for x, y in dual_traversal(build_forest(cell, part["n"].to_numpy(), raw.view(np.uint64)), like):
            differ = groups[x] != groups[y]
            if best:
                best.add(x[differ], y[differ])
            else:
                yield rows(np.minimum(ids[x], ids[y])[differ], np.maximum(ids[x], ids[y])[differ])
        if best:
            yield rows(np.minimum(ids[best.row], best.partner), np.maximum(ids[best.row], best.partner))
            open_rows = np.flatnonzero(best.more)
            _, at = np.unique(cell[open_rows], return_index=True)
            yield rows(at, at, [part[k].to_numpy()[open_rows[at]] for k in keys])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def cells_of(table: pa.Table) -> np.ndarray:
            columns = [table[k].to_numpy() for k in keys]
            change = np.zeros(len(table), dtype=bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            return np.cumsum(change)

        def process(table: pa.Table) -> Iterator[pa.RecordBatch]:
            cell, octave = cells_of(table), table["octave"].to_numpy()
            edges = [0, *(np.flatnonzero(octave[1:] != octave[:-1]) + 1).tolist(), len(table)]
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                yield from pairs(table.slice(s, e - s), int(octave[s]), cell[s:e])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.nbytes >= BUFFER_BYTES:
                cell = cells_of(held)
                last = int(np.searchsorted(cell, cell[-1]))
                if last:
                    yield from process(held.slice(0, last))
                    held = held.slice(last)
        if held is not None and len(held):
            yield from process(held)

    placed = cells.select(*keys, "n", "class_id", "sig", "component").repartition(*keys).sortWithinPartitions(*keys, "n", "class_id")
    return placed.mapInArrow(tidy(run), "a long, b long, octave int, token long, i int, j int")


# ---- the join ---------------------------------------------------------------------------


def _cells(classes: DataFrame, like: Likeness) -> DataFrame:
    """Classes by key and size: each in the cell of its own octave of sizes and, if sizes of the
    next octave can be similar, in that one too. Rows without a partner of similar size go."""
    octave = (F.length(F.bin("n")) - 1).cast("int")
    next_fits = like.den * F.col("n") >= like.num * F.expr("shiftleft(1L, octave + 1)")
    keyed = (
        classes.select("class_id", "n", F.explode("prefix").alias("token"))
        .withColumn("octave", octave)
        .withColumn("octave", F.explode(F.when(next_fits, F.array("octave", F.col("octave") + 1)).otherwise(F.array("octave"))))
    )
    by_size = Window.partitionBy("octave", "token").orderBy("n")
    before, after = F.lag("n").over(by_size), F.lead("n").over(by_size)
    partner = (F.col("before") * like.den >= F.col("n") * like.num) | (F.col("n") * like.den >= F.col("after") * like.num)
    together = F.count(F.lit(1)).over(Window.partitionBy("octave", "token"))
    paired = keyed.withColumn("before", before).withColumn("after", after).withColumn("members", together).where(partner)
    pieces = F.ceil(F.col("members") / CELL).cast("int")
    own = F.pmod(F.xxhash64("class_id"), F.col("pieces")).cast("int")
    return (
        paired.withColumn("pieces", pieces)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .select("octave", "token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "class_id", "n")
    )


def similar(like: Likeness) -> Column:
    both = F.size(F.array_intersect("left", "right"))
    return like.den * both >= like.num * (F.size("left") + F.size("right") - both)


def verified(pairs: DataFrame, docs: DataFrame, like: Likeness) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets are similar. An id with several texts links by each."""
    nodes = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    tokens = stored(token_sets(docs, like, nodes), "shingle-tokens")
    left, right = (tokens.select(F.col("doc_id").alias(i), F.col("tokens").alias(side)) for i, side in (("a", "left"), ("b", "right")))
    return pairs.join(left, "a").join(right, "b").where(similar(like)).select("a", "b")


def _links_between(cells: DataFrame, links: DataFrame, texts: DataFrame, like: Likeness) -> DataFrame:
    """Links in crowded cells between classes that ``links`` does not connect. Wide bitmaps of the
    classes in these cells leave few pairs that are not similar."""
    known = connected_components(links)
    labelled = cells.join(known, F.col("class_id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "class_id"))
    several = labelled.groupBy(*CELL_KEYS).agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rest = stored(labelled.join(several.select(*CELL_KEYS), list(CELL_KEYS), "left_semi").select(*CELL_KEYS, "class_id", "n", "component"), "shingle-crowded")
    wide = wide_signatures(texts, like, rest.select(F.col("class_id").alias("doc_id")).distinct())
    pairs = stored(cell_pairs(rest.join(wide, ["class_id", "n"]), like, None, wide_bits).select("a", "b").distinct(), "shingle-rest")
    return verified(pairs, texts, like)


def jaccard_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", like: Likeness = Likeness()) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row of ``docs``.

    Texts link when their shingle sets reach the similarity; the component is the smallest id
    reachable by links, the row's own included. A null or empty text, or one without words, has
    the empty set and links with nothing. Rows with one id are one document, which links by each
    of its texts; rows without an id get no component. Other columns are ignored. Classes of
    equal texts are never expanded into pairs, and no cell is capped: one of more than ``CELL``
    classes is cut in pieces whose trees meet pair by pair.
    """
    levels = frequency_sketch(docs, text, like.words)
    sets = stored(shingle_sets(docs, doc_id, text, like, levels), "shingle-sets")
    classes = stored(
        sets.where("n > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("class_id"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("sig").alias("sig")),
        "shingle-classes",
    )
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    cells = stored(_cells(classes, like), "shingle-cells")
    bitmaps = classes.select("class_id", "n", "sig")
    first = stored(cell_pairs(cells.join(bitmaps, ["class_id", "n"]).withColumn("component", F.col("class_id")), like, NEAREST), "shingle-pairs")
    links = stored(verified(stored(first.where("a is not null").select("a", "b").distinct(), "shingle-first"), texts, like), "shingle-links")
    crowded = first.where("a is null").select(*CELL_KEYS).distinct()
    if not crowded.isEmpty():
        links = links.unionByName(_links_between(cells.join(crowded, list(CELL_KEYS), "left_semi"), links, texts, like))
    member = sets.select("doc_id", "n", "digest").join(classes.select("digest", "class_id"), "digest", "left")
    several = member.where("class_id is not null").groupBy("doc_id").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high")).where("low < high")
    same_id = member.join(several.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("class_id").alias("b")).where("b is not null")
    found = connected_components(links.unionByName(same_id))
    return member.join(found, F.col("class_id") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id", "doc_id")).alias("component_id")
    )
