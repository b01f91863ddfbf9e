"""Shards of fixed capacity by best-fit-decreasing bin packing of indivisible groups.

Documents with equal texts are one group. Groups are taken by falling size, and each enters the
fullest shard that still has room for it; a balanced tree of remaining capacities finds that shard.
Groups of one size are alike, so the packing runs over a catalogue of sizes with their counts: a
shard takes as many of a size as it has room for, which is what one by one would give. The
catalogue has at most ``2**BITS`` small sizes and ``2**(BITS - 1)`` classes of each octave above,
whatever the number of groups; a class counts with its largest group, so no shard overflows (where
shards are only to be even, with the mean of its groups).

The groups themselves are sorted, numbered and looked up in the runs that the packing gives, task
by task. Rows of a group are never gathered: sizes are added up before the shuffle, the join back
to the rows may be split where one text fills a partition, and slots come from a sort.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barframe.session import stored

BITS = 12  # leading bits of a size that the catalogue keeps
PART = 33  # bits of a row's place within its partition (monotonically_increasing_id)

Runs = list[tuple[int, int]]  # (shard, number of groups), in the order of the groups


class Capacities:
    """Remaining capacities of open shards: a treap, whose random priorities keep it balanced.

    Nodes are ``[key, priority, left, right]`` with ``(capacity left, shard)`` as key.
    """

    def __init__(self, seed: int = 1) -> None:
        self.root: list | None = None
        self.draw = np.random.default_rng(seed)

    def add(self, capacity: int, shard: int) -> None:
        low, high = _split(self.root, (capacity, shard))
        self.root = _merge(_merge(low, [(capacity, shard), self.draw.random(), None, None]), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and give the least ``(capacity, shard)`` with room for ``size``."""
        found, node = None, self.root
        while node:
            if node[0][0] >= size:
                found, node = node[0], node[2]
            else:
                node = node[3]
        if found:
            low, rest = _split(self.root, found)
            _, high = _split(rest, (found[0], found[1] + 1))
            self.root = _merge(low, high)
        return found


def _split(node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
    """The nodes below ``key`` and the others."""
    if node is None:
        return None, None
    if node[0] < key:
        low, high = _split(node[3], key)
        node[3] = low
        return node, high
    low, high = _split(node[2], key)
    node[2] = high
    return low, node


def _merge(low: list | None, high: list | None) -> list | None:
    if low is None or high is None:
        return high if low is None else low
    if low[1] > high[1]:
        low[3] = _merge(low[3], high)
        return low
    high[2] = _merge(low, high[2])
    return high


def pack(sizes: Sequence[int], counts: Sequence[int], capacity: int, most: int | None = None, first: int = 0) -> Runs | None:
    """Best fit decreasing of ``counts`` groups of falling ``sizes`` into shards of ``capacity``,
    numbered from ``first``; None once more than ``most`` shards would be open. A group larger than
    the capacity has a shard of its own."""
    free, runs, opened = Capacities(), [], 0
    for size, count in zip(sizes, counts, strict=True):
        while count:
            found = free.take_tightest(size)
            if found is None:
                if opened == most:
                    return None
                found, opened = (max(capacity, size), first + opened), opened + 1
            room, shard = found
            taken = min(count, room // size)
            runs.append((shard, taken))
            count -= taken
            if room > taken * size:
                free.add(room - taken * size, shard)
    return runs


def pack_evenly(sizes: Sequence[int], counts: Sequence[int], shards: int) -> Runs:
    """Best fit decreasing into ``shards`` shards of the least capacity that holds all groups.

    Groups above an even share of what is left come first and have a shard each. For the others
    an even share plus the largest group is always enough: if some group found no room, every
    shard would hold more than its even share. Halving finds the least capacity up to one part in
    16,384 of the share.
    """
    sizes, counts, runs = list(sizes), list(counts), []
    left = sum(s * n for s, n in zip(sizes, counts, strict=True))
    while sizes and shards > 1 and sizes[0] * shards > left:
        runs.append((len(runs), 1))
        left, shards, counts[0] = left - sizes[0], shards - 1, counts[0] - 1
        if not counts[0]:
            del sizes[0], counts[0]
    if not sizes:
        return runs
    share = -(-left // shards)
    low, high, first = share, share + sizes[0], len(runs)
    best = pack(sizes, counts, low, shards, first)
    if best is None:
        best = pack(sizes, counts, high, shards, first)
        while high - low > max(1, share >> 14):
            middle = (low + high) // 2
            found = pack(sizes, counts, middle, shards, first)
            low, high, best = (low, middle, found) if found else (middle, high, best)
    return runs + best


def size_class(size: str) -> Column:
    """A size with only its ``BITS`` leading bits."""
    return F.expr(f"shiftleft(shiftright({size}, greatest(length(bin({size})) - {BITS}, 0)), greatest(length(bin({size})) - {BITS}, 0))")


def place_groups(groups: DataFrame, shards: int, capacity: int | None) -> DataFrame:
    """``(text_key, shard)`` of ``groups (text_key, bytes)``.

    What reaches the driver is one row per class of sizes and one per partition; what goes to the
    tasks is the runs.
    """
    sized = stored(groups.orderBy(F.col("bytes").desc(), "text_key").withColumn("place", F.monotonically_increasing_id()), "groups")
    classes = sized.groupBy(size_class("bytes").alias("class")).agg(F.count(F.lit(1)).alias("n"), (F.max("bytes") if capacity else F.ceil(F.avg("bytes"))).alias("size")).collect()
    classes.sort(key=lambda r: -r["class"])
    sizes, counts = [r["size"] for r in classes], [r["n"] for r in classes]
    runs = pack(sizes, counts, capacity) if capacity else pack_evenly(sizes, counts, shards)
    starts = np.cumsum([0, *[n for _, n in runs]])[:-1]
    held = {r["part"]: r["n"] for r in sized.groupBy(F.shiftright("place", PART).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = sorted(held)
    before = np.cumsum([0, *[held[p] for p in parts]])[:-1]
    given = groups.sparkSession.sparkContext.broadcast((starts, np.array([s for s, _ in runs], dtype=np.int32), np.array(parts, dtype=np.int64), before))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, shard, parts, before = given.value
        for batch in batches:
            if batch.num_rows:
                place = batch.column(1).to_numpy()
                number = before[np.searchsorted(parts, place >> PART)] + (place & ((1 << PART) - 1))
                found = shard[np.searchsorted(starts, number, side="right") - 1]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int32())], names=["text_key", "shard"])

    return sized.select("text_key", "place").mapInArrow(run, "text_key binary, shard int")


def shard_documents(df: DataFrame, shards: int = 8, capacity: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every document row.

    ``size`` is the text's UTF-8 bytes plus 1, and documents with equal texts stay together; a null
    text has no bytes and goes with the empty ones. Without ``capacity`` the documents fill exactly
    ``shards`` shards of nearly equal size; a group above an even share has a shard of its own and the
    others share the rest. With ``capacity`` in bytes as few shards are opened as best fit finds, and
    a group above it has a shard of its own. ``slot`` numbers the rows of a shard from 0 in the order
    of their ids, null first. The law is ``bytes``; ``grown_shard`` belongs to another and is null.
    Repeated rows count each, and other columns are ignored.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = stored(
        df.select(
            F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(content) + F.lit(1)).cast("long").alias("size"),
            F.crc32(content).alias("text_crc32"), F.unhex(F.md5(content)).alias("text_key"), F.monotonically_increasing_id().alias("tag"),
        ),
        "sizes",
    )
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("bytes"))
    placed = stored(rows.join(place_groups(groups, shards, capacity), "text_key").drop("text_key"), "placed")
    ordered = stored(placed.orderBy("shard", "doc_id", "text_crc32", "tag").drop("tag").withColumn("place", F.monotonically_increasing_id()), "ordered")
    parts = ordered.groupBy(F.shiftright("place", PART).alias("part"), "shard").agg(F.count(F.lit(1)).alias("n")).collect()  # partitions + shards rows
    return _with_slots(ordered, sorted((r["part"], r["shard"], r["n"]) for r in parts))


def _with_slots(ordered: DataFrame, parts: list[tuple[int, int, int]]) -> DataFrame:
    """Places within partitions to slots within shards: each row's shift, by its partition and shard."""
    shifts, before, of_part, shard_start = [], 0, {}, {}
    for part, shard, n in parts:
        start = of_part.setdefault(part, before)
        shifts.append((part, shard, start - shard_start.setdefault(shard, before)))
        before += n
    table = ordered.sparkSession.createDataFrame(shifts, "p long, s int, shift long")
    joined = ordered.join(F.broadcast(table), (F.shiftright("place", PART) == F.col("p")) & (F.col("shard") == F.col("s")))  # partitions + shards rows
    return joined.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place").bitwiseAND((1 << PART) - 1) + F.col("shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
