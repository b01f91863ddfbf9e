import random
import zlib

import pytest

from barframe.llm import binpacking as bp


def one_by_one(sizes, capacity):
    """Best fit decreasing without a tree, a catalogue or runs."""
    bins = []
    for s in sorted(sizes, reverse=True):
        room = [(free, i) for i, free in enumerate(bins) if free >= s]
        if room:
            bins[min(room)[1]] -= s
        else:
            bins.append(max(capacity, s) - s)
    return bins


def runs_of(sizes):
    found = {}
    for s in sizes:
        found[s] = found.get(s, 0) + 1
    order = sorted(found, reverse=True)
    return order, [found[s] for s in order]


def loads(sizes, counts, runs):
    left, total = list(counts), {}
    at = 0
    for shard, n in runs:
        while n:
            while not left[at]:
                at += 1
            k = min(n, left[at])
            total[shard] = total.get(shard, 0) + k * sizes[at]
            left[at] -= k
            n -= k
    assert not any(left)
    return total


@pytest.mark.parametrize("seed", range(30))
def test_runs_are_best_fit_decreasing(seed):
    draw = random.Random(seed)
    sizes = [draw.choice([1, 2, 7, 13, 40, 41, 99, draw.randint(1, 150)]) for _ in range(draw.randint(1, 400))]
    capacity = draw.choice([100, 160, 1000])
    order, counts = runs_of(sizes)
    got = loads(order, counts, bp.pack(order, counts, capacity))
    bins = one_by_one(sizes, capacity)
    assert len(got) == len(bins)
    assert [got[i] for i in range(len(bins))] == [max(capacity, capacity if free >= 0 else 0) - free if got[i] <= capacity else got[i] for i, free in enumerate(bins)]


@pytest.mark.parametrize("seed", range(20))
def test_even_shards(seed):
    draw = random.Random(seed)
    sizes = [int(draw.paretovariate(1.1) * 10) + 1 for _ in range(draw.randint(1, 3000))]
    order, counts = runs_of(sizes)
    got = loads(order, counts, bp.pack_evenly(order, counts, 8))
    assert set(got) <= set(range(8)) and sum(got.values()) == sum(sizes)
    left, shards, rest = sum(sizes), 8, sorted(sizes, reverse=True)
    while rest and shards > 1 and rest[0] * shards > left:
        left, shards = left - rest.pop(0), shards - 1
    fair = [got.get(i, 0) for i in range(8 - shards, 8)]
    assert max(fair) <= left / shards + (rest[0] if rest else 0) + 1


def test_tree_gives_the_tightest():
    draw, tree, plain = random.Random(3), bp.Capacities(), []
    for i in range(4000):
        if draw.random() < 0.6:
            c = draw.randint(1, 300)
            tree.add(c, i)
            plain.append((c, i))
        else:
            size = draw.randint(1, 300)
            want = min((e for e in plain if e[0] >= size), default=None)
            assert tree.take_tightest(size) == want
            if want:
                plain.remove(want)


def check(rows, got, shards=8):
    assert len(got) == len(rows)
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
    slots, home = {}, {}
    for r in got:
        assert (r["law"], r["grown_shard"]) == ("bytes", None) and 0 <= r["shard"] < shards
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert home.setdefault((r["size"], r["text_crc32"]), r["shard"]) == r["shard"]
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))


def totals(got):
    size = {}
    for r in got:
        size[r["shard"]] = size.get(r["shard"], 0) + r["size"]
    return [size.get(i, 0) for i in range(8)]


def test_documents_in_even_shards(make_docs, words):
    draw = random.Random(4)
    rows = [(i, " ".join(words(i, draw.randint(0, 60)))) for i in range(1500)]
    rows += [(2000 + i, rows[i % 40][1]) for i in range(800)]
    df = make_docs(rows)
    got = bp.shard_documents(df).collect()
    check(rows, got)
    assert max(totals(got)) <= 1.01 * sum(totals(got)) / 8 and min(totals(got)) >= 0.99 * sum(totals(got)) / 8
    again = bp.shard_documents(df.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_a_group_above_its_share(make_docs, words):
    rows = [(i, "the same text " * 5) for i in range(500)] + [(1000 + i, " ".join(words(i, 12))) for i in range(700)]
    got = bp.shard_documents(make_docs(rows)).collect()
    check(rows, got)
    size = totals(got)
    others = sum(size) - max(size)
    assert max(size) == sum(r["size"] for r in got if r["doc_id"] < 500)
    assert all(abs(s - others / 7) <= 0.02 * others / 7 for s in size if s != max(size))


def test_fixed_capacity(make_docs, words):
    draw = random.Random(5)
    rows = [(i, "".join(words(i, draw.randint(1, 30)))) for i in range(300)] + [(900, "x" * 5000)]
    got = bp.shard_documents(make_docs(rows), capacity=2000).collect()
    size = {}
    for r in got:
        size.setdefault(r["shard"], []).append(r["size"])
    assert all(sum(s) <= 2000 or len(s) == 1 for s in size.values())
    assert len(size) == len(one_by_one([r["size"] for r in got], 2000))
    check(rows, got, shards=len(size))


def test_odd_rows(make_docs):
    rows = [(1, None), (2, ""), (None, "a"), (None, "a"), (3, "é🙂"), (3, "é🙂"), (4, "long " * 100_000)]
    docs = make_docs(rows).selectExpr("*", "1 as size", "2 as shard", "3 as place", "4 as tag", "5 as text_key")
    check(rows, bp.shard_documents(docs).collect())
    assert bp.shard_documents(make_docs(rows).limit(0)).collect() == []
    assert bp.shard_documents(make_docs([(7, None)])).first()["text_crc32"] == 0
