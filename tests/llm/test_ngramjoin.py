import random
import re

import numpy as np
import pytest

from barframe.llm import ngramjoin
from barframe.llm.ngramjoin import Likeness

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, like):
    """Sizes per row and least reachable id per id, by comparing all pairs."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for i, text in rows:
        w = WORDS.findall((text or "").translate(lower))
        sets.append((i, {tuple(w[a : a + like.words]) for a in range(len(w) - like.words + 1)} if len(w) >= like.words else ({tuple(w)} if w else set())))
    parent = {i: i for i, _ in rows if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and i is not None and j is not None and like.den * len(s & t) >= like.num * len(s | t):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sorted((str(i), len(s), str(root(i) if i is not None else None)) for i, s in sets)


def found(df, like):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in ngramjoin.jaccard_groups(df, like=like).collect())


@pytest.mark.parametrize("like", [Likeness(), Likeness(5, 80, 100), Likeness(2, 50, 100)])
def test_groups_as_brute_force(make_docs, words, like):
    draw, rows = random.Random(2), []
    shared = words(99, 60)
    for i in range(60):
        base = words(i, draw.choice([4, 9, 33, 62, 66, 128, 140]))
        rows.append((len(rows), " ".join(base)))
        for _ in range(draw.randint(0, 4)):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 15))):
                copy[draw.randrange(len(copy))] = "new" + str(draw.random())
            rows.append((len(rows), " ".join(copy).upper()))
        if i % 3 == 0:
            rows.append((len(rows), " ".join(words(1000 + i, 30) + shared)))
    draw.shuffle(rows)
    assert found(make_docs(rows), like) == brute(rows, like)


def test_odd_rows(spark, make_docs, words):
    long = " ".join(words(5, 30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one  two"), (8, "two one"), (None, "one two"), (None, None), (9, long), (10, long + " end"), (11, "É b c d"), (12, "é b c d"), (9, long)]
    rows += [(20, "a b c d e"), (20, "v w x y z"), (21, "a b c d e"), (22, "v w x y z")]  # one id, two texts
    assert found(make_docs(rows), Likeness()) == brute(rows, Likeness())
    clash = make_docs(rows).selectExpr("*", "1 as class_id", "2 as digest", "3 as component", "'x' as node")
    assert found(clash, Likeness()) == brute(rows, Likeness())
    assert ngramjoin.jaccard_groups(make_docs(rows).limit(0)).count() == 0


def test_large_cells_are_cut_and_lose_nothing(make_docs, words, monkeypatch):
    monkeypatch.setattr(ngramjoin, "CELL", 5)
    draw, base, rows = random.Random(4), words(3, 60), []
    for i in range(40):
        copy = list(base)
        for k in draw.sample(range(60), draw.randint(0, 3)):
            copy[k] = f"x{i}"
        rows.append((i, " ".join(copy)))
    assert found(make_docs(rows), Likeness()) == brute(rows, Likeness())


@pytest.mark.parametrize("nearest", [1, 2, 8])
def test_crowded_cells_lose_no_link(make_docs, words, monkeypatch, nearest):
    """Groups of near copies around the threshold: what the first pairs leave open is found later."""
    monkeypatch.setattr(ngramjoin, "NEAREST", nearest)
    draw, rows = random.Random(nearest), []
    for g in range(3):
        base = words(g, 120)
        for _ in range(40):
            copy = list(base)
            for k in draw.sample(range(120), draw.randint(0, 4)):
                copy[k] = f"x{draw.random()}"
            rows.append((len(rows), " ".join(copy)))
    draw.shuffle(rows)
    assert found(make_docs(rows), Likeness()) == brute(rows, Likeness())


def test_tree_drops_no_similar_pair_and_prunes():
    rng, like = np.random.default_rng(0), Likeness()
    base = [rng.integers(0, 1 << 63, rng.integers(260, 500)).astype(np.uint64) for _ in range(60)]
    sets = base + [np.concatenate([b[: int(len(b) * rng.uniform(0.85, 1))], rng.integers(0, 1 << 63, 8).astype(np.uint64)]) for b in base]
    sets = sorted((np.unique(s) for s in sets), key=len)
    sizes = np.array([len(s) for s in sets])
    bits = np.stack([np.frombuffer(ngramjoin.signature(s, ngramjoin.signature_bits(8)), dtype=np.uint64) for s in sets])
    forest = ngramjoin.build_forest(np.zeros(len(sets), int), sizes, bits)
    got = {(int(a), int(b)) for x, y in ngramjoin.dual_traversal(forest, like) for a, b in zip(x, y, strict=True)}
    want = {(a, b) for b in range(len(sets)) for a in range(b) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 90 * len(np.union1d(sets[a], sets[b]))}
    assert want <= got
    assert len(got) < 0.1 * len(sets) * (len(sets) - 1) / 2


def test_query_on_the_small_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    from barframe.llm.queries import QUERIES

    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in QUERIES["op4_ngram_join"](spark, "/root/testdata/sf0.001").collect())
    assert got == brute(rows, Likeness())
