import math
import random
import re

import pytest

from barframe.llm import mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, most=3):
    """Weights 1, 2, 3 by code point, null last; what is above ``most`` times a size is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, open_, found = sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return found | share
        for s in over:
            found[s] = most * sizes[s]
            left -= found[s]
        open_ -= over
    return found


def check(rows, got):
    sizes, taken, longest = {}, {}, {}
    for _, text, _, source in rows:
        n = len(WORDS.findall(text or ""))
        sizes[source] = sizes.get(source, 0) + n
        longest[source] = max(longest.get(source, 0), n)
    want = targets(sizes)
    assert len(got) == len(rows)
    ids = {}
    for i, text, _, source in rows:
        ids.setdefault(i, set()).add(source)
    for r in got:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        if len(ids[r["doc_id"]]) == 1:
            source = next(iter(ids[r["doc_id"]]))
            assert r["source_size"] == sizes[source]
            assert math.isclose(r["target"], want[source], rel_tol=1e-12, abs_tol=1e-9)
            taken[source] = taken.get(source, 0) + r["taken"]
    for source, words in taken.items():
        assert abs(words - want[source]) <= longest[source] / 2 + 1e-6


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(make_docs, words, seed):
    draw = random.Random(seed)
    names = ["a", "B", "ü", "𐀀", "z", "", None, "big"]
    rows = [(i, " ".join(words(i, draw.randint(0, 30))) if draw.random() < 0.95 else None, "en", draw.choice(names) if draw.random() < 0.6 else "big") for i in range(200)]
    df = make_docs(rows)
    got = mixing.mix_sources(df).collect()
    check(rows, got)
    again = mixing.mix_sources(df.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_odd_rows(make_docs):
    rows = [(1, "a b c", "en", "x"), (1, "a b c", "en", "x"), (2, None, "en", "y"), (3, "", "en", "y"), (4, "w " * 50_000, "en", None), (5, "one", "en", "q")]
    check(rows, mixing.mix_sources(make_docs(rows).selectExpr("*", "1 as size", "2 as key", "3 as target", "4 as weight", "5 as tag")).collect())
    assert mixing.mix_sources(make_docs(rows).limit(0)).count() == 0
    empty = [(1, None, "en", "x"), (2, "", "en", None)]
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.mix_sources(make_docs(empty)).collect()] == [(0, 0.0, 0)] * 2


def test_null_id_and_given_targets(spark, make_docs):
    rows = [(None, "a b", "en", "x"), (None, "c d e", "en", "x"), (3, "f", "en", "y"), (4, "g h", "en", "z")]
    wanted = spark.createDataFrame([("x", 10.0), ("y", 99.0)], "source string, target double")
    got = mixing.mix_sources(make_docs(rows), targets=wanted).collect()
    assert sum(r["taken"] for r in got if r["source_size"] == 5) in (9, 10, 11)
    assert [r["taken"] for r in got if r["doc_id"] == 3] == [3]
    assert [r["taken"] for r in got if r["doc_id"] == 4] == [0]


def profile_of(spark, rows):
    found = {}
    for source, size in rows:
        found[source, size] = found.get((source, size), 0) + 1
    return spark.createDataFrame([(s, z, n) for (s, z), n in found.items()], "source string, size long, n long")


@pytest.mark.parametrize("seed", range(3))
def test_the_dual_is_solved(spark, seed):
    """Conditions that only the one solution fulfils: sources get their targets, lengths are kept up to
    the price, and every rate is the exponential of the multipliers, cut at 3."""
    draw = random.Random(seed)
    rows = [(s, int(draw.paretovariate(0.9) * k) % 5000 + 1) for s, k in (("a", 3), ("b", 30), (None, 8), ("d", 100)) for _ in range(draw.randint(20, 200))]
    sizes = {}
    for s, z in rows:
        sizes[s] = sizes.get(s, 0) + z
    want = targets(sizes)
    aimed = spark.createDataFrame([(s, sizes[s], float(want[s])) for s in sizes], "source string, source_size long, target double")
    tilts, u, mean, spread = mixing.tilt(profile_of(spark, rows), aimed)
    t = {r["source"]: r["t"] for r in tilts.collect()}
    total = sum(sizes.values())
    x = [(math.log1p(z) - mean) / spread for _, z in rows]
    assert abs(sum(z * v for (_, z), v in zip(rows, x, strict=True))) < 1e-6 * total
    rate = [min(3.0, math.exp(min(50.0, t[s] + u[0] * v + u[1] * (v * v - 1)))) for (s, _), v in zip(rows, x, strict=True)]
    for s in sizes:
        assert math.isclose(sum(z * r for (o, z), r in zip(rows, rate, strict=True) if o == s), want[s], rel_tol=1e-8)
    for k, f in enumerate((lambda v: v, lambda v: v * v - 1)):
        assert abs(sum(z * r * f(v) for (_, z), r, v in zip(rows, rate, x, strict=True)) + mixing.PRICE * total * u[k]) < 1e-6 * total
    assert max(abs(v) for v in u) > 1e-3 and len({round(r, 6) for r in rate}) > 8  # rates differ inside a source


def test_lengths_are_kept(spark, make_docs, words):
    """Without the second kind of constraint the source of long texts would bring its lengths with it."""
    draw = random.Random(9)
    rows = [(i, " ".join(words(i, draw.randint(5, 60) if i % 2 else draw.randint(5, 120))), "en", "ab"[i % 2]) for i in range(600)]
    size = {i: len(text.split()) for i, text, _, _ in rows}
    wanted = spark.createDataFrame([("a", 0.4 * sum(size[i] for i in range(0, 600, 2))), ("b", 2.0 * sum(size[i] for i in range(1, 600, 2)))], "source string, target double")
    got = mixing.mix_sources(make_docs(rows), targets=wanted).collect()
    mean = lambda weight: sum(w * math.log1p(size[i]) for i, w in weight.items()) / sum(weight.values())
    by_source = {i: size[i] * (0.4 if i % 2 == 0 else 2.0) for i in size}
    corpus, plain, mixed = mean(size), mean(by_source), mean({r["doc_id"]: r["taken"] for r in got})
    assert abs(mixed - corpus) < 0.5 * abs(plain - corpus)


def test_sources_without_room(spark):
    aimed = spark.createDataFrame([("a", 10, 30.0), ("b", 1000, 1.0), ("c", 5, 5.0), ("d", 7, 0.0), ("e", 0, 0.0)], "source string, source_size long, target double")
    rows = [("a", 4), ("a", 6), ("b", 1000), ("c", 5), ("d", 7), ("e", 0)]
    tilts, u, mean, spread = mixing.tilt(profile_of(spark, rows), aimed)
    t = {r["source"]: r["t"] for r in tilts.collect()}
    assert set(t) == {"a", "b", "c"}
    rate = lambda s, z: min(3.0, math.exp(min(50.0, t[s] + u[0] * (x := (math.log1p(z) - mean) / spread) + u[1] * (x * x - 1))))
    assert math.isclose(rate("a", 4) * 4 + rate("a", 6) * 6, 30, rel_tol=1e-6)
    assert math.isclose(rate("b", 1000), 1e-3, rel_tol=1e-6) and math.isclose(rate("c", 5), 1.0, rel_tol=1e-6)
