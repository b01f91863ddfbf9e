"""Severity of toxic language by cumulative-link ordinal regression.

``P(grade >= k) = sigmoid(w . x - threshold_k)``: one weight vector over sparse text features is
shared by all ordered thresholds, and the expected severity is the sum of these probabilities.
Features are words and their first letters, chosen on labelled texts by their share of the words, so
a word that long clean texts hold once can still speak for toxic where it is dense.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.arrays import code_points, give_back, lower_points, point_sums, rows_of, span_hashes, text_chunks, tidy, with_input

SAMPLE_ROWS = 2000  # labelled documents of each class that the model is fitted on
FEATURES = 512  # features kept, those that tell the classes apart best
LEAST_DOCS = 4  # labelled documents that a feature must occur in
PURITY = 0.9  # least share of toxic in a feature's mean share of the words, over equally many documents of both classes
AMOUNT = 10.0  # times a feature's count over the root of the text's words, before the logarithm
GROUPS = 500  # groups (languages) whose documents are counted for an even sample, the largest first
GRADES = 4  # none, mild, strong, severe
STEMS = (4, 5)  # letters of a word's beginning that count as features of their own


@dataclass
class Model:
    features: np.ndarray  # sorted 64-bit hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one for each grade above the lowest


def nothing_known(n_grades: int) -> Model:
    return Model(np.zeros(0, np.uint64), np.zeros(0), np.arange(n_grades - 1, dtype=float) + 20.0)


def text_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and rows of all words and stems of each text, and the words per text."""
    rows = len(offsets) - 1
    points, places = code_points(data)
    low = lower_points()[points]
    row = rows_of(offsets, places)
    letter = low != 32
    if not letter.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(rows, np.int64)
    edge = np.concatenate([[True], row[1:] != row[:-1], [True]])
    starts = np.flatnonzero(letter & (edge[:-1] | np.concatenate([[True], ~letter[:-1]])))
    ends = np.flatnonzero(letter & (edge[1:] | np.concatenate([~letter[1:], [True]]))) + 1
    sums, owner = point_sums(low), row[starts]
    hashes, owners = [span_hashes(sums, starts, ends)], [owner]
    for k in STEMS:
        longer = ends - starts > k
        hashes.append(span_hashes(sums, starts[longer], starts[longer] + k) ^ np.uint64(k))
        owners.append(owner[longer])
    return np.concatenate(hashes), np.concatenate(owners), np.bincount(owner, minlength=rows)


def count_matrix(features: np.ndarray, hashes: np.ndarray, owners: np.ndarray, rows: int, counts: np.ndarray | None = None) -> np.ndarray:
    """How often each text has each of the sorted features (rows x features). ``counts`` says how often
    each hash stands for, once if missing."""
    if not len(features) or not len(hashes):
        return np.zeros((rows, len(features)), np.float32)
    maybe = np.zeros(1 << 16, dtype=bool)
    maybe[features >> np.uint64(48)] = True
    likely = np.flatnonzero(maybe[hashes >> np.uint64(48)])
    at = np.minimum(np.searchsorted(features, hashes[likely]), len(features) - 1)
    hit = features[at] == hashes[likely]
    found = likely[hit]
    cells = np.bincount(owners[found] * len(features) + at[hit], None if counts is None else counts[found], minlength=rows * len(features))
    return cells.reshape(rows, len(features)).astype(np.float32)


def amounts(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What the model sees of counts: between a count, which grows with the length of a text, and a
    share of its words, which fades in it."""
    return np.log1p(AMOUNT * counts / np.sqrt(np.maximum(words, 1))[:, None])


def fit_ordinal(x: np.ndarray, grades: np.ndarray, n_grades: int, steps: int = 400, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of the cumulative-link model, by Adam steps on the
    mean likelihood."""
    n = len(grades)
    if not n:
        return np.zeros(x.shape[1]), np.arange(n_grades - 1, dtype=float) + 20.0
    share = 1.0 / n
    w = np.zeros(x.shape[1])
    gaps = np.concatenate([[0.0], np.zeros(n_grades - 2)])  # threshold_1, then logs of the steps up
    params = np.concatenate([w, gaps])
    first, second = np.zeros_like(params), np.zeros_like(params)
    bounds = np.arange(n_grades)

    def unpack(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = p[x.shape[1] :]
        return p[: x.shape[1]], np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))

    for step in range(1, steps + 1):
        w, theta = unpack(params)
        score = x @ w
        up = 1 / (1 + np.exp(-np.clip(score[:, None] - theta, -30, 30)))
        # probability of the own grade is the difference of neighbouring cumulative ones
        full = np.concatenate([np.ones((n, 1)), up, np.zeros((n, 1))], axis=1)
        own = np.maximum(full[np.arange(n), grades] - full[np.arange(n), grades + 1], 1e-9)[:, None]
        slope = up * (1 - up)
        sign = (grades[:, None] == bounds[1:]).astype(float) - (grades[:, None] == bounds[:-1]).astype(float)
        pull = sign * slope / own * share  # of log likelihood with respect to (score - theta_k)
        d_score, d_theta = pull.sum(axis=1), -pull.sum(axis=0)
        raw = params[x.shape[1] :]
        tails = np.cumsum(d_theta[::-1])[::-1]
        grad = np.concatenate([ridge * w - x.T @ d_score, -tails * np.concatenate([[1.0], np.exp(raw[1:])])])
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        params = params - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return unpack(params)


def severity_grades(toxic: np.ndarray, x: np.ndarray, n_grades: int = GRADES) -> np.ndarray:
    """Ordered grades where labels only say toxic or not: 0 if not, else 1 and up by the amount of
    telling features, cut in equal parts of the toxic texts (ties go down)."""
    grades = (toxic == 1).astype(np.int64)
    amount, bad = x.sum(axis=1), toxic == 1
    if bad.any() and n_grades > 2:
        cuts = np.quantile(amount[bad], np.arange(1, n_grades - 1) / (n_grades - 1))
        grades[bad] += (amount[bad][:, None] > cuts).sum(axis=1)
    return grades


def fair_share(counts: Iterable[int], total: int) -> float:
    """The most that each group may give so that all together give ``total``, small groups all they have."""
    left, waiting = float(total), sorted(counts)
    for i, n in enumerate(waiting):
        if n * (len(waiting) - i) >= left:
            return left / (len(waiting) - i)
        left -= n
    return float(max(waiting, default=1))


def even_sample(docs: DataFrame, labels: DataFrame, key: str, toxic: str, group: str | None, sample_rows: int) -> DataFrame:
    """``(key, toxic)`` of at most ``sample_rows`` labelled documents of each class, in order of a hash
    of the id; each group of documents gives as many as any other, or all it has."""
    per_doc = labels.where(F.col(key).isNotNull() & F.col(toxic).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(F.col(toxic).cast("int")).alias("toxic"))
    kind = F.coalesce(F.col(group).cast("string"), F.lit("")) if group else F.lit("")
    known = docs.select(F.col(key).alias("key"), kind.alias("kind")).join(per_doc.where("toxic in (0, 1)"), "key").groupBy("key", "toxic").agg(F.min("kind").alias("kind"))
    found = known.groupBy("toxic", "kind").count().orderBy(F.col("count").desc(), "toxic", "kind").limit(2 * GROUPS).collect()
    draw = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / float(1 << 30)

    def drawn(side: int) -> DataFrame:
        sizes = {r["kind"]: r["count"] for r in found if r["toxic"] == side}
        share = fair_share(sizes.values(), sample_rows)
        rates = [F.lit(v) for k, n in sizes.items() for v in (k, min(1.0, share / n))]
        rate = F.coalesce(F.try_element_at(F.create_map(*rates), F.col("kind")), F.lit(1.0)) if rates else F.lit(1.0)
        return known.where(F.col("toxic") == side).withColumn("draw", draw / rate).orderBy("draw", "key").limit(sample_rows).select("key", "toxic")

    return drawn(0).unionByName(drawn(1))


def fit_severity(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    toxic: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    features: int = FEATURES,
    n_grades: int = GRADES,
    group: str | None = None,
) -> Model:
    """Fit on at most ``sample_rows`` labelled documents of each class, picked by a hash of the id and
    evenly from the values of the column ``group`` of ``docs`` (the language), if it is named.

    A document is toxic if any label row says so; rows with a null id or label teach nothing. Where
    nothing tells the classes apart, the model knows no feature and calls nothing toxic.
    """
    chosen = F.broadcast(even_sample(docs, labels, key, toxic, group, sample_rows))  # at most 2 * sample_rows rows
    texts = docs.select(F.col(text).alias("text"), F.col(key).alias("key")).join(chosen, "key").where("text is not null").dropDuplicates(["key"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, at in text_chunks(batch.column(0)):
                hashes, owners, words = text_features(data, at)
                order = np.argsort(owners, kind="stable")
                cuts = np.searchsorted(owners[order], np.arange(end - row + 1))
                bags = [np.unique(hashes[order][a:b], return_counts=True) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                packed = [pa.array([x.astype(kind).tobytes() for x in column], pa.binary()) for column, kind in zip(zip(*bags, strict=True), ("<u8", "<u4"), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(row, end - row), batch.column(2).slice(row, end - row), *packed, pa.array(words, pa.int64())], names=["key", "toxic", "features", "counts", "words"]
                )

    sample = texts.select("text", "key", "toxic").mapInArrow(tidy(run), "key long, toxic int, features binary, counts binary, words long").toArrow()
    if not sample.num_rows:
        return nothing_known(n_grades)
    order = np.argsort(sample["key"].to_numpy(), kind="stable")
    y, words = sample["toxic"].to_numpy()[order].astype(np.int64), sample["words"].to_numpy()[order]
    if y.min() == y.max():
        return nothing_known(n_grades)
    bags, counts = ([np.frombuffer(sample[name][i].as_buffer(), dtype=kind) for i in order.tolist()] for name, kind in (("features", "<u8"), ("counts", "<u4")))
    chosen_features = telling_features(bags, counts, words, y, features)
    owners = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    x = amounts(count_matrix(chosen_features, np.concatenate(bags), owners, len(bags), np.concatenate(counts)), words)
    w, theta = fit_ordinal(x, severity_grades(y, x, n_grades), n_grades)
    del sample, bags, counts, owners, x
    give_back()
    return Model(chosen_features, w, theta)


def telling_features(bags: list[np.ndarray], counts: list[np.ndarray], words: np.ndarray, y: np.ndarray, keep: int) -> np.ndarray:
    """Sorted hashes of the features that speak for toxic by their share of the words, ranked by
    likelihood ratio of their presence.

    A feature counts only where the ratio is beyond what the best of so many candidates would
    reach by chance, so a small sample yields few features and not spurious ones.
    """
    sides = []
    for side in (0, 1):
        texts = [i for i in range(len(y)) if y[i] == side]
        found, place, n = np.unique(np.concatenate([bags[i] for i in texts]), return_inverse=True, return_counts=True)
        sides.append((found, n, np.bincount(place, np.concatenate([counts[i] / max(words[i], 1) for i in texts]), minlength=len(found))))
    every = np.union1d(sides[0][0], sides[1][0])
    docs, shares = np.zeros((2, len(every))), np.zeros((2, len(every)))
    for side, (hashes, n, share) in enumerate(sides):
        at = np.searchsorted(every, hashes)
        docs[side, at], shares[side, at] = n, share
    total = np.array([(y == 0).sum(), (y == 1).sum()])[:, None]
    both = docs.sum(axis=0)
    expected = both * total / total.sum()
    ratio = 2 * (docs * np.log(np.maximum(docs, 1e-9) / np.maximum(expected, 1e-9))).sum(axis=0)
    rate, dense = docs / total, shares / total
    candidate = (both >= LEAST_DOCS) & (rate[1] > rate[0]) & (dense[1] >= PURITY * dense.sum(axis=0))
    ratio[~candidate] = 0
    chance = 2 * np.log(max(2, candidate.sum()))
    order = np.lexsort((every, -ratio))[:keep]
    return every[np.sort(order[ratio[order] > chance])]


def severity(df: DataFrame, model: Model, text: str = "text", expected: str = "severity", grade: str = "grade", toxic: str = "toxic") -> DataFrame:
    """Add the expected severity (0 to the highest grade), the likeliest grade, and whether
    any grade above 0 is likelier than not. A null or empty text is not toxic, with severity 0.
    Columns of these names in ``df`` are replaced, all others kept."""
    added = [expected, grade, toxic]
    source, rest, schema = with_input(df, text, added)
    schema = schema.add(expected, "double").add(grade, "integer").add(toxic, "boolean")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for batch in batches:
            for row, end, data, at in text_chunks(batch.column(0), rows=2048):
                hashes, owners, words = text_features(data, at)
                x = amounts(count_matrix(learned.features, hashes, owners, end - row), words)
                up = 1 / (1 + np.exp(-np.clip((x @ learned.weights)[:, None] - learned.thresholds, -50, 50)))
                up[words == 0] = 0
                each = -np.diff(np.concatenate([np.ones((end - row, 1)), up, np.zeros((end - row, 1))], axis=1), axis=1)
                kept = [batch.column(i + 1).slice(row, end - row) for i in range(len(rest))]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(up.sum(axis=1), pa.float64()), pa.array(each.argmax(axis=1), pa.int32()), pa.array(up[:, 0] > 0.5, pa.bool_())], names=[*rest, *added]
                )

    return source.mapInArrow(tidy(run), schema)
