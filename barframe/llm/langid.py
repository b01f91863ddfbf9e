"""Language identification with error-correcting output codes.

Every language has a codeword of bits. One linear classifier per bit, over hashed letter n-grams
of the whole text, predicts that bit; the language whose codeword has the least loss, weighted by
how well each bit was learned, is the answer. A small lead over the runner-up flags ambiguity.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barframe.llm.arrays import code_points, give_back, lower_points, rows_of, text_chunks, tidy, with_input

BUCKET_BITS = 12
SAMPLE_ROWS = 1000  # labelled rows that the classifiers are fitted on, over all languages
QUARTERS = 4  # a language has as many sample rows at least, if it has rows enough
LEAD = 0.2  # a smaller lead in probability is ambiguous
ROWS = 512  # texts per matrix of counts


@dataclass
class Model:
    labels: list[str]
    codes: np.ndarray  # labels x bits, -1 or 1
    weights: np.ndarray  # buckets x bits
    bias: np.ndarray
    trust: np.ndarray  # per bit


def ngram_counts(data: np.ndarray, offsets: np.ndarray, bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed letter pairs and triples of each text (rows x buckets), and its letters."""
    rows, size = len(offsets) - 1, 1 << bits
    points, places = code_points(data)
    low = lower_points()[points]
    row = rows_of(offsets, places)
    letters = np.bincount(row[low != 32], minlength=rows)
    # one space before each text and one after the last
    seq = np.full(len(low) + rows + 1, 32, dtype=np.uint32)
    owner = np.zeros(len(seq), dtype=np.int64)
    at = np.arange(len(low)) + row + 1
    seq[at], owner[at] = low, row
    owner[np.searchsorted(places, offsets[:-1]) + np.arange(rows)] = np.arange(rows)
    a, b, c = seq[:-2], seq[1:-1], seq[2:]
    blank_a, blank_b = a == 32, b == 32
    first = np.uint32(0x9E3779B1) * a + np.uint32(0x85EBCA77) * b

    def cells(value: np.ndarray, keep: np.ndarray) -> np.ndarray:
        value = value[keep]
        value = (value ^ (value >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        return owner[:-2][keep] * size + (value >> np.uint32(32 - bits)).astype(np.int64)

    pairs = cells(first, ~(blank_a & blank_b))
    triples = cells(first * np.uint32(0x27D4EB2F) + c + np.uint32(1), ~blank_b & ~(blank_a & (c == 32)))
    total = np.bincount(pairs, minlength=rows * size) + np.bincount(triples, minlength=rows * size)
    return total.reshape(rows, size), letters


def _scaled(counts: np.ndarray) -> np.ndarray:
    x = np.sqrt(counts, dtype=np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A row of -1 and 1 per class: every split of up to five classes, else the random code of
    ``15 log2 n`` bits with the largest least distance of 200 draws (fewer beyond
    500 classes, where a draw takes long)."""
    if n <= 1:
        return np.ones((n, 0), dtype=np.int8)
    if n <= 5:
        columns = [c for c in product((-1, 1), repeat=n - 1) if 1 in c]
        return np.array([[-1] * len(columns), *zip(*columns, strict=True)], dtype=np.int8)
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(15 * np.log2(n)))
    best, least = None, -1
    for _ in range(max(1, min(200, 10**10 // (n * n * bits)))):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), size=(n, bits))
        apart = (bits - code.astype(np.int32) @ code.T.astype(np.int32)) // 2
        distance = int(apart[~np.eye(n, dtype=bool)].min())
        if distance > least and np.all(np.abs(code.sum(axis=0)) < n):
            best, least = code, distance
    return best


def fit_codes(counts: np.ndarray, labels: list[str], steps: int = 150, ridge: float = 1e-4) -> Model:
    """Logistic classifiers of all bits at once, by gradient steps with momentum."""
    names = sorted(set(labels))
    codes = codewords(len(names))
    place = {name: i for i, name in enumerate(names)}
    owner = np.array([place[x] for x in labels], dtype=np.int64)
    x, target = _scaled(counts), codes[owner].astype(np.float32)
    share = 1.0 / (np.bincount(owner, minlength=len(names))[owner] * len(names)) if len(owner) else np.zeros(0)
    share = share.astype(np.float32)[:, None]
    weights, bias = np.zeros((x.shape[1], codes.shape[1]), np.float32), np.zeros(codes.shape[1], np.float32)
    speed, push = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(steps if codes.shape[1] else 0):
        slope = -target * share / (1 + np.exp(np.clip(target * (x @ weights + bias), -30, 30)))
        speed = 0.9 * speed - 4.0 * (x.T @ slope + ridge * weights)
        push = 0.9 * push - 1.0 * slope.sum(axis=0)
        weights, bias = weights + speed, bias + push
    right = (((x @ weights + bias) * target > 0) * share).sum(axis=0) if codes.shape[1] else bias
    return Model(names, codes, weights, bias, np.maximum(2 * right - 1, 0.05).astype(np.float32))


def decode_codes(model: Model, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best label's place, its probability, and its lead over the next, per row of counts."""
    margin = _scaled(counts) @ model.weights + model.bias
    loss = np.zeros((len(counts), len(model.labels)))
    for k, code in enumerate(model.codes):
        loss[:, k] = (np.logaddexp(0, -margin * code) * model.trust).sum(axis=1)
    chance = np.exp(loss.min(axis=1, keepdims=True) - loss)
    chance /= chance.sum(axis=1, keepdims=True)
    best = chance.argmax(axis=1)
    order = np.sort(chance, axis=1)
    lead = order[:, -1] - (order[:, -2] if len(model.labels) > 1 else 0)
    return best, order[:, -1], lead


def fit_languages(
    docs: DataFrame, learn: Column | None = None, text: str = "text", label: str = "lang", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS
) -> Model:
    """Fit on a bounded sample of the labelled rows for which ``learn`` holds.

    The sample holds about ``sample_rows`` rows, shared evenly among the languages and picked by a hash
    of key and text, so reruns agree. However rare, every language is in it: its least draw of each
    of ``QUARTERS`` parts is taken in any case. At most ``2 * sample_rows`` rows and 16 of each
    language are drawn. Rows without text or label teach nothing; without any such row the model
    knows no language.
    """
    known = docs.where(F.col(text).isNotNull() & F.col(label).isNotNull())
    known = known.where(learn) if learn is not None else known
    hashed = F.xxhash64("key", "text")
    known = known.select(F.col(text).alias("text"), F.col(label).cast("string").alias("label"), F.col(key).alias("key"))
    known = known.withColumn("draw", F.pmod(F.shiftright(hashed, 8), F.lit(1 << 30)) / float(1 << 30)).withColumn("quarter", F.pmod(hashed, F.lit(QUARTERS)))
    least = [F.min(F.when(F.col("quarter") == q, F.col("draw"))).alias(f"q{q}") for q in range(QUARTERS)]
    counts = known.groupBy("label").agg(F.count(F.lit(1)).alias("count"), *least).collect()  # one row per language
    if not counts:
        return fit_codes(np.zeros((0, 1 << BUCKET_BITS)), [])
    each = max(1, sample_rows // len(counts))
    cuts = [(r["label"], max(each / r["count"], *[r[f"q{q}"] or 0.0 for q in range(QUARTERS)])) for r in counts]
    cut = F.try_element_at(F.create_map(*[F.lit(v) for pair in cuts for v in pair]), F.col("label"))
    sample = known.withColumn("place", F.col("draw") / F.greatest(cut, F.lit(1e-12))).where(F.col("place") <= 1)
    sample = sample.orderBy("place", "label", "key").limit(2 * sample_rows + 16 * len(counts))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, at in text_chunks(batch.column(0), rows=ROWS):
                found, _ = ngram_counts(data, at)
                packed = pa.array([np.minimum(r, 65535).astype("<u2").tobytes() for r in found], pa.binary())
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(row, end - row) for i in (1, 2)], packed], names=["label", "draw", "counts"])

    rows = sample.select("text", "label", "draw").mapInArrow(tidy(run), "label string, draw double, counts binary").toArrow()
    names, draws = rows["label"].to_pylist(), rows["draw"].to_pylist()
    order = sorted(range(len(names)), key=lambda i: (names[i], draws[i]))
    matrix = np.zeros((len(names), 1 << BUCKET_BITS), dtype="<u2")
    for place, i in enumerate(order):
        matrix[place] = np.frombuffer(rows["counts"][i].as_buffer(), dtype="<u2")
    del rows
    model = fit_codes(matrix, [names[i] for i in order])
    give_back()
    return model


def identify(df: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred", score: str = "score", ambiguous: str = "ambiguous", unknown: str = "und") -> DataFrame:
    """Add the predicted language of each whole text, its probability, and whether it is ambiguous.

    A null text, a text without a letter, and every text when no language was learned get
    ``unknown``, score 0 and ambiguous true. Ties go to the label first by code point. Columns of
    these names in ``df`` are replaced, all others kept.
    """
    source, rest, schema = with_input(df, text, (pred, score, ambiguous))
    schema = schema.add(pred, "string").add(score, "double").add(ambiguous, "boolean")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for batch in batches:
            for row, end, data, at in text_chunks(batch.column(0), rows=ROWS):
                counts, letters = ngram_counts(data, at)
                told = (letters > 0) & bool(learned.labels)
                names, chance, lead = np.full(end - row, unknown, dtype=object), np.zeros(end - row), np.zeros(end - row)
                if told.any():
                    best, p, apart = decode_codes(learned, counts[told])
                    names[told], chance[told], lead[told] = np.array(learned.labels, dtype=object)[best], p, apart
                kept = [batch.column(i + 1).slice(row, end - row) for i in range(len(rest))]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(names, pa.string()), pa.array(chance, pa.float64()), pa.array(lead < LEAD, pa.bool_())], names=[*rest, pred, score, ambiguous]
                )

    return source.mapInArrow(tidy(run), schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id's text leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def cross_checked(docs: DataFrame) -> DataFrame:
    """Languages of all documents from a model that saw only rows with an id that are not held out."""
    model = fit_languages(docs, F.col("doc_id").isNotNull() & ~held_out())
    return identify(docs.withColumn("held_out", held_out()), model)
