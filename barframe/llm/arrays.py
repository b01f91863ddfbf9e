"""Texts as flat arrays: chunks of an Arrow column, words, code points and 64-bit hashes.

Everything here works on whole texts. A chunk holds at least one text and about ``limit`` bytes,
so memory follows the longest text and not the size of an Arrow batch.
"""

from __future__ import annotations

import ctypes
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHUNK_BYTES = 1 << 18
BATCH_ROWS = 1000  # texts of an Arrow batch

WHITE = np.zeros(256, dtype=bool)  # [\x20\x09-\x0D]
WHITE[[0x20, *range(0x09, 0x0E)]] = True

_MUL = np.uint64(0x9E3779B97F4A7C15)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES, rows: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of consecutive pieces of a string column,
    of at most ``rows`` rows each.

    ``offsets`` has a place for every row of the piece and one more; a null counts as empty.
    """
    column = column.fill_null("").cast(pa.large_string())
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    values = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), row + rows, len(column))
        cut = offsets[row : end + 1]
        yield row, end, values[cut[0] : cut[-1]], cut - cut[0]
        row = end


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows for the session, unless it has asked for its own
    number: texts are long, and a batch is held by the executor and by the worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":  # the default
        spark.conf.set(name, str(BATCH_ROWS))


def with_input(df: DataFrame, column: str, added: Sequence[str]) -> tuple[DataFrame, list[str], StructType]:
    """What a row-wise operator reads: ``column`` first, then the columns it keeps, which are all but
    those it adds (whatever their case); the kept names and their schema."""
    small_batches(df.sparkSession)
    taken = {name.lower() for name in added}
    rest = [c for c in df.columns if c.lower() not in taken]
    source = df.select(F.col(f"`{column}`").alias("__input"), *[F.col(f"`{c}`") for c in rest])
    return source, rest, StructType(source.schema.fields[1:])


def give_back() -> None:
    """Hand memory that is free inside this process back to the system, as far as the C library can: the
    many small pieces of a fit or a task otherwise stay with a driver or worker that lives on."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` as the function of a task, which gives its memory back at the end."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def rows_of(offsets: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The row that each byte place (ascending or not) lies in."""
    return np.searchsorted(offsets, places, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _MUL)


_powers: list[np.ndarray] = []
KEPT_POWERS = 1 << 20  # a longer text makes its own tables, which go with it


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, at least ``n`` of each."""
    if _powers and len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    size = max(n, CHUNK_BYTES + 1)
    base = 0x5851F42D4C957F2D
    made = [np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b, dtype=np.uint64))]) for b in (base, pow(base, -1, 1 << 64))]
    if size <= KEPT_POWERS:
        _powers[:] = made
    return made[0], made[1]


def running_sums(values: np.ndarray) -> np.ndarray:
    """What ``span_hashes`` needs of a sequence of 64-bit values."""
    power, _ = _power_tables(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return total


def span_hashes(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; equal spans have equal hashes wherever they stand."""
    _, inverse = _power_tables(len(total))
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def byte_sums(data: np.ndarray) -> np.ndarray:
    return running_sums(_byte_values()[data])


def point_sums(points: np.ndarray) -> np.ndarray:
    return running_sums(mix(points.astype(np.uint64) * _MUL + np.uint64(1)))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words ``[^\\x20\\x09-\\x0D]+`` of each text."""
    inside = ~WHITE[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    starts = np.flatnonzero(inside & (first[:-1] | np.concatenate([[True], ~inside[:-1]])))
    ends = np.flatnonzero(inside & (first[1:] | np.concatenate([~inside[1:], [True]]))) + 1
    return starts, ends, rows_of(offsets, starts)


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the byte each begins at."""
    places = np.flatnonzero((data & 0xC0) != 0x80)
    points = data[places].astype(np.uint32)
    wide = np.flatnonzero(points >= 0x80)
    if len(wide):
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        at, lead = places[wide], points[wide]
        b1, b2, b3 = ((padded[at + k] & 0x3F).astype(np.uint32) for k in (1, 2, 3))
        two, three = ((lead & 0x1F) << 6) | b1, ((lead & 0x0F) << 12) | (b1 << 6) | b2
        four = ((lead & 0x07) << 18) | (b1 << 12) | (b2 << 6) | b3
        points[wide] = np.minimum(np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four)), 0x10FFFF)
    return points, places


LETTER, NUMBER, OTHER, SPACE = range(4)
_WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@cache
def point_classes() -> np.ndarray:
    """Letter, number, white space (Unicode's White_Space) or other, for every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[list(_WHITE_SPACE)] = SPACE
    return table


@cache
def lower_points() -> np.ndarray:
    """The simple lower case of every code point, letters only; everything else becomes a space."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    letters = np.flatnonzero(point_classes() == LETTER)
    table[letters] = [ord(low) if len(low := chr(c).lower()) == 1 else c for c in letters.tolist()]
    return table
