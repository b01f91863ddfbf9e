"""Exponentially weighted means and the indicators made of them.

``y[0] = x[0]``, ``y[i] = a * x[i] + (1 - a) * y[i-1]``. With ``q = 1 - a`` the mean at place
p of a block is ``sum(u[i] * q**(p - i)) + carry * q**(p + 1)``, where the sum runs over the
block and ``carry`` is the mean at the end of the block before. So each block needs one
running sum and one carried number:

* the running sum uses the factor ``q**-i``; the block size keeps that below 1e200;
* the carry is ``sum(end[b - k] * q**(size * (k - 1)))`` over the earlier blocks, and the
  weight falls below the smallest double after a fixed number of blocks. Taking that many
  is the whole carry in double arithmetic, so a block looks back over a few block ends and
  never over its series.

A signal, the mean of the difference of two means, is carried the same way: a mean ``y``
at the end of a block adds ``a * sum(y * r**j * q**(m - j), j = 1..m)`` to the signal m rows
later (r is the factor of the mean, q that of the signal), which has a closed form.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barframe.operators.blocks import BLOCK_ROWS, SERIES_KEYS, block_window, row_blocks, row_ordinal

FACTOR_LIMIT = 200  # decimal digits a factor q**-i may reach inside one block
FADE_DIGITS = 345  # decimal digits after which a weight is zero as a double


@dataclass(frozen=True)
class Ewm:
    """One mean: of ``col`` with weight ``alpha``, from row ``start`` on, NULL for the first
    ``min_periods - 1`` rows of it."""

    col: str
    alpha: float
    min_periods: int = 1
    start: int = 0

    @classmethod
    def span(cls, col: str, span: int, start: int = 0) -> Ewm:
        return cls(col, 2.0 / (span + 1), span, start)

    @property
    def first(self) -> int:
        """Row of the first value."""
        return self.start + self.min_periods - 1


@dataclass(frozen=True)
class Signal:
    """The mean, with weight ``alpha``, of the mean named ``fast`` less the mean named ``slow``,
    from row ``start`` on."""

    fast: str
    slow: str
    alpha: float
    min_periods: int
    start: int

    @property
    def first(self) -> int:
        return self.start + self.min_periods - 1


def _digits(alpha: float) -> float:
    """Decimal digits by which the weight of a value fades per row."""
    return -math.log10(1.0 - alpha)


def block_size(alphas: Sequence[float]) -> int:
    """Largest power of two up to 65536 that keeps the factors in range, and not more than
    are needed to reach 2048 rows with a look-back of at most 8 blocks."""
    moving = [a for a in alphas if a < 1] or [0.5]
    fastest, slowest = max(map(_digits, moving)), min(map(_digits, moving))
    size = 64
    while size < 65536 and 2 * size * fastest <= FACTOR_LIMIT:
        if size >= 2048 and FADE_DIGITS / (size * slowest) <= 8:
            break
        size *= 2
    return size


def _look_back(size: int, alphas: Sequence[float]) -> int:
    return math.ceil(FADE_DIGITS / (size * min(map(_digits, alphas)))) + 1


def _power(alpha: float, exponent: Column) -> Column:
    return F.pow(F.lit(1.0 - alpha), exponent)


def _response(alpha: float, signal: float, m: Column) -> Column:
    """What a mean with weight ``alpha`` and value 1 adds to a signal with weight ``signal``
    over the next m rows without input."""
    r, q = 1.0 - alpha, 1.0 - signal
    if r == q:
        return m * F.pow(F.lit(q), m) * signal
    return (_power(alpha, m) - _power(signal, m)) * (signal * r / (r - q))


def _later(
    point: Mapping[str, Column], m: Column, means: Mapping[str, Ewm], signals: Mapping[str, Signal]
) -> dict[str, Column]:
    """The values of means and signals m rows after ``point``, without input."""
    out = {n: point[n] * _power(e.alpha, m) for n, e in means.items()}
    for n, s in signals.items():
        fast, slow = means[s.fast], means[s.slow]
        out[n] = (
            point[n] * _power(s.alpha, m)
            + point[s.fast] * _response(fast.alpha, s.alpha, m)
            - point[s.slow] * _response(slow.alpha, s.alpha, m)
        )
    return out


def block_ends(
    rows: DataFrame, means: Mapping[str, Ewm], size: int, keys: Sequence[str], signals: Mapping[str, Signal]
) -> DataFrame:
    """What the rows of each block add to every mean and signal at the block's end, ``(*keys, __end, __<name>)``.

    A sum over the rows, which tasks reduce before the shuffle. A row adds to a mean by its share
    and to a signal by the way its means go on; before the signal's first row they only go on.
    """
    rn = F.col("rn")
    left = F.lit(size - 1) - (rn - F.expr(f"rn div {size}") * size)

    def own(m: Ewm) -> Column:
        x = F.col(m.col)
        return F.coalesce(F.when(rn == m.start, x).when(rn > m.start, x * m.alpha), F.lit(0.0))

    point = {n: own(m) for n, m in means.items()}
    for n, s in signals.items():
        line = point[s.fast] - point[s.slow]
        point[n] = F.when(rn == s.start, line).when(rn > s.start, line * s.alpha).otherwise(0.0)
    out = _later(point, left, means, signals)
    for n, s in signals.items():
        before = F.greatest(F.lit(s.start) - rn, F.lit(0))
        at_start = {m: point[m] * _power(means[m].alpha, before) for m in (s.fast, s.slow)}
        at_start[n] = at_start[s.fast] - at_start[s.slow]
        only = {m: means[m] for m in (s.fast, s.slow)}
        out[n] = F.when(rn < s.start, _later(at_start, F.lit(size - 1 - s.start), only, {n: s})[n]).otherwise(out[n])
    return rows.groupBy(*keys, F.expr(f"rn div {size}").alias("__end")).agg(*[F.sum(v).alias(f"__{n}") for n, v in out.items()])


def smooth_blocks(
    blocks: DataFrame, rows: DataFrame, means: Mapping[str, Ewm], size: int, keys: Sequence[str] = SERIES_KEYS,
    signals: Mapping[str, Signal] | None = None,
) -> DataFrame:
    """Add ``means``, and ``signals`` made of them, to rows that carry ``rn`` and ``blk`` (core rows only).

    ``rows`` are the same rows before they were put in blocks, with the columns of the means.
    Only ``blocks`` is shuffled row by row; ``rows`` is reduced to block ends first.
    """
    signals = signals or {}
    everything = {**means, **signals}
    alphas = [m.alpha for m in everything.values()]
    if not all(0 < a < 1 for a in alphas):
        raise ValueError("alpha must be above 0 and below 1")
    if size * max(map(_digits, alphas)) > 300:
        raise ValueError("blocks too long for these weights")
    if any(s.start >= size for s in signals.values()):
        raise ValueError("a signal must start in the first block")
    keys = list(keys)
    rn, place = F.col("rn"), F.col("rn") - F.col("blk") * size
    so_far = block_window(keys).rowsBetween(Window.unboundedPreceding, 0)

    def running(value: Column, m: Ewm | Signal) -> Column:
        share = F.when(rn == m.start, value).when(rn > m.start, value * m.alpha)
        total = F.sum(share * _power(m.alpha, -place)).over(so_far)
        return F.coalesce(total, F.lit(0.0)) * _power(m.alpha, place)

    local = blocks.select("*", *[running(F.col(m.col), m).alias(f"__{n}") for n, m in means.items()])
    if signals:
        local = local.select(
            "*", *[running(F.col(f"__{s.fast}") - F.col(f"__{s.slow}"), s).alias(f"__{n}") for n, s in signals.items()]
        )
    ends = block_ends(rows, means, size, keys, signals).withColumn(
        "__k", F.explode(F.sequence(F.lit(1), F.lit(_look_back(size, alphas))))
    )
    passed = _later({n: F.col(f"__{n}") for n in everything}, (F.col("__k") - 1) * size, means, signals)
    carry = ends.groupBy(*keys, (F.col("__end") + F.col("__k")).alias("blk")).agg(
        *[F.sum(v).alias(f"__carry_{n}") for n, v in passed.items()]
    )
    joined = local.join(carry, [*keys, "blk"], "left")
    faded = _later({n: F.col(f"__carry_{n}") for n in everything}, place + 1, means, signals)
    return joined.select(
        *[c for c in blocks.columns if c not in everything],
        *[
            F.when(rn >= m.first, F.col(f"__{n}") + F.coalesce(faded[n], F.lit(0.0))).alias(n)
            for n, m in everything.items()
        ],
    )


def ewma(
    df: DataFrame, means: Mapping[str, Ewm], keys: Sequence[str] = SERIES_KEYS, size: int | None = None
) -> DataFrame:
    """Add several means at once; they share one exchange and one carry table.

    The columns may hold NULL only before the ``start`` row of their mean.
    """
    moving = {n: m for n, m in means.items() if m.alpha != 1}
    size = size or block_size([m.alpha for m in means.values()])
    numbered = df if "rn" in df.columns else row_ordinal(df, keys)
    out = smooth_blocks(row_blocks(numbered, size=size), numbered, moving, size, keys).drop("blk", "core") if moving else numbered
    # alpha = 1 is the value itself.
    same = {n: F.when(F.col("rn") >= m.first, F.col(m.col)) for n, m in means.items() if n not in moving}
    return out.withColumns(same) if same else out


# ---- indicators ---------------------------------------------------------------------


BEFORE = "close_before"  # the value in the row before, as row_ordinal adds it


def numbered_with_previous(
    df: DataFrame, col: str, keys: Sequence[str] = SERIES_KEYS, size: int = BLOCK_ROWS, before: str = BEFORE
) -> DataFrame:
    """``df`` with ``rn`` and the value of ``col`` in the row before, found in the numbering pass
    unless ``df`` has its ordinals already; then by an exchange of its own."""
    if before in df.columns:
        return df
    if "rn" not in df.columns:
        return row_ordinal(df, keys, previous={before: col})
    lagged = row_blocks(df, before=1, size=size).withColumn(before, F.lag(col).over(block_window(keys)))
    return lagged.where("core").drop("blk", "core")


def move_cols(col: str, before: str = BEFORE) -> dict[str, Column]:
    """Size of the rise and of the fall against the row before; 0 on the first row."""
    move = F.col(col) - F.col(before)
    return {"__rise": F.when(move > 0, move).otherwise(0.0), "__fall": F.when(move < 0, -move).otherwise(0.0)}


def rsi_means(window: int) -> dict[str, Ewm]:
    return {
        "__rise_mean": Ewm("__rise", 1.0 / window, window),
        "__fall_mean": Ewm("__fall", 1.0 / window, window),
    }


def rsi_col() -> Column:
    up, down = F.col("__rise_mean"), F.col("__fall_mean")
    return F.when(down == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + F.try_divide(up, down)))


def macd_means(col: str, fast: int, slow: int) -> dict[str, Ewm]:
    return {"__fast": Ewm.span(col, fast), "__slow": Ewm.span(col, slow)}


def macd_signal(slow: int, sign: int) -> dict[str, Signal]:
    return {"__signal": Signal("__fast", "__slow", 2.0 / (sign + 1), sign, slow - 1)}


def macd_col() -> Column:
    return F.col("__fast") - F.col("__slow") - F.col("__signal")


def rsi(
    df: DataFrame, col: str = "close", window: int = 14, out: str = "rsi", keys: Sequence[str] = SERIES_KEYS,
    size: int | None = None,
) -> DataFrame:
    """Relative strength on Wilder means; 100 where the mean fall is 0, NULL in the first ``window - 1`` rows."""
    means = rsi_means(window)
    size = size or block_size([m.alpha for m in means.values()])
    moves = numbered_with_previous(df, col, keys, size).withColumns(move_cols(col))
    rest = [c for c in df.columns if c not in (out, BEFORE)]
    return smooth_blocks(row_blocks(moves, size=size), moves, means, size, keys).select(*rest, rsi_col().alias(out))


def macd_diff(
    df: DataFrame, col: str = "close", fast: int = 12, slow: int = 26, sign: int = 9, out: str = "macd_diff",
    keys: Sequence[str] = SERIES_KEYS, size: int | None = None,
) -> DataFrame:
    """Fast minus slow mean, less the mean of that line; first value on row ``slow + sign - 2``."""
    means, signal = macd_means(col, fast, slow), macd_signal(slow, sign)
    size = size or block_size([m.alpha for m in (*means.values(), *signal.values())])
    numbered = df if "rn" in df.columns else row_ordinal(df, keys)
    lines = smooth_blocks(row_blocks(numbered, size=size), numbered, means, size, keys, signal)
    return lines.select(*[c for c in df.columns if c != out], macd_col().alias(out))
