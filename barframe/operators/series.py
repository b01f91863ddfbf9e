"""Time-series operators on long tables ``(symbol, ts, ...)``.

Each takes the rows of any number of series and works on row blocks (see ``blocks``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from barframe.functions import series as fx
from barframe.operators.blocks import BLOCK_ROWS, SERIES_KEYS, over_blocks


def pct_change(
    df: DataFrame, col: str = "close", n: int = 1, out: str | None = None,
    keys: Sequence[str] = SERIES_KEYS, size: int = BLOCK_ROWS,
) -> DataFrame:
    name = out or f"{col}_change_{n}"
    return over_blocks(df, lambda w: {name: fx.pct_change_col(col, n, w)}, before=n, keys=keys, size=size)


def forward_target(
    df: DataFrame, col: str = "close", horizon: int = 60, out: str = "target", null_tail: bool = False,
    keys: Sequence[str] = SERIES_KEYS, size: int = BLOCK_ROWS,
) -> DataFrame:
    """1 if the ``horizon``-row return, ``horizon`` rows ahead, is positive, else 0."""
    return over_blocks(
        df,
        lambda w: {out: fx.target_col(fx.forward_return_col(col, horizon, w), null_tail)},
        after=horizon, keys=keys, size=size,
    )


def rolling_std(
    df: DataFrame, col: str = "close", n: int = 30, out: str = "volatility",
    keys: Sequence[str] = SERIES_KEYS, size: int = BLOCK_ROWS,
) -> DataFrame:
    return over_blocks(df, lambda w: {out: fx.rolling_std_col(col, n, w)}, before=n - 1, keys=keys, size=size)


def session_parts(df: DataFrame, ts: str = "ts", tz: str | None = None) -> DataFrame:
    return df.withColumns(fx.session_parts(ts, tz))
