"""Features of several series, and the table a trend model is trained on."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.fixed_values import BASE_FEATURES, FEATURE_GROUPS, FEATURE_SOURCES, INSTRUMENTS, PRIMARY, TARGET
from barframe.functions import series as fx
from barframe.operators import smoothing as sm
from barframe.operators.align import align_by_position, align_by_time
from barframe.operators.blocks import SERIES_KEYS, block_window, row_blocks
from barframe.operators.rows import drop_incomplete, latest_row

RETURN_COLUMNS = ("return", "return_1h", "target", "rsi", "macd", "volatility")


def add_returns(
    bars: DataFrame, horizon: int = 60, rsi_window: int = 14, fast: int = 12, slow: int = 26, sign: int = 9,
    vol_window: int = 30, null_tail: bool = False, keys: Sequence[str] = SERIES_KEYS,
    size: int | None = None,
) -> DataFrame:
    """Returns, target, RSI, MACD difference and volatility of every series, and the ordinal ``rn``.

    All frames and means share one exchange on ``(symbol, block)``, in blocks of ``size`` rows: a
    block gets the rows its frames reach in the blocks beside it, and the means add their carry by
    a join on the same key. The carry comes from the numbered rows, reduced to block ends before
    their shuffle. Hand in bars that ``row_ordinal`` numbered with ``previous={"close_before":
    "close"}``, or bars without ordinals; others get the close before by one more exchange.
    """
    means = {**sm.rsi_means(rsi_window), **sm.macd_means("close", fast, slow)}
    signal = sm.macd_signal(slow, sign)
    size = size or sm.block_size([m.alpha for m in (*means.values(), *signal.values())])
    numbered = sm.numbered_with_previous(bars, "close", keys, size).withColumns(sm.move_cols("close"))
    rest = [c for c in numbered.columns if c not in (sm.BEFORE, "__rise", "__fall")]
    w = block_window(keys)
    framed = (
        row_blocks(numbered, before=max(horizon, vol_window - 1), after=horizon, size=size)
        .withColumns(
            {
                "return": F.try_divide(F.col("close"), F.col(sm.BEFORE)) - 1,
                "return_1h": fx.pct_change_col("close", horizon, w),
                "target": fx.target_col(fx.forward_return_col("close", horizon, w), null_tail),
                "volatility": fx.rolling_std_col("close", vol_window, w),
            }
        )
        .where("core")
    )
    return sm.smooth_blocks(framed, numbered, means, size, keys, signal).select(
        *rest, "return", "return_1h", "target", sm.rsi_col().alias("rsi"), sm.macd_col().alias("macd"), "volatility"
    )


def require_series(bars: DataFrame, names: Collection[str] = tuple(INSTRUMENTS), primary: str = PRIMARY) -> list[str]:
    """The wanted series that have bars; an error if the primary one has none.

    Brings one row per wanted series to the driver.
    """
    found = {r["symbol"] for r in bars.where(F.col("symbol").isin(*names)).select("symbol").distinct().collect()}
    if primary not in found:
        raise ValueError(f"the primary series {primary} has no bars")
    return [n for n in names if n in found]


def feature_columns(present: Collection[str]) -> dict[str, tuple[str, str]]:
    """Feature name -> (series, column), for the series that are present."""
    return {name: source for name, source in FEATURE_SOURCES.items() if source[0] in present}


def feature_table(
    bars: DataFrame, sentiment: DataFrame | int = 0, present: Collection[str] | None = None, primary: str = PRIMARY,
    align: str = "position", tolerance: str | None = None, tz: str | None = None, null_tail: bool = False,
    complete: bool = True, size: int | None = None,
) -> DataFrame:
    """One row per primary bar, with the features of all series and the target.

    ``bars`` carries the catalog names in ``symbol``. ``align`` is ``position`` (row i beside
    row i) or ``time``. ``present`` names the series to use; without it the bars are asked.
    """
    present = require_series(bars, primary=primary) if present is None else list(present)
    wanted = bars.where(F.col("symbol").isin(*present))
    columns = {**feature_columns(present), TARGET: (primary, "target")}
    long = add_returns(wanted, null_tail=null_tail, size=size)
    if align == "position":
        wide = align_by_position(long, primary, columns)
    else:
        wide = align_by_time(long, primary, columns, tolerance)
    score = sentiment.scalar() if isinstance(sentiment, DataFrame) else F.lit(sentiment)
    features = [c for c in columns if c != TARGET]
    table = wide.withColumns(fx.session_parts("ts", tz)).withColumn("Sentiment", score.cast("int")).select(
        "ts", *features, "Hour", "Minute", "DayOfWeek", "Sentiment", F.col(TARGET).cast("int").alias(TARGET)
    )
    return drop_incomplete(table) if complete else table


def select_features(columns: Collection[str]) -> list[str]:
    """The model's features among the columns, in their fixed order."""
    wanted = list(BASE_FEATURES)
    for marker, group in FEATURE_GROUPS:
        if marker in columns:
            wanted += group
    return [c for c in wanted if c in columns]


def latest_features(table: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """The newest row of the feature table: the one to score. Of rows with one time, the last by their values."""
    row = latest_row(table, tie_breakers=[c for c in table.columns if c != "ts"])
    return row.select("ts", *features) if features else row


