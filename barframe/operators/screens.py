"""Activity screens: tagged unions of record tables and ranked lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barframe.fixed_values import KEYS_COLUMN, REASON_COLUMN
from barframe.operators.rows import head_rows
from barframe.sources.records import record_keys


def tag_reason(df: DataFrame, category: str | Column) -> DataFrame:
    return df.withColumn(REASON_COLUMN, F.lit(category) if isinstance(category, str) else category)


def add_record_keys(df: DataFrame, raw: str = "raw") -> DataFrame:
    return df.withColumn(KEYS_COLUMN, record_keys(raw))


def union_categories(*dfs: DataFrame) -> DataFrame:
    """All rows of all tables by column name; a column a table lacks is NULL, duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def reasons_by_stock(df: DataFrame, symbol: str = "symbol", reason: str = REASON_COLUMN) -> DataFrame:
    """The sorted distinct reasons of each symbol, and how many there are."""
    distinct = df.select(symbol, reason).distinct()
    return distinct.groupBy(symbol).agg(
        F.sort_array(F.collect_set(reason)).alias("reasons"), F.count(reason).alias("reason_count")
    )


# ---- ranked lists ---------------------------------------------------------------------


def activity_by_symbol(trades: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Traded value and volume per key of ``trades(symbol, price, qty)``."""
    return trades.groupBy(*keys).agg(
        F.sum(F.col("price") * F.col("qty")).alias("value"), F.sum("qty").alias("volume")
    )


def volume_gain(periods: DataFrame, period: str = "period") -> DataFrame:
    """Volume of the last period over the mean volume of the earlier ones, per symbol of
    ``periods(symbol, period, volume)``. A symbol without trades in the last period of the
    table, or in none before, has no row."""
    last = periods.agg(F.max(period)).scalar()
    is_last = F.col(period) == F.col("__last")
    return (
        periods.withColumn("__last", last)
        .groupBy("symbol")
        .agg(
            F.sum(F.when(is_last, F.col("volume"))).alias("volume"),
            F.avg(F.when(~is_last, F.col("volume"))).alias("mean_volume"),
        )
        .where("volume is not null and mean_volume is not null")
        .withColumn("gain", F.try_divide("volume", "mean_volume"))
    )


def close_change(closes: DataFrame, order: str = "ts") -> DataFrame:
    """Last close over the close before it, less 1, per symbol of ``closes(symbol, ts, close)``.

    Each task keeps the two latest rows of a symbol before the shuffle.
    """
    two = head_rows(closes.select("symbol", order, "close"), [F.col(order).desc()], 2, ["symbol"])
    latest = two.groupBy("symbol").agg(
        F.max_by("close", order).alias("close"),
        F.min_by("close", order).alias("__previous"),
        F.count(F.lit(1)).alias("__n"),
    )
    change = F.try_divide("close", "__previous") - 1
    return latest.where("__n = 2").select("symbol", "close", change.alias("change")).where("change is not null")


def ranked_screen(
    df: DataFrame, metric: str, k: int = 10, ascending: bool = False, symbol: str = "symbol",
    keys: Sequence[str] = (),
) -> DataFrame:
    """The k best rows by ``metric``, ties by symbol; of the table or of each key."""
    by = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    return head_rows(df, [by, F.col(symbol)], k, keys)
