"""Several series side by side, one row per row of a primary series."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barframe.operators.blocks import row_ordinal

Columns = Mapping[str, tuple[str, str]]  # output name -> (symbol, column)


def align_by_position(df: DataFrame, primary: str, columns: Columns, keep: Sequence[str] = ("ts",)) -> DataFrame:
    """Row i of every series beside row i of the primary one.

    Longer series lose their extra rows, shorter ones give NULL. One grouping on the
    ordinal does all the joins; a group holds one row per series.
    """
    numbered = df if "rn" in df.columns else row_ordinal(df)
    wanted = {primary, *(symbol for symbol, _ in columns.values())}
    is_primary = F.col("symbol") == primary
    return (
        numbered.where(F.col("symbol").isin(*wanted))
        .groupBy("rn")
        .agg(
            F.max(is_primary).alias("__primary"),
            *[F.max(F.when(is_primary, F.col(c))).alias(c) for c in keep],
            *[F.max(F.when(F.col("symbol") == s, F.col(c))).alias(name) for name, (s, c) in columns.items()],
        )
        .where("__primary")
        .drop("__primary")
    )


SHORTEST_BIN, LONGEST_BIN = 60, 3600  # seconds


def align_by_time(df: DataFrame, primary: str, columns: Columns, tolerance: str | None = None) -> DataFrame:
    """The bars of the other series at the time of each primary bar.

    Without ``tolerance`` the times must be equal. With one (an interval such as
    ``'15 minutes'``) the latest bar at or before the primary bar counts if it is not
    older than that; values of one series always come from one bar.

    Times are put in order bin by bin, and a bin is as long as the tolerance (a minute at least,
    an hour at most). The last bar of each series in a bin is handed to the next one: nothing
    older than that can count. Only beyond an hour it is carried on from any earlier bin, by a
    window over one row per bin.
    """
    others = sorted({s for s, _ in columns.values()} - {primary})
    wide = (
        df.where(F.col("symbol").isin(primary, *others))
        .groupBy("ts")
        .agg(
            F.max(F.col("symbol") == primary).alias("__primary"),
            *[F.max(F.col("symbol") == s).alias(f"__has_{s}") for s in others],
            *[F.max(F.when(F.col("symbol") == s, F.col(c))).alias(name) for name, (s, c) in columns.items()],
        )
    )
    if tolerance is None:
        return wide.where("__primary").select("ts", *columns)

    # One struct per series and time; the last one seen is carried forward.
    def bar_of(symbol: str):
        own = [F.col(name).alias(name) for name, (s, _) in columns.items() if s == symbol]
        return F.when(F.col(f"__has_{symbol}"), F.struct(F.col("ts").alias("at"), *own))

    # An interval may hold months, which have no length; such a tolerance is long in any case.
    seconds = df.sparkSession.range(1).select(F.unix_micros(F.expr(f"timestamp '2000-01-01' + interval {tolerance}")) / 1e6 - F.unix_micros(F.expr("timestamp '2000-01-01'")) / 1e6).first()[0]
    length = min(max(math.ceil(seconds), SHORTEST_BIN), LONGEST_BIN)
    binned = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(length * 1_000_000)).cast("long")
    bars = wide.withColumn("__bin", binned).withColumns({f"__bar_{s}": bar_of(s) for s in others})
    up_to_now = Window.partitionBy("__bin").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    last = bars.groupBy("__bin").agg(*[F.max(f"__bar_{s}").alias(f"__old_{s}") for s in others])
    if seconds <= length:
        closing = last.withColumn("__bin", F.col("__bin") + 1)
    else:
        earlier = Window.partitionBy(F.lit(0)).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
        closing = last.select("__bin", *[F.last(f"__old_{s}", ignorenulls=True).over(earlier).alias(f"__old_{s}") for s in others])
    seen = bars.withColumns(
        {f"__bar_{s}": F.last(f"__bar_{s}", ignorenulls=True).over(up_to_now) for s in others}
    ).where("__primary")
    filled = seen.join(closing, "__bin", "left").withColumns(
        {f"__bar_{s}": F.coalesce(f"__bar_{s}", f"__old_{s}") for s in others}
    )
    limit = F.expr(f"interval {tolerance}")

    def value(name: str, symbol: str):
        if symbol == primary:
            return F.col(name)
        bar = F.col(f"__bar_{symbol}")
        return F.when(bar["at"] >= F.col("ts") - limit, bar[name])

    return filled.select("ts", *[value(name, s).alias(name) for name, (s, _) in columns.items()])


def attach_scalar(df: DataFrame, scalar: DataFrame, name: str) -> DataFrame:
    """One value, from a one-row one-column table, on all rows."""
    return df.withColumn(name, scalar.scalar())
