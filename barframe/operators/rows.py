"""Row selections: complete rows, folds, first, latest and best rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barframe.operators.blocks import row_ordinal


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop the rows with a missing value; an infinite one is kept."""
    return df.na.drop("any", subset=list(cols) if cols else None)


def require_rows(df: DataFrame, n: int = 500, message: str = "too few complete rows for training") -> DataFrame:
    """``df``, or an error if it has fewer than ``n`` rows. Reads at most ``n`` rows."""
    if df.limit(n).count() < n:
        raise ValueError(message)
    return df


def time_series_split(
    df: DataFrame, n_splits: int = 5, fold: int | None = -1, gap: int = 0, time_col: str = "ts", bucket: str = "day",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Expanding splits in time order, with columns ``fold`` (0-based) and ``part`` (train or test),
    of the table or of each key. Rows without time or key are in no split; ``n_splits`` rows or
    fewer are an error.

    With ``k = n // (n_splits + 1)`` the fold ``f`` tests ``k`` rows from ``n - (n_splits - f) * k``
    on and trains on all rows before them, less the last ``gap``. ``fold=-1`` is the last
    fold and ``None`` gives all of them.
    """
    numbered = df.drop("rn").withColumnRenamed(time_col, "__ts")
    numbered = row_ordinal(numbered, keys=keys, time_col="__ts", bucket=bucket).withColumnRenamed("__ts", time_col)
    timed = df.na.drop("any", subset=[*keys, time_col])
    enough = lambda n: F.when(n > n_splits, n).otherwise(F.raise_error(F.format_string(f"%d rows cannot make {n_splits} folds", n)).cast("bigint"))
    if keys:
        counted = timed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        numbered = numbered.join(counted, list(keys)).withColumn("n", enough(F.col("n")))
    else:
        numbered = numbered.withColumn("n", enough(timed.agg(F.count(F.lit(1))).scalar()))
    k = F.expr(f"n div {n_splits + 1}")
    folds = list(range(n_splits)) if fold is None else [range(n_splits)[fold]]
    start = F.col("n") - (n_splits - F.col("fold")) * k
    split = (
        numbered.withColumn("fold", F.explode(F.array(*[F.lit(f) for f in folds])))
        .withColumn(
            "part",
            F.when(F.col("rn") < start - gap, "train").when((F.col("rn") >= start) & (F.col("rn") < start + k), "test"),
        )
    )
    return split.where("part is not null").drop("n")


def latest_row(df: DataFrame, keys: Sequence[str] = (), time_col: str = "ts", tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The last row by time, of the table or of each key; of rows with one time the last by ``tie_breakers``."""
    if not keys:
        return df.orderBy(F.col(time_col).desc(), *[F.col(c).desc() for c in tie_breakers]).limit(1)
    if tie_breakers:
        last_by = Window.partitionBy(*keys).orderBy(F.col(time_col).desc(), *[F.col(c).desc() for c in tie_breakers])
        return df.withColumn("__rank", F.row_number().over(last_by)).where("__rank = 1").drop("__rank")
    rest = [c for c in df.columns if c not in (*keys, time_col)]
    # One max_by per column: over numbers this stays a hash aggregate, over a struct it would sort.
    last = [F.max_by(c, time_col).alias(c) for c in rest]
    return df.groupBy(*keys).agg(F.max(time_col).alias(time_col), *last).select(*df.columns)


def head_rows(df: DataFrame, order: Sequence[str | Column], max_rows: int = 20, keys: Sequence[str] = ()) -> DataFrame:
    """The first rows in the given order, of the table or of each key."""
    if not keys:
        return df.orderBy(*order).limit(max_rows)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= max_rows).drop("__rank")


def data_points(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("data_points"))
