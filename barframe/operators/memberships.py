"""Index membership: one row per index and stock, with a cap class per stock."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barframe.fixed_values import CAP_CLASSES, CAP_COLUMN, INDEX_TYPE, MID_PATTERN, SMALL_PATTERN
from barframe.functions.names import quoted_name
from barframe.functions.text import name_matches, same_text
from barframe.operators.skew import join_per_key

RESERVED = ("Index", "Index Type", "Stock")


def drop_self_row(df: DataFrame, index: str = "index_name", symbol: str = "symbol", pos: str = "pos") -> DataFrame:
    """Drop the first record of an index if it is the index itself; later equal rows stay."""
    is_self = (F.col(pos) == 0) & same_text(F.coalesce(F.col(symbol), F.lit("")), index)
    return df.where(~is_self)


def membership_rows(df: DataFrame, index: str = "index_name", symbol: str = "symbol", drop: Sequence[str] = ()) -> DataFrame:
    """``Index``, ``Index Type``, ``Stock`` and all other fields; those three names are never overwritten."""
    rest = [c for c in df.columns if c not in (*RESERVED, index, *drop)]
    return df.select(
        F.col(index).alias("Index"), F.lit(INDEX_TYPE).alias("Index Type"), F.col(symbol).alias("Stock"), *map(quoted_name, rest)
    )


def order_columns(df: DataFrame, first: Sequence[str] = ("Stock", "Index Type", "Index")) -> DataFrame:
    lead = [c for c in first if c in df.columns]
    return df.select(*map(quoted_name, [*lead, *[c for c in df.columns if c not in lead]]))


def normalize_index(df: DataFrame, index: str = "Index") -> DataFrame:
    return df.withColumn(index, F.upper(index))


def distinct_members(df: DataFrame, pattern: str, index: str = "Index", stock: str = "Stock") -> DataFrame:
    return df.where(name_matches(index, pattern)).select(stock).distinct()


def cap_class_col(mid: Column, small: Column) -> Column:
    return (
        F.when(mid, CAP_CLASSES["mid"]).when(small, CAP_CLASSES["small"]).otherwise(CAP_CLASSES["large"])
    )


def membership_flags(
    df: DataFrame, index: str = "Index", stock: str = "Stock", mid: str = MID_PATTERN, small: str = SMALL_PATTERN
) -> DataFrame:
    """Per stock (NULL is one): is it in any mid or small index, and how many rows has it."""
    return df.groupBy(stock).agg(
        F.coalesce(F.bool_or(name_matches(index, mid)), F.lit(False)).alias("in_mid"),
        F.coalesce(F.bool_or(name_matches(index, small)), F.lit(False)).alias("in_small"),
        F.count(F.lit(1)).alias("rows"),
    )


def add_cap_class(
    df: DataFrame, index: str = "Index", stock: str = "Stock", mid: str = MID_PATTERN, small: str = SMALL_PATTERN,
    out: str = CAP_COLUMN,
) -> DataFrame:
    """Mid Cap before Small Cap before Large Cap, by the indices that hold the stock."""
    flags = membership_flags(df, index, stock, mid, small)
    per_stock = flags.select(stock, cap_class_col(F.col("in_mid"), F.col("in_small")).alias(out))
    return join_per_key(df, per_stock, stock)


def unique_stocks(df: DataFrame, stock: str = "Stock") -> DataFrame:
    return df.agg(F.countDistinct(stock).alias("unique_stocks"))


SKETCH_BITS = 12  # 4,096 registers: a relative error of 1.04 / 64 at one deviation


def stock_sketches(df: DataFrame, index: str = "Index", stock: str = "Stock", bits: int = SKETCH_BITS) -> DataFrame:
    """``(index, sketch)``: a small sketch of the distinct stocks of each index (NULL not counted).

    Sketches are kept and merged: those of new rows join the stored ones, and no row is read
    again. Stocks are counted by their text.
    """
    return df.groupBy(index).agg(F.hll_sketch_agg(F.col(stock).cast("string"), F.lit(bits)).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str] = ("Index",)) -> DataFrame:
    """One sketch per key (without keys, one for all) of any number of stored ones."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def approx_unique_stocks(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The number of distinct stocks by the sketches, of all or per key."""
    return merged_sketches(sketches, keys).select(*keys, F.hll_sketch_estimate("sketch").alias("unique_stocks"))


def sketch_error(bits: int = SKETCH_BITS, deviations: float = 4.0) -> float:
    """The relative error that an estimate stays within, at this many deviations."""
    return deviations * 1.04 / 2 ** (bits / 2)


def cap_summary(df: DataFrame, cap: str = CAP_COLUMN, stock: str = "Stock") -> DataFrame:
    """Distinct stocks (NULL not counted), and rows per class."""
    return df.agg(
        F.countDistinct(stock).alias("unique_stocks"),
        *[F.count_if(F.col(cap) == CAP_CLASSES[k]).alias(f"{k}_cap") for k in ("large", "mid", "small")],
    )


def index_coverage(df: DataFrame, catalog: DataFrame, index: str = "Index", name: str = "index_name") -> DataFrame:
    """How many of the configured indices have a row."""
    seen = df.select(F.upper(index).alias("__i")).distinct()
    return catalog.join(seen, F.upper(name) == F.col("__i"), "left").agg(
        F.count("__i").alias("successful_indices"), F.count(F.lit(1)).alias("configured_indices")
    )
