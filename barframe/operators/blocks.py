"""Row ordinals and row blocks of ordered series.

A window over a whole series is one task per series, and one series may hold a third of
all rows. Here a series is cut twice, and no task sees more than one piece:

* ``row_ordinal`` numbers the rows by calendar bucket and adds the number of rows in the
  earlier buckets;
* ``row_blocks`` cuts the numbered rows in blocks of equal size and copies the few rows
  that a frame of a neighbouring block reaches into that block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SERIES_KEYS = ("symbol",)
BLOCK_ROWS = 4096


def row_ordinal(
    df: DataFrame,
    keys: Sequence[str] = SERIES_KEYS,
    time_col: str = "ts",
    tie_breakers: Sequence[str] = (),
    bucket: str = "day",
    name: str = "rn",
    previous: Mapping[str, str] | None = None,
    cut: str | None = None,
) -> DataFrame:
    """Position 0..n-1 of each row in its series, by ``(time_col, *tie_breakers)``.

    ``bucket`` (a ``date_trunc`` unit) bounds the rows one task sorts; a day holds 1440
    one-minute bars, and a table of ticks wants a smaller unit. The table of bucket counts
    holds one row per series and bucket; only that table is put in order as a whole. Rows
    without key or time belong to no series and are dropped before anything is counted.
    ``previous`` (new name -> column) adds the value a column has in the row before, NULL in the
    first: inside a bucket by ``lag``, and for its first row from the table of buckets. ``cut`` names
    a column that already holds the calendar bucket; rows stored by key and ``cut`` stay in place.
    """
    previous = previous or {}
    keys = list(keys)
    given, cut, before = cut, "__bucket", "__before"
    df = df.na.drop("any", subset=[*keys, time_col])
    bucketed = df.withColumn(cut, F.col(given) if given else F.date_trunc(bucket, F.col(time_col)))
    buckets = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(cut)
    earlier = buckets.rowsBetween(Window.unboundedPreceding, -1)
    order = F.struct(time_col, *tie_breakers) if tie_breakers else F.col(time_col)
    offsets = (
        bucketed.groupBy(*keys, cut)
        .agg(F.count(F.lit(1)).alias("__n"), *[F.max_by(c, order).alias(f"__last_{n}") for n, c in previous.items()])
        .select(
            *keys, cut, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias(before),
            *[F.lag(f"__last_{n}").over(buckets).alias(f"__last_{n}") for n in previous],
        )
    )
    inside = Window.partitionBy(*keys, cut).orderBy(time_col, *tie_breakers)
    place = F.row_number().over(inside)
    added = {n: F.when(place == 1, F.col(f"__last_{n}")).otherwise(F.lag(c).over(inside)) for n, c in previous.items()}
    return (
        bucketed.join(offsets, [*keys, cut])
        .withColumns({name: F.col(before) + place - 1, **added})
        .select(*[c for c in df.columns if c not in added], name, *added)
    )


def row_blocks(
    df: DataFrame,
    before: int = 0,
    after: int = 0,
    size: int = BLOCK_ROWS,
    rn: str = "rn",
) -> DataFrame:
    """Add ``blk`` and ``core``: each row in its own block, and copies in the blocks whose
    frames reach up to ``before`` rows back or ``after`` rows ahead.

    ``core`` is true for the row in its own block. Compute over ``block_window`` and keep
    the core rows.
    """
    own = F.expr(f"{rn} div {size}")
    if not before and not after:
        return df.withColumn("blk", own).withColumn("core", F.lit(True))
    first = F.expr(f"greatest({rn} - {after}, 0) div {size}")
    last = F.expr(f"({rn} + {before}) div {size}")
    return df.withColumn("blk", F.explode(F.sequence(first, last))).withColumn("core", F.col("blk") == own)


def block_window(keys: Sequence[str] = SERIES_KEYS, rn: str = "rn") -> WindowSpec:
    return Window.partitionBy(*keys, "blk").orderBy(rn)


def over_blocks(
    df: DataFrame,
    build,
    before: int = 0,
    after: int = 0,
    keys: Sequence[str] = SERIES_KEYS,
    size: int = BLOCK_ROWS,
) -> DataFrame:
    """Add the columns ``build(window)`` returns as ``{name: Column}``, block by block.

    ``df`` gets its ordinal ``rn`` first if it has none.
    """
    numbered = df if "rn" in df.columns else row_ordinal(df, keys)
    columns: dict[str, Column] = build(block_window(keys))
    return (
        row_blocks(numbered, before, after, size)
        .withColumns(columns)
        .where("core")
        .select(*[c for c in numbered.columns if c not in columns], *columns)
    )
