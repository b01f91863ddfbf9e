"""Bar tables: read finished bars, or build them from single trades or events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.fixed_values import INSTRUMENTS
from barframe.operators.rows import drop_incomplete

OHLCV = ("open", "high", "low", "close", "volume")


def project_ohlcv(df: DataFrame) -> DataFrame:
    """The key columns and the five bar columns."""
    return df.select("symbol", F.col("ts").cast("timestamp").alias("ts"), *OHLCV)


def read_bars(
    spark: SparkSession, path: str, symbols: Sequence[str] | None = None, days: int | None = 7,
    end: str | None = None, fmt: str = "parquet",
) -> DataFrame:
    """Complete bars of the last ``days`` days, back from ``end`` or from the latest bar read.

    With ``end`` given, both bounds are literals and prune the files.
    """
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    if fmt == "csv":
        doubles = ", ".join(f"{c} double" for c in OHLCV)
        reader = reader.schema(f"symbol string, ts timestamp, {doubles}")
    bars = project_ohlcv(reader.format(fmt).load(path))
    if symbols is not None:
        bars = bars.where(F.col("symbol").isin(*symbols))
    if days is not None:
        last = F.lit(end).cast("timestamp") if end else bars.agg(F.max("ts")).scalar()
        bars = bars.where(F.col("ts") >= last - F.make_dt_interval(F.lit(days)))
        if end:
            bars = bars.where(F.col("ts") <= last)
    return drop_incomplete(bars)


BUCKETS = 64  # files of a day


def write_bar_table(bars: DataFrame, name: str, path: str, buckets: int = BUCKETS, mode: str = "append") -> None:
    """Store bars as the table ``name``: partitioned by date, bucketed by symbol and day, sorted by time.

    A day of a symbol lies in one bucket, in order, so what works per symbol and day needs no
    exchange of the rows (``row_ordinal`` with ``cut="day"``), and a symbol with most of the bars
    spreads over its days. Incomplete bars are left out.
    """
    dated = drop_incomplete(project_ohlcv(bars)).withColumn("day", F.to_date("ts")).withColumn("date", F.col("day"))
    spread = dated.repartition(buckets, "symbol", "day")
    spread.write.mode(mode).format("parquet").option("path", path).partitionBy("date").bucketBy(buckets, "symbol", "day").sortBy("symbol", "ts").saveAsTable(name)


def open_bar_table(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> None:
    """Make a table that another session has stored known to this one, with the partitions it has by now."""
    columns = "symbol string, ts timestamp, open double, high double, low double, close double, volume double, day date, date date"
    spark.sql(
        f"create table if not exists {name} ({columns}) using parquet location '{path}' partitioned by (date) "
        f"clustered by (symbol, day) sorted by (symbol, ts) into {buckets} buckets"
    )
    spark.sql(f"alter table {name} recover partitions")


def newest_date(spark: SparkSession, name: str) -> str | None:
    """The last date of a bar table, from the names of its partitions."""
    found = spark.sql(f"show partitions {name}").agg(F.max(F.substring_index("partition", "=", -1))).first()
    return found[0]


def read_bar_table(spark: SparkSession, name: str, symbols: Sequence[str] | None = None, days: int | None = 7, end: str | None = None) -> DataFrame:
    """Bars of the last ``days`` days, back from ``end`` or from the latest bar, with their ``day``.

    Only folders of these days are read: the newest date comes from the partitions' names, and the
    latest bar is looked for in that one.
    """
    bars = spark.table(name)
    if symbols is not None:
        bars = bars.where(F.col("symbol").isin(*symbols))
    if days is not None:
        if end is None:
            newest = newest_date(spark, name)
            end = bars.where(F.col("date") == F.lit(newest).cast("date")).agg(F.max("ts").cast("string")).first()[0] if newest else None
            if end is None and newest:  # the wanted symbols have no bar that day
                end = bars.agg(F.max("ts").cast("string")).first()[0]
        last = F.lit(end).cast("timestamp")
        first = last - F.make_dt_interval(F.lit(days))
        bars = bars.where(F.col("date").between(F.to_date(first), F.to_date(last)) & F.col("ts").between(first, last))
    return bars.select("symbol", "ts", *OHLCV, "day")


def instrument_catalog(spark: SparkSession, instruments: Mapping[str, str] = INSTRUMENTS) -> DataFrame:
    """Name and vendor symbol of each instrument, from a small mapping."""
    return spark.createDataFrame(list(instruments.items()), "name string, symbol string")


def named_bars(bars: DataFrame, instruments: Mapping[str, str] = INSTRUMENTS) -> DataFrame:
    """Bars of the catalog's instruments, with the catalog name as ``symbol``."""
    names = F.create_map(*[F.lit(x) for name, symbol in instruments.items() for x in (symbol, name)])
    return bars.where(F.col("symbol").isin(*instruments.values())).withColumn("symbol", names[F.col("symbol")])


def tick_order(ts: str = "ts", event_id: str = "event_id") -> Column:
    """``(ts, event_id)`` as one decimal.

    A fixed-width order keeps ``min_by`` and ``max_by`` in a hash aggregate; a struct would
    force a sort of all ticks before the partial aggregation.
    """
    width = "20000000000000000000BD"  # wider than the range of a long
    return F.expr(f"cast(unix_micros({ts}) as decimal(18, 0)) * {width} + cast({event_id} as decimal(20, 0))")


def bar_columns(price: str = "price", order: Column | None = None) -> list[Column]:
    order = tick_order() if order is None else order
    return [
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.count(F.lit(1)).cast("double").alias("volume"),
    ]


def build_bars(ticks: DataFrame, interval: str = "1 minute") -> DataFrame:
    """Bars of ``ticks(symbol, event_id, ts, price)``; the time of a bar is its start.

    Ticks are reduced before the shuffle, and a busy symbol spreads over its bars.
    """
    return (
        ticks.where("price is not null and not isnan(price)")
        .groupBy("symbol", F.window("ts", interval).alias("__w"))
        .agg(*bar_columns())
        .select("symbol", F.col("__w.start").alias("ts"), *OHLCV)
    )
