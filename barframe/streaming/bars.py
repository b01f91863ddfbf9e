"""Bars from a stream of ticks."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barframe.session import shared_path
from barframe.sources.bars import OHLCV, bar_columns

NEVER_LATE = "400000 days"  # longer than any input, so that no watermark passes a window
AT_END = -1  # stands for the micro-batch in the folder of the windows closed at the end
BAR_SCHEMA = "symbol string, ts timestamp, open double, high double, low double, close double, volume double"


def stream_bars(ticks: DataFrame, interval: str = "1 minute", delay: str = "5 minutes") -> DataFrame:
    """Bars of ``ticks(symbol, event_id, ts, price)``, each given once, when the watermark
    has passed its end. Ticks later than ``delay`` may be dropped."""
    return (
        ticks.where("price is not null and not isnan(price)")
        .withColumn("ts", F.col("ts").cast("timestamp"))  # a watermark needs a zoned timestamp
        .withWatermark("ts", delay)
        .groupBy("symbol", F.window("ts", interval).alias("__w"))
        .agg(*bar_columns())
        .select("symbol", F.col("__w.start").alias("ts"), *OHLCV)
    )


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Take all that has arrived, append the finished rows to the table at ``path``, and stop."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()


def open_bars(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The bars of the windows that a stopped ``stream_bars`` still holds open, from its state."""
    state = spark.read.format("statestore").load(checkpoint)
    # The buffers of bar_columns, in their order; two of the names occur twice, so the cast gives new ones.
    held = F.col("value").cast("struct<open: double, open_at: decimal(38,0), high: double, low: double, close: double, close_at: decimal(38,0), volume: double>")
    return state.select(F.col("key.symbol").alias("symbol"), F.col("key.window.start").alias("ts"), held.alias("held")).select("symbol", "ts", *[f"held.{c}" for c in OHLCV])


def run_to_end(ticks: DataFrame, path: str, checkpoint: str, interval: str = "1 minute", delay: str = NEVER_LATE) -> None:
    """Take all that has arrived of a finite input and write all its bars, open windows included.

    Bars are appended, each once: a window that the watermark passes leaves with its micro-batch,
    and when the input has ended one pass over the state writes the windows that are still open.
    Ticks later than ``delay`` may be dropped; by default none from 1970 on is late, and all windows
    stay open till the end. Folders are named by the micro-batch, so a retry replaces what it left.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = (
        stream_bars(ticks, interval, delay).writeStream.outputMode("append")
        .foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    spark = ticks.sparkSession
    try:
        left = open_bars(spark, checkpoint)
    except PySparkException as error:
        if not (error.getCondition() or "").startswith("STDS_"):
            raise
        left = spark.createDataFrame([], BAR_SCHEMA)  # nothing has arrived, so there is no state
    left.write.mode("overwrite").parquet(f"{path}/batch_id={AT_END}")


def read_bars_to_end(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``run_to_end`` has written."""
    return spark.read.schema(BAR_SCHEMA).option("recursiveFileLookup", True).parquet(path)


def bars_to_end(spark: SparkSession, ticks: DataFrame, interval: str = "1 minute", delay: str = NEVER_LATE) -> DataFrame:
    """``run_to_end`` into a new table of the shared folder, read back."""
    path = shared_path(spark, "stream")
    run_to_end(ticks, f"{path}/table", f"{path}/checkpoint", interval, delay)
    return read_bars_to_end(spark, f"{path}/table")


def stream_once(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Run a stream over what is there into a new table of the shared folder, and read it."""
    path = shared_path(spark, "stream")
    run_to_table(stream, f"{path}/table", f"{path}/checkpoint")
    return spark.read.schema(StructType(stream.schema.fields)).parquet(f"{path}/table")
