"""Driver tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.operators.blocks import row_ordinal
from barframe.operators.smoothing import BEFORE
from barframe.session import stored
from barframe.sources.bars import build_bars, named_bars

# Which event type plays which instrument.
INSTRUMENTS = {"NSEI": "click", "NSEBANK": "view", "SNP": "purchase", "INDIA_VIX": "error"}

MID, SMALL = "NATION_1$", "NATION_2$"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def as_ticks(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("symbol"), "event_id", F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
    )


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    return as_ticks(table(spark, sf, "events"))


def bars(spark: SparkSession, sf: str, interval: str = "1 minute") -> DataFrame:
    return build_bars(ticks(spark, sf), interval)


def stored_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Bars written once, so that the plans that read them twice reduce the ticks once."""
    return stored(bars(spark, sf), "bars")


def numbered_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered bars with the close before, as the indicators take them."""
    return row_ordinal(stored_bars(spark, sf), previous={BEFORE: "close"})


def named(spark: SparkSession, sf: str) -> DataFrame:
    return named_bars(bars(spark, sf), INSTRUMENTS)


def plain_ts(df: DataFrame, *cols: str) -> DataFrame:
    """Time columns without zone, as the stored tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols or ("ts",)})


def trades(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey")).alias("symbol"), F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("qty"), F.col("l_shipdate").alias("ts"), "l_returnflag",
    )


def members(spark: SparkSession, sf: str) -> DataFrame:
    """Which stock (part) is in which index (nation of a supplier of it)."""
    supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    return (
        table(spark, sf, "lineitem")
        .select("l_suppkey", "l_partkey")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("Index"), F.col("l_partkey").alias("Stock"))
        .distinct()
    )


def constituent_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One document per order; some list the index itself first, in another case."""
    nation = table(spark, sf, "nation")
    kind = (
        F.when(F.col("n_regionkey") == 0, "nifty midcap ")
        .when(F.col("n_regionkey") == 1, "nifty smallcap ")
        .otherwise("nifty ")
    )
    index = F.concat(kind, F.col("n_nationkey"))
    first = F.to_json(
        F.struct(
            F.when(F.col("o_orderstatus") == "F", F.upper(index)).otherwise(F.concat(F.lit("C"), "o_custkey")).alias("symbol"),
            F.col("o_totalprice").alias("lastPrice"),
        )
    )
    second = F.to_json(
        F.struct(
            F.when(F.col("o_orderstatus") == "P", index).otherwise(F.concat(F.lit("C"), "c_nationkey")).alias("symbol"),
            F.col("o_orderpriority").alias("Index"),
            F.col("o_orderkey").alias("open"),
        )
    )
    return (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            index.alias("index_name"), F.concat(F.lit('{"data":['), first, F.lit(","), second, F.lit("]}")).alias("doc")
        )
    )


def snapshot_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Landed documents of three forms, one per order; its status picks the category."""
    record = F.to_json(F.struct(F.concat(F.lit("C"), "o_custkey").alias("symbol"), F.col("o_totalprice").alias("price")))
    other = F.to_json(
        F.struct(F.concat(F.lit("O"), "o_orderkey").alias("symbol"), F.col("o_custkey").alias("qty"),
                 F.struct(F.col("o_orderpriority").alias("name")).alias("meta"))
    )
    plain = F.concat(F.lit('{"data":['), record, F.lit(","), other, F.lit("]}"))
    nested = F.concat(F.lit('{"allSec":{"data":['), record, F.lit("]}}"))
    deals = F.concat(
        F.lit('{"BULK_DEALS_DATA":['), record, F.lit('],"BLOCK_DEALS_DATA":[],"SHORT_DEALS_DATA":['), other,
        F.lit(","), record, F.lit("]}"),
    )
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(status == "F", "Volume Gainers").when(status == "O", "Top Losers").otherwise("Large Deals").alias("category"),
        F.when(status == "F", plain).when(status == "O", nested).otherwise(deals).alias("doc"),
    )


def update_text(kind):
    """What a user wrote, by event type."""
    return (
        F.when(kind == "view", "//ping")
        .when(kind == "click", "/PING@bot a b")
        .when(kind == "signup", "hello /ping")
        .when(kind == "purchase", F.concat(F.lit("/Status  x"), F.col("user_id")))
        .otherwise("/foo\t1 2")
    )


def as_updates(events: DataFrame) -> DataFrame:
    return events.select(
        (F.col("event_id") + 1).alias("update_id"),
        F.struct(
            F.struct(
                F.col("user_id").alias("id"), F.col("event_type").alias("first_name"),
                F.lit(None).cast("string").alias("last_name"),
            ).alias("chat"),
            update_text(F.col("event_type")).alias("text"),
        ).alias("message"),
    )


def updates(spark: SparkSession, sf: str) -> DataFrame:
    return as_updates(table(spark, sf, "events"))


CHAT_IDS = [1, 2, 3, 5, 8, 13, 21, 34, 55, 89]


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("alert_id"),
        F.when(kind == "error", None).when(kind == "signup", 0).otherwise(F.col("user_id")).alias("chat_id"),
        F.col("props").alias("text"),
    )


def option_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as option contracts, one report per brand."""
    family = F.when(F.col("p_size") < 20, "NSE:BANKNIFTY25JUL").when(F.col("p_size") < 40, "NIFTY25JUL").otherwise("STOCK-")
    side = F.when(F.col("p_type") == "ECONOMY", "CE").otherwise("PE")
    change = F.round(F.col("p_retailprice") - 1000, 2)
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("report_id"),
        F.col("p_partkey").alias("ord"),
        F.concat(family, F.lpad(F.col("p_partkey").cast("string"), 5, "0"), side).alias("Symbol"),
        F.col("p_size").alias("Strike"),
        (F.col("p_partkey") * 100).alias("Latest_OI"),
        F.round(change / 10, 2).alias("OI_3m"),
        F.when(F.col("p_size") != 7, change).alias("OI_Change"),
        F.col("p_name").alias("OI_Time"),
    )


RULES = {
    "Strike": {"atm": "🎯"},
    "OI_3m": {"positive": "🟢", "negative": "🔴", "zero": "⚪"},
    "OI_Change": {"high_change": "⚡"},
}


def quality_labels(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", (F.length("text") > 500).cast("int").alias("yhat"))
    return table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y")).join(docs, "doc_id")
