"""Landed constituent documents to the membership table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.fixed_values import INDICES
from barframe.functions.names import quoted_name
from barframe.operators.memberships import (
    add_cap_class,
    drop_self_row,
    membership_rows,
    normalize_index,
    order_columns,
)
from barframe.session import stored
from barframe.sources.records import discover_fields, read_documents, record_array


def index_catalog(spark: SparkSession, indices: Sequence[str] = INDICES) -> DataFrame:
    return spark.createDataFrame([(i,) for i in indices], "index_name string")


def read_index_documents(spark: SparkSession, path: str, indices: Sequence[str] = INDICES) -> DataFrame:
    """``(index_name, doc)`` of the configured indices, from folders ``index_name=...``.

    The filter on the folder prunes the files of other indices.
    """
    return read_documents(spark, path).where(F.col("index_name").isin(*indices))


def constituent_records(docs: DataFrame) -> DataFrame:
    """``(index_name, pos, raw)``: one row per record; an empty list gives none."""
    return docs.select("index_name", F.posexplode(record_array("doc", "$.data")).alias("pos", "raw"))


def read_memberships(spark: SparkSession, path: str, indices: Sequence[str] = INDICES) -> DataFrame:
    """The records of the configured indices."""
    return constituent_records(read_index_documents(spark, path, indices))


def membership_table(docs: DataFrame, fields: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """The membership table with its cap classes, of ``(index_name, doc)``.

    With the fields known, one pass turns a document into columns. The rows are stored before
    they are classified: the classes and both branches of their join then read columns
    instead of parsing the documents again.
    """
    fields = discover_fields(constituent_records(docs), ("index_name", "pos")) if fields is None else list(fields)
    if not any(name == "symbol" for name, _ in fields):
        fields = [("symbol", "string"), *fields]
    schema = ", ".join(f"{quoted_name(name)}: string" for name, _ in fields)
    records = F.from_json("doc", f"struct<data: array<struct<{schema}>>>").getField("data")
    # A record's own field called index_name or pos must not meet ours.
    parsed = docs.select(F.col("index_name").alias("__index"), F.posexplode(records).alias("__pos", "__record"))
    wide = parsed.select(
        "__index", "__pos", *[F.col("__record").getField(name).try_cast(dtype).alias(name) for name, dtype in fields]
    )
    kept = drop_self_row(wide, "__index", "symbol", "__pos")
    rows = membership_rows(kept, "__index", "symbol", drop=("__pos",))
    return add_cap_class(stored(normalize_index(order_columns(rows)), "memberships"))
