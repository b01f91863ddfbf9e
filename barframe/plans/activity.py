"""Landed activity documents to one tagged table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.fixed_values import CATEGORY_ORDER, KEYS_COLUMN, REASON_COLUMN, SNAPSHOT_PATHS, SPLIT_DOCUMENT
from barframe.functions.names import quoted_name
from barframe.operators.screens import add_record_keys, tag_reason
from barframe.sources.records import all_records, discover_fields, expand_fields, read_snapshots


def activity_table(records: DataFrame, fields: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """The fields of all records side by side, with the reason and the record's own keys.

    ``fields`` (name, type) saves the pass that looks for them.
    """
    place = F.array_position(F.lit(CATEGORY_ORDER), F.col("category"))
    fields = discover_fields(records, (place, "pos")) if fields is None else fields
    tagged = add_record_keys(tag_reason(records, F.col("category")))
    return expand_fields(tagged, fields).select(*[quoted_name(n) for n, _ in fields], REASON_COLUMN, KEYS_COLUMN)


def read_activity(spark: SparkSession, catalog: Mapping[str, str]) -> DataFrame:
    """The activity table of a catalog of category -> path; all six documents must be there."""
    missing = {*SNAPSHOT_PATHS, SPLIT_DOCUMENT} - set(catalog)
    if missing:
        raise ValueError(f"no document for {', '.join(sorted(missing))}")
    return activity_table(all_records(read_snapshots(spark, catalog)))
