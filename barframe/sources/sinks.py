"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKS = "_commits"  # readers of the table pass over names that begin so


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Replace the table at ``path``; CSV gets a header."""
    writer = df.write.mode("overwrite").option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)


def write_activity(df: DataFrame, path: str, fmt: str = "csv") -> None:
    write_table(df, path, fmt)


def write_memberships(df: DataFrame, path: str, fmt: str = "csv", partition_by: Sequence[str] = ()) -> bool:
    """Write the table if it has rows, and say whether it did."""
    if df.isEmpty():
        return False
    write_table(df, path, fmt, partition_by)
    return True


def _folder(run: str) -> str:
    # The leading mark keeps a run such as 007 a text when folders are read as a column.
    return f"run=_{quote(run, safe='')}"


def committed_runs(spark: SparkSession, path: str) -> DataFrame | None:
    """``(run)`` of the runs whose rows are complete; None if there is none."""
    try:
        return spark.read.schema("run string").option("recursiveFileLookup", True).parquet(f"{path}/{MARKS}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_run(df: DataFrame, path: str, run: str) -> bool:
    """Add the rows of one run to the table at ``path``, once: a run that is complete is left as it is.

    The rows go to a folder of the run, which replaces what a failed attempt left there, and a mark
    is written after them. Rows are keyed by the run and by their own key, so a repeated job adds
    nothing. Two jobs must not write one run at the same time. Says whether rows were written.
    """
    spark = df.sparkSession
    done = committed_runs(spark, path)
    if done is not None and not done.where(F.col("run") == run).isEmpty():
        return False
    df.write.mode("overwrite").parquet(f"{path}/{_folder(run)}")
    spark.range(1).select(F.lit(run).alias("run")).coalesce(1).write.mode("overwrite").parquet(f"{path}/{MARKS}/{_folder(run)}")
    return True


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the complete runs, with their ``run``; what a failed attempt left is not among them."""
    done = committed_runs(spark, path)
    rows = spark.read.parquet(path).withColumn("run", F.substring("run", 2, 1 << 30))
    return rows.limit(0) if done is None else rows.join(done.distinct(), "run", "left_semi")


def write_outbox(df: DataFrame, path: str, run: str) -> bool:
    """Add the rows to send of one run, ``(alert_id, chat_id, part, ...)``; see ``write_run``."""
    return write_run(df, path, run)


def append_run(results: DataFrame, path: str, run: str | None = None) -> None:
    """Append one run to the table of runs, or with its name add it once."""
    if run is None:
        results.write.mode("append").parquet(path)
    else:
        write_run(results, path, run)
