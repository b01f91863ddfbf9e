"""Durable progress of a log, compacted and checked.

A run keeps its progress in two slots that take turns: a note replaces the one before the last,
so the last good one is whole while a new one is written, and the table never grows with the
number of micro-batches. Every note carries a digest. What cannot be read, or does not match its
digest, counts as not there; without any good note the log starts from 0.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NOTE = "last_update_id bigint, last_save string, processed bigint, total bigint, run string, batch_id bigint, slot int"
FIELDS = [field.split()[0] for field in NOTE.split(", ")]


def _digest() -> Column:
    return F.sha2(F.to_json(F.struct(*FIELDS)), 256)


class Progress:
    """The notes under ``path``. ``last_update_id`` is the highest id handled so far, ``processed`` counts
    the updates of a micro-batch and ``total`` those of the run."""

    def __init__(self, spark: SparkSession, path: str, run: str):
        self.spark, self.path, self.run = spark, path, run

    def notes(self) -> DataFrame:
        """The good notes of all runs, two of each at most."""
        try:
            rows = (
                self.spark.read.schema(f"{NOTE}, digest string")
                .option("recursiveFileLookup", True)  # the folders' names are not columns
                .option("ignoreCorruptFiles", True)
                .option("ignoreMissingFiles", True)
                .parquet(self.path)
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{NOTE}, digest string")
        return rows.where(F.col("digest") == _digest())

    def before(self, batch_id: int | None = None) -> tuple[int, int, int]:
        """``(highest id, total of this run, slot to write)`` before a micro-batch of this run, or after its
        last one. A note of the micro-batch itself, from an attempt that failed later, does not count."""
        own = F.col("run") == self.run
        later = own & (F.col("batch_id") >= batch_id) if batch_id is not None else F.lit(False)
        rows = self.notes().where(~later).select("last_update_id", "total", "slot", "batch_id", own.alias("own")).collect()  # two of a run
        last = max((r for r in rows if r["own"]), key=lambda r: r["batch_id"], default=None)
        mark = max((r["last_update_id"] for r in rows), default=0)
        return (mark, last["total"], 1 - last["slot"]) if last else (mark, 0, 0)

    def note(self, batch_id: int, mark: int, processed: int, total: int, slot: int, now: str) -> None:
        values = [mark, now, processed, total, self.run, batch_id, slot]
        row = self.spark.createDataFrame([tuple(values)], NOTE).withColumn("digest", _digest())
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/run={self.run}/slot={slot}")
