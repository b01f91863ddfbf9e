"""A log of updates as a stream whose offset is the update id.

``land_updates`` keeps the log in folders by span of ids. The source gives the lowest ids above
its offset, ``limit`` of them in a pull, in ascending order, wherever files end; it reads
the ids of as few spans as hold them, and the rows of exactly those ids.

A micro-batch is one pull, or with ``pulls`` as many as wait, up to that number: a long log costs
a micro-batch per ``AT_ONCE`` ids, not one per pull. Each pull still is the ``limit`` lowest ids
above the one before it, and each row says which it came with.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from barframe.fixed_values import BATCH_LIMIT
from barframe.operators.commands import UPDATE_SCHEMA
from barframe.sources.files import file_system

SPAN = 4096  # update ids of a folder
AT_ONCE = 1 << 16  # ids of a micro-batch that holds many pulls
PULL_COLUMNS = ("pull", "after")  # the number of a pull and the id it starts after


def land_updates(updates: DataFrame, path: str) -> None:
    """Add updates to the log at ``path``; those without an id cannot be pulled and are left out."""
    spanned = updates.where("update_id is not null").select("update_id", "message").withColumn("span", F.expr(f"update_id div {SPAN}"))
    spanned.repartition("span").write.mode("append").partitionBy("span").parquet(path)


class SpanPartition(InputPartition):
    def __init__(self, folder: str, above: int, upto: int, pull: int = 0, marks: Sequence[int] = ()):
        self.folder, self.above, self.upto, self.pull, self.marks = folder, above, upto, pull, marks


class UpdateLogReader(DataSourceStreamReader):
    """Plans micro-batches of ``limit`` ids above ``after``. Options are texts, as Spark hands them on."""

    def __init__(self, path: str, after: int = 0, limit: int = BATCH_LIMIT):
        self.path, self.limit, self.after, self.handed = path, limit, after, after

    def _spans(self) -> list[tuple[int, str]]:
        """The spans that may hold ids above what was handed out, ascending, with their folders."""
        system, root = file_system(self.path)
        found = [(int(info.base_name.removeprefix("span=")), info.path) for info in system.get_file_info(fs.FileSelector(root)) if info.base_name.startswith("span=")]
        return sorted((n, folder) for n, folder in found if n >= self.handed // SPAN)

    def _table(self, folder: str) -> ds.Dataset:
        return ds.dataset(folder, filesystem=file_system(self.path)[0], format="parquet")

    def initialOffset(self) -> dict:
        return {"update_id": self.after}

    def _ids(self, folder: str, wanted: pc.Expression) -> list[int]:
        column = self._table(folder).to_table(columns=["update_id"], filter=wanted)["update_id"]
        return sorted(pc.unique(column).to_pylist())

    def _lowest(self, n: int) -> list[int]:
        """The ``n`` lowest ids above what was handed out."""
        ids: list[int] = []
        for _, folder in self._spans():
            ids += self._ids(folder, pc.field("update_id") > self.handed)[: n - len(ids)]
            if len(ids) == n:
                break
        return ids

    def _planned(self, above: int, upto: int) -> list[tuple[int, str]]:
        """The spans that may hold ids above ``above`` and up to ``upto``, which then count as handed out."""
        self.handed = above
        wanted = [(n, folder) for n, folder in self._spans() if n <= upto // SPAN]
        self.handed = upto
        return wanted

    def latestOffset(self) -> dict:
        ids = self._lowest(self.limit)
        return {"update_id": ids[-1] if ids else self.handed}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        above, upto = start["update_id"], end["update_id"]
        return [SpanPartition(folder, above, upto) for _, folder in self._planned(above, upto)]

    def read(self, partition: SpanPartition) -> Iterator[pa.RecordBatch]:
        inside = (pc.field("update_id") > partition.above) & (pc.field("update_id") <= partition.upto)
        table = self._table(partition.folder).to_table(columns=["update_id", "message"], filter=inside)
        yield from table.sort_by("update_id").to_batches()


class PullsReader(UpdateLogReader):
    """Plans micro-batches of up to ``pulls`` pulls; ``stops``, ascending ids, also end one. The offset also
    counts the pulls; a partition knows the ids (``marks``) that the pulls of its span start after, the
    first of them being ``pull``."""

    def __init__(self, path: str, after: int = 0, limit: int = BATCH_LIMIT, pulls: int = 1, stops: Sequence[int] = ()):
        super().__init__(path, after, limit)
        self.pulls, self.stops, self.counted = pulls, stops, 0

    def initialOffset(self) -> dict:
        return {"update_id": self.after, "pulls": 0}

    def latestOffset(self) -> dict:
        ids = self._lowest(self.limit * self.pulls)
        coming = bisect_left(self.stops, ids[0]) if ids else len(self.stops)
        if coming < len(self.stops):
            ids = ids[: bisect_right(ids, self.stops[coming])]
        return {"update_id": ids[-1] if ids else self.handed, "pulls": self.counted + (len(ids) + self.limit - 1) // self.limit}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        above, upto = start["update_id"], end["update_id"]
        spans, ends, seen = self._planned(above, upto), [], 0
        for _, folder in spans:
            ids = self._ids(folder, (pc.field("update_id") > above) & (pc.field("update_id") <= upto))
            ends += ids[(-seen - 1) % self.limit :: self.limit]
            seen += len(ids)
        ends = [*ends[: end["pulls"] - start["pulls"] - 1], upto]  # ids that came since belong to the pulls as planned
        marks, wanted = [above, *ends], []
        for n, folder in spans:
            first, last = (bisect_left(ends, i) for i in (max(n * SPAN, above + 1), min(n * SPAN + SPAN - 1, upto)))
            wanted.append(SpanPartition(folder, above, upto, start["pulls"] + first, marks[first : last + 1]))
        self.counted = end["pulls"]
        return wanted

    def read(self, partition: SpanPartition) -> Iterator[pa.RecordBatch]:
        marks = np.array(partition.marks, "int64")
        for batch in super().read(partition):
            at = np.searchsorted(marks, batch.column("update_id").to_numpy()) - 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(partition.pull + at), pa.array(marks[at])], names=[*batch.schema.names, *PULL_COLUMNS])


class UpdateLog(DataSource):
    """``spark.readStream.format("update_log")`` with the options ``path``, ``after``, ``limit``, ``pulls`` and ``stops``."""

    @classmethod
    def name(cls) -> str:
        return "update_log"

    def schema(self) -> str:
        return ", ".join([UPDATE_SCHEMA, *[f"{c} bigint" for c in PULL_COLUMNS if "pulls" in self.options]])

    def streamReader(self, schema) -> UpdateLogReader:
        path, after, limit = self.options["path"], int(self.options.get("after", 0)), int(self.options.get("limit", BATCH_LIMIT))
        if "pulls" not in self.options:
            return UpdateLogReader(path, after, limit)
        return PullsReader(path, after, limit, int(self.options["pulls"]), [int(i) for i in self.options.get("stops", "").split()])


def pulls_at_once(limit: int = BATCH_LIMIT) -> int:
    """How many pulls of ``limit`` ids a micro-batch holds where it may hold many."""
    return max(AT_ONCE // limit, 1)


def pulled_updates(
    spark: SparkSession, path: str, after: int = 0, limit: int = BATCH_LIMIT, pulls: int | None = None, stops: Iterable[int] = ()
) -> DataFrame:
    """The updates above ``after`` as a stream, the ``limit`` lowest ids in each pull.

    A micro-batch is one pull. With ``pulls`` it holds as many as wait, up to that number, none that goes
    over one of the ids ``stops``, and rows say their ``pull``, counted from 0 on, and the id it starts ``after``.
    """
    spark.dataSource.register(UpdateLog)
    stream = spark.readStream.format("update_log").option("path", path).option("after", after).option("limit", limit)
    if pulls is not None:
        stream = stream.option("pulls", pulls).option("stops", " ".join(map(str, sorted(stops))))
    return stream.load()
