"""The command log as a stream: read updates, handle commands, write replies.

The highest handled id is durable progress (``streaming/progress.py``): repeated ids are dropped by
it, and without a readable note the log starts from 0. Everything a micro-batch writes goes to
folders named after the run and the micro-batch and replaces what a failed attempt left, so a
retry neither loses nor doubles a reply, and a run with a new checkpoint leaves earlier output
alone. A micro-batch is written once and counted in that pass; its branches read that copy.

``run`` takes landed files, whose progress is in the streaming checkpoint. ``pull`` takes a log
by update id, some ids a time; its micro-batches hold as many pulls as wait, within bounds, and are
named by the id they start after. A new start goes on from the durable progress alone.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Iterator
from functools import reduce
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from barframe.fixed_values import (
    BATCH_LIMIT,
    DEFAULT_COMMANDS,
    ERROR_TEXT,
    INFO_FALLBACK_TEXT,
    PING_TEXT,
    STATUS_MESSAGE,
    UNKNOWN_TEXT,
)
from barframe.functions.text import fill_lines
from barframe.operators.alerts import is_authorized, message_parts
from barframe.operators.commands import (
    UPDATE_SCHEMA,
    dead_letters,
    help_text,
    parse_commands,
    route_updates,
)
from barframe.session import cut_lineage, shared_path
from barframe.streaming.progress import Progress
from barframe.streaming.pull import PULL_COLUMNS, pulled_updates, pulls_at_once

Handler = Callable[[DataFrame], DataFrame]  # commands -> (update_id, chat_id, reply)
Function = Callable[[int, list[str]], str | None]  # (chat id, args) -> reply

SPAN = 4096  # update ids per piece when looking for the id before


class Registry:
    """Command handlers by name. A later registration replaces the former.

    A handler is a function of one command, ``(chat id, args) -> reply``, or for whole columns a
    function of the table of commands. A function is called once per command; where it fails, that
    command answers with its error. A failure inside a table of commands is looked for by halving,
    which takes jobs of its own, so handlers that may fail should be functions.
    """

    def __init__(self) -> None:
        self.handlers: dict[str, Handler | None] = dict.fromkeys(DEFAULT_COMMANDS)
        self.functions: dict[str, Function] = {}

    def register_command(self, name: str, handler: Handler) -> None:
        name = name.lower().lstrip("/")
        self.functions.pop(name, None)
        self.handlers[name] = handler

    def register_function(self, name: str, function: Function) -> None:
        """``function`` travels to the executors; a reply of None sends nothing."""
        name = name.lower().lstrip("/")
        self.handlers.pop(name, None)
        self.functions[name] = function

    @property
    def names(self) -> list[str]:
        return [*self.handlers, *self.functions]

    @property
    def built_in(self) -> list[str]:
        return [n for n, h in self.handlers.items() if h is None]

    @property
    def custom(self) -> dict[str, Handler]:
        return {n: h for n, h in self.handlers.items() if h is not None}


def updates_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Landed update files (JSON lines) as a stream; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.schema(f"{UPDATE_SCHEMA}, _corrupt_record string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def read_updates(spark: SparkSession, path: str) -> DataFrame:
    """The batch form of ``updates_stream``."""
    return spark.read.schema(f"{UPDATE_SCHEMA}, _corrupt_record string").json(path)


def new_updates(updates: DataFrame, high_water: int) -> DataFrame:
    """Updates above the high-water mark, each id once; unreadable rows have no id and stay.

    Of rows with one id and different content the first by its JSON text counts.
    """
    content = F.to_json(F.struct(*[c for c in updates.columns if c not in ("update_id", *PULL_COLUMNS)]))
    first = Window.partitionBy("update_id").orderBy(content)
    fresh = updates.where(F.col("update_id") > high_water).withColumn("__rank", F.row_number().over(first)).where("__rank = 1").drop("__rank")
    return fresh.unionByName(updates.where(F.col("update_id").isNull()))


def with_previous_id(updates: DataFrame, high_water: int) -> DataFrame:
    """Add ``last_update_id``: the highest id handled before this update.

    Inside spans of ids by ``lag``, for the first of a span from the spans before it, and for the
    first span of a large span from the large spans before it. Only the large spans, one row per
    ``SPAN * SPAN`` ids, are put in order as a whole.
    """
    spans = updates.where("update_id is not null").withColumn("__span", F.expr(f"update_id div {SPAN}"))
    tops = spans.groupBy("__span").agg(F.max("update_id").alias("__top")).withColumn("__large", F.expr(f"__span div {SPAN}"))
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    large = (
        tops.groupBy("__large")
        .agg(F.max("__top").alias("__large_top"))
        .select("__large", F.coalesce(F.max("__large_top").over(upto(Window.partitionBy(F.lit(0)).orderBy("__large"))), F.lit(high_water)).alias("__mark"))
    )
    before = tops.join(large, "__large").select(
        "__span", F.coalesce(F.max("__top").over(upto(Window.partitionBy("__large").orderBy("__span"))), F.col("__mark")).alias("__before")
    )
    inside = F.lag("update_id").over(Window.partitionBy("__span").orderBy("update_id"))
    return (
        spans.join(before, "__span")
        .withColumn("last_update_id", F.coalesce(inside, F.col("__before")))
        .drop("__span", "__before")
    )


def built_in_replies(commands: DataFrame, registry: Registry, ids: Collection[int]) -> DataFrame:
    """Replies of the built-in commands and to unknown ones; commands with a handler of
    their own are left out. Needs ``last_update_id``."""
    status = fill_lines(
        STATUS_MESSAGE,
        {
            "authorized": F.lit(len(set(ids))),
            "commands": F.lit(len(registry.names)),
            "last_update_id": F.col("last_update_id"),
        },
    )
    texts = {
        "status": status,
        "help": F.lit(help_text(registry.names)),
        "ping": F.lit(PING_TEXT),
        "info": F.lit(INFO_FALLBACK_TEXT),
    }
    reply = F.concat(F.lit(UNKNOWN_TEXT), F.col("command"))
    for name in registry.built_in:
        reply = F.when(F.col("command") == name, texts[name]).otherwise(reply)
    own = [*registry.custom, *registry.functions]
    rest = commands.where(~F.col("command").isin(*own)) if own else commands
    return rest.select("update_id", "chat_id", reply.alias("reply"))


def as_outbox(replies: DataFrame) -> DataFrame:
    return message_parts(replies.withColumnRenamed("reply", "text")).select("update_id", "chat_id", "part", "text")


def first_line(error: Exception) -> str:
    """What failed, without the trace: the last line of a Python worker's, else the first line."""
    lines = [line.strip() for line in str(error).splitlines() if line.strip()] or [type(error).__name__]
    raised = [line for line in lines if line.split(":")[0].endswith(("Error", "Exception")) and " " not in line.split(":")[0]]
    return raised[-1] if raised and "Traceback" in str(error) else lines[0]


def function_replies(commands: DataFrame, functions: dict[str, Function]) -> DataFrame:
    """``(update_id, chat_id, command, reply, error)`` of the commands that have a function: each is
    called once, and what it raises is the ``error`` of that row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            replies, errors = [], []
            for name, chat, args in zip(rows["command"], rows["chat_id"], rows["args"], strict=True):
                try:
                    reply = functions[name](chat, args)
                    replies.append(None if reply is None else str(reply))
                    errors.append(None)
                except Exception as error:  # noqa: BLE001 - any failure of user code becomes a row
                    replies.append(None)
                    errors.append(str(error) or type(error).__name__)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("update_id", "chat_id", "command")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(replies, pa.string()), pa.array(errors, pa.string())], names=["update_id", "chat_id", "command", "reply", "error"])

    mine = commands.where(F.col("command").isin(*functions)).select("update_id", "chat_id", "command", "args")
    return mine.mapInArrow(run, "update_id long, chat_id long, command string, reply string, error string")


class UpdateJob:
    """Handles the command log from ``source`` (a stream of updates) into tables under ``root``:
    ``outbox``, ``unauthorized``, ``dead_letters``, ``handled`` (what functions gave), ``processed`` (one
    row per micro-batch, or per pull of it) and ``state``. ``run`` names the folders of this log's checkpoint; ``now`` is
    the time the state notes, by default the clock's."""

    def __init__(
        self, source: DataFrame | None, root: str, ids: Collection[int], registry: Registry | None = None, run: str = "0",
        now: datetime | str | None = None,
    ):
        self.source, self.root, self.ids = source, root, list(ids)
        self.registry, self.run_name, self.now = registry or Registry(), run, now

    def run(self) -> None:
        """Handle all updates that have arrived, then stop."""
        query = (
            self.source.writeStream.foreachBatch(self.handle)
            .option("checkpointLocation", f"{self.root}/checkpoint/{self.run_name}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def pull(self, spark: SparkSession, log: str, limit: int = BATCH_LIMIT, pulls: int | None = None) -> None:
        """Handle the landed log of ``land_updates`` from the noted progress on, ``limit`` ids a time,
        until none waits, then stop.

        A micro-batch handles the pulls that wait together, ``pulls`` of them at most; progress is noted
        after it and ``processed`` has a row for each. Handlers of whole tables get one pull a time, so
        with them a micro-batch is one pull. A micro-batch is named by the highest id before it, so one
        that failed is written again in place by the next start. Where progress was lost, those that
        were written since are planned from the same ids on, and replaced too.
        """
        progress = Progress(spark, f"{self.root}/state", self.run_name)
        pulls = 1 if self.registry.custom else pulls or pulls_at_once(limit)
        source = pulled_updates(spark, log, progress.before()[0], limit, pulls, self._begun(spark))
        query = (
            source.writeStream.foreachBatch(lambda batch, _: self.handle(batch, progress.before()[0]))
            .option("checkpointLocation", shared_path(spark, "pull"))
            .start()
        )
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    def _begun(self, spark: SparkSession) -> set[int]:
        """The micro-batches of this run that wrote something, noted or not."""
        try:
            files = spark.read.schema("update_id bigint").parquet(f"{self.root}/unauthorized/run={self.run_name}").inputFiles()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return set()
        return {int(file.split("/")[-2].removeprefix("batch_id=")) for file in files}

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        progress = Progress(spark, f"{self.root}/state", self.run_name)
        mark, total, slot = progress.before(batch_id)
        seen = Observation()
        updates = self._staged(new_updates(batch, mark).observe(seen, F.count(F.lit(1)).alias("n"), F.max("update_id").alias("top")))
        found = seen.get
        processed, top = found.get("n") or 0, max(found.get("top") or mark, mark)
        messages = route_updates(updates)
        allowed = is_authorized("chat_id", self.ids)
        self._write(messages.where(~allowed), "unauthorized", batch_id)
        self._write(dead_letters(updates), "dead_letters", batch_id)
        commands = parse_commands(messages.where(allowed)).join(with_previous_id(updates.select("update_id"), mark), "update_id")
        self._write(as_outbox(built_in_replies(commands, self.registry, self.ids)), "outbox", batch_id, "built_in")
        if self.registry.functions:
            self._handle_functions(commands, batch_id)
        for name, handler in self.registry.custom.items():
            self._handle_custom(commands.where(F.col("command") == name), name, handler, batch_id)
        now = str(self.now or datetime.now(timezone.utc).isoformat())
        if "after" in updates.columns and processed:
            taken = updates.groupBy("after").agg(F.count(F.lit(1)).alias("processed"), F.max("update_id").alias("last_update_id"), F.lit(now).alias("last_save"))
        else:
            taken = spark.createDataFrame([(processed, top, now)], "processed bigint, last_update_id bigint, last_save string")
        self._write(taken.coalesce(1), "processed", batch_id)
        progress.note(batch_id, top, processed, total + processed, slot, now)

    def _staged(self, updates: DataFrame) -> DataFrame:
        """The updates of this micro-batch, written once; the next one takes the place."""
        path = f"{self.root}/staging/{self.run_name}"
        updates.write.mode("overwrite").parquet(path)
        return updates.sparkSession.read.schema(updates.schema).parquet(path)

    def _handle_functions(self, commands: DataFrame, batch_id: int) -> None:
        schema = "update_id bigint, chat_id bigint, command string, reply string, error string"
        self._write(function_replies(commands, self.registry.functions), "handled", batch_id)
        handled = commands.sparkSession.read.schema(schema).parquet(self._path("handled", batch_id))
        reply = F.coalesce(F.concat(F.lit(ERROR_TEXT), "error"), "reply")
        replies = handled.select("update_id", "chat_id", reply.alias("reply")).where("reply is not null")
        self._write(as_outbox(replies), "outbox", batch_id, "functions")

    def _handle_custom(self, commands: DataFrame, name: str, handler: Handler, batch_id: int) -> None:
        """The replies of a handler. Where it fails, the commands are halved by id until the ones it
        fails on stand alone; those answer with the error and all others as usual."""
        pieces, good = [commands], []
        while pieces:
            piece = pieces.pop()
            try:
                replies = cut_lineage(handler(piece).select("update_id", "chat_id", "reply"))
            except Exception as error:  # noqa: BLE001 - any failure of user code becomes a reply
                low, high, n = piece.agg(F.min("update_id"), F.max("update_id"), F.count(F.lit(1))).first()
                if n > 1 and low < high:
                    middle = (low + high) // 2
                    pieces += [piece.where(F.col("update_id") <= middle), piece.where(F.col("update_id") > middle)]
                    continue
                replies = piece.select("update_id", "chat_id", F.lit(f"{ERROR_TEXT}{first_line(error)}").alias("reply"))
            good.append(replies)
        self._write(as_outbox(reduce(DataFrame.unionByName, good)), "outbox", batch_id, name)

    def _path(self, table: str, batch_id: int, part: str | None = None) -> str:
        return f"{self.root}/{table}/run={self.run_name}/batch_id={batch_id}" + (f"/handler={part}" if part else "")

    def _write(self, df: DataFrame, table: str, batch_id: int, part: str | None = None) -> None:
        df.write.mode("overwrite").parquet(self._path(table, batch_id, part))


def read_outbox(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/outbox").select("update_id", "chat_id", "part", "text")


def read_processed(spark: SparkSession, root: str) -> DataFrame:
    """``(run, batch_id, processed, last_update_id, last_save)``: the updates each micro-batch took, or each pull,
    whose ``batch_id`` is the id it starts after."""
    rows = spark.read.schema("after bigint, processed bigint, last_update_id bigint, last_save string").parquet(f"{root}/processed")
    batch_id = F.coalesce("after", F.col("batch_id").cast("bigint")).alias("batch_id")
    return rows.select(F.col("run").cast("string").alias("run"), batch_id, "processed", "last_update_id", "last_save")
