"""The command log as tables: parse, authorize, dispatch, status."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.fixed_values import (
    BATCH_LIMIT,
    DEFAULT_COMMANDS,
    HELP_MESSAGE,
    INFO_FALLBACK_TEXT,
    PING_TEXT,
    STATUS_MESSAGE,
    UNKNOWN_TEXT,
)
from barframe.functions.text import command_args, command_name, fill_lines, full_name, is_command
from barframe.operators.alerts import split_authorized

UPDATE_SCHEMA = (
    "update_id bigint, "
    "message struct<chat: struct<id: bigint, first_name: string, last_name: string>, text: string>"
)


def next_batch(log: DataFrame, after: int, n: int | None = BATCH_LIMIT) -> DataFrame:
    """The ``n`` lowest update ids above ``after``, in order."""
    waiting = log.where(F.col("update_id") > after).orderBy("update_id")
    return waiting.limit(n) if n is not None else waiting


def route_updates(updates: DataFrame) -> DataFrame:
    """The messages among the updates: ``(update_id, chat_id, user, text)``.

    A message without chat id cannot be handled and is left to ``dead_letters``.
    """
    return updates.where("message is not null and message.chat.id is not null").select(
        "update_id",
        F.col("message.chat.id").alias("chat_id"),
        full_name("message.chat.first_name", "message.chat.last_name").alias("user"),
        F.coalesce("message.text", F.lit("")).alias("text"),
    )


def dead_letters(updates: DataFrame) -> DataFrame:
    """Updates that count as processed but whose message cannot be handled, with the reason."""
    reason = F.when(F.col("message").isNotNull() & F.col("message.chat.id").isNull(), F.lit("message without chat id"))
    if "_corrupt_record" in updates.columns:
        reason = F.when(F.col("_corrupt_record").isNotNull(), F.lit("unreadable update")).otherwise(reason)
        raw = F.coalesce("_corrupt_record", F.to_json("message"))
    else:
        raw = F.to_json("message")
    return updates.select("update_id", raw.alias("raw"), reason.alias("error")).where("error is not null")


def parse_commands(messages: DataFrame, ids: Collection[int] | DataFrame | None = None) -> DataFrame:
    """``(..., command, args)`` for the messages that start with ``/``, of authorized chats if ``ids`` is given."""
    allowed = messages if ids is None else split_authorized(messages, ids)[0]
    return allowed.where(is_command("text")).withColumns(
        {"command": command_name("text"), "args": command_args("text")}
    )


def unauthorized_messages(messages: DataFrame, ids: Collection[int] | DataFrame) -> DataFrame:
    return split_authorized(messages, ids)[1]


def dispatch(commands: DataFrame, replies: Mapping[str, str], out: str = "reply") -> DataFrame:
    """Add the reply of a known command, or the text for an unknown one. ``replies`` is the registry."""
    known = F.lit(None).cast("string")
    if replies:
        registry = F.create_map(*[F.lit(x) for pair in replies.items() for x in pair])
        known = F.try_element_at(registry, F.col("command"))
    return commands.withColumn(out, F.coalesce(known, F.concat(F.lit(UNKNOWN_TEXT), "command")))


def sorted_commands(names: Collection[str]) -> str:
    return "\n".join(f"/{name}" for name in sorted(set(names)))


def command_list(commands: DataFrame, names: Collection[str] = DEFAULT_COMMANDS, name: str = "command") -> DataFrame:
    """The registered command names that a table holds, sorted, one per line. What users type is
    open-ended; the registry bounds the row."""
    names = commands.where(F.col(name).isin(*names)).select(F.concat(F.lit("/"), name).alias("c")).distinct()
    return names.agg(F.array_join(F.sort_array(F.collect_set("c")), "\n").alias("commands"))


def help_text(names: Collection[str] = DEFAULT_COMMANDS) -> str:
    return HELP_MESSAGE.replace("{commands}", sorted_commands(names))


def log_status(updates: DataFrame, ids: Collection[int], names: Collection[str] = DEFAULT_COMMANDS) -> DataFrame:
    """One row: authorized chats, commands, highest update id (0 if none), updates processed, and the status text."""
    row = updates.agg(
        F.coalesce(F.max("update_id"), F.lit(0)).alias("last_update_id"), F.count(F.lit(1)).alias("processed")
    ).select(
        F.lit(len(set(ids))).alias("authorized"), F.lit(len(set(names))).alias("commands"), "last_update_id", "processed"
    )
    values = {c: F.col(c) for c in ("authorized", "commands", "last_update_id")}
    return row.withColumn("text", fill_lines(STATUS_MESSAGE, values))


def default_replies(
    ids: Collection[int], last_update_id: int, names: Collection[str] = DEFAULT_COMMANDS
) -> dict[str, str]:
    """Texts of the built-in commands at one state of the log. ``info`` asks a remote
    service in the original setting, so here it has its fallback text."""
    status = (
        STATUS_MESSAGE
        .replace("{authorized}", str(len(set(ids))))
        .replace("{commands}", str(len(set(names))))
        .replace("{last_update_id}", str(last_update_id))
    )
    return {"status": status, "help": help_text(names), "ping": PING_TEXT, "info": INFO_FALLBACK_TEXT}
