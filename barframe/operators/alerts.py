"""Alerts: styling, fan-out to recipients, and the parts of long texts."""

from __future__ import annotations

import math
from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barframe.fixed_values import DEFAULT_STYLE, ERROR_MESSAGE, MESSAGE_LIMIT, PREDICTION_MESSAGE, STYLES
from barframe.functions.text import fill_lines, fixed_point, percent_text, text_parts, timestamp_text
from barframe.operators.skew import flag_members


def style_lookup(
    df: DataFrame, type_col: str = "type", styles: Mapping[str, tuple[str, str]] = STYLES, default: str = DEFAULT_STYLE
) -> DataFrame:
    """Add ``icon`` and ``color`` of the alert type; unknown types look like ``default``."""

    def pick(i: int) -> Column:
        table = F.create_map(*[F.lit(x) for t, style in styles.items() for x in (t, style[i])])
        return F.coalesce(F.try_element_at(table, F.col(type_col)), F.lit(styles[default][i]))

    return df.withColumn("icon", pick(0)).withColumn("color", pick(1))


def style_alert(df: DataFrame, type_col: str = "type", message: str = "message", out: str = "text") -> DataFrame:
    styled = style_lookup(df, type_col)
    return styled.withColumn(out, F.concat("icon", F.lit(" <b>"), message, F.lit("</b>")))


def is_authorized(chat_id: Column | str, ids: Collection[int]) -> Column:
    """Allow-list predicate; NULL is not authorized."""
    c = F.col(chat_id) if isinstance(chat_id, str) else chat_id
    return F.coalesce(c.isin(*ids), F.lit(False)) if ids else F.lit(False)


def flag_authorized(
    df: DataFrame, ids: Collection[int] | DataFrame, chat_id: str = "chat_id", out: str = "authorized"
) -> DataFrame:
    """Add whether the chat is authorized. ``ids`` is a list or a table ``(chat_id)``."""
    if isinstance(ids, DataFrame):
        return flag_members(df, ids, chat_id, "chat_id", out)
    return df.withColumn(out, is_authorized(chat_id, ids))


def split_authorized(
    df: DataFrame, ids: Collection[int] | DataFrame, chat_id: str = "chat_id"
) -> tuple[DataFrame, DataFrame]:
    """The rows of authorized chats, and the others."""
    flagged = flag_authorized(df, ids, chat_id, "__known")
    return flagged.where("__known").drop("__known"), flagged.where("not __known").drop("__known")


def fan_out(
    alerts: DataFrame, recipients: Collection[int] | DataFrame, alert_id: str = "alert_id", grid: int | None = None
) -> DataFrame:
    """One row per alert and recipient, in ``chat_id``.

    An alert without chat id (NULL or 0) goes to every recipient, another one to its chat
    if that is a recipient. A list of recipients needs no join. With a table, addressed
    alerts take a join by chat, and alerts for everyone meet the recipients in a grid of
    ``grid`` x ``grid`` pieces, so neither side is broadcast or held by one task. By default the
    grid has about one piece per shuffle partition.
    """
    to_all = F.col("chat_id").isNull() | (F.col("chat_id") == 0)
    rest = [c for c in alerts.columns if c != "chat_id"]
    if not isinstance(recipients, DataFrame):
        ids = sorted(set(recipients))
        everyone = F.lit(ids).cast("array<bigint>") if ids else F.array().cast("array<bigint>")
        targets = F.when(to_all, everyone).when(
            is_authorized("chat_id", ids), F.array(F.col("chat_id").cast("bigint"))
        )
        return alerts.select(*rest, F.explode(targets).alias("chat_id")).select(*alerts.columns)
    known = recipients.select(F.col("chat_id").cast("bigint").alias("chat_id")).distinct()
    addressed, _ = split_authorized(alerts.where(~to_all).withColumn("chat_id", F.col("chat_id").cast("bigint")), known)
    grid = grid or math.ceil(math.sqrt(int(alerts.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    pieces = F.sequence(F.lit(0), F.lit(grid - 1))
    left = (
        alerts.where(to_all)
        .drop("chat_id")
        .withColumn("__a", F.pmod(F.xxhash64(alert_id), F.lit(grid)).cast("int"))
        .withColumn("__r", F.explode(pieces))
    )
    right = known.withColumn("__r", F.pmod(F.xxhash64("chat_id"), F.lit(grid)).cast("int")).withColumn(
        "__a", F.explode(pieces)
    )
    return left.join(right, ["__a", "__r"]).select(*alerts.columns).unionByName(addressed)


def message_parts(df: DataFrame, text: str = "text", limit: int = MESSAGE_LIMIT) -> DataFrame:
    """One row per part of at most ``limit`` characters, numbered in ``part``."""
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.posexplode(text_parts(text, limit)).alias("part", text))


def rejected_alerts(alerts: DataFrame, recipients: Collection[int] | DataFrame) -> DataFrame:
    """``(alert_id, chat_id, reason)`` of the alerts that ``outbox`` leaves out: addressed to a chat
    that is no recipient, or without text."""
    addressed = F.col("chat_id").isNotNull() & (F.col("chat_id") != 0)
    flagged = flag_authorized(alerts.select("alert_id", F.col("chat_id").cast("bigint").alias("chat_id"), "text"), recipients, out="__known")
    reason = F.when(F.col("text").isNull(), "no text").when(addressed & ~F.col("__known"), "chat not authorized")
    return flagged.select("alert_id", "chat_id", reason.alias("reason")).where("reason is not null")


def delivery_status(alerts: DataFrame, recipients: Collection[int] | DataFrame) -> DataFrame:
    """``(alert_id, recipients, success)`` per alert id: how many chats get it, and whether any does."""
    sent = fan_out(alerts.where("text is not null").select("alert_id", "chat_id"), recipients)
    counted = sent.groupBy("alert_id").agg(F.count_distinct("chat_id").alias("recipients"))
    every = alerts.select("alert_id").distinct().join(counted, "alert_id", "left")
    n = F.coalesce("recipients", F.lit(0))
    return every.select("alert_id", n.alias("recipients"), (n > 0).alias("success"))


def outbox(alerts: DataFrame, recipients: Collection[int] | DataFrame) -> DataFrame:
    """Rows to send, ``(alert_id, chat_id, part, text, silent)``, of styled alerts
    ``(alert_id, chat_id, text[, silent])``. What is not sent is in ``rejected_alerts``."""
    silent = F.col("silent") if "silent" in alerts.columns else F.lit(False)
    ready = alerts.select("alert_id", "chat_id", "text", F.coalesce(silent, F.lit(False)).alias("silent"))
    return message_parts(fan_out(ready.where("text is not null"), recipients)).select("alert_id", "chat_id", "part", "text", "silent")


# ---- texts -----------------------------------------------------------------------------


def render_prediction(results: DataFrame) -> DataFrame:
    """Add the prediction text and its alert type to rows of results."""
    values = {
        "timestamp": timestamp_text("timestamp"),
        "trend": F.col("trend"),
        "probability": percent_text("probability"),
        "accuracy": percent_text("accuracy"),
        "precision_0": fixed_point("precision_0"),
        "precision_1": fixed_point("precision_1"),
        "recall_0": fixed_point("recall_0"),
        "recall_1": fixed_point("recall_1"),
        "data_points": F.col("data_points"),
        "features_used": F.col("features_used"),
    }
    kind = (
        F.when(F.contains("trend", F.lit("Uptrend")), "success")
        .when(F.contains("trend", F.lit("Downtrend")), "warning")
        .otherwise("info")
    )
    return results.withColumn("type", kind).withColumn("text", fill_lines(PREDICTION_MESSAGE, values))


def render_error(errors: DataFrame) -> DataFrame:
    """The styled text of rows ``(error, timestamp)``."""
    values = {"timestamp": timestamp_text("timestamp"), "error": F.col("error")}
    message = errors.withColumn("type", F.lit("error")).withColumn("message", F.trim(fill_lines(ERROR_MESSAGE, values)))
    return style_alert(message).drop("icon", "color")
