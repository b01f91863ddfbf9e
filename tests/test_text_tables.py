import datetime as dt

import pytest
from pyspark.sql import functions as F

from barframe.functions import text as tx
from barframe.operators import alerts as al
from barframe.operators import tables as tb
from barframe.operators.report import binary_measures, classification_report


def one(spark, column, *, row=("",), schema="x string"):
    return spark.createDataFrame([row], schema).select(column.alias("y")).first()["y"]


@pytest.mark.parametrize("x", [0.0, 1.0, -0.65, 1.8, 100.0, 1e7, 12345678.9, 1e15, 1e16, 1.5e20, 0.001, 0.0001, 1e-5,
                               -2.5e-7, 4.8828125e-05, float("nan"), float("inf"), float("-inf")])
def test_float_text(spark, x):
    assert one(spark, tx.float_text("x"), row=(x,), schema="x double") == str(x)


@pytest.mark.parametrize("x", [0.125, 0.375, 0.5, 12.345, 0.005, 1234567.891])
def test_fixed_point_and_percent(spark, x):
    assert one(spark, tx.fixed_point("x"), row=(x,), schema="x double") == f"{x:.2f}"
    assert one(spark, tx.percent_text("x"), row=(x,), schema="x double") == f"{x:.1%}"


@pytest.mark.parametrize(("symbol", "short"), [
    ("BANKNIFTY25JUL57000CE", "BN 57000 CE"), ("NSE:BANKNIFTY25JUL57000PE", "BN 57000 PE"),
    ("NSE:NIFTY25JUL25000PE", "NF 25000 PE"), ("NIFTY25JUL25000CE", "NF 25000 CE"),
    ("BANKNIFTY-INDEX-X", "BANKNIFTY-INDEX..."), ("FINNIFTY24PECE", "NF F24PE CE"),
    ("123456789012345", "123456789012345"), ("1234567890123456", "123456789012345..."), ("", ""), ("N/A", "N/A"),
    ("RELIANCE", "RELIANCE"),
])
def test_option_symbol(spark, symbol, short):
    assert one(spark, tx.option_symbol("x"), row=(symbol,)) == short


@pytest.mark.parametrize(("value", "text"), [
    (10.0, "H <b><u>+10.0</u></b>"), (-10.0, "H <b><u>-10.0</u></b>"), (9.99, "🟢 +9.99"), (-0.65, "🔴 -0.65"),
    (0.0, "⚪ 0.0"), (None, ""),
])
def test_change_cell(spark, value, text):
    cell = tx.render_cell("x", "OI_Change", "double", {"OI_Change": {"high_change": "H"}})
    assert one(spark, cell, row=(value,), schema="x double") == text
    plain = tx.render_cell("x", "OI_Change", "double", {"other": {}})
    assert one(spark, plain, row=(value,), schema="x double") == ("" if value is None else str(value))


@pytest.mark.parametrize(("strike", "text"), [(100, "🎯 <b>100</b>"), (99, "🟡 99"), (101, "o 101")])
def test_strike_cell(spark, strike, text):
    cell = tx.render_cell("x", "Strike", "int", {"Strike": {"otm": "o"}}, 100)
    assert one(spark, cell, row=(strike,), schema="x int") == text


def test_first_pattern_wins(spark):
    cell = tx.render_cell("x", "note", "string", {"note": {"values": {"BUY": "1", "strong": "2"}}})
    assert one(spark, cell, row=("Strong buy",)) == "1 Strong buy"
    assert one(spark, cell, row=("hold",)) == "hold"


@pytest.mark.parametrize(("p", "band"), [(0.6, "➡️ Sideways"), (0.61, "📈 Uptrend"), (0.4, "➡️ Sideways"), (0.39, "📉 Downtrend")])
def test_trend_band(spark, p, band):
    assert one(spark, tx.trend_band("x"), row=(p,), schema="x double") == band


@pytest.mark.parametrize("n", [0, 1, 4096, 4097, 9000])
@pytest.mark.parametrize("char", ["x", "📈", "\n"])
def test_text_parts(spark, n, char):
    text = char * n
    parts = one(spark, tx.text_parts("x"), row=(text,))
    assert parts == ([text[i:i + 4096] for i in range(0, n, 4096)] or [""])


def test_columns_and_labels():
    columns = ["Symbol", "Strike", "Latest_OI", "OI_3m", "OI_Change", "OI_Time"]
    assert tx.change_columns(columns) == ["OI_3m", "OI_Change"]
    assert [tx.period_label(c) for c in ("OI_3m", "OI_Change")] == ["3min", "Change"]


@pytest.mark.parametrize(("text", "command", "args"), [
    ("/PING", "ping", []), ("//ping", "ping", []), ("/ping@bot a  b", "ping", ["a", "b"]), ("/", "", []),
    ("/a\tb\n c ", "a", ["b", "c"]),
])
def test_command(spark, text, command, args):
    assert one(spark, tx.command_name("x"), row=(text,)) == command
    assert one(spark, tx.command_args("x"), row=(text,)) == args
    assert one(spark, tx.is_command("x"), row=(text,))


def test_names_and_previews(spark):
    assert one(spark, tx.full_name(F.lit(None).cast("string"), F.lit("B"))) == "B"
    assert one(spark, tx.full_name(F.lit("A"), F.lit("B"))) == "A B"
    assert one(spark, tx.preview("x"), row=("y" * 60,)) == "y" * 50 + "..."


def option_table(spark, n=3):
    data = [("r", i, "BANKNIFTY25JUL57000CE", 56999 + i, 1812265 + i, [-0.65, 12.0, None][i % 3], None, "t") for i in range(n)]
    return spark.createDataFrame(
        data, "report_id string, ord int, Symbol string, Strike int, Latest_OI bigint, OI_3m double, OI_Change double, OI_Time string"
    )


def test_render_table(spark):
    rules = {"Strike": {}, "OI_3m": {"positive": "🟢"}}
    got = tb.render_table(option_table(spark).repartition(3), "T", rules, atm_strike=57000).first()
    rule = "─" * 40
    assert got["text"] == "\n".join([
        "<b>📊 T</b>\n", "<code>", "🟡 56999 | OI: 1812265", "   BN 57000 CE", "   3min: 🔴 -0.65", rule,
        "🎯 <b>57000</b> | OI: 1812266", "   BN 57000 CE", "   3min: ⚡ <b><u>+12.0</u></b>", rule,
        "🔵 57001 | OI: 1812267", "   BN 57000 CE", "</code>",
    ])


def test_render_table_limit_and_order(spark):
    text = tb.render_table(option_table(spark, 25).repartition(4)).first()["text"]
    assert text.startswith("<code>\n56999 | OI: 1812265\n")
    assert text.count("| OI: ") == 20 and "1812285" not in text
    assert tb.render_table(option_table(spark, 3).limit(0)).count() == 0


def test_render_table_missing_columns(spark):
    df = spark.createDataFrame([("r", 1, None)], "report_id string, ord int, Latest_OI bigint")
    assert tb.render_table(df).first()["text"] == "<code>\nN/A | OI: None\n   N/A\n</code>"


def test_styles(spark):
    df = spark.createDataFrame([("loss", "m"), ("?", "m"), (None, "m")], "type string, message string")
    assert [r["text"] for r in al.style_alert(df).collect()] == ["📉 <b>m</b>", "ℹ️ <b>m</b>", "ℹ️ <b>m</b>"]


@pytest.mark.parametrize("as_table", [False, True])
def test_fan_out(spark, as_table):
    data = [(1, None, "a"), (2, 0, "b"), (3, 7, "c"), (4, 99, "d")]
    df = spark.createDataFrame(data, "alert_id bigint, chat_id bigint, text string")
    ids = spark.createDataFrame([(7,), (8,), (8,)], "chat_id bigint") if as_table else [7, 8, 8]
    got = sorted((r["alert_id"], r["chat_id"]) for r in al.fan_out(df, ids).collect())
    assert got == [(1, 7), (1, 8), (2, 7), (2, 8), (3, 7)]


def test_fan_out_without_recipients(spark):
    df = spark.createDataFrame([(1, None, "a")], "alert_id bigint, chat_id bigint, text string")
    assert al.fan_out(df, []).count() == 0


def test_outbox(spark):
    df = spark.createDataFrame([(1, None, "x" * 5000, None)], "alert_id bigint, chat_id bigint, text string, silent boolean")
    got = sorted((r["chat_id"], r["part"], len(r["text"]), r["silent"]) for r in al.outbox(df, [5]).collect())
    assert got == [(5, 0, 4096, False), (5, 1, 904, False)]


def test_prediction_and_error(spark):
    row = dict(trend="📉 Downtrend", probability=0.125, accuracy=0.5, precision_0=0.125, precision_1=1.0, recall_0=0.0,
               recall_1=0.375, timestamp=dt.datetime(2024, 1, 2, 3, 4, 5), data_points=None, features_used=17)
    schema = ("trend string, probability double, accuracy double, precision_0 double, precision_1 double, recall_0 double, "
              "recall_1 double, timestamp timestamp, data_points bigint, features_used int")
    df = spark.createDataFrame([tuple(row.values())], schema)
    got = al.render_prediction(df).first()
    assert got["type"] == "warning"
    lines = got["text"].split("\n")
    assert lines[1] == "⏰ <i>2024-01-02 03:04:05</i>"
    assert lines[4] == "<b>Uptrend Probability:</b> 12.5%"
    assert lines[8] == "• Precision (Down): 0.12"
    assert lines[14] == "• Data Points: N/A (1-min intervals)"
    error = spark.createDataFrame([("boom", dt.datetime(2024, 1, 2))], "error string, timestamp timestamp")
    text = al.render_error(error).first()["text"]
    assert text.startswith("❌ <b><b>🚨") and "<b>Error:</b> boom" in text


def test_report(spark):
    cells = [(0, 0)] * 3 + [(0, 1)] * 44 + [(1, 0)] * 55 + [(1, 1)] * 297
    df = spark.createDataFrame(cells, "y int, yhat int")
    got = {r["label"]: r for r in classification_report(df).collect()}
    assert got["0"]["precision"] == pytest.approx(3 / 58) and got["1"]["recall"] == pytest.approx(297 / 352)
    assert got["accuracy"]["f1_score"] == pytest.approx(300 / 399) and got["macro avg"]["support"] == 399
    assert got["weighted avg"]["recall"] == pytest.approx(300 / 399)
    row = binary_measures(df).first()
    assert (row["support_0"], row["support_1"]) == (47, 352) and row["accuracy"] == pytest.approx(300 / 399)


def test_report_of_one_class(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "y int, yhat int")
    row = binary_measures(df).first()
    assert (row["precision_0"], row["f1_0"], row["support_0"], row["precision_1"]) == (0.0, 0.0, 0, 1.0)
    assert {r["label"] for r in classification_report(df).collect()} == {"1", "accuracy", "macro avg", "weighted avg"}
    assert binary_measures(df.limit(0)).first()["accuracy"] == 0.0


def test_class_never_predicted(spark):
    got = {r["label"]: r for r in classification_report(spark.createDataFrame([(0, 1), (1, 1)], "y int, yhat int")).collect()}
    assert (got["0"]["precision"], got["0"]["f1_score"], got["0"]["support"]) == (0.0, 0.0, 1)
