import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barframe.operators import rows
from barframe.operators.align import align_by_position, align_by_time, attach_scalar
from barframe.operators.blocks import row_ordinal
from barframe.operators.memberships import add_cap_class
from barframe.operators.skew import flag_members, join_per_key
from barframe.plans.features import feature_table, require_series, select_features
from barframe.sources.bars import build_bars, instrument_catalog, named_bars, newest_date, open_bar_table, read_bar_table, read_bars, write_bar_table
from barframe.sources.sinks import append_run, write_memberships, write_table


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


@pytest.fixture(scope="module")
def two(spark):
    data = [("a", at(m), float(m)) for m in (0, 1, 2, 3, 1500)] + [("b", at(m), m + 0.5) for m in (1, 3, 4)]
    return spark.createDataFrame(data, "symbol string, ts timestamp, close double")


COLUMNS = {"a": ("a", "close"), "b": ("b", "close")}


def test_position(two):
    got = [tuple(r) for r in align_by_position(two, "a", COLUMNS).orderBy("rn").select("a", "b").collect()]
    assert got == [(0, 1.5), (1, 3.5), (2, 4.5), (3, None), (1500, None)]


def test_position_longer_other_is_cut(two):
    assert align_by_position(two, "b", {"a": ("a", "close")}).count() == 3


def test_time(two):
    got = [tuple(r) for r in align_by_time(two, "a", COLUMNS).orderBy("ts").select("a", "b").collect()]
    assert got == [(0, None), (1, 1.5), (2, None), (3, 3.5), (1500, None)]


@pytest.mark.parametrize(("tolerance", "last"), [("1 minute", None), ("2 days", 4.5)])
def test_asof(two, tolerance, last):
    got = [tuple(r) for r in align_by_time(two, "a", COLUMNS, tolerance).orderBy("ts").select("a", "b").collect()]
    assert got == [(0, None), (1, 1.5), (2, 1.5), (3, 3.5), (1500, last)]


def test_asof_keeps_a_null_of_the_latest_bar(spark):
    data = [("a", at(5), 1.0), ("b", at(1), 2.0), ("b", at(4), None)]
    df = spark.createDataFrame(data, "symbol string, ts timestamp, close double")
    assert align_by_time(df, "a", COLUMNS, "1 hour").first()["b"] is None


def test_scalar(spark):
    one = spark.range(7, 8).select(F.col("id").alias("x"))
    assert {r["s"] for r in attach_scalar(spark.range(3), one, "s").collect()} == {7}


def test_drop_incomplete_keeps_infinity(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),)], "x double")
    assert rows.drop_incomplete(df).count() == 2


def test_require_rows(spark):
    assert rows.require_rows(spark.range(500)).count() == 500
    with pytest.raises(ValueError):
        rows.require_rows(spark.range(499))


@pytest.mark.parametrize("n", [6, 11, 1003])
def test_split(spark, n):
    df = spark.range(n).selectExpr("timestamp_seconds(id * 5000) as ts", "id")
    got = rows.time_series_split(df, fold=None).toPandas()
    k = n // 6
    for f in range(5):
        start = n - (5 - f) * k
        part = got[got["fold"] == f]
        assert sorted(part[part["part"] == "train"]["id"]) == list(range(start))
        assert sorted(part[part["part"] == "test"]["id"]) == list(range(start, start + k))
    last = rows.time_series_split(df, gap=2)
    assert last.where("part = 'test'").count() == k
    assert last.where("part = 'train'").count() == n - k - 2


def test_latest_and_head(spark):
    df = spark.createDataFrame([("a", at(1), 1, "x"), ("a", at(2), None, "y"), ("b", at(0), 3, "z")],
                               "k string, ts timestamp, v int, s string")
    got = {tuple(r) for r in rows.latest_row(df, ["k"]).select("k", "v", "s").collect()}
    assert got == {("a", None, "y"), ("b", 3, "z")}
    assert rows.latest_row(df).first()["s"] == "y"
    assert [r["s"] for r in rows.head_rows(df, ["s"], 2).collect()] == ["x", "y"]
    assert {r["s"] for r in rows.head_rows(df, ["ts"], 1, ["k"]).collect()} == {"x", "z"}


def test_join_per_key(spark):
    """A key with half of the rows, a NULL key and copies of one row: nothing is lost or doubled."""
    left = spark.createDataFrame([("h", 1)] * 50 + [(None, 2)] * 20 + [(f"k{i}", i) for i in range(30)], "key string, v int")
    per_key = left.select("key").distinct().withColumn("tag", F.concat(F.lit("t-"), F.coalesce("key", F.lit("null"))))
    got = join_per_key(left, per_key, "key").toPandas()
    assert len(got) == 100
    assert (got["tag"] == "t-" + got["key"].fillna("null")).all()
    assert join_per_key(left, per_key.limit(0), "key").where("tag is null").count() == 100


def scans(df):
    """Scans of the executed plan, which adaptive execution has settled."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return text.count("FileScan") + text.count("Scan ExistingRDD"), text


def test_one_plan_reads_the_left_side_twice_at_most(spark, tmp_path):
    rows = [("NIFTY MIDCAP 50" if i % 2 else "NIFTY 50", "hot" if i % 3 == 0 else f"s{i}") for i in range(900)]
    spark.createDataFrame(rows, "Index string, Stock string").write.parquet(str(tmp_path / "m"))
    df = add_cap_class(spark.read.parquet(str(tmp_path / "m")))
    n, text = scans(df)
    assert n <= 2 and "Cartesian" not in text and "NestedLoop" not in text
    assert df.where("Stock = 'hot'").select("`Market Cap Classification`").distinct().collect()[0][0] == "Mid Cap"
    assert df.count() == 900


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_rows_without_time_have_no_place(spark, keys):
    data = [("a", None, 1), ("a", at(3), 2), ("a", None, 3), ("a", at(1), 4), ("a", at(60 * 24), 5), ("a", at(2), 6)]
    df = spark.createDataFrame(data, "k string, ts timestamp, v int")
    got = sorted((r["rn"], r["v"]) for r in row_ordinal(df, keys).collect())
    assert got == [(0, 4), (1, 6), (2, 2), (3, 5)]
    split = rows.time_series_split(df, n_splits=3, fold=None, keys=keys)
    assert sorted((r["fold"], r["rn"]) for r in split.where("part = 'test'").collect()) == [(0, 1), (1, 2), (2, 3)]


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_fewer_rows_than_folds_are_an_error(spark, keys):
    df = spark.createDataFrame([("a", at(i)) for i in range(5)], "k string, ts timestamp")
    with pytest.raises(Exception, match="cannot make 5 folds"):
        rows.time_series_split(df, keys=keys).collect()
    assert rows.time_series_split(df, n_splits=4, keys=keys).count() == 5


def test_latest_row_breaks_ties(spark):
    df = spark.createDataFrame([("a", at(1), 1, None), ("a", at(1), 3, "x"), ("a", at(1), 2, "y")], "k string, ts timestamp, n int, s string")
    assert rows.latest_row(df, tie_breakers=["n"]).first()["s"] == "x"
    assert [r["s"] for r in rows.latest_row(df, ["k"], tie_breakers=["n"]).collect()] == ["x"]


def test_flag_members(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "chat bigint")
    ids = spark.createDataFrame([(1,), (1,), (9,), (None,)], "id bigint")
    got = sorted((r["chat"] or 0, r["ok"]) for r in flag_members(left, ids, "chat", "id", "ok").collect())
    assert got == [(0, False), (1, True), (1, True), (2, False)]


def test_build_bars_ties_and_nulls(spark):
    data = [("a", 2, at(0), 5.0), ("a", 1, at(0), 7.0), ("a", 3, at(0), 6.0), ("a", 4, at(0), None), ("a", 5, at(2), 1.0)]
    df = spark.createDataFrame(data, "symbol string, event_id bigint, ts timestamp, price double")
    got = [tuple(r)[2:] for r in build_bars(df).orderBy("ts").collect()]
    assert got == [(7.0, 7.0, 5.0, 6.0, 3.0), (1.0, 1.0, 1.0, 1.0, 1.0)]


def test_build_bars_stays_a_hash_aggregate(spark):
    df = spark.createDataFrame([], "symbol string, event_id bigint, ts timestamp, price double")
    plan = build_bars(df)._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_read_bars(spark, tmp_path, fmt):
    data = [("^NSEI", at(60 * 24 * d), 1.0, 1.0, 1.0, None if d == 9 else 1.0, 1.0) for d in range(11)]
    data += [("other", at(60 * 24 * 30), 1.0, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(data, "symbol string, ts timestamp, open double, high double, low double, close double, volume double")
    write_table(df, str(tmp_path / "bars"), fmt)
    got = read_bars(spark, str(tmp_path / "bars"), ["^NSEI"], fmt=fmt)
    assert sorted(r["ts"].day for r in got.collect()) == [4, 5, 6, 7, 8, 9, 11]
    early = read_bars(spark, str(tmp_path / "bars"), ["^NSEI"], days=1, end="2024-01-03 00:00:00", fmt=fmt)
    assert sorted(r["ts"].day for r in early.collect()) == [2, 3]
    assert {r["symbol"] for r in named_bars(got).collect()} == {"NSEI"}


def test_instruments(spark):
    assert instrument_catalog(spark).where("name = 'SNP'").first()["symbol"] == "^GSPC"


def test_require_series(spark):
    df = spark.createDataFrame([("NSEI",), ("SNP",)], "symbol string")
    assert require_series(df) == ["NSEI", "SNP"]
    with pytest.raises(ValueError, match="NSEI"):
        require_series(df.where("symbol = 'SNP'"))


def test_feature_table_of_present_series(spark):
    minutes = pd.DataFrame({"i": range(200)})
    minutes["close"] = 100 + (minutes["i"] * 7919 % 101) / 10
    df = spark.createDataFrame(minutes).selectExpr(
        "explode(array('NSEI', 'SNP')) as symbol", "timestamp_seconds(i * 60) as ts", "close as open", "close as high",
        "close as low", "close", "1.0D as volume",
    )
    table = feature_table(df, 3)
    assert table.columns == [
        "ts", "N_Close", "N_Return", "N_Return_1h", "SNP_Return", "NSEI_RSI", "NSEI_MACD", "NSEI_Volatility", "Hour",
        "Minute", "DayOfWeek", "Sentiment", "Target",
    ]
    assert table.count() == 140  # the first 60 rows lack the 60-row return, the made-up tail targets stay
    assert feature_table(df, 3, null_tail=True).count() == 80
    assert feature_table(df, 3, align="time").count() == 140
    assert feature_table(df, 3, align="time", tolerance="5 minutes").count() == 140
    assert select_features(table.columns) == [
        "N_Return", "N_Return_1h", "NSEI_RSI", "NSEI_MACD", "NSEI_Volatility", "Hour", "Minute", "DayOfWeek",
        "Sentiment", "SNP_Return",
    ]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("x", 1)], "`Index Type` string, n int")
    assert write_memberships(df, str(tmp_path / "m"))
    assert spark.read.option("header", True).csv(str(tmp_path / "m")).columns == ["Index Type", "n"]
    assert not write_memberships(df.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    append_run(df, str(tmp_path / "runs"))
    append_run(df, str(tmp_path / "runs"))
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 2


def test_rows_per_key_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([], "k string, v int")
    plan = rows.head_rows(df, ["v"], 2, ["k"])._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan


def test_no_price_makes_no_bar(spark):
    df = spark.createDataFrame([("a", 1, at(0), float("nan")), ("a", 2, at(0), None)],
                               "symbol string, event_id bigint, ts timestamp, price double")
    assert build_bars(df).count() == 0


@pytest.mark.parametrize("tolerance", ["1 second", "90 seconds", "10 minutes", "3 hours"])
def test_tolerance_bins_against_brute_force(spark, tolerance):
    import random

    draw = random.Random(len(tolerance))
    ticks = {s: {draw.randint(0, 40_000): float(draw.randint(1, 99)) for _ in range(400)} for s in ("p", "q", "r")}
    at = lambda second: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)
    df = spark.createDataFrame([(s, at(t), v) for s, found in ticks.items() for t, v in found.items()], "symbol string, ts timestamp, close double")
    number, unit = tolerance.split()
    limit = int(number) * {"second": 1, "seconds": 1, "minutes": 60, "hours": 3600}[unit]

    def last(series, t):
        seen = [u for u in ticks[series] if t - limit <= u <= t]
        return ticks[series][max(seen)] if seen else None

    got = align_by_time(df, "p", {"own": ("p", "close"), "q": ("q", "close"), "r": ("r", "close")}, tolerance)
    want = sorted(((at(t), v, last("q", t), last("r", t)) for t, v in ticks["p"].items()), key=str)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_a_day_of_ticks_is_no_single_sort(spark):
    """Ticks of one day: no task holds more than a few bins of them."""
    ticks = spark.range(86_400).selectExpr("if(id % 2 = 0, 'p', 'q') as symbol", "timestamp_seconds(id) as ts", "cast(id as double) as close")
    got = align_by_time(ticks, "p", {"q": ("q", "close")}, "1 minute")
    assert got.where("q = cast(unix_seconds(ts) - 1 as double)").count() == 43_199
    binned = ticks.groupBy((F.unix_seconds("ts") / 60).cast("long")).count().agg(F.max("count")).first()[0]
    assert binned == 60
    assert "__bin" in got._jdf.queryExecution().optimizedPlan().toString() and "date_trunc" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_bar_table_is_pruned_and_numbered_in_place(spark, tmp_path):
    bars = spark.range(20 * 1440).selectExpr(
        "if(id % 5 < 4, 'hot', concat('s', id % 7)) as symbol", "timestamp_seconds(1704067200 + id * 60) as ts", "1.0D as open", "1.0D as high", "1.0D as low", "cast(id as double) as close", "1.0D as volume",
    )
    path = str(tmp_path / "bars")
    write_bar_table(bars.where("close < 20000"), "bars_written", path, buckets=4)
    write_bar_table(bars.where("close >= 20000"), "bars_written", path, buckets=4)
    open_bar_table(spark, "bars_opened", path, buckets=4)
    assert newest_date(spark, "bars_opened") == "2024-01-20"
    seven = read_bar_table(spark, "bars_opened")
    assert seven.count() == 7 * 1440 + 1 and read_bar_table(spark, "bars_opened", ["hot"], end="2024-01-05").count() == 4 * 4 * 1440 // 5 + 1
    scan = seven._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in scan and "PartitionFilters: []" not in scan
    numbered = rows_numbered = row_ordinal(read_bar_table(spark, "bars_opened", days=None), cut="day", previous={"before": "close"})
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    # what is exchanged is the table of buckets; the rows' own columns are in no exchange
    exchanged = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanged and len(exchanged) <= 2 and "Bucketed: true" in plan
    after = plan.split("Exchange", 1)[1]
    assert "partial_count" in after or "count(1)" in after
    want = {(r["symbol"], r["ts"]): (r["rn"], r["before"]) for r in row_ordinal(bars, previous={"before": "close"}).collect()}
    assert {(r["symbol"], r["ts"]): (r["rn"], r["before"]) for r in rows_numbered.collect()} == want
    for name in ("bars_written", "bars_opened"):
        spark.sql(f"drop table {name}")
