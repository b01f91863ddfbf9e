"""Series operators against pandas on random walks, with small blocks so that many edges are crossed."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barframe.operators import smoothing as sm
from barframe.operators.blocks import row_ordinal
from barframe.operators.series import forward_target, pct_change, rolling_std
from barframe.plans.features import add_returns

LENGTHS = [1, 13, 14, 29, 30, 33, 34, 60, 61, 200, 5000]


def walk(n, seed, flat=False):
    rng = np.random.default_rng(seed)
    return np.full(n, 100.0) if flat else 100 + np.cumsum(rng.normal(0, 1, n)) * 0.1


def rsi_pandas(close, window=14):
    move = close.diff(1)
    up, down = move.where(move > 0, 0.0), -move.where(move < 0, 0.0)
    args = dict(alpha=1 / window, adjust=False, min_periods=window)
    mean_up, mean_down = up.ewm(**args).mean(), down.ewm(**args).mean()
    out = 100 - 100 / (1 + mean_up / mean_down)
    return out.mask(mean_down == 0, 100.0)


def macd_pandas(close, fast=12, slow=26, sign=9):
    def mean(x, span):
        return x.ewm(span=span, min_periods=span, adjust=False).mean()

    line = mean(close, fast) - mean(close, slow)
    return line - mean(line, sign)


@pytest.fixture(scope="module")
def frames():
    out = {f"w{n}": walk(n, n) for n in LENGTHS}
    out["flat"] = walk(300, 0, flat=True)
    # One early move, then thousands of equal prices: both means fade but keep their ratio.
    still = np.full(4300, 50.0)
    still[:6] = [50, 51, 50.5, 52, 51.5, 51]
    still[6:] = 51
    out["still"] = still
    rows = []
    for symbol, close in out.items():
        ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(len(close)) * 37, unit="min")
        rows.append(pd.DataFrame({"symbol": symbol, "ts": ts, "close": close}))
    return pd.concat(rows, ignore_index=True)


@pytest.fixture(scope="module")
def bars(spark, frames):
    df = spark.createDataFrame(frames.sample(frac=1, random_state=1)).withColumn("ts", F.col("ts").cast("timestamp"))
    return df.repartition(5).cache()


def check(result, frames, name, expected, tol=1e-9):
    got = result.toPandas().sort_values(["symbol", "ts"]).reset_index(drop=True)
    want = frames.sort_values(["symbol", "ts"], kind="stable").reset_index(drop=True)
    assert len(got) == len(want)
    values = want.groupby("symbol")["close"].transform(expected)
    g, w = got[name].astype(float).to_numpy(), values.astype(float).to_numpy()
    assert (np.isnan(g) == np.isnan(w)).all()
    ok = ~np.isnan(w)
    assert np.abs(g[ok] - w[ok]).max() < tol


def test_row_ordinal(bars, frames):
    got = row_ordinal(bars).toPandas().sort_values(["symbol", "ts"])
    assert (got["rn"] == got.groupby("symbol").cumcount()).all()
    assert len(got) == len(frames)


def test_row_ordinal_without_key(spark):
    df = spark.range(1000).selectExpr("timestamp_micros(id * 7919000000) as ts", "id")
    got = row_ordinal(df, keys=()).toPandas()
    assert (got["rn"] == got["id"]).all()


@pytest.mark.parametrize("n", [1, 60])
def test_pct_change(bars, frames, n):
    check(pct_change(bars, n=n, out="x", size=64), frames, "x", lambda c: c.pct_change(n))


def test_forward_target(bars, frames):
    def expected(c):
        return c.pct_change(60).shift(-60).apply(lambda x: 1 if x > 0 else 0)

    check(forward_target(bars, out="x", size=64), frames, "x", expected)


def test_forward_target_null_tail(bars):
    got = forward_target(bars, null_tail=True).groupBy("symbol").agg(F.count_if(F.col("target").isNull()).alias("n"))
    sizes = dict(bars.groupBy("symbol").count().collect())
    assert {r[0]: r[1] for r in got.collect()} == {s: min(n, 60) for s, n in sizes.items()}


def test_rolling_std(bars, frames):
    check(rolling_std(bars, out="x", size=64), frames, "x", lambda c: c.rolling(30).std(), 1e-6)


@pytest.mark.parametrize("size", [64, 256, None])
def test_ewma(bars, frames, size):
    means = {"a": sm.Ewm("close", 1 / 14, 14), "b": sm.Ewm.span("close", 12), "c": sm.Ewm("close", 1.0)}
    got = sm.ewma(bars, means, size=size)
    check(got, frames, "a", lambda c: c.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean())
    check(got, frames, "b", lambda c: c.ewm(span=12, adjust=False, min_periods=12).mean())
    check(got, frames, "c", lambda c: c)


def test_ewma_long_span(bars, frames):
    got = sm.ewma(bars, {"x": sm.Ewm("close", 0.002)}, size=64)
    check(got, frames, "x", lambda c: c.ewm(alpha=0.002, adjust=False).mean())


def test_rsi(bars, frames):
    check(sm.rsi(bars), frames, "rsi", rsi_pandas)


def test_rsi_small_blocks_keep_the_ratio_of_faded_means(bars, frames, monkeypatch):
    monkeypatch.setattr(sm, "block_size", lambda alphas: 128)
    check(sm.rsi(bars), frames, "rsi", rsi_pandas)


def test_macd(bars, frames):
    check(sm.macd_diff(bars), frames, "macd_diff", macd_pandas)


def test_constant_mean_is_the_constant(bars):
    got = sm.ewma(bars.where("symbol = 'flat'"), {"x": sm.Ewm("close", 0.1)}, size=64)
    assert got.where("abs(x - 100) > 1e-9").count() == 0


@pytest.mark.parametrize("size", [128, None])
def test_add_returns(bars, frames, monkeypatch, size):
    if size:
        monkeypatch.setattr(sm, "block_size", lambda alphas: size)
    got = add_returns(bars).cache()
    check(got, frames, "return", lambda c: c.pct_change())
    check(got, frames, "return_1h", lambda c: c.pct_change(60))
    check(got, frames, "target", lambda c: (c.pct_change(60).shift(-60) > 0).astype(int))
    check(got, frames, "rsi", rsi_pandas)
    check(got, frames, "macd", macd_pandas)
    check(got, frames, "volatility", lambda c: c.rolling(30).std(), 1e-6)


def test_empty(spark):
    empty = spark.createDataFrame([], "symbol string, ts timestamp, close double")
    assert add_returns(empty).count() == 0


def test_zero_price_gives_null(spark):
    df = spark.createDataFrame([("a", i, p) for i, p in enumerate([0.0, 5.0, 0.0, 0.0])], "symbol string, i int, close double")
    df = df.withColumn("ts", F.timestamp_seconds("i"))
    got = [r["x"] for r in pct_change(df, out="x").orderBy("i").collect()]
    assert got == [None, None, -1.0, None]


def test_block_size():
    assert sm.block_size([1 / 14, 2 / 13, 2 / 27, 0.2]) == 2048
    assert sm.block_size([2 / 3]) == 256
    for alphas in ([0.001], [0.2], [2 / 3, 0.1]):
        size = sm.block_size(alphas)
        assert max(1 - a for a in alphas) <= 1 and (1 - max(alphas)) ** -size <= 1e201


def test_rows_are_shuffled_by_block_only(bars):
    """Numbered rows go by (symbol, block) once, through three windows; block ends are reduced before
    their shuffle."""
    numbered = row_ordinal(bars, previous={sm.BEFORE: "close"}).select("symbol", "ts", "close", "rn", sm.BEFORE)
    plan = add_returns(bars.sparkSession.createDataFrame([], numbered.schema))
    lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    exchanges = [re.sub(r"#\d+L?", "", line) for line in lines if "Exchange hashpartitioning" in line]
    assert sum("(symbol, blk," in line for line in exchanges) == 1
    assert len(exchanges) == 3  # the rows, the block ends, the carry
    windows = [re.sub(r"#\d+L?", "", line) for line in lines if "Window [" in line]
    assert len(windows) <= 4 and all("windowspecdefinition(symbol, blk, rn" in line for line in windows)
    assert not any("SinglePartition" in line for line in lines)
