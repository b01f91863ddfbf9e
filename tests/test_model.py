import pytest
from pyspark.sql import functions as F

from barframe.plans.trend import labelled, predict, score_latest, train_and_predict, train_trend_model, trend_job

FEATURES = ["x", "z"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(600).selectExpr(
        "timestamp_seconds(id * 60) as ts", "cast((id * 7919) % 1000 as double) as x", "cast(id % 7 as double) as z",
    ).withColumn("Target", (F.col("x") > 500).cast("int"))


def test_learns_and_repeats(rows):
    train, test = rows.where("ts < '1970-01-01 08:00:00'"), rows.where("ts >= '1970-01-01 08:00:00'")
    runs = []
    for _ in range(2):
        model = train_trend_model(train, FEATURES, trees=10, depth=4)
        runs.append([tuple(r) for r in predict(model, test).select("ts", "prediction", "probability_up").orderBy("ts").collect()])
    assert runs[0] == runs[1]
    right = predict(model, test).where("prediction = Target").count()
    assert right / test.count() > 0.95
    latest = score_latest(model, rows, FEATURES).collect()
    assert len(latest) == 1 and 0 <= latest[0]["probability"] <= 1


@pytest.mark.parametrize("value", [0, 1])
def test_one_class(rows, value):
    same = rows.withColumn("Target", F.lit(value))
    model = train_trend_model(same, FEATURES, trees=3, depth=2)
    assert score_latest(model, same, FEATURES).first()["probability"] == value
    assert labelled(same).schema["label"].metadata["ml_attr"]["vals"] == ["0", "1"]


def test_run(spark):
    bars = spark.range(900).selectExpr(
        "explode(array('NSEI', 'SNP')) as symbol", "timestamp_seconds(id * 60) as ts", "1.0D as open", "1.0D as high",
        "1.0D as low", "100 + 10 * sin(id / 40.0) + (id * 7919 % 13) / 10 as close", "1.0D as volume",
    )
    results, report = train_and_predict(bars, 2, run_ts="2024-01-01 00:00:00", trees=10, depth=5)
    row = results.first()
    assert results.columns == [
        "trend", "probability", "accuracy", "precision_0", "precision_1", "recall_0", "recall_1", "f1_0", "f1_1",
        "support_0", "support_1", "timestamp", "data_points", "features_used",
    ]
    assert row["data_points"] == 840 and row["features_used"] == 10
    assert row["support_0"] + row["support_1"] == 840 // 6
    labels = {r["label"]: r for r in report.collect()}
    assert labels["accuracy"]["precision"] == pytest.approx(row["accuracy"])
    with pytest.raises(ValueError, match="too few"):
        train_and_predict(bars.where("ts < '1970-01-01 07:00:00'"), 2)


def test_job(spark, tmp_path):
    out, runs = str(tmp_path / "outbox"), str(tmp_path / "runs")
    bars = spark.range(900).selectExpr(
        "'NSEI' as symbol", "timestamp_seconds(id * 60) as ts", "1.0D as open", "1.0D as high", "1.0D as low",
        "100 + 10 * sin(id / 40.0) + (id * 7919 % 13) / 10 as close", "1.0D as volume",
    )
    ts = "2024-01-01 00:00:00"
    assert trend_job(lambda: train_and_predict(bars, 2, run_ts=ts, trees=3, depth=3), [7, 8], out, runs, ts)
    row = spark.read.parquet(runs).first()
    sent = spark.read.parquet(out).collect()
    assert sorted(r["chat_id"] for r in sent) == [7, 8]
    assert f"Data Points: {row['data_points']} " in sent[0]["text"] and row["trend"] in sent[0]["text"]
    assert not trend_job(lambda: train_and_predict(bars.limit(100), 2), [7], out, runs, ts)
    failed = spark.read.parquet(out).where("text like '%Pipeline failed%'").collect()
    assert [r["chat_id"] for r in failed] == [7] and spark.read.parquet(runs).count() == 1
