"""Train a next-hour trend model on the feature table and score the latest row."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.fixed_values import FAILURE_TEXT, MIN_TRAINING_ROWS, TARGET
from barframe.functions.text import trend_band
from barframe.operators.alerts import outbox, render_error, render_prediction
from barframe.operators.blocks import row_ordinal
from barframe.operators.report import binary_measures, classification_report
from barframe.operators.rows import require_rows, time_series_split
from barframe.operators.smoothing import BEFORE
from barframe.plans.features import feature_table, latest_features, select_features
from barframe.session import cut_lineage, stored
from barframe.sources.sinks import append_run, write_outbox

TREES = 150
DEPTH = 10
SEED = 42


def labelled(df: DataFrame, target: str = TARGET) -> DataFrame:
    """The target as a label that names both classes, so that one-class data still trains."""
    two_classes = {"ml_attr": {"type": "nominal", "name": "label", "vals": ["0", "1"]}}
    return df.withColumn("label", F.col(target).cast("double").alias("label", metadata=two_classes))


def train_trend_model(
    train: DataFrame, features: Sequence[str], target: str = TARGET, trees: int = TREES, depth: int = DEPTH,
    seed: int = SEED, time_col: str = "ts",
) -> PipelineModel:
    """A random forest on ``features``. Executors grow all trees level by level; node ids are
    cached per row, so that a level does not walk the trees again.

    Growing trees costs far more than reading the rows, so they are spread over as many
    tasks as a shuffle has, by time: the same rows in the same pieces on every run.
    """
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True, maxMemoryInMB=1024, labelCol="label",
        featuresCol="features",
    )
    tasks = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = train.repartition(tasks, time_col)
    stages = [VectorAssembler(inputCols=list(features), outputCol="features"), forest]
    fitted = Pipeline(stages=stages).fit(labelled(spread, target).select("label", *features))
    # A copy drops the training summary, which holds the session: tasks must not be sent that.
    return PipelineModel([stage.copy() for stage in fitted.stages])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the predicted class and the probability of class 1."""
    return (
        model.transform(df)
        .withColumn("prediction", F.col("prediction").cast("int"))
        .withColumn("probability_up", vector_to_array("probability")[1])
        .drop("features", "rawPrediction", "probability")
    )


def score_latest(model: PipelineModel, table: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row: probability of class 1 for the newest row, and its trend."""
    scored = predict(model, latest_features(table, features))
    return scored.select(F.col("probability_up").alias("probability"), trend_band("probability_up").alias("trend"))


def results_row(
    latest: DataFrame, tested: DataFrame, table: DataFrame, features_used: int, run_ts: datetime | str | None = None,
    target: str = TARGET,
) -> DataFrame:
    """The 14 fields of a run, in one row."""
    measures = binary_measures(tested, target, "prediction")
    names = measures.columns
    when = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    quality = measures.select(F.struct(*names)).scalar()
    return (
        latest.withColumn("__q", quality)
        .select("trend", "probability", *[F.col(f"__q.{n}").alias(n) for n in names])
        .withColumn("timestamp", when)
        .withColumn("data_points", table.agg(F.count(F.lit(1))).scalar())
        .withColumn("features_used", F.lit(features_used))
    )


def train_and_predict(
    bars: DataFrame, sentiment: DataFrame | int = 0, present: Collection[str] | None = None,
    run_ts: datetime | str | None = None, gap: int = 0, trees: int = TREES, depth: int = DEPTH, seed: int = SEED,
    min_rows: int = MIN_TRAINING_ROWS, **table_options,
) -> tuple[DataFrame, DataFrame]:
    """``(results, report)`` of one run: features, guard, last time fold, forest, latest score.

    ``bars`` should be a stored table. The numbered bars are stored once, for the branches of
    the feature plan, and the feature table is checkpointed once: the guard, the fit and the
    scores read that copy.
    """
    if "rn" not in bars.columns:
        bars = stored(row_ordinal(bars, previous={BEFORE: "close"}), "bars")
    table = cut_lineage(feature_table(bars, sentiment, present, **table_options))
    require_rows(table, min_rows)
    features = select_features(table.columns)
    split = time_series_split(table.select("ts", *features, TARGET), gap=gap)
    model = train_trend_model(split.where("part = 'train'"), features, trees=trees, depth=depth, seed=seed)
    tested = predict(model, split.where("part = 'test'"))
    latest = score_latest(model, table, features)
    return (
        results_row(latest, tested, table, len(features), run_ts),
        classification_report(tested, TARGET, "prediction"),
    )


def alert_rows(texts: DataFrame) -> DataFrame:
    """A text for everyone, as an alert of ``outbox``."""
    return texts.select(F.lit(0).cast("bigint").alias("alert_id"), F.lit(None).cast("bigint").alias("chat_id"), "text")


def trend_job(
    predicted: Callable[[], tuple[DataFrame, DataFrame]], recipients: Collection[int] | DataFrame, outbox_path: str,
    runs_path: str, run_ts: datetime | str,
) -> bool:
    """One run of the whole job: train, note the run, and send the prediction to every recipient;
    on a failure send the error instead. Returns whether the run went well.

    ``predicted`` gives ``(results, report)``, as ``train_and_predict`` does. The results are
    stored before anything is sent, so that a failure cannot come half-way. Only failures of the
    run become an alert; one of the outbox itself is raised. The run and its alerts are keyed by
    ``run_ts``: a repeated run adds nothing (one that fails and then goes well sends both texts).
    """
    spark = SparkSession.active()
    try:
        results = stored(predicted()[0], "results")
    except Exception as error:  # noqa: BLE001 - whatever fails is reported
        row = spark.range(1).select(F.lit(FAILURE_TEXT + (str(error).splitlines() or [""])[0]).alias("error"), F.lit(run_ts).cast("timestamp").alias("timestamp"))
        write_outbox(outbox(alert_rows(render_error(row)), recipients), outbox_path, f"{run_ts} failed")
        return False
    append_run(results, runs_path, str(run_ts))
    write_outbox(outbox(alert_rows(render_prediction(results)), recipients), outbox_path, str(run_ts))
    return True
