"""Classification quality from label and prediction columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion_counts(df: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """One row per pair of label and prediction that occurs."""
    return df.groupBy(F.col(y).alias("y"), F.col(yhat).alias("yhat")).agg(F.count(F.lit(1)).alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return _ratio(2 * p * r, p + r)


def classification_report(df: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """``(label, precision, recall, f1_score, support)`` per class that occurs as label or
    prediction, then ``accuracy`` (in every measure), ``macro avg`` and ``weighted avg``."""
    counts = confusion_counts(df, y, yhat)
    hit = F.col("y") == F.col("yhat")
    per_class = (
        counts.withColumn("label", F.explode(F.array_distinct(F.array("y", "yhat"))))
        .groupBy("label")
        .agg(
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("tp"),
            F.sum(F.when(F.col("yhat") == F.col("label"), F.col("n")).otherwise(0)).alias("predicted"),
            F.sum(F.when(F.col("y") == F.col("label"), F.col("n")).otherwise(0)).alias("support"),
        )
        .withColumn("precision", _ratio(F.col("tp"), F.col("predicted")))
        .withColumn("recall", _ratio(F.col("tp"), F.col("support")))
        .withColumn("f1_score", _f1(F.col("precision"), F.col("recall")))
    )
    measures = ("precision", "recall", "f1_score")
    total = F.sum("support")
    # Three summary rows from one pass over the class rows.
    summary = per_class.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("label"),
                *[_ratio(F.sum("tp"), total).alias(m) for m in measures],
                total.alias("support"),
            ),
            F.struct(F.lit("macro avg").alias("label"), *[F.avg(m).alias(m) for m in measures], total.alias("support")),
            F.struct(
                F.lit("weighted avg").alias("label"),
                *[_ratio(F.sum(F.col(m) * F.col("support")), total).alias(m) for m in measures],
                total.alias("support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    classes = per_class.select(F.col("label").cast("string").alias("label"), *measures, "support")
    return classes.unionByName(summary.where("support is not null"))


def binary_measures(df: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """One row: accuracy, and precision, recall, f1 and support of the classes 0 and 1
    (0 for a class that does not occur)."""
    counts = confusion_counts(df, y, yhat)

    def n(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    cells = counts.agg(
        n(F.lit(True)).alias("rows"),
        n(F.col("y") == F.col("yhat")).alias("hits"),
        *[n((F.col("y") == c) & (F.col("yhat") == c)).alias(f"tp_{c}") for c in (0, 1)],
        *[n(F.col("yhat") == c).alias(f"predicted_{c}") for c in (0, 1)],
        *[n(F.col("y") == c).alias(f"support_{c}") for c in (0, 1)],
    )
    return (
        cells.withColumn("accuracy", _ratio(F.col("hits"), F.col("rows")))
        .withColumns({f"precision_{c}": _ratio(F.col(f"tp_{c}"), F.col(f"predicted_{c}")) for c in (0, 1)})
        .withColumns({f"recall_{c}": _ratio(F.col(f"tp_{c}"), F.col(f"support_{c}")) for c in (0, 1)})
        .withColumns({f"f1_{c}": _f1(F.col(f"precision_{c}"), F.col(f"recall_{c}")) for c in (0, 1)})
        .select(
            "accuracy", "precision_0", "precision_1", "recall_0", "recall_1", "f1_0", "f1_1", "support_0", "support_1"
        )
    )
