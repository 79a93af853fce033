"""Classifier metrics from counts per distinct score.

Rows are first counted per score, so tied scores, however many, are one row;
running counts come from :mod:`deliverylens.operators.ranks`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.operators.ranks import running_sums

METRIC_NAMES = ("average_precision", "roc_auc", "f1", "precision", "recall", "balanced_accuracy", "accuracy")


def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    return df.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    )


def score_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: its counts and those of all scores at least as high."""
    counts = score_counts(df, score, label, by)
    curve = running_sums(counts, [F.desc("score")], ["positives", "negatives"], by)
    return curve.withColumnsRenamed({"cum_positives": "tp", "cum_negatives": "fp"})


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def average_precision_of(curve: DataFrame) -> DataFrame:
    gained = F.sum(F.col("positives") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return curve.agg(_ratio(gained, F.sum("positives")).alias("average_precision"))


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    """Sum over distinct scores of recall gained times precision."""
    return average_precision_of(score_curve(df, score, label))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve, tied pairs counted half; null with one class."""
    return score_curve(df, score, label).agg(_auc().alias("roc_auc"))


def _auc() -> Column:
    above = F.col("tp") - F.col("positives")
    wins = F.sum(F.col("negatives") * (above + F.col("positives") / 2))
    return F.try_divide(wins, F.sum("positives").cast("double") * F.sum("negatives"))


def precision_recall_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Precision, recall and F1 at each distinct score, and the closing point (1, 0)."""
    curve = score_curve(df, score, label)
    points = _points(curve)
    closing = curve.limit(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
        F.lit(None).cast("double").alias("f1"),
    )
    return points.unionByName(closing)


def _points(curve: DataFrame) -> DataFrame:
    total = curve.agg(F.sum("positives")).scalar()
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    with_rates = curve.select(
        F.col("score").alias("threshold"),
        precision.alias("precision"),
        # Without positives recall is taken as 1.
        F.when(total == 0, F.lit(1.0)).otherwise(F.try_divide(F.col("tp"), total)).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return with_rates.withColumn("f1", 2 * p * r / (p + r + F.lit(1e-12)))


def best_threshold(df: DataFrame, score: str, label: str) -> DataFrame:
    """The score with the highest F1, the lowest of equals."""
    return _points(score_curve(df, score, label)).orderBy(F.desc("f1"), F.asc("threshold")).limit(1)


def confusion_counts(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    """tn, fp, fn, tp in one row; a score equal to the threshold is positive."""
    predicted = F.col(score) >= F.lit(float(threshold))
    actual = F.col(label) == 1
    return df.agg(
        F.count_if(~predicted & ~actual).alias("tn"),
        F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & actual).alias("fn"),
        F.count_if(predicted & actual).alias("tp"),
    )


def confusion_table(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    """Two rows, one per actual class."""
    rows = F.array(
        F.struct(F.lit("Actual On Time").alias("actual"), F.col("tn").alias("predicted_on_time"), F.col("fp").alias("predicted_late")),
        F.struct(F.lit("Actual Late").alias("actual"), F.col("fn").alias("predicted_on_time"), F.col("tp").alias("predicted_late")),
    )
    return confusion_counts(df, score, label, threshold).select(F.inline(rows))


def evaluate(
    df: DataFrame,
    score: str,
    label: str,
    threshold: float | Column = 0.5,
    by: Sequence[str] = (),
) -> DataFrame:
    """The seven metrics and the threshold, one row per group.

    ``threshold`` is a number or an expression of the ``by`` columns.
    """
    curve = score_curve(df, score, label, by)
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    hit = F.col("score") >= t
    gained = F.sum(F.col("positives") * F.col("tp") / (F.col("tp") + F.col("fp")))
    counts = curve.groupBy(*by).agg(
        _ratio(gained, F.sum("positives")).alias("average_precision"),
        _auc().alias("roc_auc"),
        F.sum(F.when(hit, F.col("positives")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("negatives")).otherwise(0)).alias("fp"),
        F.sum("positives").alias("p"),
        F.sum("negatives").alias("n"),
    )
    precision = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _ratio(F.col("tp"), F.col("p"))
    tn = F.col("n") - F.col("fp")
    # The mean of the recalls of the classes that occur.
    recalls = F.array_compact(F.array(F.try_divide(F.col("tp"), F.col("p")), F.try_divide(tn, F.col("n"))))
    mean_recall = F.aggregate(recalls, F.lit(0.0), lambda a, x: a + x) / F.size(recalls)
    return counts.select(
        *by,
        "average_precision",
        "roc_auc",
        _ratio(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("p")).alias("f1"),
        precision.alias("precision"),
        recall.alias("recall"),
        mean_recall.alias("balanced_accuracy"),
        ((F.col("tp") + tn) / (F.col("p") + F.col("n"))).alias("accuracy"),
        t.alias("threshold"),
    )


def metric_payload(summary: DataFrame) -> DataFrame:
    """Long form of the validation and test metrics: prefixed name, finite value.

    ``summary`` has one row per ``section`` ('validation', 'test').
    """
    values = summary.select("section", *[F.col(m).cast("double").alias(m) for m in METRIC_NAMES])
    long = values.unpivot(["section"], list(METRIC_NAMES), "metric", "value")
    return long.select(F.concat_ws("_", "section", "metric").alias("name"), "value")


def check_metric_payload(payload: DataFrame) -> dict[str, float]:
    """The payload as a dictionary; raises when a value is missing or not finite."""
    import math

    found = {r["name"]: r["value"] for r in payload.collect()}
    for section in ("validation", "test"):
        for metric in METRIC_NAMES:
            value = found.get(f"{section}_{metric}")
            if value is None or not math.isfinite(value):
                raise ValueError(f"invalid metric {section}_{metric}")
    return found
