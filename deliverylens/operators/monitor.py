"""Summary of request and prediction logs, drift and alerts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.functions.jsonlog import is_error_status, is_object, safe_float, safe_int, text_field
from deliverylens.operators.quantiles import column_quantiles
from deliverylens.session import cut_lineage
from deliverylens.sources.logs import LogScan

SCORING_PATHS = ("/predict", "/predict/batch")


@dataclass(frozen=True)
class MonitorLimits:

    minimum_predictions: int = 30
    baseline_count: int = 14471
    baseline_late_rate: float = 0.2048234399834151
    baseline_mean_probability: float = 0.05929370779772134
    late_rate_delta: float = 0.10
    mean_probability_delta: float = 0.03
    error_rate: float = 0.05
    average_latency_ms: float = 500.0


def request_events(records: DataFrame) -> DataFrame:
    """Scoring requests: error flag and latency (null when it cannot be read)."""
    record = F.col("record")
    keep = [c for c in records.columns if c != "record"]
    return records.filter(
        (text_field(record, "$.event") == "api_request") & text_field(record, "$.path").isin(*SCORING_PATHS)
    ).select(*keep, is_error_status(record).alias("is_error"), safe_float(record, "$.latency_ms").alias("latency_ms"))


def prediction_events(records: DataFrame) -> DataFrame:
    """Predictions with a finite probability and a label of 0 or 1; others are skipped."""
    record = F.col("record")
    keep = [c for c in records.columns if c != "record"]
    output = F.try_variant_get(record, "$.output", "variant")
    fields = F.struct(
        is_object(output).alias("_has_output"),
        safe_float(record, "$.output.late_probability").alias("late_probability"),
        safe_int(record, "$.output.predicted_is_late").alias("predicted_is_late"),
    )
    # Fields are read once; the checks below look at the values.
    found = records.filter(text_field(record, "$.event") == "prediction").select(*keep, F.inline(F.array(fields)))
    return found.filter(
        F.col("_has_output") & F.col("late_probability").isNotNull() & F.col("predicted_is_late").isin(0, 1)
    ).drop("_has_output")


def marked_requests(lines: DataFrame) -> DataFrame:
    """Every log line, invalid ones included: ``valid``, whether it is ``counted`` as a scoring request, and its figures."""
    record = F.col("record")
    scoring = (text_field(record, "$.event") == "api_request") & text_field(record, "$.path").isin(*SCORING_PATHS)
    return lines.select(
        "valid",
        F.coalesce(F.col("valid") & scoring, F.lit(False)).alias("counted"),
        is_error_status(record).alias("is_error"),
        safe_float(record, "$.latency_ms").alias("latency_ms"),
    )


def marked_predictions(lines: DataFrame) -> DataFrame:
    """Every log line, invalid ones included: ``valid``, whether it is ``counted`` as a prediction, and its figures."""
    record = F.col("record")
    fields = F.struct(
        ((text_field(record, "$.event") == "prediction") & is_object(F.try_variant_get(record, "$.output", "variant"))).alias("_made"),
        safe_float(record, "$.output.late_probability").alias("late_probability"),
        safe_int(record, "$.output.predicted_is_late").alias("predicted_is_late"),
    )
    found = lines.select("valid", F.inline(F.array(fields)))
    usable = F.col("valid") & F.col("_made") & F.col("late_probability").isNotNull() & F.col("predicted_is_late").isin(0, 1)
    return found.withColumn("counted", F.coalesce(usable, F.lit(False))).drop("_made")


def request_totals(counted: Column | None = None) -> tuple[Column, ...]:
    """Aggregates over request events, shared by batch and stream; of the ``counted`` rows where that is given."""
    counted = F.lit(True) if counted is None else counted
    latency = F.when(counted, F.col("latency_ms"))
    errors = F.count_if(counted & F.col("is_error"))
    return (
        F.count_if(counted).alias("request_count"),
        errors.alias("error_count"),
        F.coalesce(F.try_divide(errors, F.count_if(counted)), F.lit(0.0)).alias("error_rate"),
        F.avg(latency).alias("average_latency_ms"),
        F.max(latency).alias("max_latency_ms"),
    )


def prediction_totals(counted: Column | None = None) -> tuple[Column, ...]:
    counted = F.lit(True) if counted is None else counted
    late = F.count_if(counted & (F.col("predicted_is_late") == 1))
    return (
        F.count_if(counted).alias("prediction_count"),
        late.alias("predicted_late_count"),
        F.count_if(counted & (F.col("predicted_is_late") == 0)).alias("predicted_on_time_count"),
        F.try_divide(late, F.count_if(counted)).alias("predicted_late_rate"),
        F.avg(F.when(counted, F.col("late_probability"))).alias("mean_late_probability"),
    )


def request_metrics(events: DataFrame) -> DataFrame:
    """Counts, error rate and latency figures in one row; p95 is exact."""
    totals = events.agg(*request_totals())
    p95 = column_quantiles(events, ["latency_ms"], {"p95": 0.95}).agg(F.max("p95"))
    return totals.select(
        "request_count",
        "error_count",
        "error_rate",
        "average_latency_ms",
        p95.scalar().alias("p95_latency_ms"),
        "max_latency_ms",
    )


def prediction_metrics(events: DataFrame) -> DataFrame:
    return events.agg(*prediction_totals())


def drift(metrics: DataFrame, limits: MonitorLimits = MonitorLimits()) -> DataFrame:
    """Add deltas to the baseline and ``drift_status``; limits are exclusive."""
    enough = F.col("prediction_count") >= limits.minimum_predictions
    rate = F.when(enough, F.abs(F.col("predicted_late_rate") - F.lit(limits.baseline_late_rate)))
    mean = F.when(enough, F.abs(F.col("mean_late_probability") - F.lit(limits.baseline_mean_probability)))
    moved = (F.col("late_rate_absolute_delta") > limits.late_rate_delta) | (
        F.col("mean_probability_absolute_delta") > limits.mean_probability_delta
    )
    return metrics.withColumns({"late_rate_absolute_delta": rate, "mean_probability_absolute_delta": mean}).withColumn(
        "drift_status",
        F.when(~enough, "insufficient_data").when(moved, "drift_detected").otherwise("stable"),
    )


def alert_list(limits: MonitorLimits = MonitorLimits()) -> Column:
    """Names of the limits that are passed, from request metrics and drift columns."""
    return F.array_compact(
        F.array(
            F.when((F.col("request_count") > 0) & (F.col("error_rate") > limits.error_rate), "high_error_rate"),
            F.when(F.col("average_latency_ms") > limits.average_latency_ms, "high_average_latency"),
            F.when(F.col("drift_status") == "drift_detected", "prediction_drift"),
        )
    )


def alerts(request_row: DataFrame, drift_row: DataFrame, limits: MonitorLimits = MonitorLimits()) -> DataFrame:
    """One row: status and alerts."""
    return _side_by_side(request_row, drift_row).select(
        F.when(F.size(alert_list(limits)) > 0, "alert").otherwise("ok").alias("status"),
        alert_list(limits).alias("alerts"),
    )


def _side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of two one-row tables in one row."""
    row = right.select(F.struct(*right.columns)).scalar()
    return left.withColumn("_right", row).select(*left.columns, "_right.*")


def monitoring_summary(
    requests: LogScan,
    predictions: LogScan,
    limits: MonitorLimits = MonitorLimits(),
) -> DataFrame:
    """The whole summary as one row of nested structs.

    Each log is parsed once: the figures of request lines are written, since the
    p95 passes over them again, and one aggregate a log gives its totals and its
    count of invalid lines.
    """
    invalid = F.count_if(~F.col("valid"))
    asked = cut_lineage(marked_requests(requests.lines))
    p95 = column_quantiles(asked.where("counted"), ["latency_ms"], {"p95": 0.95}).agg(F.max("p95"))
    totals = asked.agg(*request_totals(F.col("counted")), invalid.alias("_invalid_requests")).withColumn("p95_latency_ms", p95.scalar())
    answered = marked_predictions(predictions.lines).agg(*prediction_totals(F.col("counted")), invalid.alias("_invalid_predictions"))
    both = _side_by_side(totals, drift(answered, limits))
    names = alert_list(limits)
    return both.select(
        F.when(F.size(names) > 0, "alert").otherwise("ok").alias("status"),
        F.struct("request_count", "error_count", "error_rate", "average_latency_ms", "p95_latency_ms", "max_latency_ms").alias("requests"),
        F.struct(
            "prediction_count",
            "predicted_late_count",
            "predicted_on_time_count",
            "predicted_late_rate",
            "mean_late_probability",
        ).alias("predictions"),
        F.struct(
            F.col("drift_status").alias("status"),
            F.lit(limits.minimum_predictions).alias("minimum_predictions"),
            F.lit(limits.baseline_count).alias("baseline_prediction_count"),
            F.lit(limits.baseline_late_rate).alias("baseline_predicted_late_rate"),
            F.lit(limits.baseline_mean_probability).alias("baseline_mean_late_probability"),
            F.col("late_rate_absolute_delta").alias("predicted_late_rate_absolute_delta"),
            F.col("mean_probability_absolute_delta").alias("mean_late_probability_absolute_delta"),
            F.lit(limits.late_rate_delta).alias("predicted_late_rate_threshold"),
            F.lit(limits.mean_probability_delta).alias("mean_late_probability_threshold"),
        ).alias("drift"),
        names.alias("alerts"),
        F.struct(
            F.col("_invalid_requests").alias("requests"),
            F.col("_invalid_predictions").alias("predictions"),
        ).alias("invalid_log_records"),
    )


def baseline(scored: DataFrame) -> DataFrame:
    """Drift baseline from scored orders; both forms of the deviation are given."""
    return scored.agg(
        F.count(F.lit(1)).alias("prediction_count"),
        F.avg(F.col("predicted_is_late").cast("double")).alias("predicted_late_rate"),
        F.avg("late_probability").alias("mean_late_probability"),
        F.stddev_pop("late_probability").alias("std_late_probability"),
        F.try_divide(
            F.stddev_pop("late_probability") * F.sqrt(F.count(F.lit(1)).cast("double")),
            F.sqrt((F.count(F.lit(1)) - 1).cast("double")),
        ).alias("sample_std_late_probability"),
    )
