"""Request and prediction metrics over event-time windows of growing logs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from deliverylens.functions.jsonlog import text_field
from deliverylens.operators.monitor import (
    MonitorLimits,
    drift,
    prediction_events,
    prediction_totals,
    request_events,
    request_totals,
)
from deliverylens.sources.logs import scan_lines


def read_log_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Lines of new log files with the event time of their ``timestamp`` field."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return with_event_time(lines)


def _event_time() -> Column:
    return text_field(F.col("record"), "$.timestamp").try_cast("timestamp")


def with_event_time(lines: DataFrame) -> DataFrame:
    return scan_lines(lines).records.withColumn("event_time", _event_time())


def set_aside(lines: DataFrame) -> DataFrame:
    """The lines no window can count, with the reason; a stream of its own beside the windows."""
    scanned = scan_lines(lines.withColumn("line", F.col("value"))).lines
    reason = F.when(~F.col("valid"), "no object").when(_event_time().isNull(), "no timestamp")
    return scanned.select("line", reason.alias("reason")).filter(F.col("reason").isNotNull())


def _window(length: str, slide: str | None) -> Column:
    return F.window("event_time", length, slide) if slide else F.window("event_time", length)


def windowed_requests(
    records: DataFrame,
    length: str,
    watermark: str,
    slide: str | None = None,
    accuracy: int | None = None,
) -> DataFrame:
    """Request metrics per window; events older than the watermark are dropped.

    The exact p95 keeps the counted distinct latencies of a window as state;
    ``accuracy`` bounds that state with a sketch.
    """
    p95 = (
        F.percentile_approx("latency_ms", 0.95, accuracy) if accuracy else F.percentile("latency_ms", 0.95)
    ).alias("p95_latency_ms")
    events = request_events(records.filter(F.col("event_time").isNotNull()))
    return (
        events.withWatermark("event_time", watermark)
        .groupBy(_window(length, slide))
        .agg(*request_totals(), p95)
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "request_count",
            "error_count",
            "error_rate",
            "average_latency_ms",
            "p95_latency_ms",
            "max_latency_ms",
        )
    )


def windowed_predictions(records: DataFrame, length: str, watermark: str, slide: str | None = None) -> DataFrame:
    """Prediction metrics per window."""
    events = prediction_events(records.filter(F.col("event_time").isNotNull()))
    return (
        events.withWatermark("event_time", watermark)
        .groupBy(_window(length, slide))
        .agg(*prediction_totals())
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "prediction_count",
            "predicted_late_count",
            "predicted_on_time_count",
            "predicted_late_rate",
            "mean_late_probability",
        )
    )


def request_alerts(windows: DataFrame, limits: MonitorLimits = MonitorLimits()) -> DataFrame:
    """Windows that pass a request limit, with the names of the limits."""
    names = F.array_compact(
        F.array(
            F.when((F.col("request_count") > 0) & (F.col("error_rate") > limits.error_rate), "high_error_rate"),
            F.when(F.col("average_latency_ms") > limits.average_latency_ms, "high_average_latency"),
        )
    )
    return windows.withColumn("alerts", names).filter(F.size("alerts") > 0)


def drift_alerts(windows: DataFrame, limits: MonitorLimits = MonitorLimits()) -> DataFrame:
    """Windows whose predictions moved away from the baseline."""
    return drift(windows, limits).filter(F.col("drift_status") == "drift_detected")


def start_alerts(
    windows: DataFrame,
    find: Callable[[DataFrame], DataFrame],
    deliver: Callable[[DataFrame, int], None],
    checkpoint: str,
) -> StreamingQuery:
    """Hand the alerting windows of every batch to ``deliver``."""

    def each(batch: DataFrame, batch_id: int) -> None:
        deliver(find(batch), batch_id)

    return (
        windows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(each)
        .trigger(availableNow=True)
        .start()
    )


def publish_windows(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write every window a batch has changed, open ones included.

    Each batch has a folder of its own, so a batch that runs again replaces its
    rows. :func:`published` reads how the windows stand.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        windows.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(each)
        .trigger(availableNow=True)
        .start()
    )


def published(spark: SparkSession, path: str) -> DataFrame:
    """Each published window as its last batch left it."""
    rows = spark.read.option("basePath", path).parquet(path)
    values = [c for c in rows.columns if c not in ("window_start", "window_end", "batch")]
    last = rows.groupBy("window_start", "window_end").agg(F.max_by(F.struct(*values), "batch").alias("last"))
    return last.select("window_start", "window_end", "last.*")


def start_windows(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed windows as Parquet files."""
    return (
        windows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
