"""JSON Lines logs: tolerant scan and prediction-log sink."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.errors import ScoringError
from deliverylens.functions.jsonlog import is_object, parse_line
from deliverylens.sources.tables import _path_exists


@dataclass(frozen=True)
class LogScan:
    """Parsed lines: ``records`` keeps objects as VARIANT, ``report`` counts lines."""

    lines: DataFrame

    @property
    def records(self) -> DataFrame:
        return self.lines.filter("valid").drop("valid")

    @property
    def report(self) -> DataFrame:
        return self.lines.agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if("valid").alias("records"),
            F.count_if(~F.col("valid")).alias("invalid"),
        )


def scan_lines(df: DataFrame, column: str = "value") -> LogScan:
    """Parse log text lines; blank lines are skipped, lines that hold no object are invalid.

    Repeated keys are allowed in the session from here on, as log writers allow them.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    filled = df.filter(F.trim(F.translate(column, "\t\r\n", "   ")) != "")
    keep = [c for c in df.columns if c != column]
    # A generator keeps later filters above the parse, so a line is parsed once.
    parsed = filled.select(*keep, F.explode(F.array(parse_line(F.col(column)))).alias("record"))
    return LogScan(parsed.withColumn("valid", is_object(F.col("record"))))


def read_jsonl(spark: SparkSession, path: str) -> LogScan:
    """Scan a log file or folder; an absent one is an empty log."""
    if not _path_exists(spark, path):
        return scan_lines(spark.createDataFrame([], "value STRING"))
    return scan_lines(spark.read.text(path))


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def _json_value(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    value = F.col(name)
    if kind in ("double", "float"):
        return F.when(~F.isnan(value), value).alias(name)
    if kind.startswith("timestamp"):
        with_fraction = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
        return F.when(F.date_format(value, "SSSSSS") == "000000", whole).otherwise(with_fraction).alias(name)
    return value.alias(name)


def prediction_lines(
    scored: DataFrame,
    *,
    input_columns: Sequence[str],
    request_id: str,
    model_type: str,
    model_version: str,
    threshold: float,
    timestamp: Column | None = None,
) -> DataFrame:
    """One JSON line per scored row, inputs and outputs nested, nulls written."""
    absent = [c for c in ("late_probability", "predicted_is_late") if c not in scored.columns]
    if absent:
        raise ScoringError("prediction columns are missing: " + ", ".join(absent))
    absent = [c for c in input_columns if c not in scored.columns]
    if absent:
        raise ScoringError("prediction input columns are missing: " + ", ".join(absent))
    stamp = timestamp if timestamp is not None else F.current_timestamp()
    record = F.struct(
        F.lit("prediction").alias("event"),
        _iso(stamp).alias("timestamp"),
        F.lit(request_id).alias("request_id"),
        F.struct(*[_json_value(scored, c) for c in input_columns]).alias("input"),
        F.struct(
            F.col("late_probability").cast("double").alias("late_probability"),
            F.col("predicted_is_late").cast("int").alias("predicted_is_late"),
        ).alias("output"),
        F.lit(model_type).alias("model_type"),
        F.lit(model_version).alias("model_version"),
        F.lit(float(threshold)).alias("threshold"),
    )
    return scored.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))


def log_predictions(
    scored: DataFrame,
    path: str,
    *,
    input_columns: Sequence[str],
    latency_ms: float,
    model_type: str,
    model_version: str,
    threshold: float,
    compression: str = "none",
) -> str:
    """Append a request line and one line per scored row; returns the request id.

    The size in the request line is counted while the rows are written, so the
    scoring runs once. Files of a log may differ in ``compression``.
    """
    from pyspark.sql import Observation

    spark = scored.sparkSession
    request_id = str(uuid.uuid4())
    counted = Observation()
    lines = prediction_lines(
        scored.observe(counted, F.count(F.lit(1)).alias("rows")),
        input_columns=input_columns,
        request_id=request_id,
        model_type=model_type,
        model_version=model_version,
        threshold=threshold,
    )
    lines.write.mode("append").option("compression", compression).text(path)
    request = spark.range(1).select(
        F.to_json(
            F.struct(
                F.lit("prediction_request").alias("event"),
                _iso(F.current_timestamp()).alias("timestamp"),
                F.lit(request_id).alias("request_id"),
                F.lit(counted.get["rows"]).alias("request_size"),
                F.array(*[F.lit(c) for c in input_columns]).alias("input_columns"),
                F.lit(float(latency_ms)).alias("latency_ms"),
                F.lit(model_type).alias("model_type"),
                F.lit(model_version).alias("model_version"),
                F.lit(float(threshold)).alias("threshold"),
            )
        ).alias("value")
    )
    request.write.mode("append").option("compression", compression).text(path)
    return request_id
