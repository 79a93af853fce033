"""Scoring of orders with a saved bundle."""

from __future__ import annotations

from collections.abc import Sequence
from time import perf_counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.errors import ScoringError
from deliverylens.functions.text import finite
from deliverylens.operators.features import engineer_features, prediction_input_columns, select_model_features
from deliverylens.operators.model import class_probabilities
from deliverylens.session import run_dir
from deliverylens.sources.bundle import Bundle, is_threshold
from deliverylens.sources.orders_file import (
    NUMBER_FIELDS,
    ORDER_FIELDS,
    TEXT_FIELDS,
    TIME_FIELDS,
    load_orders,
    read_order_text,
)

POSITIVE_CLASS = 1


def positive_probability(probabilities: Column, classes: Sequence[int], positive_class: int = POSITIVE_CLASS) -> Column:
    """Probability of the positive class, found by class value and not by position."""
    places = [i for i, c in enumerate(classes) if c == positive_class]
    if len(places) != 1:
        raise ScoringError(f"class {positive_class!r} must occur once in {list(classes)}")
    return F.get(probabilities, F.lit(places[0]))


def probability_report(df: DataFrame, probabilities: str, classes: Sequence[int]) -> DataFrame:
    """One row: rows, rows with another number of classes, rows with a bad probability."""
    bad = F.exists(probabilities, lambda p: p.isNull() | F.isnan(p) | (p < 0) | (p > 1))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.size(probabilities) != len(classes)).alias("wrong_class_count"),
        F.count_if(bad).alias("out_of_range"),
    )


def check_probabilities(df: DataFrame, probabilities: str, classes: Sequence[int], expected_rows: int | None = None) -> None:
    r = probability_report(df, probabilities, classes).first()
    if r["wrong_class_count"]:
        raise ScoringError("number of probabilities does not match the number of classes")
    if r["out_of_range"]:
        raise ScoringError(f"{r['out_of_range']} rows have probabilities outside [0, 1]")
    if expected_rows is not None and r["rows"] != expected_rows:
        raise ScoringError(f"{r['rows']} predictions for {expected_rows} rows")


def apply_threshold(probability: Column, threshold: float) -> Column:
    """1 when the probability reaches the threshold, else 0."""
    if not is_threshold(threshold):
        raise ScoringError(f"no threshold from 0 to 1: {threshold!r}")
    return (probability >= F.lit(float(threshold))).cast("int")


def _guarded(probability: Column) -> Column:
    """Stops the job on a probability that is no number in [0, 1]."""
    good = finite(probability).between(0.0, 1.0)
    return F.when(F.coalesce(good, F.lit(False)), probability).otherwise(
        F.raise_error(F.lit("probability outside [0, 1]")).cast("double")
    )


def score_rows(orders: DataFrame, bundle: Bundle, keep: Sequence[str] = ("order_id",)) -> DataFrame:
    """Engineer, transform and score; row-wise, without an action, so it also runs on a stream."""
    prep = bundle.preprocessor
    keep = [c for c in keep if c in orders.columns]
    held = {f"_keep_{i}": F.col(c) for i, c in enumerate(keep)}
    engineered = engineer_features(orders.withColumns(held) if held else orders)
    ready = select_model_features(engineered, prep.numeric_features, prep.categorical_features, keep=list(held))
    scored = class_probabilities(ready, prep, bundle.model)
    probability = positive_probability(F.col("probability"), bundle.model.classes)
    return scored.select(
        *[F.col(h).alias(c) for h, c in zip(held, keep)], _guarded(probability).alias("late_probability")
    ).withColumn("predicted_is_late", apply_threshold(F.col("late_probability"), bundle.threshold))


def score(orders: DataFrame, bundle: Bundle) -> DataFrame:
    """``order_id, late_probability, predicted_is_late``, one row per order."""
    if orders.isEmpty():
        raise ScoringError("no orders to score")
    return score_rows(orders, bundle)


def with_version(scored: DataFrame, bundle: Bundle) -> DataFrame:
    return scored.withColumn("model_version", F.lit(bundle.version))


def write_predictions(scored: DataFrame, path: str, compression: str = "none") -> str:
    """JSON Lines, one object per order."""
    scored.write.mode("overwrite").option("ignoreNullFields", False).option("compression", compression).json(path)
    return path


def score_file(spark: SparkSession, source: str, target: str, bundle: Bundle) -> DataFrame:
    """Read an order file, score it, write predictions with the model version."""
    result = with_version(score_rows(load_orders(spark, source), bundle), bundle)
    write_predictions(result, target)
    return spark.read.schema(result.schema).json(target)


def score_and_log(spark: SparkSession, source: str, target: str, rejected: str, log: str, bundle: Bundle) -> DataFrame:
    """Score an order file as one job: predictions, rejected orders with reasons, log lines.

    Every order of the file is in exactly one of ``target`` and ``rejected``, which
    :func:`read_rejected` reads. The checked orders and the scored ones are written
    once each, and all three results come from these, so a logged probability is the
    one of the prediction. The logged latency is that of scoring the whole file.
    They are compressed with gzip: a log line has the inputs of its order with all
    their names.
    """
    from deliverylens.sources.logs import log_predictions

    checked_path, scored_path = run_dir(spark, "checked"), run_dir(spark, "scored")
    mark_contract(read_order_text(spark, source)).write.parquet(checked_path)
    valid, bad = split_marked(spark.read.parquet(checked_path))
    bad.write.mode("overwrite").option("compression", "gzip").json(rejected)
    inputs = prediction_input_columns(valid.columns)
    start = perf_counter()
    score_rows(valid, bundle, keep=inputs).write.parquet(scored_path)
    latency = (perf_counter() - start) * 1000
    scored = spark.read.parquet(scored_path)
    result = with_version(scored.select("order_id", "late_probability", "predicted_is_late"), bundle)
    write_predictions(result, target, "gzip")
    log_predictions(
        scored,
        log,
        input_columns=inputs,
        latency_ms=latency,
        model_type=bundle.model.model_type,
        model_version=bundle.version,
        threshold=bundle.threshold,
        compression="gzip",
    )
    return spark.read.schema(result.schema).json(target)


REJECTED_SCHEMA = ", ".join(f"{c} STRING" for c in ORDER_FIELDS) + ", reasons ARRAY<STRING>"


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The rejected orders of :func:`score_and_log`, of which there may be none."""
    return spark.read.schema(REJECTED_SCHEMA).json(path)


# --- order-record contract -------------------------------------------------


def contract_columns(columns: Sequence[str]) -> list[str]:
    """Reasons the column set breaks the contract: absent or extra fields."""
    reasons = [f"missing field: {c}" for c in ORDER_FIELDS if c not in columns]
    return reasons + [f"extra field: {c}" for c in columns if c not in ORDER_FIELDS]


def _reason(name: str) -> Column:
    value = F.col(name)
    given = value.isNotNull()
    if name == "order_id":
        return F.when(F.coalesce(F.length(value.cast("string")), F.lit(0)) == 0, F.lit("order_id is empty"))
    if name in NUMBER_FIELDS:
        return F.when(given & value.try_cast("double").isNull(), F.lit(f"{name} is not a number"))
    if name in TIME_FIELDS:
        return F.when(given & value.try_cast("timestamp_ntz").isNull(), F.lit(f"{name} is not a timestamp"))
    return F.lit(None).cast("string")


def mark_contract(orders: DataFrame) -> DataFrame:
    """Order records with ``reasons``, empty for a valid one; a wrong column set is an error."""
    wrong = contract_columns(orders.columns)
    if wrong:
        raise ScoringError("; ".join(wrong))
    return _with_reasons(orders, orders.columns, F.array_compact(F.array(*[_reason(c) for c in ORDER_FIELDS])))


def _with_reasons(orders: DataFrame, columns: Sequence[str], reasons: Column) -> DataFrame:
    """A generator keeps filters on the reasons from being rewritten in terms of every field."""
    return orders.select(*columns, F.inline(F.array(F.struct(reasons.alias("reasons")))))


def split_marked(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed valid rows, and the others as they are."""
    valid = marked.filter(F.size("reasons") == 0).select(
        F.col("order_id").cast("string").alias("order_id"),
        *[F.col(c).try_cast("double").alias(c) for c in NUMBER_FIELDS],
        *[F.col(c).cast("string").alias(c) for c in TEXT_FIELDS],
        *[F.col(c).try_cast("timestamp_ntz").alias(c) for c in TIME_FIELDS],
    )
    return valid, marked.filter(F.size("reasons") > 0)


def check_contract(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split order records into typed valid rows and rejected rows with reasons.

    A wrong column set rejects the whole input; a bad value rejects its row.
    """
    return split_marked(mark_contract(orders))


def mark_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines of JSON, one order each, with every field as text, the ``line`` itself and ``reasons``.

    A line must be an object with exactly the fields of the contract, in any order.
    Blank lines are no records.
    """
    fields = F.from_json(column, "map<string,string>")
    found = lines.where(F.trim(column) != "").select(F.col(column).alias("line"), fields.alias("_fields"))
    given = F.map_keys("_fields")
    found = found.withColumn("_given", F.coalesce(given, F.array().cast("array<string>")))
    found = found.select("line", "_fields", "_given", *[F.try_element_at("_fields", F.lit(c)).alias(c) for c in ORDER_FIELDS])
    missing = [F.when(~F.array_contains("_given", c), F.lit(f"missing field: {c}")) for c in ORDER_FIELDS]
    values = [F.when(F.array_contains("_given", c), _reason(c)) for c in ORDER_FIELDS]
    extra = F.transform(F.array_except("_given", F.array(*map(F.lit, ORDER_FIELDS))), lambda k: F.concat(F.lit("extra field: "), k))
    twice = F.size("_given") > F.size(F.array_distinct("_given"))
    reasons = F.concat(F.array_compact(F.array(F.when(twice, F.lit("repeated field")), *missing)), extra, F.array_compact(F.array(*values)))
    reasons = F.when(F.col("_fields").isNull(), F.array(F.lit("no JSON object"))).otherwise(reasons)
    return _with_reasons(found, ["line", *ORDER_FIELDS], reasons)
