"""Rule-driven checks of the labelled table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.errors import DataQualityError
from deliverylens.operators.mart import MART_COLUMNS

LABELLED_COLUMNS = (*MART_COLUMNS, "delay_days", "is_late")

# Federal states of Brazil.
STATES = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
)


@dataclass(frozen=True)
class Rules:
    """Limits of the labelled table. The defaults are fixed values, those of the real data set."""

    row_count: tuple[int, int] = (90000, 110000)
    columns: Sequence[str] = LABELLED_COLUMNS
    unique_key: str = "order_id"
    not_null: Sequence[str] = (
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "customer_state",
        "item_count",
        "unique_products",
        "unique_sellers",
        "total_item_price",
        "total_freight_value",
        "delay_days",
        "is_late",
    )
    mostly_not_null: Mapping[str, float] = field(
        default_factory=lambda: {
            "order_approved_at": 0.999,
            "order_delivered_carrier_date": 0.9999,
            "payment_records": 0.9999,
            "payment_types_count": 0.9999,
            "payment_total": 0.9999,
            "payment_installments_max": 0.9999,
            "primary_payment_type": 0.9999,
        }
    )
    allowed: Mapping[str, Sequence] = field(
        default_factory=lambda: {"order_status": ("delivered",), "is_late": (0, 1), "customer_state": STATES}
    )
    ranges: Mapping[str, tuple[float, float]] = field(
        default_factory=lambda: {
            "item_count": (1, 25),
            "unique_products": (1, 10),
            "unique_sellers": (1, 10),
            "total_item_price": (0, 20000),
            "total_freight_value": (0, 2500),
            "payment_total": (0, 20000),
            "payment_installments_max": (0, 30),
            "delay_days": (-365, 365),
        }
    )


_RESULT = "rule STRING, column_name STRING, success BOOLEAN, observed_value DOUBLE, unexpected_count BIGINT"


def row_count_rule(limits: tuple[int, int]) -> Column:
    n = F.count(F.lit(1))
    return _entry("row_count_between", None, n.between(*limits), n, F.lit(0))


def _entry(rule: str, column: str | None, success: Column, observed: Column, unexpected: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"),
        F.lit(column).cast("string").alias("column_name"),
        success.cast("boolean").alias("success"),
        observed.cast("double").alias("observed_value"),
        unexpected.cast("bigint").alias("unexpected_count"),
    )


def not_null_rule(column: str, mostly: float = 1.0) -> Column:
    """Success when at least ``mostly`` of the rows have a value."""
    missing = F.count_if(F.col(column).isNull())
    filled = F.coalesce(F.try_divide(F.count(column), F.count(F.lit(1))), F.lit(1.0))
    success = missing == 0 if mostly >= 1.0 else filled >= F.lit(float(mostly))
    return _entry("not_null" if mostly >= 1.0 else "mostly_not_null", column, success, filled, missing)


def in_set_rule(column: str, allowed: Sequence) -> Column:
    """Values must be among ``allowed``; nulls are not looked at."""
    outside = F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))
    return _entry("in_set", column, outside == 0, F.count(column), outside)


def between_rule(column: str, low: float, high: float) -> Column:
    """Values must lie in [low, high]; nulls are not looked at."""
    outside = F.count_if(~F.col(column).between(low, high))
    return _entry("between", column, outside == 0, F.count(column), outside)


def unique_rule(df: DataFrame, column: str) -> DataFrame:
    """Every row of a value that occurs more than once is unexpected."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    repeated = F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0))
    return counts.agg(_entry("unique", column, repeated == 0, F.count(F.lit(1)), repeated).alias("r")).select("r.*")


def column_rules(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Rules on the schema alone."""
    have, want = list(df.columns), list(columns)
    difference = len(set(have) ^ set(want))
    return [
        _entry("column_count", None, F.lit(len(have) == len(want)), F.lit(len(have)), F.lit(abs(len(have) - len(want)))),
        _entry("column_set", None, F.lit(difference == 0), F.lit(len(set(have) & set(want))), F.lit(difference)),
    ]


def validate(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per rule: success, observed value, unexpected count.

    All row-level rules are one aggregate over one scan; uniqueness is the
    only one that shuffles. A rule on a column that is absent fails.
    """
    entries = [("row", row_count_rule(rules.row_count))]
    entries += [("not_null", not_null_rule(c)) for c in rules.not_null if c in df.columns]
    entries += [("mostly", not_null_rule(c, m)) for c, m in rules.mostly_not_null.items() if c in df.columns]
    entries += [("set", in_set_rule(c, v)) for c, v in rules.allowed.items() if c in df.columns]
    entries += [("range", between_rule(c, *v)) for c, v in rules.ranges.items() if c in df.columns]
    aggregated = df.agg(*[e.alias(f"_{i}") for i, (_, e) in enumerate(entries)])
    result = aggregated.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(entries))])))
    spark = df.sparkSession
    schema_rows = spark.range(1).select(F.inline(F.array(*column_rules(df, rules.columns))))
    result = result.unionByName(schema_rows)
    absent = [("not_null", c) for c in rules.not_null] + [("mostly_not_null", c) for c in rules.mostly_not_null]
    absent += [("in_set", c) for c in rules.allowed] + [("between", c) for c in rules.ranges]
    absent = [(r, c, False, None, None) for r, c in absent if c not in df.columns]
    if rules.unique_key in df.columns:
        result = result.unionByName(unique_rule(df, rules.unique_key))
    else:
        absent.append(("unique", rules.unique_key, False, None, None))
    return result.unionByName(spark.createDataFrame(absent, _RESULT)) if absent else result


def overall(results: DataFrame) -> DataFrame:
    """One row: rules, rules met, and whether all are met."""
    return results.agg(
        F.count(F.lit(1)).alias("evaluated_rules"),
        F.count_if("success").alias("successful_rules"),
        F.every("success").alias("success"),
    )


def target_consistency(df: DataFrame) -> DataFrame:
    """Rows, and rows where the label and the sign of the delay differ.

    A null delay counts as not late.
    """
    expected = F.when(F.col("delay_days") > 0, 1).otherwise(0)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~expected.eqNullSafe(F.col("is_late").cast("int"))).alias("mismatches"),
    )


def assert_target_consistency(df: DataFrame) -> None:
    absent = sorted({"delay_days", "is_late"} - set(df.columns))
    if absent:
        raise DataQualityError("label check is missing columns: " + ", ".join(absent))
    r = target_consistency(df).first()
    if r["mismatches"]:
        raise DataQualityError(f"{r['mismatches']} rows disagree between delay_days and is_late")


def run_quality(df: DataFrame, rules: Rules = Rules(), raise_on_failure: bool = True) -> DataFrame:
    """Label check and rules on a non-empty table; raises on failure unless told not to."""
    if df.isEmpty():
        raise DataQualityError("labelled data must not be empty")
    assert_target_consistency(df)
    results = validate(df, rules)
    if raise_on_failure:
        failed = results.filter(~F.col("success")).collect()
        if failed:
            raise DataQualityError("; ".join(f"{r['rule']}({r['column_name']}): {r['unexpected_count']}" for r in failed))
    return results
