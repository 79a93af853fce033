"""Summary tables of the training data.

Numeric summaries come from one wide aggregate over all columns, category
summaries from one value count over all columns; neither loops over columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deliverylens.functions import stats
from deliverylens.functions.dates import WEEKDAYS
from deliverylens.functions.text import normalized, to_number
from deliverylens.operators.quantiles import column_quantiles

# Columns of the numeric, categorical and chart summaries.
NUMERIC_COLUMNS = (
    "item_count",
    "unique_products",
    "unique_sellers",
    "total_item_price",
    "avg_item_price",
    "total_freight_value",
    "avg_freight_value",
    "unique_product_categories",
    "avg_product_weight_g",
    "max_product_weight_g",
    "avg_product_length_cm",
    "avg_product_height_cm",
    "avg_product_width_cm",
    "avg_product_photos_qty",
    "unique_seller_states",
    "payment_records",
    "payment_types_count",
    "payment_total",
    "payment_installments_max",
)
CATEGORICAL_COLUMNS = (
    "customer_city",
    "customer_state",
    "primary_product_category",
    "primary_seller_state",
    "primary_payment_type",
)
CHART_COLUMNS = (
    "total_item_price",
    "total_freight_value",
    "avg_item_price",
    "item_count",
    "payment_installments_max",
    "avg_product_weight_g",
)
CORRELATION_COLUMNS = NUMERIC_COLUMNS + (
    "estimated_delivery_days",
    "approval_hours",
    "customer_seller_distance_km",
    "same_customer_seller_state",
    "is_fixed_national_holiday",
    "is_late",
)
RARE_LIMIT = 50
MIN_MONTH_ORDERS = 100
MIN_ZIP_ORDERS = 50
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def aggregate_each(
    df: DataFrame,
    columns: Sequence[str],
    measures: Callable[[str], Mapping[str, Column]],
    by: Sequence[str] = (),
    name: str = "feature",
) -> DataFrame:
    """One row per column with the given measures, from a single aggregate."""
    exprs, rows = [], []
    for c in columns:
        found = measures(c)
        exprs += [expr.alias(f"{c}__{m}") for m, expr in found.items()]
        rows.append(F.struct(F.lit(c).alias(name), *[F.col(f"{c}__{m}").alias(m) for m in found]))
    return df.groupBy(*by).agg(*exprs).select(*by, F.inline(F.array(*rows)))


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), as_type: str = "double") -> DataFrame:
    """One row per row and column: ``feature``, ``value``."""
    typed = df.select(*keep, *[F.col(c).cast(as_type).alias(c) for c in columns])
    return typed.unpivot(list(keep), list(columns), "feature", "value")


def value_counts(df: DataFrame, columns: Sequence[str], name: str = "column_name") -> DataFrame:
    """Rows per column and value as text, null included; combined before the shuffle."""
    return (
        long_values(df, columns, as_type="string")
        .withColumnRenamed("feature", name)
        .groupBy(name, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_distribution(df: DataFrame, label: str = "is_late") -> DataFrame:
    whole = Window.partitionBy(F.lit(0))
    return (
        df.groupBy(label)
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("percentage", F.col("count") / F.sum("count").over(whole) * 100)
    )


def class_balance(df: DataFrame, label: str = "is_late") -> DataFrame:
    """Class counts in one row, the ratio of on-time to late, and whether it is 2 or more."""
    late = F.count_if(F.col(label) == 1)
    on_time = F.count_if(F.col(label) == 0)
    ratio = F.try_divide(on_time, late)
    return df.agg(
        on_time.alias("on_time_orders"),
        late.alias("late_orders"),
        F.try_divide(late * 100, F.count(F.lit(1))).alias("late_percentage"),
        ratio.alias("imbalance_ratio"),
        (ratio >= 2).alias("imbalanced"),
    )


def _rates() -> tuple[Column, ...]:
    return (
        F.count("order_id").alias("orders"),
        F.sum("is_late").alias("late_orders"),
        F.avg("is_late").alias("late_rate"),
        (F.avg("is_late") * 100).alias("late_rate_pct"),
    )


def late_rate_by(df: DataFrame, dimension: str, drop_null: bool = False) -> DataFrame:
    """Orders, late orders and late rate per value of one dimension."""
    if drop_null:
        df = df.filter(F.col(dimension).isNotNull())
    return df.groupBy(dimension).agg(*_rates())


def late_rate_tables(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """The late-rate tables of several dimensions from one scan.

    Long form: dimension, value as text, measures. Null is a value.
    """
    return (
        long_values(df, dimensions, ("order_id", "is_late"), "string")
        .groupBy(F.col("feature").alias("dimension"), "value")
        .agg(*_rates())
    )


def reliable(summary: DataFrame, minimum: int) -> DataFrame:
    """Groups with enough orders."""
    return summary.filter(F.col("orders") >= minimum)


def top_rows(df: DataFrame, order_by: Sequence[Column], rows: int) -> DataFrame:
    return df.orderBy(*order_by).limit(rows)


def highest_late_month(monthly: DataFrame) -> DataFrame:
    """The month with the highest late rate, the earliest of equals."""
    return top_rows(monthly, [F.desc("late_rate_pct"), F.asc("purchase_year_month")], 1)


def weekday_table(df: DataFrame) -> DataFrame:
    """Late rates for Monday to Sunday; a day without orders has null measures."""
    days = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(d) for d in WEEKDAYS])).alias("purchase_weekday"))
    rates = late_rate_by(df, "purchase_weekday", drop_null=True)
    return days.join(rates, "purchase_weekday", "left")


def crosstab_pct(df: DataFrame, dimension: str, label: str = "is_late") -> DataFrame:
    """Percent of each class per value; rows without a value are left out."""
    present = df.filter(F.col(dimension).isNotNull() & F.col(label).isNotNull())
    return present.groupBy(dimension).agg(
        (F.count_if(F.col(label) == 0) / F.count(F.lit(1)) * 100).alias("on_time_pct"),
        (F.count_if(F.col(label) == 1) / F.count(F.lit(1)) * 100).alias("late_pct"),
    )


def quartiles(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Exact quartiles per group and column, which several summaries of the same rows may share."""
    return column_quantiles(df, columns, QUARTILES, by)


def _shared(found: DataFrame | None, df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    if found is None:
        return quartiles(df, columns, by)
    return found.where(F.col("feature").isin(list(columns)))


def describe(df: DataFrame, columns: Sequence[str], found: DataFrame | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum; ``found`` holds quartiles made before."""

    def measures(c: str) -> dict[str, Column]:
        x = F.col(c).cast("double")
        return {
            "count": F.count(x),
            "mean": F.avg(x),
            "std": F.try_divide(F.stddev_samp(x), F.lit(1.0)),
            "min": F.min(x),
            "max": F.max(x),
        }

    moments = aggregate_each(df, columns, measures)
    return moments.join(_shared(found, df, columns), "feature", "left").select(
        "feature", "count", "mean", "std", "min", "q1", "median", "q3", "max"
    )


def class_means_medians(df: DataFrame, columns: Sequence[str], label: str = "is_late", found: DataFrame | None = None) -> DataFrame:
    """Count, mean and exact median per class and column."""
    means = aggregate_each(
        df, columns, lambda c: {"count": F.count(c), "mean": F.avg(F.col(c).cast("double"))}, by=[label]
    )
    medians = column_quantiles(df, columns, {"median": 0.5}, [label]) if found is None else found
    return means.join(medians, ["feature", label], "left").select("feature", label, "count", "mean", "median")


def range_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, maximum and the number of negative and zero values."""
    return aggregate_each(
        df,
        columns,
        lambda c: {
            "minimum": F.min(F.col(c).cast("double")),
            "maximum": F.max(F.col(c).cast("double")),
            "negative_count": F.count_if(F.col(c) < 0),
            "zero_count": F.count_if(F.col(c) == 0),
        },
    )


def skew_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    skews = aggregate_each(df, columns, lambda c: {"skewness": stats.adjusted_skewness(F.col(c).cast("double"))})
    return skews.select(
        "feature",
        "skewness",
        F.abs("skewness").alias("absolute_skew"),
        F.coalesce(F.abs("skewness") > 1, F.lit(False)).alias("highly_skewed"),
    )


def _bounds(df: DataFrame, columns: Sequence[str], by: Sequence[str], found: DataFrame | None) -> DataFrame:
    """Quartiles and 1.5-IQR bounds, one row per group and column."""
    iqr = F.col("q3") - F.col("q1")
    return _shared(found, df, columns, by).select(
        "feature",
        *by,
        *QUARTILES,
        iqr.alias("iqr"),
        (F.col("q1") - 1.5 * iqr).alias("lower_bound"),
        (F.col("q3") + 1.5 * iqr).alias("upper_bound"),
    )


def outlier_summary(df: DataFrame, columns: Sequence[str], found: DataFrame | None = None) -> DataFrame:
    """Values outside the 1.5-IQR bounds per column.

    The second pass meets the bounds (one row per column) inside each task.
    """
    bounds = _bounds(df, columns, [], found)
    outside = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    keys = ("feature", "q1", "q3", "iqr", "lower_bound", "upper_bound")
    return (
        long_values(df, columns)
        .filter(F.col("value").isNotNull())
        .join(F.broadcast(bounds), "feature")
        .groupBy(*keys)
        .agg(F.count_if(outside).alias("outlier_count"), F.count(F.lit(1)).alias("_n"))
        .select(*keys, "outlier_count", (F.col("outlier_count") / F.col("_n") * 100).alias("outlier_pct"))
    )


def box_stats(df: DataFrame, columns: Sequence[str], label: str = "is_late", found: DataFrame | None = None) -> DataFrame:
    """Quartiles and whiskers per class; whiskers end at the last value inside the bounds.

    The broadcast bounds have one row per class and column.
    """
    bounds = _bounds(df, columns, [label], found)
    inside = (F.col("value") >= F.col("lower_bound")) & (F.col("value") <= F.col("upper_bound"))
    whiskers = (
        long_values(df, columns, [label])
        .filter(F.col("value").isNotNull())
        .join(F.broadcast(bounds), ["feature", label])
        .groupBy("feature", label, *QUARTILES)
        .agg(F.min(F.when(inside, F.col("value"))).alias("_lo"), F.max(F.when(inside, F.col("value"))).alias("_hi"))
    )
    # A whisker never ends inside the box.
    return whiskers.select(
        "feature",
        label,
        F.least(F.coalesce("_lo", "q1"), F.col("q1")).alias("whisker_low"),
        *QUARTILES,
        F.greatest(F.coalesce("_hi", "q3"), F.col("q3")).alias("whisker_high"),
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 40) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed."""
    values = long_values(df, columns).filter(F.col("value").isNotNull())
    limits = aggregate_each(
        df, columns, lambda c: {"low": F.min(F.col(c).cast("double")), "high": F.max(F.col(c).cast("double"))}
    )
    # A constant column gets a range of one around its value.
    flat = F.col("high") == F.col("low")
    limits = limits.select(
        "feature",
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    )
    width = (F.col("high") - F.col("low")) / bins
    index = F.least(F.floor((F.col("value") - F.col("low")) / width), F.lit(bins - 1))
    counted = (
        values.join(F.broadcast(limits), "feature")
        .groupBy("feature", index.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    every_bin = limits.select("feature", "low", "high", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every_bin.join(counted, ["feature", "bin"], "left").select(
        "feature",
        "bin",
        (F.col("low") + width * F.col("bin")).alias("bin_start"),
        (F.col("low") + width * (F.col("bin") + 1)).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("count"),
    )


def target_correlation(df: DataFrame, columns: Sequence[str], label: str = "is_late") -> DataFrame:
    y = F.col(label).cast("double")
    rows = aggregate_each(
        df, columns, lambda c: {"correlation_with_is_late": stats.pearson(F.col(c).cast("double"), y)}
    )
    return rows.withColumn("absolute_correlation", F.abs("correlation_with_is_late"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair over the rows where both are present.

    Columns are centred on their mean; each task then adds up the products of
    values and presence marks of its batches with one matrix product, and the
    partial sums, one small table per task, are added by pair.
    """
    columns = list(dict.fromkeys(columns))
    numbers = df.select(*[to_number(F.col(c).cast("string") if dict(df.dtypes)[c] == "boolean" else F.col(c)).alias(c) for c in columns])
    means = numbers.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in columns]).first()
    centred = numbers.select(*[(F.col(c) - F.lit(means[c])).alias(c) for c in columns])
    k = len(columns)
    left, right = np.meshgrid(np.arange(k), np.arange(k), indexing="ij")

    def partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, sx, sxx, sxy = (np.zeros((k, k)) for _ in range(4))
        for batch in batches:
            x = batch.to_numpy(dtype=float, na_value=np.nan)
            present = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            n += present.T @ present
            sx += x.T @ present
            sxx += (x * x).T @ present
            sxy += x.T @ x
        yield pd.DataFrame(
            {"i": left.ravel(), "j": right.ravel(), "n": n.ravel(), "sx": sx.ravel(), "sy": sx.T.ravel(),
             "sxx": sxx.ravel(), "syy": sxx.T.ravel(), "sxy": sxy.ravel()}
        )

    schema = "i INT, j INT, n DOUBLE, sx DOUBLE, sy DOUBLE, sxx DOUBLE, syy DOUBLE, sxy DOUBLE"
    sums = centred.mapInPandas(partial_sums, schema).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]
    )
    cov = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    var_x = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    var_y = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    # Rounding noise of a constant column must not look like a spread.
    noise = 1e-12
    spread = (var_x > noise * F.col("n") * F.col("sxx")) & (var_y > noise * F.col("n") * F.col("syy"))
    r = F.when(spread & (F.col("n") > 1), cov / F.sqrt(var_x * var_y))
    names = F.array(*[F.lit(c) for c in columns])
    return sums.select(
        F.element_at(names, F.col("i") + 1).alias("feature"),
        F.element_at(names, F.col("j") + 1).alias("other"),
        F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)).alias("correlation"),
    )


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Type, missing and distinct values of every column, null counted as a value."""
    columns = list(columns or df.columns)
    types = dict(df.dtypes)
    dtype = F.element_at(F.create_map(*[F.lit(v) for c in columns for v in (c, types[c])]), F.col("column_name"))
    return (
        value_counts(df, columns)
        .groupBy("column_name")
        .agg(
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing_count"),
            F.count(F.lit(1)).alias("unique_values"),
            F.sum("n").alias("_rows"),
        )
        .select(
            "column_name",
            dtype.alias("dtype"),
            "missing_count",
            (F.col("missing_count") / F.col("_rows") * 100).alias("missing_pct"),
            "unique_values",
            (F.col("unique_values") / F.col("_rows") * 100).alias("unique_pct"),
        )
    )


def approximate_profile(df: DataFrame, columns: Sequence[str] | None = None, error: float = 0.02) -> DataFrame:
    """As :func:`column_profile` with sketched distinct counts: one small sketch per
    column and task is shuffled instead of the values."""
    columns = list(columns or df.columns)
    missing = F.count_if(F.col("value").isNull())
    return (
        long_values(df, columns, as_type="string")
        .groupBy(F.col("feature").alias("column_name"))
        .agg(
            missing.alias("missing_count"),
            (missing / F.count(F.lit(1)) * 100).alias("missing_pct"),
            (F.approx_count_distinct("value", error) + F.when(missing > 0, 1).otherwise(0)).alias("unique_values"),
        )
    )


def missing_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing values; one pass of null counts."""
    columns = list(columns or df.columns)
    n = F.count(F.lit(1))

    def measures(c: str) -> dict[str, Column]:
        missing = F.count_if(F.col(c).isNull())
        return {"missing_count": missing, "missing_pct": missing / n * 100}

    return aggregate_each(df, columns, measures, name="column_name").filter(F.col("missing_count") > 0)


def missing_impact(df: DataFrame, columns: Sequence[str] | None = None, label: str = "is_late") -> DataFrame:
    """Late rate where a column is missing against where it is present."""
    columns = list(columns or df.columns)
    y = F.col(label).cast("double")
    rows = aggregate_each(
        df,
        columns,
        lambda c: {
            "missing_rows": F.count_if(F.col(c).isNull()),
            "present_rows": F.count(c),
            "missing_late_rate": F.avg(F.when(F.col(c).isNull(), y)),
            "present_late_rate": F.avg(F.when(F.col(c).isNotNull(), y)),
        },
        name="column_name",
    )
    return rows.filter(F.col("missing_rows") > 0).withColumn(
        "late_rate_difference", F.col("missing_late_rate") - F.col("present_late_rate")
    )


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with a single value, null counted as one.

    Minimum and maximum tell whether values differ, so nothing is shuffled.
    """
    columns = list(columns or df.columns)

    def measures(c: str) -> dict[str, Column]:
        filled = F.count(c)
        one_value = (F.min(c) == F.max(c)) & (filled == F.count(F.lit(1)))
        return {"constant": (filled == 0) | F.coalesce(one_value, F.lit(False))}

    return aggregate_each(df, columns, measures, name="column_name").filter("constant").select("column_name")


def categorical_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct and missing values and the most frequent value, the smallest of equals."""
    counts = value_counts(df, columns, "feature")
    # The top count is found first and the smallest value with that count second.
    totals = counts.groupBy("feature").agg(
        F.count(F.lit(1)).alias("unique_values"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing_count"),
        F.sum("n").alias("_rows"),
        F.max("n").alias("top_count"),
    )
    top = (
        counts.join(F.broadcast(totals.select("feature", "top_count")), "feature")
        .filter(F.col("n") == F.col("top_count"))
        .groupBy("feature")
        .agg(F.min("value").alias("top_value"))
    )
    return totals.join(top, "feature").select(
        "feature",
        "unique_values",
        "missing_count",
        (F.col("missing_count") / F.col("_rows") * 100).alias("missing_pct"),
        "top_value",
        "top_count",
    )


def rare_category_summary(df: DataFrame, columns: Sequence[str], limit: int = RARE_LIMIT) -> DataFrame:
    rare = F.col("n") < limit
    return (
        value_counts(df, columns, "feature")
        .groupBy("feature")
        .agg(
            F.count(F.lit(1)).alias("total_categories"),
            F.count_if(rare).alias("rare_categories"),
            F.sum(F.when(rare, F.col("n")).otherwise(0)).alias("rare_orders"),
            F.sum("n").alias("_rows"),
        )
        .select(
            "feature",
            "total_categories",
            "rare_categories",
            "rare_orders",
            (F.col("rare_orders") / F.col("_rows") * 100).alias("rare_orders_pct"),
        )
    )


def messy_category_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values before and after trimming and lower-casing.

    Works on the counted values, so the second distinct count sees each raw
    value once.
    """
    raw = value_counts(df, columns, "feature").filter(F.col("value").isNotNull())
    per_form = raw.groupBy("feature", normalized(F.col("value")).alias("_form")).agg(F.count(F.lit(1)).alias("_raw"))
    return per_form.groupBy("feature").agg(
        F.sum("_raw").alias("raw_unique"),
        F.count(F.lit(1)).alias("normalized_unique"),
        F.sum(F.col("_raw") - 1).alias("possible_format_duplicates"),
    )
