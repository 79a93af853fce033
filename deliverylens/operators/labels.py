"""Late-delivery label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deliverylens.errors import DataQualityError
from deliverylens.functions.dates import calendar_days_between, parse_timestamp


def labelable(orders: DataFrame) -> DataFrame:
    """Delivered orders with both the actual and the promised date."""
    return orders.filter(
        (F.col("order_status") == "delivered")
        & parse_timestamp("order_delivered_customer_date").isNotNull()
        & parse_timestamp("order_estimated_delivery_date").isNotNull()
    )


def add_label(orders: DataFrame) -> DataFrame:
    """Add ``delay_days`` (negative when early) and ``is_late`` (1 above zero)."""
    delay = calendar_days_between(
        parse_timestamp("order_delivered_customer_date"),
        parse_timestamp("order_estimated_delivery_date"),
    )
    return orders.withColumn("delay_days", delay).withColumn("is_late", (F.col("delay_days") > 0).cast("tinyint"))


def label_report(labelled: DataFrame) -> DataFrame:
    """One row of counts that must be zero, and the number of classes."""
    late = F.col("is_late") == 1
    return labelled.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(late & (F.col("delay_days") <= 0)).alias("invalid_late"),
        F.count_if((F.col("is_late") == 0) & (F.col("delay_days") > 0)).alias("invalid_on_time"),
        F.count_if(F.col("delay_days").isNull()).alias("missing_delay"),
        F.count_if(F.col("is_late").isNull()).alias("missing_label"),
        F.max(F.when(late, 1).otherwise(0)).alias("has_late"),
        F.max(F.when(F.col("is_late") == 0, 1).otherwise(0)).alias("has_on_time"),
    )


def assert_labels(labelled: DataFrame) -> None:
    """Raise unless label and delay agree and both classes occur."""
    r = label_report(labelled).first()
    bad = r["invalid_late"] + r["invalid_on_time"] + r["missing_delay"] + r["missing_label"]
    if bad or not r["has_late"] or not r["has_on_time"]:
        raise DataQualityError(f"label check failed: {r.asDict()}")


def label_coverage(orders: DataFrame) -> DataFrame:
    """Orders, labelable orders and the rest."""
    usable = (
        (F.col("order_status") == "delivered")
        & parse_timestamp("order_delivered_customer_date").isNotNull()
        & parse_timestamp("order_estimated_delivery_date").isNotNull()
    )
    return orders.agg(
        F.count(F.lit(1)).alias("original_orders"),
        F.count_if(usable).alias("labelable_orders"),
        F.count_if(~F.coalesce(usable, F.lit(False))).alias("removed_orders"),
    )


def labelled_examples(labelled: DataFrame, label: int, rows: int) -> DataFrame:
    """First example rows of one class by order id."""
    return (
        labelled.filter(F.col("is_late") == label)
        .select(
            "order_id",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
            "delay_days",
            "is_late",
        )
        .orderBy("order_id")
        .limit(rows)
    )
