"""Engineered model features and the feature lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deliverylens.functions import dates, geo
from deliverylens.operators.checks import missing_columns

# Model inputs in model order.
NUMERIC_FEATURES = (
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
    "purchase_hour",
    "estimated_delivery_days",
    "approval_hours",
    "customer_seller_distance_km",
    "same_customer_seller_state",
    "is_fixed_national_holiday",
)
CATEGORICAL_FEATURES = (
    "customer_state",
    "primary_product_category",
    "primary_seller_state",
    "primary_payment_type",
    "purchase_month",
    "purchase_weekday",
)
ENGINEERED_FEATURES = (
    "purchase_month",
    "purchase_weekday",
    "purchase_hour",
    "estimated_delivery_days",
    "approval_hours",
    "is_fixed_national_holiday",
    "same_customer_seller_state",
    "customer_seller_distance_km",
)
ENGINEERING_INPUTS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_estimated_delivery_date",
    "customer_state",
    "primary_seller_state",
    "customer_lat",
    "customer_lng",
    "avg_seller_lat",
    "avg_seller_lng",
)
TIMESTAMP_INPUTS = ("order_purchase_timestamp", "order_approved_at", "order_estimated_delivery_date")


def engineer_features(df: DataFrame) -> DataFrame:
    """Add the eight engineered columns; row-wise native expressions only."""
    absent = missing_columns(df, ENGINEERING_INPUTS)
    if absent:
        raise ValueError(f"cannot engineer features without {sorted(absent)}")
    df = df.withColumns({c: dates.parse_timestamp(c) for c in TIMESTAMP_INPUTS})
    bought = F.col("order_purchase_timestamp")
    return df.withColumns(
        {
            "purchase_month": dates.month_of_year(bought),
            "purchase_weekday": dates.weekday_name(bought),
            "purchase_hour": F.hour(bought),
            "estimated_delivery_days": dates.elapsed_days(F.col("order_estimated_delivery_date"), bought),
            "approval_hours": dates.elapsed_hours(F.col("order_approved_at"), bought),
            "is_fixed_national_holiday": dates.fixed_holiday_flag(bought),
            "same_customer_seller_state": (F.col("customer_state") == F.col("primary_seller_state")).cast("double"),
            "customer_seller_distance_km": geo.haversine_km(
                F.col("customer_lat"), F.col("customer_lng"), F.col("avg_seller_lat"), F.col("avg_seller_lng")
            ),
        }
    )


def profile_features(df: DataFrame) -> DataFrame:
    """Time, distance and state columns of the profile tables.

    Differs from the model features: calendar month as 'yyyy-MM', holiday 0
    without a date, and the actual delivery days, which models must not see.
    """
    bought = F.col("order_purchase_timestamp")
    return df.withColumns(
        {
            "purchase_year_month": dates.year_month(bought),
            "purchase_weekday": dates.weekday_name(bought),
            "purchase_hour": F.hour(bought),
            "estimated_delivery_days": dates.elapsed_days(F.col("order_estimated_delivery_date"), bought),
            "actual_delivery_days": dates.elapsed_days(F.col("order_delivered_customer_date"), bought),
            "approval_hours": dates.elapsed_hours(F.col("order_approved_at"), bought),
            "is_fixed_national_holiday": dates.fixed_holiday_flag_or_zero(bought),
            "same_customer_seller_state": (F.col("customer_state") == F.col("primary_seller_state")).cast("tinyint"),
            "customer_seller_distance_km": geo.haversine_km(
                F.col("customer_lat"), F.col("customer_lng"), F.col("avg_seller_lat"), F.col("avg_seller_lng")
            ),
        }
    )


def select_model_features(
    df: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The model columns in configured order, after ``keep`` columns."""
    absent = missing_columns(df, [*numeric, *categorical])
    if absent:
        raise ValueError("model feature columns are missing: " + ", ".join(sorted(absent)))
    return df.select(*keep, *numeric, *categorical)


def prediction_input_columns(
    columns: Sequence[str],
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
) -> list[str]:
    """Source columns a prediction needs: direct features, then engineering inputs by name."""
    direct = [c for c in (*numeric, *categorical) if c not in ENGINEERED_FEATURES]
    needed = direct + [c for c in sorted(ENGINEERING_INPUTS) if c not in direct]
    absent = [c for c in needed if c not in columns]
    if absent:
        raise ValueError("prediction input columns are missing: " + ", ".join(absent))
    return ["order_id", *needed] if "order_id" in columns else needed
