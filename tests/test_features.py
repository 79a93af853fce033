"""Engineered features on single orders worked out by hand."""

import datetime as dt

import pytest

from deliverylens.operators.features import (
    ENGINEERED_FEATURES,
    NUMERIC_FEATURES,
    engineer_features,
    prediction_input_columns,
    select_model_features,
)
from deliverylens.sources.orders_file import ORDER_FIELDS

ORDER = {
    "order_id": "one",
    "order_purchase_timestamp": "2017-09-07 10:30:00",
    "order_approved_at": "2017-09-07 12:30:00",
    "order_estimated_delivery_date": "2017-09-17 10:30:00",
    "customer_state": "SP",
    "primary_seller_state": "SP",
    "customer_lat": 0.0,
    "customer_lng": 0.0,
    "avg_seller_lat": 0.0,
    "avg_seller_lng": 1.0,
}
SCHEMA = ", ".join(f"{k} {'DOUBLE' if isinstance(v, float) else 'STRING'}" for k, v in ORDER.items())


def one(spark, **changes):
    return spark.createDataFrame([tuple({**ORDER, **changes}.values())], SCHEMA)


def test_hand_computed_row(spark):
    row = engineer_features(one(spark)).first()
    assert row["purchase_month"] == "9"
    assert row["purchase_weekday"] == "Thursday"
    assert row["purchase_hour"] == 10
    assert row["estimated_delivery_days"] == 10.0
    assert row["approval_hours"] == 2.0
    assert row["is_fixed_national_holiday"] == 1
    assert row["same_customer_seller_state"] == 1
    assert row["customer_seller_distance_km"] == pytest.approx(111.1949, rel=1e-4)
    assert row["order_purchase_timestamp"] == dt.datetime(2017, 9, 7, 10, 30)


def test_session_zone_does_not_matter(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # The night in which clocks were set forward in 2017.
        row = engineer_features(
            one(spark, order_purchase_timestamp="2017-10-14 23:00:00", order_approved_at="2017-10-15 01:00:00")
        ).first()
        assert row["approval_hours"] == 2.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_missing_values_stay_missing(spark):
    assert engineer_features(one(spark, customer_state=None)).first()["same_customer_seller_state"] is None
    assert engineer_features(one(spark, customer_lat=None)).first()["customer_seller_distance_km"] is None
    broken = engineer_features(one(spark, order_purchase_timestamp="not a date")).first()
    assert broken["purchase_month"] is None and broken["is_fixed_national_holiday"] is None


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="avg_seller_lng"):
        engineer_features(one(spark).drop("avg_seller_lng"))


def test_feature_order_and_missing_feature(spark):
    df = spark.createDataFrame([("x", 1.0, 2.0)], "category STRING, number_b DOUBLE, number_a DOUBLE")
    assert select_model_features(df, ["number_a", "number_b"], ["category"]).columns == ["number_a", "number_b", "category"]
    with pytest.raises(ValueError, match="absent"):
        select_model_features(df, ["absent"], ["category"])


def test_prediction_inputs():
    columns = prediction_input_columns(ORDER_FIELDS)
    assert len(columns) == 31 and columns[0] == "order_id" and set(columns) == set(ORDER_FIELDS)
    assert not set(columns) & set(ENGINEERED_FEATURES)
    with pytest.raises(ValueError, match="payment_total"):
        prediction_input_columns([c for c in ORDER_FIELDS if c != "payment_total"])
    assert len(NUMERIC_FEATURES) == 25
