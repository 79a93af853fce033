"""DuckDB definitions of the emulated tables and of the stage tables.

``with_tables`` puts the definitions a query needs in front of it.
"""

from __future__ import annotations

import re

from deliverylens.operators.features import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from deliverylens.sources.fixtures import FIXTURE_SQL

_RAW = ("orders", "customer", "nation", "lineitem", "part", "supplier", "events")

TABLES = {f"m_{name}": sql.format(**{t: t for t in _RAW}) for name, sql in FIXTURE_SQL.items()}

TABLES["t_zip"] = """
SELECT geolocation_zip_code_prefix AS zip, avg(geolocation_lat) AS lat, avg(geolocation_lng) AS lng
FROM m_geolocation GROUP BY geolocation_zip_code_prefix
"""
TABLES["t_customers"] = """
SELECT c.*, z.lat AS customer_lat, z.lng AS customer_lng
FROM m_customers c LEFT JOIN t_zip z ON c.customer_zip_code_prefix = z.zip
"""
TABLES["t_details"] = """
SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date, i.price, i.freight_value,
 p.product_category_name, t.product_category_name_english, p.product_photos_qty, p.product_weight_g,
 p.product_length_cm, p.product_height_cm, p.product_width_cm, s.seller_state, z.lat AS seller_lat, z.lng AS seller_lng
FROM m_order_items i LEFT JOIN m_products p ON i.product_id = p.product_id
LEFT JOIN m_product_category_translation t ON p.product_category_name = t.product_category_name
LEFT JOIN m_sellers s ON i.seller_id = s.seller_id LEFT JOIN t_zip z ON s.seller_zip_code_prefix = z.zip
"""
TABLES["t_items"] = """
SELECT order_id, count(*) AS item_count, count(DISTINCT product_id) AS unique_products,
 count(DISTINCT seller_id) AS unique_sellers, sum(price) AS total_item_price, avg(price) AS avg_item_price,
 sum(freight_value) AS total_freight_value, avg(freight_value) AS avg_freight_value,
 max(shipping_limit_date) AS max_shipping_limit_date,
 count(DISTINCT product_category_name) AS unique_product_categories,
 mode() WITHIN GROUP (ORDER BY product_category_name_english) AS primary_product_category,
 avg(product_weight_g) AS avg_product_weight_g, max(product_weight_g) AS max_product_weight_g,
 avg(product_length_cm) AS avg_product_length_cm, avg(product_height_cm) AS avg_product_height_cm,
 avg(product_width_cm) AS avg_product_width_cm, avg(product_photos_qty) AS avg_product_photos_qty,
 count(DISTINCT seller_state) AS unique_seller_states,
 mode() WITHIN GROUP (ORDER BY seller_state) AS primary_seller_state,
 avg(seller_lat) AS avg_seller_lat, avg(seller_lng) AS avg_seller_lng
FROM t_details GROUP BY order_id
"""
TABLES["t_payments"] = """
SELECT order_id, count(*) AS payment_records, count(DISTINCT payment_type) AS payment_types_count,
 sum(payment_value) AS payment_total, max(payment_installments) AS payment_installments_max,
 mode() WITHIN GROUP (ORDER BY payment_type) AS primary_payment_type FROM m_order_payments GROUP BY order_id
"""
TABLES["t_reviews"] = """
SELECT order_id, count(*) AS review_count, avg(review_score) AS review_score_mean, min(review_score) AS review_score_min,
 max(review_score) AS review_score_max, max(CASE WHEN review_comment_message IS NOT NULL THEN 1 ELSE 0 END) AS has_review_comment
FROM m_order_reviews GROUP BY order_id
"""
TABLES["t_mart"] = """
SELECT o.*, c.* EXCLUDE (customer_id), i.* EXCLUDE (order_id), p.* EXCLUDE (order_id), r.* EXCLUDE (order_id)
FROM m_orders o LEFT JOIN t_customers c ON o.customer_id = c.customer_id LEFT JOIN t_items i ON o.order_id = i.order_id
LEFT JOIN t_payments p ON o.order_id = p.order_id LEFT JOIN t_reviews r ON o.order_id = r.order_id
"""
_DELAY = "date_diff('day', CAST(order_estimated_delivery_date AS DATE), CAST(order_delivered_customer_date AS DATE))"
_LABELABLE = (
    "order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL"
)
TABLES["t_labelled"] = f"""
SELECT *, CAST({_DELAY} AS INTEGER) AS delay_days, CAST({_DELAY} > 0 AS TINYINT) AS is_late FROM t_mart WHERE {_LABELABLE}
"""
TABLES["t_split"] = """
SELECT * EXCLUDE (rn, total), CASE WHEN rn <= CAST(floor(total * 0.7::DOUBLE) AS BIGINT) THEN 'train'
 WHEN rn <= CAST(floor(total * 0.85::DOUBLE) AS BIGINT) THEN 'validation' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY order_purchase_timestamp, order_id) AS rn, count(*) OVER () AS total FROM t_labelled)
"""
_TS = "order_purchase_timestamp"


def seconds(later: str, earlier: str) -> str:
    return f"(date_diff('microsecond', {earlier}, {later}) / 1000000.0::DOUBLE)"


HOLIDAY = (
    "(strftime({ts}, '%m-%d') IN ('01-01', '04-21', '05-01', '09-07', '10-12', '11-02', '11-15', '12-25'))"
)
DISTANCE = (
    "2 * 6371.0::DOUBLE * asin(sqrt(pow(sin((radians(avg_seller_lat) - radians(customer_lat)) / 2), 2)"
    " + cos(radians(customer_lat)) * cos(radians(avg_seller_lat))"
    " * pow(sin((radians(avg_seller_lng) - radians(customer_lng)) / 2), 2)))"
)
ENGINEERED = f"""
 CAST(month({_TS}) AS VARCHAR) AS purchase_month, dayname({_TS}) AS purchase_weekday,
 CAST(hour({_TS}) AS INTEGER) AS purchase_hour,
 {seconds('order_estimated_delivery_date', _TS)} / 86400.0::DOUBLE AS estimated_delivery_days,
 {seconds('order_approved_at', _TS)} / 3600.0::DOUBLE AS approval_hours,
 CAST({HOLIDAY.format(ts=_TS)} AS DOUBLE) AS is_fixed_national_holiday,
 CAST(customer_state = primary_seller_state AS DOUBLE) AS same_customer_seller_state,
 {DISTANCE} AS customer_seller_distance_km
"""
TABLES["t_engineered"] = f"SELECT *, {ENGINEERED} FROM t_split"
TABLES["t_train"] = "SELECT * EXCLUDE (split) FROM t_split WHERE split = 'train'"
TABLES["t_profile"] = f"""
SELECT *, strftime({_TS}, '%Y-%m') AS purchase_year_month, dayname({_TS}) AS purchase_weekday,
 CAST(hour({_TS}) AS INTEGER) AS purchase_hour,
 {seconds('order_estimated_delivery_date', _TS)} / 86400.0::DOUBLE AS estimated_delivery_days,
 {seconds('order_delivered_customer_date', _TS)} / 86400.0::DOUBLE AS actual_delivery_days,
 {seconds('order_approved_at', _TS)} / 3600.0::DOUBLE AS approval_hours,
 CAST(coalesce({HOLIDAY.format(ts=_TS)}, false) AS TINYINT) AS is_fixed_national_holiday,
 CAST(customer_state = primary_seller_state AS TINYINT) AS same_customer_seller_state,
 {DISTANCE} AS customer_seller_distance_km FROM t_train
"""


def long_form(table: str, columns, keep: str = "", cast: str = "DOUBLE") -> str:
    """Rows (keep..., feature, value) of the given columns, nulls included."""
    lead = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{c}' AS feature, CAST({c} AS {cast}) AS value FROM {table}" for c in columns
    )


def numbered(columns, cast: str = "DOUBLE", table: str = "t_engineered") -> str:
    """Long form of the model inputs with their position and split."""
    return " UNION ALL ".join(
        f"SELECT order_id, split, {i} AS place, '{c}' AS feature, CAST({c} AS {cast}) AS value FROM {table}"
        for i, c in enumerate(columns)
    )


# Preprocessing state and its application, in long form.
TABLES["t_numbers"] = numbered(NUMERIC_FEATURES)
TABLES["t_imputer"] = """
SELECT place, feature, quantile_cont(value, 0.5) AS median, count(*) - count(value) AS missing_count
FROM t_numbers WHERE split = 'train' GROUP BY place, feature
"""
TABLES["t_inputs"] = """
SELECT n.order_id, n.split, 0 AS block, n.place, n.feature, coalesce(n.value, i.median) AS x
FROM t_numbers n JOIN t_imputer i ON n.feature = i.feature
UNION ALL SELECT n.order_id, n.split, 1, n.place, 'missingindicator_' || n.feature, CASE WHEN n.value IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
FROM t_numbers n JOIN t_imputer i ON n.feature = i.feature WHERE i.missing_count > 0
"""
TABLES["t_scaler"] = """
SELECT block, place, feature, avg(x) AS mean, var_pop(x) AS variance, count(*) AS n,
 CASE WHEN var_pop(x) <= 1e-20 THEN 1.0::DOUBLE ELSE stddev_pop(x) END AS scale,
 row_number() OVER (ORDER BY block, place) - 1 AS position
FROM t_inputs WHERE split = 'train' GROUP BY block, place, feature
"""
TABLES["t_categories"] = (
    "SELECT order_id, split, place, feature, coalesce(value, '__MISSING__') AS category FROM ("
    + numbered(CATEGORICAL_FEATURES, "VARCHAR")
    + ")"
)
TABLES["t_category_counts"] = """
SELECT place, feature, category, count(*) AS n FROM t_categories WHERE split = 'train' GROUP BY place, feature, category
"""
TABLES["t_slots"] = """
SELECT place, feature, category, (SELECT count(*) FROM t_scaler) + row_number() OVER (ORDER BY place, infrequent, category) - 1 AS position
FROM (SELECT place, feature, category, 0 AS infrequent FROM t_category_counts WHERE n >= 50
 UNION ALL SELECT DISTINCT place, feature, 'infrequent_sklearn', 1 FROM t_category_counts WHERE n < 50)
"""
TABLES["t_encoded"] = """
SELECT c.order_id, c.split, c.feature, coalesce(k.category, i.category) AS category, coalesce(k.position, i.position) AS position
FROM t_categories c
LEFT JOIN t_slots k ON c.feature = k.feature AND c.category = k.category AND k.category <> 'infrequent_sklearn'
LEFT JOIN t_slots i ON c.feature = i.feature AND i.category = 'infrequent_sklearn'
"""
# The fixed linear model: coefficient of output column j is (7 j mod 11 - 5) / 20, intercept -1.5.
TABLES["t_names"] = """
SELECT position, 'numeric__' || feature AS feature FROM t_scaler
UNION ALL SELECT position, 'categorical__' || feature || '_' || category FROM t_slots
"""
TABLES["t_scored"] = """
SELECT order_id, split, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(sum(term) - 1.5::DOUBLE))) AS late_probability FROM (
 SELECT i.order_id, i.split, (7 * s.position % 11 - 5) / 20.0::DOUBLE * (i.x - s.mean) / s.scale AS term
 FROM t_inputs i JOIN t_scaler s ON i.feature = s.feature
 UNION ALL SELECT order_id, split, (7 * position % 11 - 5) / 20.0::DOUBLE FROM t_encoded WHERE position IS NOT NULL
) GROUP BY order_id, split
"""
# A score with many ties over all labelled orders.
TABLES["t_tied"] = """
SELECT order_id, is_late, ((order_id * 37) % 101 + 15 * is_late) / 120.0::DOUBLE AS score FROM t_labelled
"""
TABLES["t_curve"] = """
SELECT score, sum(is_late) AS positives, sum(1 - is_late) AS negatives,
 sum(sum(is_late)) OVER w AS tp, sum(sum(1 - is_late)) OVER w AS fp
FROM t_tied GROUP BY score WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
"""
TABLES["t_points"] = """
SELECT score AS threshold, tp / (tp + fp)::DOUBLE AS "precision", tp / (SELECT sum(positives) FROM t_curve)::DOUBLE AS recall FROM t_curve
"""
TABLES["t_f1"] = """
SELECT *, 2 * "precision" * recall / ("precision" + recall + 1e-12::DOUBLE) AS f1 FROM t_points
"""

# Log lines: kind is the JSON type of a line, null for text that is no JSON.
for _log in ("request", "prediction"):
    TABLES[f"t_{_log}_lines"] = f"""
SELECT event_id, ts, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS record,
 coalesce(json_valid(value) AND json_type(CASE WHEN json_valid(value) THEN value END) = 'OBJECT', false) AS valid
FROM m_{_log}_log WHERE trim(value) <> ''
"""
TABLES["t_requests"] = """
SELECT event_id, ts, coalesce(TRY_CAST(record->>'$.status_code' AS INTEGER) >= 400, true) AS is_error,
 TRY_CAST(record->>'$.latency_ms' AS DOUBLE) AS latency_ms
FROM t_request_lines WHERE valid AND record->>'$.event' = 'api_request' AND record->>'$.path' IN ('/predict', '/predict/batch')
"""
TABLES["t_predictions"] = """
SELECT event_id, ts, TRY_CAST(record->>'$.output.late_probability' AS DOUBLE) AS late_probability,
 TRY_CAST(record->>'$.output.predicted_is_late' AS BIGINT) AS predicted_is_late
FROM t_prediction_lines WHERE valid AND record->>'$.event' = 'prediction' AND json_type(record, '$.output') = 'OBJECT'
 AND TRY_CAST(record->>'$.output.late_probability' AS DOUBLE) IS NOT NULL
 AND TRY_CAST(record->>'$.output.predicted_is_late' AS BIGINT) IN (0, 1)
"""
TABLES["t_request_metrics"] = """
SELECT count(*) AS request_count, count(*) FILTER (is_error) AS error_count,
 coalesce(count(*) FILTER (is_error) / nullif(count(*), 0)::DOUBLE, 0) AS error_rate, avg(latency_ms) AS average_latency_ms,
 quantile_cont(latency_ms, 0.95) AS p95_latency_ms, max(latency_ms) AS max_latency_ms FROM t_requests
"""
TABLES["t_prediction_metrics"] = """
SELECT count(*) AS prediction_count, count(*) FILTER (predicted_is_late = 1) AS predicted_late_count,
 count(*) FILTER (predicted_is_late = 0) AS predicted_on_time_count,
 count(*) FILTER (predicted_is_late = 1) / nullif(count(*), 0)::DOUBLE AS predicted_late_rate, avg(late_probability) AS mean_late_probability
FROM t_predictions
"""
TABLES["t_drift"] = """
SELECT *, CASE WHEN prediction_count < 30 THEN 'insufficient_data'
 WHEN late_rate_absolute_delta > 0.10 OR mean_probability_absolute_delta > 0.03 THEN 'drift_detected' ELSE 'stable' END AS drift_status
FROM (SELECT *, CASE WHEN prediction_count >= 30 THEN abs(predicted_late_rate - 0.2048234399834151::DOUBLE) END AS late_rate_absolute_delta,
 CASE WHEN prediction_count >= 30 THEN abs(mean_late_probability - 0.05929370779772134::DOUBLE) END AS mean_probability_absolute_delta
 FROM t_prediction_metrics)
"""
TABLES["t_alerts"] = """
SELECT concat_ws(',', CASE WHEN request_count > 0 AND error_rate > 0.05 THEN 'high_error_rate' END,
 CASE WHEN average_latency_ms > 500 THEN 'high_average_latency' END,
 CASE WHEN drift_status = 'drift_detected' THEN 'prediction_drift' END) AS alerts FROM t_request_metrics, t_drift
"""

_NAME = re.compile(r"\b[mt]_[a-z_0-9]+\b")


def with_tables(sql: str) -> str:
    """``sql`` with the definitions it needs, in order of use."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_NAME.findall(text)):
            if name in TABLES and name not in ordered:
                visit(TABLES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    if not ordered:
        return sql.strip()
    definitions = ",\n".join(f"{n} AS ({TABLES[n].strip()})" for n in ordered)
    return f"WITH {definitions}\n{sql.strip()}"
