"""The DuckDB statement for each registered query."""

from __future__ import annotations

from deliverylens.operators.checks import CANDIDATE_KEYS, LEAKAGE_COLUMNS, RELATIONSHIPS
from deliverylens.operators.features import (
    CATEGORICAL_FEATURES,
    ENGINEERED_FEATURES,
    NUMERIC_FEATURES,
    TIMESTAMP_INPUTS,
    prediction_input_columns,
)
from deliverylens.operators.mart import MART_COLUMNS
from deliverylens.operators.metrics import METRIC_NAMES
from deliverylens.operators.profile import (
    CATEGORICAL_COLUMNS,
    CHART_COLUMNS,
    CORRELATION_COLUMNS,
    NUMERIC_COLUMNS,
)
from deliverylens.sources.tables import SOURCE_TABLES
from oracles.tables import HOLIDAY, long_form, seconds, with_tables

ORACLES: dict[str, str] = {}


def add(key: str, sql: str, doubles: str = "", places: int = 6) -> None:
    """Register a statement; the named columns are rounded."""
    names = doubles.split()
    if names:
        replaced = ", ".join(f"round({n}, {places}) + 0.0::DOUBLE AS {n}" for n in names)
        sql = f"SELECT * REPLACE ({replaced}) FROM ({sql.strip()})"
    ORACLES[key] = with_tables(sql)


def union(parts) -> str:
    return " UNION ALL ".join(parts)


TS = "order_purchase_timestamp"
MART_DOUBLES = (
    "customer_lat customer_lng total_item_price avg_item_price total_freight_value avg_freight_value "
    "avg_product_weight_g max_product_weight_g avg_product_length_cm avg_product_height_cm avg_product_width_cm "
    "avg_product_photos_qty avg_seller_lat avg_seller_lng payment_total review_score_mean"
)
ITEM_DOUBLES = (
    "total_item_price avg_item_price total_freight_value avg_freight_value avg_product_weight_g max_product_weight_g "
    "avg_product_length_cm avg_product_height_cm avg_product_width_cm avg_product_photos_qty avg_seller_lat avg_seller_lng"
)
LABELLED = (*MART_COLUMNS, "delay_days", "is_late")
_four = ", ".join(f"round({c}, 4) + 0.0::DOUBLE AS {c}" for c in MART_DOUBLES.split())
ROUNDED_TRAIN = f"(SELECT * REPLACE ({_four}) FROM t_train)"

# Scans and sinks: the copy equals the table.
add("s1_csv_scan_order_items", "SELECT * FROM m_order_items", "price freight_value")
add("s1_csv_scan_products", "SELECT * FROM m_products")
CSV_DOUBLES = {"order_payments": "payment_value", "geolocation": "geolocation_lat geolocation_lng"}
for table in SOURCE_TABLES:
    if table not in ("order_items", "products"):
        add(f"s1_csv_scan_{table}", f"SELECT * FROM m_{table}", CSV_DOUBLES.get(table, ""))
add("s2_table_sink", "SELECT * FROM m_order_payments", "payment_value")
add("s3_table_scan", "SELECT * FROM m_orders")
counts = union(f"SELECT '{t}' AS table_name, count(*) AS \"rows\" FROM m_{t}" for t in SOURCE_TABLES)
add("s4_catalog_check", f"SELECT *, true AS available FROM ({counts}) UNION ALL SELECT 'order_returns', 0, false")
add(
    "s5_checked_stage",
    'SELECT count(*) AS "rows", count(DISTINCT order_id) AS unique_keys, count(*) - count(is_late) AS null_is_late FROM t_labelled',
)


def rates(table: str, column: str, drop_null: bool = False, having: str = "") -> str:
    where = f"WHERE {column} IS NOT NULL" if drop_null else ""
    return (
        f"SELECT {column}, count(order_id) AS orders, CAST(sum(is_late) AS BIGINT) AS late_orders, avg(is_late) AS late_rate, "
        f"avg(is_late) * 100 AS late_rate_pct FROM {table} {where} GROUP BY {column} {having}"
    )


RATES = "late_rate late_rate_pct"
add("s6_csv_report", rates("t_train", "customer_state"), RATES)
INPUTS = prediction_input_columns(["order_id", *LABELLED])
INPUT_DOUBLES = " ".join(c for c in MART_DOUBLES.split() if c in INPUTS)
NUMBERS = [c for c in INPUTS if c in NUMERIC_FEATURES]


def as_number(columns) -> str:
    return ", ".join(
        f"CAST({c} AS VARCHAR) AS {c}" if c == "order_id" else f"CAST({c} AS DOUBLE) AS {c}" if c in NUMBERS else c for c in columns
    )


add("s7_order_file_scan", f"SELECT {as_number(INPUTS)} FROM t_split", INPUT_DOUBLES)
for log in ("request", "prediction"):
    add(
        f"s8_{log}_log_scan",
        f"SELECT count(*) AS lines, count(*) FILTER (valid) AS records, count(*) FILTER (NOT valid) AS invalid FROM t_{log}_lines",
    )
ORACLES["s8_jsonl_file_scan"] = ORACLES["s8_request_log_scan"]
add(
    "s9_prediction_log_sink",
    """
SELECT 'prediction_request' AS event, 1 AS lines, count(*) AS request_size, CAST(NULL AS BIGINT) AS late, CAST(NULL AS DOUBLE) AS mean_late_probability
FROM t_scored
UNION ALL SELECT 'prediction', count(*), NULL, CAST(sum(CASE WHEN late_probability >= 0.25 THEN 1 ELSE 0 END) AS BIGINT), avg(late_probability)
FROM t_scored
""",
    "mean_late_probability",
)
SCORED = "SELECT order_id, late_probability, CAST(late_probability >= 0.25 AS INTEGER) AS predicted_is_late FROM t_scored"
add("s11_prediction_output", f"SELECT *, 'fixed' AS model_version FROM ({SCORED})", "late_probability")
add(
    "s12_bundle_roundtrip",
    "SELECT position, feature, (7 * position % 11 - 5) / 20.0::DOUBLE AS coefficient FROM t_names",
    "coefficient",
)
add(
    "s13_feature_matrix",
    """
SELECT count(*) AS "rows", (SELECT count(*) FROM t_names) AS width, CAST(sum(is_late) AS BIGINT) AS late_orders FROM t_split
""",
)

# Raw table checks.
WIDTHS = {
    "orders": 8, "customers": 5, "order_items": 7, "order_payments": 5, "order_reviews": 4,
    "products": 7, "sellers": 3, "geolocation": 3, "product_category_translation": 2,
}
add(
    "q1_table_overview",
    union(
        f"SELECT '{t}' AS table_name, count(*) AS \"rows\", CAST({WIDTHS[t]} AS BIGINT) AS columns, "
        f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM m_{t})) AS full_row_duplicates FROM m_{t}"
        for t in SOURCE_TABLES
    ),
)
ITEM_TYPES = (
    ("order_id", "bigint"), ("order_item_id", "int"), ("product_id", "bigint"), ("seller_id", "bigint"),
    ("shipping_limit_date", "timestamp_ntz"), ("price", "double"), ("freight_value", "double"),
)
add(
    "q2_table_columns",
    union(
        f"SELECT '{c}' AS \"column\", 'order_items' AS table_name, CAST({i} AS INTEGER) AS position, '{t}' AS dtype, "
        f"count(*) - count({c}) AS missing FROM m_order_items"
        for i, (c, t) in enumerate(ITEM_TYPES)
    ),
)
add("q2_sample_rows", "SELECT * FROM m_orders ORDER BY order_id LIMIT 3")


def key_check(source: str, name: str, keys) -> str:
    listed = ", ".join(keys)
    any_null = " OR ".join(f"{k} IS NULL" for k in keys)
    return (
        f"SELECT '{name}' AS table_name, '{' + '.join(keys)}' AS candidate_key, CAST(sum(n) AS BIGINT) AS \"rows\", count(*) AS unique_keys, "
        f"CAST(sum(n - 1) AS BIGINT) AS duplicate_keys, CAST(sum(CASE WHEN {any_null} THEN n ELSE 0 END) AS BIGINT) AS missing_key_rows "
        f"FROM (SELECT {listed}, count(*) AS n FROM {source} GROUP BY {listed})"
    )


add("q3_key_check", union(key_check(f"m_{t}", t, k) for t, k in CANDIDATE_KEYS.items()))
add("q3_key_check_duplicates", key_check("lineitem", "lineitem", ["l_orderkey", "l_linenumber"]))
add(
    "q4_multiplicity",
    union(
        f"SELECT '{t}' AS table_name, count(*) AS orders, avg(n) AS mean_rows_per_order, count(*) FILTER (n > 1) AS orders_with_multiple_rows, "
        f"max(n) AS max_rows_per_order FROM (SELECT order_id, count(*) AS n FROM m_{t} GROUP BY order_id)"
        for t in ("order_items", "order_payments", "order_reviews")
    ),
    "mean_rows_per_order",
)


def orphans(pairs) -> str:
    return union(
        f"SELECT '{c}.{ck} -> {p}.{pk}' AS relationship, count(*) AS missing_references FROM m_{c} "
        f"WHERE {ck} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM m_{p} p WHERE p.{pk} = m_{c}.{ck})"
        for c, ck, p, pk in pairs
    )


add("q5_orphans", orphans(RELATIONSHIPS))
add(
    "q5_orphan_zips",
    orphans(
        (
            ("customers", "customer_zip_code_prefix", "geolocation", "geolocation_zip_code_prefix"),
            ("products", "product_category_name", "product_category_translation", "product_category_name"),
        )
    ),
)


def grain(source: str, name: str, key: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, count(*) AS \"rows\", count(DISTINCT {key}) AS unique_keys, "
        f"count(*) = count(DISTINCT {key}) AS one_row_per_key FROM {source}"
    )


add(
    "q6_grain_report",
    union(
        [
            grain("m_orders", "orders", "order_id"),
            grain("t_customers", "customers_enriched", "customer_id"),
            grain("m_order_items", "order_items", "order_id"),
            grain("t_payments", "payments_agg", "order_id"),
            grain("t_reviews", "reviews_agg", "order_id"),
        ]
    ),
)
add("q7_row_counts", counts)
add(
    "q8_join_coverage",
    union(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, (count(*) - count({c})) / count(*)::DOUBLE * 100 AS missing_pct FROM t_mart"
        for c in ("item_count", "payment_total", "review_count", "customer_lat", "avg_seller_lat")
    ),
    "missing_pct",
)

# Projections and filters.
FEATURE_DOUBLES = " ".join(
    c for c in NUMERIC_FEATURES if c in MART_DOUBLES.split() or (c in ENGINEERED_FEATURES and c != "purchase_hour")
)
add(
    "p1_model_features",
    f"SELECT order_id, {', '.join(NUMERIC_FEATURES + CATEGORICAL_FEATURES)} FROM t_engineered",
    FEATURE_DOUBLES,
    7,
)
add("p2_prediction_input", f"SELECT {', '.join(INPUTS)} FROM t_split", INPUT_DOUBLES)
LABELABLE = "order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL"
add("p3_labelable", f"SELECT * FROM m_orders WHERE {LABELABLE}")
add(
    "p3_label_coverage",
    f"SELECT count(*) AS original_orders, count(*) FILTER ({LABELABLE}) AS labelable_orders, "
    f"count(*) - count(*) FILTER ({LABELABLE}) AS removed_orders FROM m_orders",
)
_safe = [c for c in LABELLED if c not in LEAKAGE_COLUMNS]
add(
    "p4_without_leakage",
    f"SELECT {', '.join(_safe)} FROM t_labelled",
    " ".join(c for c in MART_DOUBLES.split() if c in _safe),
)
add(
    "p5_comment_flag",
    "SELECT review_id, CASE WHEN review_comment_message IS NOT NULL THEN 1 ELSE 0 END AS has_review_comment FROM m_order_reviews",
)
add("p6_reshaped_columns", "SELECT order_id, split, CAST(is_late AS INTEGER) AS actual_is_late FROM t_split")
add("p7_scoring_requests", "SELECT * FROM t_requests", "latency_ms")
add("p7_predictions", "SELECT * FROM t_predictions", "late_probability")
add(
    "p8_constant_columns",
    union(
        f"SELECT '{c}' AS column_name FROM t_train HAVING count(DISTINCT {c}) + CASE WHEN count({c}) < count(*) THEN 1 ELSE 0 END = 1"
        for c in LABELLED
    ),
)
TIMES = ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
         "order_estimated_delivery_date", "max_shipping_limit_date")
TEXTS = ("customer_id", "order_status", "customer_unique_id", "customer_city", "customer_state", "primary_product_category",
         "primary_seller_state", "primary_payment_type")
KINDS = {
    "id": ("order_id", "customer_id", "customer_unique_id"),
    "geo_code": ("customer_zip_code_prefix",),
    "categorical": TEXTS,
    "datetime": TIMES,
    "numeric": tuple(c for c in LABELLED if c not in TEXTS + TIMES),
}
add(
    "p9_column_kinds",
    union(
        f"SELECT '{k}' AS kind, CAST({len(cs)} AS BIGINT) AS columns, {' + '.join(f'count({c})' for c in cs)} AS filled_values FROM t_train"
        for k, cs in KINDS.items()
    ),
)

# Joins.
add("j1_customer_centroids", "SELECT * FROM t_customers", "customer_lat customer_lng")
add("j2_item_details", "SELECT * FROM t_details", "price freight_value seller_lat seller_lng")
add("j3_order_mart", f"SELECT {', '.join(MART_COLUMNS)} FROM t_mart", MART_DOUBLES)
add(
    "j4_orders_with_customers",
    "SELECT order_id, order_status, customer_city, customer_state FROM m_orders o JOIN m_customers c ON o.customer_id = c.customer_id ORDER BY order_id LIMIT 5",
)
PAIRS = (("train", "validation"), ("train", "test"), ("validation", "test"))
add(
    "j5_split_overlap",
    union(
        f"SELECT '{a} - {b}' AS pair, count(*) AS shared_orders FROM (SELECT order_id FROM t_split WHERE split = '{a}' "
        f"INTERSECT SELECT order_id FROM t_split WHERE split = '{b}')"
        for a, b in PAIRS
    ),
)
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
add(
    "j6_weekday_table",
    f"SELECT d.purchase_weekday, r.* EXCLUDE (purchase_weekday) FROM (VALUES {', '.join(f'({d!r})' for d in DAYS)}) d(purchase_weekday) "
    f"LEFT JOIN ({rates('t_profile', 'purchase_weekday', True)}) r ON d.purchase_weekday = r.purchase_weekday",
    RATES,
)

# Aggregates.
add("a1_zip_centroids", "SELECT * FROM t_zip", "lat lng")
add("a2_item_aggregate", "SELECT * FROM t_items", ITEM_DOUBLES)
add("a3_modes", "SELECT order_id, primary_product_category, primary_seller_state, primary_payment_type FROM t_mart")
add("a4_payment_aggregate", "SELECT * FROM t_payments", "payment_total")
add("a5_review_aggregate", "SELECT * FROM t_reviews", "review_score_mean")
add(
    "a6_class_distribution",
    'SELECT is_late, count(*) AS "count", count(*) / (SELECT count(*) FROM t_labelled)::DOUBLE * 100 AS percentage FROM t_labelled GROUP BY is_late',
    "percentage",
)
add(
    "a6_class_balance",
    """
SELECT *, imbalance_ratio >= 2 AS imbalanced FROM (SELECT count(*) FILTER (is_late = 0) AS on_time_orders, count(*) FILTER (is_late = 1) AS late_orders,
 count(*) FILTER (is_late = 1) * 100 / count(*)::DOUBLE AS late_percentage,
 count(*) FILTER (is_late = 0) / count(*) FILTER (is_late = 1)::DOUBLE AS imbalance_ratio FROM t_labelled)
""",
    "late_percentage imbalance_ratio",
)
for c in CATEGORICAL_COLUMNS:
    add(f"a7_late_rate_by_{c}", rates("t_train", c), RATES)
add("a7_late_rate_by_zip", rates("t_train", "customer_zip_code_prefix"), RATES)
add("a7_late_rate_by_same_state", rates("t_profile", "same_customer_seller_state"), RATES)
add("a7_late_rate_by_month", rates("t_profile", "purchase_year_month", True), RATES)
ORACLES["a7_late_rate_by_month_csv"] = ORACLES["a7_late_rate_by_month"]
add("a7_late_rate_by_hour", rates("t_profile", "purchase_hour", True), RATES)
add("a7_late_rate_by_holiday", rates("t_profile", "is_fixed_national_holiday", True), RATES)
add(
    "a7_late_rate_by_month_all",
    rates(f"(SELECT *, strftime({TS}, '%Y-%m') AS purchase_year_month FROM t_labelled)", "purchase_year_month", True),
    RATES,
)
add("a7_late_rate_by_state_all", rates("t_labelled", "customer_state"), RATES)
MONTHS = rates("t_profile", "purchase_year_month", True, "HAVING count(order_id) >= 10")
ZIPS = rates("t_train", "customer_zip_code_prefix", False, "HAVING count(order_id) >= 50")
add("a8_reliable_months", MONTHS, RATES)
add("a8_reliable_zips", ZIPS, RATES)
for key, c in (("state", "customer_state"), ("payment_type", "primary_payment_type")):
    add(
        f"a9_crosstab_{key}",
        f"SELECT {c}, count(*) FILTER (is_late = 0) / count(*)::DOUBLE * 100 AS on_time_pct, "
        f"count(*) FILTER (is_late = 1) / count(*)::DOUBLE * 100 AS late_pct FROM t_train WHERE {c} IS NOT NULL GROUP BY {c}",
        "on_time_pct late_pct",
    )


def describe(source: str, columns) -> str:
    return (
        'SELECT feature, count(value) AS "count", avg(value) AS "mean", stddev_samp(value) AS std, min(value) AS "min", '
        'quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS "median", quantile_cont(value, 0.75) AS q3, max(value) AS "max" '
        f"FROM ({long_form(source, columns)}) GROUP BY feature"
    )


DESCRIBED = 'mean std min q1 median q3 max'
add("a10_describe_numeric", describe("t_train", NUMERIC_COLUMNS), DESCRIBED)
add(
    "a10_describe_durations",
    describe("t_profile", ("estimated_delivery_days", "actual_delivery_days", "approval_hours", "customer_seller_distance_km")),
    DESCRIBED,
)
add(
    "a10_describe_delay",
    describe(
        "(SELECT delay_days AS all_delivered_orders, CASE WHEN is_late = 1 THEN delay_days END AS late_orders_only FROM t_labelled)",
        ("all_delivered_orders", "late_orders_only"),
    ),
    DESCRIBED,
)


def by_class(source: str, columns) -> str:
    return (
        'SELECT feature, is_late, count(value) AS "count", avg(value) AS "mean", quantile_cont(value, 0.5) AS "median" '
        f"FROM ({long_form(source, columns, 'is_late')}) GROUP BY feature, is_late"
    )


add("a11_class_means_medians", by_class("t_train", NUMERIC_COLUMNS), "mean median")
add("a11_distance_by_class", by_class("t_profile", ["customer_seller_distance_km"]), "mean median")
TRAIN_LONG = f"({long_form('t_train', NUMERIC_COLUMNS)})"
add(
    "a12_range_summary",
    f"SELECT feature, min(value) AS minimum, max(value) AS maximum, count(*) FILTER (value < 0) AS negative_count, "
    f"count(*) FILTER (value = 0) AS zero_count FROM {TRAIN_LONG} GROUP BY feature",
    "minimum maximum",
)
SKEW = (
    "SELECT feature, skewness, abs(skewness) AS absolute_skew, coalesce(abs(skewness) > 1, false) AS highly_skewed "
    f"FROM (SELECT feature, skewness(value) AS skewness FROM {TRAIN_LONG} GROUP BY feature)"
)
add("a13_skew_summary", SKEW, "skewness absolute_skew")
BOUNDS = "*, q3 - q1 AS iqr, q1 - 1.5::DOUBLE * (q3 - q1) AS lower_bound, q3 + 1.5::DOUBLE * (q3 - q1) AS upper_bound"
QUARTILES = 'quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS "median", quantile_cont(value, 0.75) AS q3'
add(
    "a14_outlier_summary",
    f"""
SELECT b.feature, q1, q3, iqr, lower_bound, upper_bound, count(*) FILTER (value < lower_bound OR value > upper_bound) AS outlier_count,
 count(*) FILTER (value < lower_bound OR value > upper_bound) / count(*)::DOUBLE * 100 AS outlier_pct
FROM {TRAIN_LONG} v JOIN (SELECT {BOUNDS} FROM (SELECT feature, {QUARTILES} FROM {TRAIN_LONG} GROUP BY feature)) b ON v.feature = b.feature
WHERE value IS NOT NULL GROUP BY ALL
""",
    "q1 q3 iqr lower_bound upper_bound outlier_pct",
)
CORRELATION = (
    "SELECT feature, r AS correlation_with_is_late, abs(r) AS absolute_correlation FROM (SELECT feature, "
    f"CASE WHEN min(value) < max(value) THEN corr(value, is_late) END AS r FROM ({long_form('t_train', NUMERIC_COLUMNS, 'is_late')}) "
    "WHERE value IS NOT NULL GROUP BY feature)"
)
add("a15_target_correlation", CORRELATION, "correlation_with_is_late absolute_correlation")
add(
    "a16_correlation_matrix",
    union(
        f"SELECT '{a}' AS feature, '{b}' AS other, CASE WHEN min({a}) FILTER ({b} IS NOT NULL) < max({a}) FILTER ({b} IS NOT NULL) "
        f"AND min({b}) FILTER ({a} IS NOT NULL) < max({b}) FILTER ({a} IS NOT NULL) THEN corr({a}, {b}) END AS correlation FROM t_profile"
        for a in CORRELATION_COLUMNS
        for b in CORRELATION_COLUMNS
    ),
    "correlation",
)
add(
    "a17_column_profile",
    union(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, (count(*) - count({c})) / count(*)::DOUBLE * 100 AS missing_pct, "
        f"count(DISTINCT {c}) + CASE WHEN count({c}) < count(*) THEN 1 ELSE 0 END AS unique_values, "
        f"(count(DISTINCT {c}) + CASE WHEN count({c}) < count(*) THEN 1 ELSE 0 END) / count(*)::DOUBLE * 100 AS unique_pct FROM {ROUNDED_TRAIN}"
        for c in LABELLED
    ),
    "missing_pct unique_pct",
)


def missing(source: str, columns) -> str:
    return union(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, (count(*) - count({c})) / count(*)::DOUBLE * 100 AS missing_pct "
        f"FROM {source} HAVING count({c}) < count(*)"
        for c in columns
    )


add("a18_missing_summary", missing("t_train", LABELLED), "missing_pct")
add(
    "a18_selected_missing",
    missing("(SELECT * FROM t_engineered WHERE split = 'train')", NUMERIC_FEATURES + CATEGORICAL_FEATURES),
    "missing_pct",
)
add(
    "a19_missing_impact",
    "SELECT *, missing_late_rate - present_late_rate AS late_rate_difference FROM ("
    + union(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_rows, count({c}) AS present_rows, "
        f"avg(is_late) FILTER ({c} IS NULL) AS missing_late_rate, avg(is_late) FILTER ({c} IS NOT NULL) AS present_late_rate "
        f"FROM t_train HAVING count({c}) < count(*)"
        for c in LABELLED
    )
    + ")",
    "missing_late_rate present_late_rate late_rate_difference",
)
VALUES = f"(SELECT feature, value, count(*) AS n FROM ({long_form('t_train', CATEGORICAL_COLUMNS, cast='VARCHAR')}) GROUP BY feature, value)"
add(
    "a20_categorical_summary",
    f"""
SELECT feature, count(*) AS unique_values, CAST(sum(CASE WHEN value IS NULL THEN n ELSE 0 END) AS BIGINT) AS missing_count,
 sum(CASE WHEN value IS NULL THEN n ELSE 0 END) / sum(n)::DOUBLE * 100 AS missing_pct, min(value) FILTER (n = top) AS top_value, max(n) AS top_count
FROM (SELECT *, max(n) OVER (PARTITION BY feature) AS top FROM {VALUES}) GROUP BY feature
""",
    "missing_pct",
)
add(
    "a21_rare_categories",
    f"SELECT feature, count(*) AS total_categories, count(*) FILTER (n < 50) AS rare_categories, "
    f"CAST(sum(CASE WHEN n < 50 THEN n ELSE 0 END) AS BIGINT) AS rare_orders, sum(CASE WHEN n < 50 THEN n ELSE 0 END) / sum(n)::DOUBLE * 100 AS rare_orders_pct "
    f"FROM {VALUES} GROUP BY feature",
    "rare_orders_pct",
)
add(
    "a22_messy_categories",
    f"SELECT feature, count(value) AS raw_unique, count(DISTINCT lower(trim(value))) AS normalized_unique, "
    f"count(value) - count(DISTINCT lower(trim(value))) AS possible_format_duplicates FROM {VALUES} GROUP BY feature",
)
CHART_LONG = f"({long_form('t_train', CHART_COLUMNS)})"
add(
    "a23_histogram",
    f"""
SELECT l.feature, CAST(b.bin AS INTEGER) AS bin, low + width * b.bin AS bin_start, low + width * (b.bin + 1) AS bin_end,
 count(v.value) AS "count"
FROM (SELECT feature, min(value) AS low, (max(value) - min(value)) / 40 AS width FROM {CHART_LONG} GROUP BY feature) l
CROSS JOIN (SELECT range AS bin FROM range(40)) b
LEFT JOIN {CHART_LONG} v ON v.feature = l.feature AND least(CAST(floor((v.value - low) / width) AS INTEGER), 39) = b.bin
GROUP BY l.feature, b.bin, low, width
""",
    "bin_start bin_end",
)
CHART_CLASS = f"({long_form('t_train', CHART_COLUMNS, 'is_late')})"
add(
    "a24_box_stats",
    f"""
SELECT b.feature, b.is_late, least(min(value) FILTER (value BETWEEN lower_bound AND upper_bound), q1) AS whisker_low, q1, "median", q3,
 greatest(max(value) FILTER (value BETWEEN lower_bound AND upper_bound), q3) AS whisker_high
FROM {CHART_CLASS} v JOIN (SELECT {BOUNDS} FROM (SELECT feature, is_late, {QUARTILES} FROM {CHART_CLASS} GROUP BY feature, is_late)) b
 ON v.feature = b.feature AND v.is_late = b.is_late WHERE value IS NOT NULL GROUP BY b.feature, b.is_late, q1, "median", q3
""",
    "whisker_low q1 median q3 whisker_high",
)
add(
    "a26_split_summary",
    f"""
SELECT split, count(*) AS "rows", count(*) / (SELECT count(*) FROM t_split)::DOUBLE * 100 AS percentage, min({TS}) AS start_date, max({TS}) AS end_date,
 CAST(sum(1 - is_late) AS BIGINT) AS on_time_orders, CAST(sum(is_late) AS BIGINT) AS late_orders, avg(is_late) * 100 AS late_rate_pct FROM t_split GROUP BY split
""",
    "percentage late_rate_pct",
)
DIMENSIONS = (*CATEGORICAL_COLUMNS, "purchase_year_month", "purchase_weekday", "purchase_hour")
_sets = ", ".join(f"({d})" for d in DIMENSIONS)
_name = " ".join(f"WHEN grouping({d}) = 0 THEN '{d}'" for d in DIMENSIONS)
_value = " ".join(f"WHEN grouping({d}) = 0 THEN CAST({d} AS VARCHAR)" for d in DIMENSIONS)
add(
    "a27_late_rate_tables",
    f"SELECT CASE {_name} END AS dimension, CASE {_value} END AS value, count(order_id) AS orders, CAST(sum(is_late) AS BIGINT) AS late_orders, "
    f"avg(is_late) AS late_rate, avg(is_late) * 100 AS late_rate_pct FROM t_profile GROUP BY GROUPING SETS ({_sets})",
    RATES,
)

# Order and windows.
add("w1_chronological_split", f"SELECT order_id, {TS}, split FROM t_split")
add(
    "w2_split_report",
    f"""
SELECT split, count(*) AS "rows", count(DISTINCT order_id) AS unique_orders, count(*) - count(DISTINCT order_id) AS duplicates,
 count(*) - count(is_late) AS missing_labels, count(*) - count({TS}) AS missing_dates, min({TS}) AS min_date, max({TS}) AS max_date FROM t_split GROUP BY split
""",
)
add("w3_time_range", f"SELECT min({TS}) AS earliest_order, max({TS}) AS latest_order FROM t_labelled")
add(
    "w4_top_product_categories",
    rates("t_train", "primary_product_category") + " ORDER BY orders DESC, primary_product_category NULLS FIRST LIMIT 20",
    RATES,
)
add("w4_top_zips", ZIPS + " ORDER BY late_rate_pct DESC, customer_zip_code_prefix NULLS FIRST LIMIT 30", RATES)
add(
    "w4_top_correlations",
    f"SELECT * FROM ({ORACLES['a15_target_correlation'][ORACLES['a15_target_correlation'].rindex('SELECT * REPLACE'):]}) "
    "ORDER BY absolute_correlation DESC NULLS LAST, feature LIMIT 5",
)
add("w4_top_missing", f"SELECT * FROM ({missing('t_train', LABELLED)}) ORDER BY missing_pct DESC, column_name LIMIT 5", "missing_pct")
add(
    "w4_top_skewed",
    f"SELECT * FROM (SELECT * REPLACE (round(skewness, 6) AS skewness, round(absolute_skew, 6) AS absolute_skew) FROM ({SKEW})) "
    "ORDER BY absolute_skew DESC NULLS LAST, feature LIMIT 5",
)
HUNDRED = rates("t_profile", "purchase_year_month", True, "HAVING count(order_id) >= 100")
add("w5_highest_late_month", f"SELECT * FROM ({HUNDRED}) ORDER BY late_rate_pct DESC, purchase_year_month LIMIT 1", RATES)
add(
    "w6_later_copies",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, count(*) AS later_copies FROM (
 SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn > 1
GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
""",
    "l_extendedprice",
)
for key, label in (("late", 1), ("on_time", 0)):
    add(
        f"w7_{key}_examples",
        "SELECT order_id, order_delivered_customer_date, order_estimated_delivery_date, delay_days, is_late FROM t_labelled "
        f"WHERE is_late = {label} ORDER BY order_id LIMIT 5",
    )

# Set operations.
add(
    "u1_stacked_counts",
    union(
        f"SELECT '{n}' AS table_name, count(*) AS \"rows\", count(DISTINCT {k}) AS unique_keys FROM {t}"
        for n, t, k in (("orders", "m_orders", "order_id"), ("customers_enriched", "t_customers", "customer_id"), ("items_agg", "t_items", "order_id"))
    ),
)
add("u2_id_intersection", "SELECT order_id FROM m_order_items INTERSECT SELECT order_id FROM m_order_reviews")
add("u2_id_difference", "SELECT order_id FROM m_orders EXCEPT SELECT order_id FROM m_order_items")
add("u3_distinct_keys", "SELECT DISTINCT order_id, payment_type FROM m_order_payments")

# Scalar functions.
add(
    "f1_parse_timestamps",
    "SELECT order_id, TRY_CAST(CASE WHEN order_id % 7 = 0 THEN 'bad ' || order_id ELSE strftime(order_approved_at, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS parsed FROM m_orders",
)
DELAY = "CAST(date_diff('day', CAST(order_estimated_delivery_date AS DATE), CAST(order_delivered_customer_date AS DATE)) AS INTEGER)"
add("f2_delay_days", f"SELECT order_id, {DELAY} AS delay_days FROM m_orders")
add("f3_late_label", "SELECT order_id, delay_days, is_late FROM t_labelled")
add(
    "f3_label_report",
    """
SELECT count(*) AS "rows", count(*) FILTER (is_late = 1 AND delay_days <= 0) AS invalid_late, count(*) FILTER (is_late = 0 AND delay_days > 0) AS invalid_on_time,
 count(*) - count(delay_days) AS missing_delay, count(*) - count(is_late) AS missing_label, CAST(max(is_late) AS INTEGER) AS has_late, CAST(1 - min(is_late) AS INTEGER) AS has_on_time FROM t_labelled
""",
)
for key, expr, out in (
    ("f4_month_of_year", f"CAST(month({TS}) AS VARCHAR)", "purchase_month"),
    ("f5_year_month", f"strftime({TS}, '%Y-%m')", "purchase_year_month"),
    ("f6_weekday_name", f"dayname({TS})", "purchase_weekday"),
    ("f7_hour", f"CAST(hour({TS}) AS INTEGER)", "purchase_hour"),
):
    add(key, f"SELECT order_id, {expr} AS {out} FROM m_orders")
add(
    "f8_elapsed_days",
    f"SELECT order_id, {seconds('order_estimated_delivery_date', TS)} / 86400.0::DOUBLE AS estimated_delivery_days, "
    f"{seconds('order_delivered_customer_date', TS)} / 86400.0::DOUBLE AS actual_delivery_days FROM m_orders",
    "estimated_delivery_days actual_delivery_days",
    7,
)
add(
    "f9_approval_hours",
    f"SELECT order_id, {seconds('order_approved_at', TS)} / 3600.0::DOUBLE AS approval_hours FROM m_orders",
    "approval_hours",
)
_flag = HOLIDAY.format(ts="order_approved_at")
add("f10_fixed_holiday", f"SELECT order_id, CAST({_flag} AS DOUBLE) AS is_fixed_national_holiday FROM m_orders")
add("f11_fixed_holiday_or_zero", f"SELECT order_id, CAST(coalesce({_flag}, false) AS TINYINT) AS is_fixed_national_holiday FROM m_orders")
add("f12_same_state", "SELECT order_id, CAST(customer_state = primary_seller_state AS DOUBLE) AS same_customer_seller_state FROM t_mart")
from oracles.tables import DISTANCE  # noqa: E402

add("f13_distance_km", f"SELECT order_id, {DISTANCE} AS customer_seller_distance_km FROM t_mart", "customer_seller_distance_km")
add(
    "f14_engineer_features",
    f"SELECT order_id, is_late, {', '.join(ENGINEERED_FEATURES)} FROM t_engineered",
    " ".join(c for c in ENGINEERED_FEATURES if c in FEATURE_DOUBLES.split()),
    7,
)
add("f15_normalized_city", "SELECT customer_id, lower(trim(customer_city)) AS city FROM m_customers")
MIXED = "CASE event_id % 6 WHEN 0 THEN event_id WHEN 1 THEN event_id WHEN 2 THEN 1 END"
add("f16_safe_float", f"SELECT event_id, CAST({MIXED} AS DOUBLE) AS number FROM m_request_log")
add("f17_error_status", f"SELECT event_id, coalesce({MIXED} >= 400, true) AS is_error FROM m_request_log")
add(
    "f18_json_fields",
    """
SELECT event_id, record->>'$.event' AS event, TRY_CAST(record->>'$.output.late_probability' AS DOUBLE) AS late_probability,
 TRY_CAST(record->>'$.output.predicted_is_late' AS BIGINT) AS predicted_is_late FROM t_prediction_lines WHERE valid
""",
    "late_probability",
)
add("f19_to_number", "SELECT product_id, CASE WHEN product_id % 5 <> 0 THEN product_weight_g END AS weight FROM m_products", "weight")

# Data quality.
NOT_NULL = ("order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date",
            "order_estimated_delivery_date", "customer_state", "item_count", "unique_products", "unique_sellers",
            "total_item_price", "total_freight_value", "delay_days", "is_late")
MOSTLY = {"order_approved_at": 0.999, "order_delivered_carrier_date": 0.9999, "payment_records": 0.9999, "payment_types_count": 0.9999,
          "payment_total": 0.9999, "payment_installments_max": 0.9999, "primary_payment_type": 0.9999}
IN_SET = {
    "order_status": "'delivered'",
    "is_late": "0, 1",
    "customer_state": ", ".join(f"'NATION_{i}'" for i in range(24)),
}
BETWEEN = {"item_count": (1, 8), "unique_products": (1, 10), "unique_sellers": (1, 10), "total_item_price": (0, 500000),
           "total_freight_value": (0, 40), "payment_total": (0, 500000), "payment_installments_max": (0, 7), "delay_days": (-20, 4)}


def rule(kind: str, column: str, success: str, observed: str, unexpected: str, source: str = "t_labelled") -> str:
    name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT '{kind}' AS \"rule\", {name} AS column_name, {success} AS success, CAST({observed} AS DOUBLE) AS observed_value, "
        f"CAST({unexpected} AS BIGINT) AS unexpected_count FROM {source}"
    )


R_ROWS = [rule("row_count_between", "", "count(*) BETWEEN 1 AND 10000000", "count(*)", "0")]
ONE = "(SELECT count(*) FROM t_labelled)"
R_COLUMNS = [rule("column_count", "", "true", "46", "0", ONE), rule("column_set", "", "true", "46", "0", ONE)]
R_NULL = [rule("not_null", c, f"count({c}) = count(*)", f"count({c}) / count(*)::DOUBLE", f"count(*) - count({c})") for c in NOT_NULL]
R_MOSTLY = [
    rule("mostly_not_null", c, f"count({c}) / count(*)::DOUBLE >= {m}::DOUBLE", f"count({c}) / count(*)::DOUBLE", f"count(*) - count({c})")
    for c, m in MOSTLY.items()
]
R_SET = [
    rule("in_set", c, f"count(*) FILTER ({c} NOT IN ({v})) = 0", f"count({c})", f"count(*) FILTER ({c} NOT IN ({v}))")
    for c, v in IN_SET.items()
]
R_BETWEEN = [
    rule("between", c, f"count(*) FILTER ({c} NOT BETWEEN {a} AND {b}) = 0", f"count({c})", f"count(*) FILTER ({c} NOT BETWEEN {a} AND {b})")
    for c, (a, b) in BETWEEN.items()
]


def unique(source: str, name: str = "order_id") -> str:
    return rule(
        "unique", name, "coalesce(sum(n) FILTER (n > 1), 0) = 0", "count(*)", "coalesce(sum(n) FILTER (n > 1), 0)",
        f"(SELECT {name}, count(*) AS n FROM {source} GROUP BY {name})",
    )


REPORT = union([*R_ROWS, *R_COLUMNS, *R_NULL, *R_MOSTLY, *R_SET, *R_BETWEEN, unique("t_labelled")])
add("d1_quality_report", REPORT, "observed_value")
add(
    "d1_quality_overall",
    f"SELECT count(*) AS evaluated_rules, count(*) FILTER (success) AS successful_rules, bool_and(success) AS success FROM ({REPORT})",
)
for key, parts in (
    ("d2_row_count", R_ROWS), ("d3_columns", R_COLUMNS), ("d4_not_null", R_NULL), ("d5_mostly_not_null", R_MOSTLY),
    ("d7_in_set", R_SET), ("d8_between", R_BETWEEN),
):
    add(key, union(parts), "observed_value")
add(
    "d6_unique",
    f"SELECT column_name, success, observed_value, unexpected_count FROM ({union([unique('m_orders'), unique('m_order_items')])})",
)
add(
    "d9_target_consistency",
    'SELECT count(*) AS "rows", count(*) FILTER (is_late <> CASE WHEN order_id % 9 <> 0 AND delay_days > 0 THEN 1 ELSE 0 END) AS mismatches FROM t_labelled',
)
add(
    "d11_contract_valid",
    "SELECT CAST(order_id AS VARCHAR) AS order_id, payment_total, customer_state, order_approved_at FROM t_split "
    "WHERE order_id % 11 <> 0 AND order_id % 13 <> 0 AND order_id % 17 <> 0",
    "payment_total",
)
add(
    "d11_contract_rejected",
    """
SELECT reasons, count(*) AS "rows" FROM (SELECT concat_ws('; ', CASE WHEN order_id % 17 = 0 THEN 'order_id is empty' END,
 CASE WHEN order_id % 11 = 0 THEN 'payment_total is not a number' END, CASE WHEN order_id % 13 = 0 THEN 'order_approved_at is not a timestamp' END) AS reasons
FROM t_split) WHERE reasons <> '' GROUP BY reasons
""",
)

# Preprocessing.
add("m1_fit_imputer", "SELECT feature, median, missing_count FROM t_imputer", "median")
add(
    "m2_missing_indicators",
    "SELECT n.order_id, n.feature, CASE WHEN n.value IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS missing FROM t_numbers n JOIN t_imputer i ON n.feature = i.feature "
    "WHERE i.missing_count > 0",
)
add("m3_fit_scaler", 'SELECT feature, "mean", variance, n AS "rows" FROM t_scaler', "mean variance", 4)
add(
    "m4_fill_missing_category",
    "SELECT order_id, " + ", ".join(f"coalesce({c}, '__MISSING__') AS {c}" for c in CATEGORICAL_FEATURES) + " FROM t_engineered",
)
add("m5_fit_categories", "SELECT feature, category, n, n >= 50 AS kept FROM t_category_counts")
add("m6_one_hot_categories", "SELECT order_id, feature, category FROM t_encoded")
add(
    "m7_feature_vectors",
    """
SELECT o.order_id, o.is_late, CAST((SELECT count(*) FROM t_names) AS INTEGER) AS width, n.total AS numeric_sum, h.hot AS hot_slots
FROM (SELECT order_id, is_late FROM t_split) o
JOIN (SELECT i.order_id, sum((i.x - s.mean) / s.scale) AS total FROM t_inputs i JOIN t_scaler s ON i.feature = s.feature GROUP BY i.order_id) n ON o.order_id = n.order_id
JOIN (SELECT order_id, CAST(count(position) AS DOUBLE) AS hot FROM t_encoded GROUP BY order_id) h ON o.order_id = h.order_id
""",
    "numeric_sum",
)
add(
    "m8_apply_numeric",
    "SELECT order_id, "
    + ", ".join(f"max(z) FILTER (feature = '{c}') AS {c}" for c in NUMERIC_FEATURES)
    + " FROM (SELECT i.order_id, i.feature, (i.x - s.mean) / s.scale AS z FROM t_inputs i JOIN t_scaler s ON i.feature = s.feature) GROUP BY order_id",
    " ".join(NUMERIC_FEATURES),
)
add("m9_feature_report", "SELECT count(*) AS \"rows\", CAST(0 AS BIGINT) AS wrong_width, CAST(0 AS BIGINT) AS not_finite FROM t_split")

# Model and metrics.
add("e1_prior_model", "SELECT order_id, (SELECT avg(is_late) FROM t_train) AS score FROM t_split WHERE split = 'validation'", "score")
AP = "(SELECT sum(positives * tp / (tp + fp)::DOUBLE) / sum(positives)::DOUBLE FROM t_curve)"
AUC = "(SELECT sum(negatives * (tp - positives + positives / 2.0::DOUBLE)) / (sum(positives) * sum(negatives))::DOUBLE FROM t_curve)"
add("e3_average_precision", f"SELECT {AP} AS average_precision", "average_precision")
add("e4_roc_auc", f"SELECT {AUC} AS roc_auc", "roc_auc")
POINT = 'threshold "precision" recall f1'.replace('"', "")
add("e5_best_threshold", 'SELECT threshold, "precision", recall, f1 FROM t_f1 ORDER BY f1 DESC, threshold LIMIT 1', POINT)
METRIC_DOUBLES = " ".join(METRIC_NAMES) + " threshold"


def threshold_metrics(source: str, by: str, threshold: str, ap: str, auc: str) -> str:
    """Metric row per group from a table with (score, is_late)."""
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
SELECT {lead}{ap} AS average_precision, {auc} AS roc_auc, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1,
 coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS "precision", coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall,
 (tp / (tp + fn)::DOUBLE + tn / (tn + fp)::DOUBLE) / 2 AS balanced_accuracy, (tp + tn) / (tp + tn + fp + fn)::DOUBLE AS accuracy, {threshold}::DOUBLE AS threshold
FROM (SELECT {lead}count(*) FILTER (score >= {threshold}::DOUBLE AND is_late = 1) AS tp, count(*) FILTER (score >= {threshold}::DOUBLE AND is_late = 0) AS fp,
 count(*) FILTER (score < {threshold}::DOUBLE AND is_late = 1) AS fn, count(*) FILTER (score < {threshold}::DOUBLE AND is_late = 0) AS tn FROM {source} {group}) q
"""


add("e6_threshold_metrics", threshold_metrics("t_tied", "", "0.7", AP, AUC), METRIC_DOUBLES)
add(
    "e7_confusion_matrix",
    union(
        f"SELECT 'Actual {n}' AS actual, count(*) FILTER (score < 0.7::DOUBLE) AS predicted_on_time, count(*) FILTER (score >= 0.7::DOUBLE) AS predicted_late FROM t_tied WHERE is_late = {y}"
        for n, y in (("On Time", 0), ("Late", 1))
    ),
)
FIXED = (
    "(SELECT s.split AS section, 'fixed' AS model, s.late_probability AS score, l.is_late FROM t_scored s JOIN t_labelled l ON s.order_id = l.order_id WHERE s.split <> 'train' "
    "UNION ALL SELECT s.split, 'constant', 0.1::DOUBLE, s.is_late FROM t_split s WHERE s.split <> 'train')"
)
CURVE = (
    "(SELECT section, model, score, sum(is_late) AS positives, sum(1 - is_late) AS negatives, sum(sum(is_late)) OVER w AS tp, sum(sum(1 - is_late)) OVER w AS fp "
    f"FROM {FIXED} GROUP BY section, model, score WINDOW w AS (PARTITION BY section, model ORDER BY score DESC ROWS UNBOUNDED PRECEDING)) c"
)
AP_BY = f"(SELECT sum(positives * tp / (tp + fp)::DOUBLE) / sum(positives)::DOUBLE FROM {CURVE} WHERE c.section = q.section AND c.model = q.model)"
AUC_BY = (
    f"(SELECT sum(negatives * (tp - positives + positives / 2.0::DOUBLE)) / (sum(positives) * sum(negatives))::DOUBLE FROM {CURVE} "
    "WHERE c.section = q.section AND c.model = q.model)"
)
COMPARISON = threshold_metrics(FIXED, "model, section", "0.25", AP_BY, AUC_BY)
add("e8_comparison_table", COMPARISON, METRIC_DOUBLES)
add(
    "e9_precision_recall_curve",
    'SELECT threshold, "precision", recall, f1 FROM t_f1 UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE, NULL',
    POINT,
)
add(
    "e10_metric_payload",
    union(f"SELECT section || '_{m}' AS name, \"{m}\" AS value FROM ({COMPARISON}) WHERE model = 'fixed'" for m in METRIC_NAMES),
    "value",
)
add("e11_score_orders", SCORED + " WHERE split = 'test'", "late_probability")
# Newton steps on counted rows, all strengths at once; the penalty holds the intercept too.
add(
    "e2_item_count_fits",
    """
WITH RECURSIVE d AS MATERIALIZED (SELECT item_count::DOUBLE AS x, is_late::DOUBLE AS y, count(*)::DOUBLE AS n FROM t_train WHERE item_count IS NOT NULL GROUP BY ALL),
fit(k, c, a, b) AS (
 SELECT 0, c, 0.0::DOUBLE, 0.0::DOUBLE FROM (VALUES (0.001::DOUBLE), (0.01::DOUBLE), (1.0::DOUBLE)) v(c)
 UNION ALL
 SELECT k + 1, c, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b - (haa * gb - hab * ga) / (haa * hbb - hab * hab)
 FROM (SELECT k, c, a, b, a + c * sum(n * (p - y)) AS ga, b + c * sum(n * (p - y) * x) AS gb, 1 + c * sum(n * p * (1 - p)) AS haa,
        c * sum(n * p * (1 - p) * x) AS hab, 1 + c * sum(n * p * (1 - p) * x * x) AS hbb
       FROM (SELECT k, c, a, b, x, y, n, 1 / (1 + exp(-(a + b * x))) AS p FROM fit CROSS JOIN d) GROUP BY k, c, a, b)
 WHERE k < 30
)
SELECT c, a AS intercept, b AS item_count FROM fit WHERE k = 30
""",
    "intercept item_count",
)
add("e12_positive_probability", f"SELECT order_id, late_probability FROM ({SCORED})", "late_probability")
add("e13_apply_threshold", "SELECT order_id, CAST(score >= 0.5::DOUBLE AS INTEGER) AS predicted_is_late FROM t_tied")
TEXT_ID = f"SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id), 'fixed' AS model_version FROM ({SCORED})"
add(
    "e14_score_and_log",
    """
SELECT 'scored' AS sink, count(*) FILTER (order_id % 100 <> 0) AS "rows" FROM t_split
UNION ALL SELECT 'rejected', count(*) FILTER (order_id % 100 = 0) FROM t_split
UNION ALL SELECT 'logged', count(*) FILTER (order_id % 100 <> 0) FROM t_split
""",
)
add("e14_score_file", TEXT_ID, "late_probability")

# Monitoring and streams.
REQUESTS = "error_rate average_latency_ms p95_latency_ms max_latency_ms"
add("b1_request_metrics", "SELECT * FROM t_request_metrics", REQUESTS)
add("b2_prediction_metrics", "SELECT * FROM t_prediction_metrics", "predicted_late_rate mean_late_probability")
DRIFT = "predicted_late_rate mean_late_probability late_rate_absolute_delta mean_probability_absolute_delta"
add("b3_drift", "SELECT * FROM t_drift", DRIFT)
STATUS = "CASE WHEN alerts = '' THEN 'ok' ELSE 'alert' END AS status"
add("b4_alerts", f"SELECT {STATUS}, alerts FROM t_alerts")
add(
    "b5_monitoring_summary",
    f"""
SELECT {STATUS}, r.*, d.*, alerts, (SELECT count(*) FROM t_request_lines WHERE NOT valid) AS invalid_requests,
 (SELECT count(*) FROM t_prediction_lines WHERE NOT valid) AS invalid_predictions FROM t_alerts, t_request_metrics r, t_drift d
""",
    f"{REQUESTS} {DRIFT}",
)
add(
    "b6_baseline",
    f"""
SELECT count(*) AS prediction_count, avg(predicted_is_late) AS predicted_late_rate, avg(late_probability) AS mean_late_probability,
 stddev_pop(late_probability) AS std_late_probability, stddev_samp(late_probability) AS sample_std_late_probability FROM ({SCORED})
""",
    "predicted_late_rate mean_late_probability std_late_probability sample_std_late_probability",
)
add(
    "b7_stream_request_windows",
    f"""
SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS request_count, count(*) FILTER (is_error) AS error_count,
 count(*) FILTER (is_error) / count(*)::DOUBLE AS error_rate, avg(latency_ms) AS average_latency_ms, quantile_cont(latency_ms, 0.95) AS p95_latency_ms,
 max(latency_ms) AS max_latency_ms FROM t_requests GROUP BY window_start
""",
    REQUESTS,
)
add(
    "b7_stream_prediction_windows",
    f"""
SELECT window_start, count(*) AS prediction_count, count(*) FILTER (predicted_is_late = 1) AS predicted_late_count,
 count(*) FILTER (predicted_is_late = 0) AS predicted_on_time_count, count(*) FILTER (predicted_is_late = 1) / count(*)::DOUBLE AS predicted_late_rate,
 avg(late_probability) AS mean_late_probability
FROM (SELECT *, time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start FROM t_predictions
 UNION ALL SELECT *, time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL 12 HOUR FROM t_predictions)
GROUP BY window_start
""",
    "predicted_late_rate mean_late_probability",
)
add(
    "b8_stream_scoring",
    "SELECT CAST(order_id AS VARCHAR) AS order_id, late_probability, CAST(late_probability >= 0.25 AS INTEGER) AS predicted_is_late, 'fixed' AS model_version "
    "FROM t_scored WHERE order_id % 100 NOT IN (1, 2, 3, 4, 5)",
    "late_probability",
)
_kinds = {1: "no JSON object", 2: "missing field: item_count", 3: "item_count is not a number", 4: "extra field: note", 5: "order_id is empty"}
add(
    "b8_stream_rejected",
    union(f"SELECT '{why}' AS reasons, count(*) AS \"rows\" FROM t_split WHERE order_id % 100 = {k} HAVING count(*) > 0" for k, why in _kinds.items())
    + " UNION ALL SELECT 'all lines', count(*) FROM t_split",
)
