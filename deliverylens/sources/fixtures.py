"""The commerce tables (``m_*``) emulated over the generated test tables.

The SQL texts are the definitions of FIXTURES.md; they run unchanged in Spark
and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The view definitions of FIXTURES.md, by commerce table.
FIXTURE_SQL = {
    "orders": """
SELECT o_orderkey AS order_id, 'c' || CAST(o_orderkey AS STRING) AS customer_id,
 CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
 o_orderdate + (o_orderkey * 7919 % 86400) * INTERVAL '1' SECOND AS order_purchase_timestamp,
 CASE WHEN o_orderkey % 500 = 0 THEN NULL ELSE o_orderdate + (o_orderkey * 7919 % 86400 + o_orderkey % 97 * 60) * INTERVAL '1' SECOND END AS order_approved_at,
 o_orderdate + INTERVAL '2' DAY AS order_delivered_carrier_date,
 CASE WHEN o_orderkey % 400 = 0 THEN NULL ELSE o_orderdate + (2 + (o_orderkey * 31 + o_custkey * 17) % 29) * INTERVAL '1' DAY + INTERVAL '15' HOUR END AS order_delivered_customer_date,
 o_orderdate + (25 + o_orderkey % 7) * INTERVAL '1' DAY AS order_estimated_delivery_date FROM {orders}
""",
    "customers": """
SELECT 'c' || CAST(o_orderkey AS STRING) AS customer_id, c_name AS customer_unique_id, 1000 + c_custkey % 60 AS customer_zip_code_prefix,
 CASE WHEN c_custkey % 40 = 0 THEN ' ' || lower(c_mktsegment) ELSE c_mktsegment END AS customer_city, n_name AS customer_state
 FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
""",
    "order_items": """
SELECT l_orderkey AS order_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS order_item_id,
 l_partkey AS product_id, l_suppkey AS seller_id, l_shipdate AS shipping_limit_date, l_extendedprice AS price, l_tax * 100 AS freight_value FROM {lineitem}
""",
    "products": """
SELECT p_partkey AS product_id, CASE WHEN p_partkey % 60 = 0 THEN NULL ELSE p_type END AS product_category_name, CAST(1 + p_partkey % 6 AS DOUBLE) AS product_photos_qty,
 CASE WHEN p_partkey % 75 = 0 THEN NULL ELSE CAST(p_size * 100 AS DOUBLE) END AS product_weight_g, CAST(10 + p_partkey % 50 AS DOUBLE) AS product_length_cm,
 CAST(2 + p_partkey % 30 AS DOUBLE) AS product_height_cm, CAST(5 + p_partkey % 40 AS DOUBLE) AS product_width_cm FROM {part}
""",
    "product_category_translation": """
SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english FROM {part} WHERE p_type <> 'PROMO'
""",
    "sellers": """
SELECT s_suppkey AS seller_id, 1000 + s_suppkey % 40 AS seller_zip_code_prefix, n_name AS seller_state FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
""",
    "geolocation": """
SELECT 1000 + c_custkey % 55 AS geolocation_zip_code_prefix, CAST(c_custkey % 200 AS DOUBLE) / 10 - 30 AS geolocation_lat, CAST(c_custkey % 150 AS DOUBLE) / 10 - 60 AS geolocation_lng FROM {customer}
""",
    "order_payments": """
SELECT l_orderkey AS order_id, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS payment_sequential,
 CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END AS payment_type, max(l_linenumber) AS payment_installments, sum(l_extendedprice) AS payment_value FROM {lineitem} GROUP BY l_orderkey, l_returnflag
""",
    "order_reviews": """
SELECT 'r' || CAST(o_orderkey AS STRING) AS review_id, o_orderkey AS order_id, o_orderkey % 5 + 1 AS review_score, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS review_comment_message FROM {orders} WHERE o_orderkey % 10 <> 0
 UNION ALL SELECT 's' || CAST(o_orderkey AS STRING), o_orderkey, 1, NULL FROM {orders} WHERE o_orderkey % 50 = 1
""",
    "request_log": """
SELECT event_id, ts, CASE WHEN event_id % 101 = 0 THEN 'not-json' WHEN event_id % 211 = 0 THEN '[1]' WHEN event_id % 307 = 0 THEN ' ' ELSE
 '{{"event":"api_request","path":"' || CASE event_type WHEN 'purchase' THEN '/health' WHEN 'click' THEN '/predict/batch' ELSE '/predict' END || '","status_code":' || CASE event_type WHEN 'error' THEN '500' ELSE '200' END || ',"latency_ms":' || CAST(CAST(value AS DECIMAL(18,2)) AS STRING) || '}}' END AS value FROM {events}
""",
    "prediction_log": """
SELECT event_id, ts, CASE WHEN event_id % 103 = 0 THEN '{{"event":"prediction","output":null}}' WHEN event_id % 223 = 0 THEN 'not-json' ELSE
 '{{"event":"' || CASE event_type WHEN 'signup' THEN 'prediction_request' ELSE 'prediction' END || '","output":{{"late_probability":' || CAST(CAST(value / 500 AS DECIMAL(18,6)) AS STRING) || ',"predicted_is_late":' || CASE WHEN value >= 100 THEN '1' ELSE '0' END || '}}}}' END AS value FROM {events}
""",
}

_RAW_TABLES = ("orders", "customer", "nation", "lineitem", "part", "supplier", "events")


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One generated Parquet table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def commerce_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One emulated commerce table (lazy)."""
    sql = FIXTURE_SQL[name]
    used = {t: raw_table(spark, sf_dir, t) for t in _RAW_TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def commerce_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine emulated commerce tables by name (lazy)."""
    from deliverylens.sources.tables import SOURCE_TABLES

    return {name: commerce_table(spark, sf_dir, name) for name in SOURCE_TABLES}
