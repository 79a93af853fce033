"""One named query per operator, over the emulated commerce tables.

A query is a function ``(spark, sf_dir) -> DataFrame``. Doubles are rounded to
six places so that the last bits of a sum do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.functions import dates, geo, jsonlog, text
from deliverylens.operators import checks, labels, mart, metrics, model, monitor, prep, profile, quality, ranks, score, split
from deliverylens.operators import features as feat
from deliverylens.plans.stages import PURCHASE_TIME, Stages, fixture_stages
from deliverylens.session import run_dir
from deliverylens.sources import bundle as bundles
from deliverylens.sources import logs, matrix, orders_file
from deliverylens.sources import tables as tbl
from deliverylens.sources.fixtures import commerce_table, raw_table
from deliverylens.streaming import metrics as stream_metrics
from deliverylens.streaming import scoring as stream_scoring

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to ``places`` decimals; negative zero becomes zero."""
    return df.select(
        *[(F.round(F.col(c), places) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def query(name: str, places: int = 6) -> Callable[[Callable[[Stages], DataFrame]], Callable[[Stages], DataFrame]]:
    """Register a function of the stages under ``name``.

    Day fractions take seven places, where no second falls on a half.
    """

    def add(fn: Callable[[Stages], DataFrame]) -> Callable[[Stages], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(fixture_stages(spark, sf_dir)), places)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return add


def with_dir(name: str) -> Callable[[Query], Query]:
    """Register a query that reads generated tables beyond the commerce tables."""

    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        return fn

    return add


# --- scans and sinks --------------------------------------------------------

_ITEM_SCHEMA = (
    "order_id BIGINT, order_item_id INT, product_id BIGINT, seller_id BIGINT, "
    "shipping_limit_date TIMESTAMP_NTZ, price DOUBLE, freight_value DOUBLE"
)
_PRODUCT_SCHEMA = (
    "product_id BIGINT, product_category_name STRING, product_photos_qty DOUBLE, product_weight_g DOUBLE, "
    "product_length_cm DOUBLE, product_height_cm DOUBLE, product_width_cm DOUBLE"
)


def _csv_copy(st: Stages, name: str, schema: str) -> DataFrame:
    folder = run_dir(st.spark, "csv")
    _write_csv(st, name, folder)
    return tbl.read_sources(st.spark, folder, schemas={name: schema}).tables[name]


def _write_csv(st: Stages, name: str, folder: str) -> None:
    writer = st.tables[name].write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/{name}.csv")


def _text_dates(df: DataFrame) -> str:
    """The table's schema with dates as text, as CSV files have them."""
    return ", ".join(f"{c} {'string' if kind.startswith(('timestamp', 'date')) else kind}" for c, kind in df.dtypes)


def _csv_scan(name: str) -> None:
    @query(f"s1_csv_scan_{name}")
    def _(st):
        copy = _csv_copy(st, name, _text_dates(st.tables[name]))
        return mart.parse_dates({name: copy})[name]


for _name in tbl.SOURCE_TABLES:
    if _name not in ("order_items", "products"):
        _csv_scan(_name)


@query("s1_csv_scan_order_items")
def _(st):
    return _csv_copy(st, "order_items", _ITEM_SCHEMA)


@query("s1_csv_scan_products")
def _(st):
    return _csv_copy(st, "products", _PRODUCT_SCHEMA)


@query("s2_table_sink")
def _(st):
    return tbl.read_table(st.spark, tbl.write_table(st.tables["order_payments"], run_dir(st.spark, "table")))


@query("s3_table_scan")
def _(st):
    return st.tables["orders"]


@query("s4_catalog_check")
def _(st):
    """Expected tables, one of them not there, with presence and row count."""
    present = dict(st.tables)
    for name, df in present.items():
        df.createOrReplaceTempView(name)
    expected = [*present, "order_returns"]
    missing = tbl.missing_tables(st.spark, expected).withColumn("rows", F.lit(0).cast("bigint")).withColumn("available", F.lit(False))
    return missing.unionByName(checks.row_counts(present).withColumn("available", F.lit(True)))


@query("s5_checked_stage")
def _(st):
    saved = tbl.write_checked(st.labelled(), run_dir(st.spark, "labelled"), "order_id", ("is_late",))
    return tbl.stage_report(saved, "order_id", ("is_late",))


@query("s6_csv_report")
def _(st):
    path = tbl.write_report(profile.late_rate_by(st.train(), "customer_state"), run_dir(st.spark, "report"))
    schema = "customer_state STRING, orders BIGINT, late_orders BIGINT, late_rate DOUBLE, late_rate_pct DOUBLE"
    return tbl.read_report(st.spark, path, schema)


def _prediction_input(st: Stages, name: str) -> DataFrame:
    rows = st.part(name)
    return rows.select(*feat.prediction_input_columns(rows.columns))


@query("s7_order_file_scan")
def _(st):
    path = run_dir(st.spark, "orders") + "/orders.csv"
    _prediction_input(st, "all").write.option("header", True).csv(path)
    return orders_file.load_orders(st.spark, path)


def _requests(st: Stages) -> logs.LogScan:
    return logs.scan_lines(st.log("request_log"))


def _predictions(st: Stages) -> logs.LogScan:
    return logs.scan_lines(st.log("prediction_log"))


@query("s8_request_log_scan")
def _(st):
    return _requests(st).report


@query("s8_prediction_log_scan")
def _(st):
    return _predictions(st).report


@query("s8_jsonl_file_scan")
def _(st):
    path = run_dir(st.spark, "log")
    st.log("request_log").select("value").write.text(path)
    return logs.read_jsonl(st.spark, path).report


def fixed_model(p: prep.Preprocessor) -> model.LinearModel:
    """A linear model by rule, so that scores can be checked in SQL."""
    weights = tuple((7 * j % 11 - 5) / 20.0 for j in range(p.width))
    return model.LinearModel(weights, -1.5, 1.0, None)


def fixed_bundle(st: Stages) -> bundles.Bundle:
    p = st.preprocessor()
    return bundles.Bundle(p, fixed_model(p), 0.25, "fixed")


@query("s9_prediction_log_sink")
def _(st):
    b = fixed_bundle(st)
    orders = _prediction_input(st, "all")
    path = run_dir(st.spark, "predictions")
    logs.log_predictions(
        score.score_rows(orders, b, keep=orders.columns),
        path,
        input_columns=orders.columns,
        latency_ms=1.0,
        model_type=b.model.model_type,
        model_version=b.version,
        threshold=b.threshold,
    )
    record = F.col("record")
    return (
        logs.read_jsonl(st.spark, path)
        .records.groupBy(jsonlog.text_field(record, "$.event").alias("event"))
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.max(jsonlog.safe_int(record, "$.request_size")).alias("request_size"),
            F.sum(jsonlog.safe_int(record, "$.output.predicted_is_late")).alias("late"),
            F.avg(jsonlog.safe_float(record, "$.output.late_probability")).alias("mean_late_probability"),
        )
    )


@query("s11_prediction_output")
def _(st):
    b = fixed_bundle(st)
    scored = score.with_version(score.score_rows(st.part("all"), b), b)
    path = score.write_predictions(scored, run_dir(st.spark, "scored"))
    return st.spark.read.schema(scored.schema).json(path)


@query("s12_bundle_roundtrip")
def _(st):
    path = run_dir(st.spark, "bundle")
    folder = bundles.save_bundle(st.spark, fixed_bundle(st), path)
    bundles.load_bundle(st.spark, path, "fixed")
    return st.spark.read.parquet(f"{folder}/coefficients").withColumn("position", F.col("position").cast("bigint"))


@query("s13_feature_matrix")
def _(st):
    from pyspark.ml.functions import vector_to_array

    path = run_dir(st.spark, "matrix")
    matrix.write_matrix(st.engineered("all"), st.preprocessor(), path)
    return matrix.read_matrix(st.spark, path).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.size(vector_to_array("features"))).cast("bigint").alias("width"),
        F.sum("is_late").alias("late_orders"),
    )


# --- raw table checks -------------------------------------------------------


@query("q1_table_overview")
def _(st):
    return checks.table_overview(st.tables)


@query("q2_table_columns")
def _(st):
    items = st.tables["order_items"]
    missing = checks.coverage(items, items.columns).select(F.col("column_name").alias("column"), "missing")
    return checks.describe_table("order_items", items).join(missing, "column")


@query("q2_sample_rows")
def _(st):
    return checks.sample_rows(st.tables["orders"], ["order_id"])


@query("q3_key_check")
def _(st):
    return checks.stack([checks.key_check(st.tables[t], k, t) for t, k in checks.CANDIDATE_KEYS.items()])


@with_dir("q3_key_check_duplicates")
def _(spark, sf_dir):
    return checks.key_check(raw_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem")


@query("q4_multiplicity")
def _(st):
    return checks.stack(
        [checks.multiplicity(st.tables[t], "order_id", t) for t in ("order_items", "order_payments", "order_reviews")]
    )


@query("q5_orphans")
def _(st):
    return checks.orphans(st.tables)


@query("q5_orphan_zips")
def _(st):
    pairs = (
        ("customers", "customer_zip_code_prefix", "geolocation", "geolocation_zip_code_prefix"),
        ("products", "product_category_name", "product_category_translation", "product_category_name"),
    )
    return checks.orphans(st.tables, pairs)


@query("q6_grain_report")
def _(st):
    t = st.tables
    centroids = mart.zip_centroids(t["geolocation"])
    return checks.stack(
        [
            checks.grain_report(t["orders"], ["order_id"], "orders"),
            checks.grain_report(mart.enrich_customers(t["customers"], centroids), ["customer_id"], "customers_enriched"),
            checks.grain_report(t["order_items"], ["order_id"], "order_items"),
            checks.grain_report(mart.aggregate_payments(t["order_payments"]), ["order_id"], "payments_agg"),
            checks.grain_report(mart.aggregate_reviews(t["order_reviews"]), ["order_id"], "reviews_agg"),
        ]
    )


@query("q7_row_counts")
def _(st):
    return checks.row_counts(st.tables)


_COVERAGE = ("item_count", "payment_total", "review_count", "customer_lat", "avg_seller_lat")


@query("q8_join_coverage")
def _(st):
    return checks.coverage(mart.build_order_mart(st.tables, _COVERAGE), _COVERAGE)


# --- projections and filters ------------------------------------------------


@query("p1_model_features", 7)
def _(st):
    return feat.select_model_features(feat.engineer_features(st.labelled()), keep=["order_id"])


@query("p2_prediction_input")
def _(st):
    return _prediction_input(st, "all")


@query("p3_labelable")
def _(st):
    return labels.labelable(st.tables["orders"])


@query("p3_label_coverage")
def _(st):
    return labels.label_coverage(st.tables["orders"])


@query("p4_without_leakage")
def _(st):
    rows = checks.without_leakage(st.labelled())
    checks.assert_no_leakage(rows.columns)
    return rows


@query("p5_comment_flag")
def _(st):
    flag = F.when(F.col("review_comment_message").isNotNull(), 1).otherwise(0)
    return st.tables["order_reviews"].select("review_id", flag.alias("has_review_comment"))


@query("p6_reshaped_columns")
def _(st):
    return (
        st.split_table()
        .withColumn("is_late", F.col("is_late").cast("int"))
        .withColumnRenamed("is_late", "actual_is_late")
        .select("order_id", "split", "actual_is_late", "delay_days")
        .drop("delay_days")
    )


@query("p7_scoring_requests")
def _(st):
    return monitor.request_events(_requests(st).records)


@query("p7_predictions")
def _(st):
    return monitor.prediction_events(_predictions(st).records)


@query("p8_constant_columns")
def _(st):
    return profile.constant_columns(st.train())


@query("p9_column_kinds")
def _(st):
    rows = st.train()
    kinds = checks.column_kinds(rows)
    pairs = [(c, kind) for kind, columns in kinds.items() for c in columns]
    kind_table = st.spark.createDataFrame(pairs, "column_name STRING, kind STRING")
    filled = profile.aggregate_each(rows, rows.columns, lambda c: {"filled": F.count(c)}, name="column_name")
    return kind_table.join(filled, "column_name").groupBy("kind").agg(
        F.count(F.lit(1)).alias("columns"), F.sum("filled").alias("filled_values")
    )


# --- joins --------------------------------------------------------------------


@query("j1_customer_centroids")
def _(st):
    return mart.enrich_customers(st.tables["customers"], mart.zip_centroids(st.tables["geolocation"]))


def _details(st: Stages) -> DataFrame:
    t = st.tables
    return mart.item_details(
        t["order_items"], t["products"], t["product_category_translation"], t["sellers"], mart.zip_centroids(t["geolocation"])
    )


@query("j2_item_details")
def _(st):
    return _details(st)


@query("j3_order_mart")
def _(st):
    return mart.build_order_mart(st.tables, check=True)


@query("j4_orders_with_customers")
def _(st):
    return mart.first_orders_with_customers(st.tables["orders"], st.tables["customers"], 5)


@query("j5_split_overlap")
def _(st):
    return split.split_overlap(st.split_table(), "order_id")


@query("j6_weekday_table")
def _(st):
    return profile.weekday_table(st.train_profile())


# --- aggregates -----------------------------------------------------------------


@query("a1_zip_centroids")
def _(st):
    return mart.zip_centroids(st.tables["geolocation"])


@query("a2_item_aggregate")
def _(st):
    return mart.aggregate_items(_details(st))


@query("a3_modes")
def _(st):
    columns = ("order_id", "primary_product_category", "primary_seller_state", "primary_payment_type")
    return mart.build_order_mart(st.tables, columns)


@query("a4_payment_aggregate")
def _(st):
    return mart.aggregate_payments(st.tables["order_payments"])


@query("a5_review_aggregate")
def _(st):
    return mart.aggregate_reviews(st.tables["order_reviews"])


@query("a6_class_distribution")
def _(st):
    return profile.class_distribution(st.labelled())


@query("a6_class_balance")
def _(st):
    return profile.class_balance(st.labelled())


def _late_rate(name: str, column: str, drop_null: bool) -> None:
    @query(f"a7_late_rate_by_{name}")
    def _(st):
        return profile.late_rate_by(st.train_profile(), column, drop_null)


# Null is kept as a group for categories, ZIP prefix and same-state only.
for _column in profile.CATEGORICAL_COLUMNS:
    _late_rate(_column, _column, False)
_late_rate("zip", "customer_zip_code_prefix", False)
_late_rate("same_state", "same_customer_seller_state", False)
_late_rate("month", "purchase_year_month", True)
_late_rate("hour", "purchase_hour", True)
_late_rate("holiday", "is_fixed_national_holiday", True)


@query("a7_late_rate_by_month_all")
def _(st):
    return profile.late_rate_by(feat.profile_features(st.labelled()), "purchase_year_month", True)


@query("a7_late_rate_by_month_csv")
def _(st):
    """The training months of a run that starts from the nine CSV files, whose dates are text."""
    folder = run_dir(st.spark, "csv")
    for name in st.tables:
        _write_csv(st, name, folder)
    schemas = {name: _text_dates(df) for name, df in st.tables.items()}
    run = Stages(st.spark, tbl.read_sources(st.spark, folder, schemas=schemas).tables)
    return profile.late_rate_by(run.train_profile(), "purchase_year_month", True)


def late_rate_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rate by customer state over all labelled orders, straight from the raw tables."""
    t = fixture_stages(spark, sf_dir).tables
    orders = dict(t, orders=labels.labelable(t["orders"]))
    columns = ("order_id", "order_delivered_customer_date", "order_estimated_delivery_date", "customer_state")
    return rounded(profile.late_rate_by(labels.add_label(mart.build_order_mart(orders, columns)), "customer_state"))


QUERIES["a7_late_rate_by_state_all"] = late_rate_by_state


#: Orders a month needs to be listed; the small generated tables hold fewer than ``profile.MIN_MONTH_ORDERS``.
MONTH_MINIMUM = 10


@query("a8_reliable_months")
def _(st):
    return profile.reliable(
        profile.late_rate_by(st.train_profile(), "purchase_year_month", True), MONTH_MINIMUM
    )


@query("a8_reliable_zips")
def _(st):
    return profile.reliable(profile.late_rate_by(st.train(), "customer_zip_code_prefix"), profile.MIN_ZIP_ORDERS)


@query("a9_crosstab_state")
def _(st):
    return profile.crosstab_pct(st.train(), "customer_state")


@query("a9_crosstab_payment_type")
def _(st):
    return profile.crosstab_pct(st.train(), "primary_payment_type")


@query("a10_describe_numeric")
def _(st):
    return profile.describe(st.train(), profile.NUMERIC_COLUMNS, st.quartiles())


@query("a10_describe_durations")
def _(st):
    columns = ("estimated_delivery_days", "actual_delivery_days", "approval_hours", "customer_seller_distance_km")
    return profile.describe(st.train_profile(), columns)


@query("a10_describe_delay")
def _(st):
    both = st.labelled().select(
        F.col("delay_days").alias("all_delivered_orders"),
        F.when(F.col("is_late") == 1, F.col("delay_days")).alias("late_orders_only"),
    )
    return profile.describe(both, both.columns)


@query("a11_class_means_medians")
def _(st):
    return profile.class_means_medians(st.train(), profile.NUMERIC_COLUMNS, found=st.quartiles(by_class=True))


@query("a11_distance_by_class")
def _(st):
    return profile.class_means_medians(st.train_profile(), ["customer_seller_distance_km"])


@query("a12_range_summary")
def _(st):
    return profile.range_summary(st.train(), profile.NUMERIC_COLUMNS)


@query("a13_skew_summary")
def _(st):
    return profile.skew_summary(st.train(), profile.NUMERIC_COLUMNS)


@query("a14_outlier_summary")
def _(st):
    return profile.outlier_summary(st.train(), profile.NUMERIC_COLUMNS, st.quartiles())


@query("a15_target_correlation")
def _(st):
    return profile.target_correlation(st.train(), profile.NUMERIC_COLUMNS)


@query("a16_correlation_matrix")
def _(st):
    return profile.correlation_matrix(st.train_profile(), profile.CORRELATION_COLUMNS)


def _four_places(df: DataFrame) -> DataFrame:
    """Doubles to four places first, so that equal values are equal in every engine."""
    return rounded(df, 4)


@query("a17_column_profile")
def _(st):
    return profile.column_profile(_four_places(st.train())).drop("dtype")


@query("a17_approximate_profile")
def _(st):
    return profile.approximate_profile(st.train())


@query("a18_missing_summary")
def _(st):
    return profile.missing_summary(st.train())


@query("a18_selected_missing")
def _(st):
    rows = st.engineered("train")
    return profile.missing_summary(rows, [*feat.NUMERIC_FEATURES, *feat.CATEGORICAL_FEATURES])


@query("a19_missing_impact")
def _(st):
    return profile.missing_impact(st.train())


@query("a20_categorical_summary")
def _(st):
    return profile.categorical_summary(st.train(), profile.CATEGORICAL_COLUMNS)


@query("a21_rare_categories")
def _(st):
    return profile.rare_category_summary(st.train(), profile.CATEGORICAL_COLUMNS)


@query("a22_messy_categories")
def _(st):
    return profile.messy_category_summary(st.train(), profile.CATEGORICAL_COLUMNS)


@query("a23_histogram")
def _(st):
    return profile.histogram(st.train(), profile.CHART_COLUMNS)


@query("a24_box_stats")
def _(st):
    return profile.box_stats(st.train(), profile.CHART_COLUMNS, found=st.quartiles(by_class=True))


@query("a26_split_summary")
def _(st):
    return split.split_summary(st.split_table(), PURCHASE_TIME)


@query("a27_late_rate_tables")
def _(st):
    dimensions = (*profile.CATEGORICAL_COLUMNS, "purchase_year_month", "purchase_weekday", "purchase_hour")
    return profile.late_rate_tables(st.train_profile(), dimensions)


# --- order and windows ------------------------------------------------------------


@query("w1_chronological_split")
def _(st):
    rows = labels.labelable(st.tables["orders"]).select("order_id", PURCHASE_TIME)
    return split.chronological_split(rows, PURCHASE_TIME, "order_id")


@query("w2_split_report")
def _(st):
    split.check_split(st.split_table(), PURCHASE_TIME, "order_id", st.cuts().rows)
    return split.split_report(st.split_table(), PURCHASE_TIME, "order_id")


@query("w3_time_range")
def _(st):
    return split.time_range(st.labelled(), PURCHASE_TIME)


@query("w4_top_product_categories")
def _(st):
    rates = profile.late_rate_by(st.train(), "primary_product_category")
    return profile.top_rows(rates, [F.desc("orders"), F.asc("primary_product_category")], 20)


@query("w4_top_zips")
def _(st):
    rates = profile.reliable(profile.late_rate_by(st.train(), "customer_zip_code_prefix"), profile.MIN_ZIP_ORDERS)
    return profile.top_rows(rates, [F.desc("late_rate_pct"), F.asc("customer_zip_code_prefix")], 30)


@query("w4_top_correlations")
def _(st):
    rows = rounded(profile.target_correlation(st.train(), profile.NUMERIC_COLUMNS))
    return profile.top_rows(rows, [F.desc("absolute_correlation"), F.asc("feature")], 5)


@query("w4_top_missing")
def _(st):
    return profile.top_rows(profile.missing_summary(st.train()), [F.desc("missing_pct"), F.asc("column_name")], 5)


@query("w4_top_skewed")
def _(st):
    rows = rounded(profile.skew_summary(st.train(), profile.NUMERIC_COLUMNS))
    return profile.top_rows(rows, [F.desc("absolute_skew"), F.asc("feature")], 5)


@query("w5_highest_late_month")
def _(st):
    monthly = profile.late_rate_by(st.train_profile(), "purchase_year_month", True)
    return profile.highest_late_month(profile.reliable(monthly, profile.MIN_MONTH_ORDERS))


@with_dir("w6_later_copies")
def _(spark, sf_dir):
    rows = raw_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return checks.later_copies(
        rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"]
    )


@query("w7_late_examples")
def _(st):
    return labels.labelled_examples(st.labelled(), 1, 5)


@query("w7_on_time_examples")
def _(st):
    return labels.labelled_examples(st.labelled(), 0, 5)


# --- set operations -----------------------------------------------------------------


@query("u1_stacked_counts")
def _(st):
    t = st.tables
    items = t["order_items"].groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    return checks.stack(
        [
            checks.grain_report(t["orders"], ["order_id"], "orders"),
            checks.grain_report(t["customers"], ["customer_id"], "customers_enriched"),
            checks.grain_report(items, ["order_id"], "items_agg"),
        ]
    ).select("table_name", "rows", "unique_keys")


@query("u2_id_intersection")
def _(st):
    """Orders with items and with reviews but without a payment of their own type list."""
    t = st.tables
    with_items = t["order_items"].select("order_id")
    with_reviews = t["order_reviews"].select("order_id")
    return with_items.intersect(with_reviews)


@query("u2_id_difference")
def _(st):
    t = st.tables
    return t["orders"].select("order_id").exceptAll(t["order_items"].select("order_id").distinct())


@query("u3_distinct_keys")
def _(st):
    return checks.distinct_rows(st.tables["order_payments"], ["order_id", "payment_type"])


# --- scalar functions -------------------------------------------------------------------


@query("f1_parse_timestamps")
def _(st):
    """Dates held as text, every seventh of them broken."""
    as_text = F.when(F.col("order_id") % 7 == 0, F.concat(F.lit("bad "), F.col("order_id").cast("string"))).otherwise(
        F.date_format("order_approved_at", "yyyy-MM-dd HH:mm:ss")
    )
    return st.tables["orders"].select("order_id", dates.parse_timestamp(as_text).alias("parsed"))


@query("f2_delay_days")
def _(st):
    days = dates.calendar_days_between(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"))
    return st.tables["orders"].select("order_id", days.alias("delay_days"))


@query("f3_late_label")
def _(st):
    return labels.add_label(labels.labelable(st.tables["orders"])).select("order_id", "delay_days", "is_late")


@query("f3_label_report")
def _(st):
    labels.assert_labels(st.labelled())
    return labels.label_report(st.labelled())


def _on_purchase(name: str, output: str, expression) -> None:
    @query(name)
    def _(st):
        return st.tables["orders"].select("order_id", expression(F.col(PURCHASE_TIME)).alias(output))


_on_purchase("f4_month_of_year", "purchase_month", dates.month_of_year)
_on_purchase("f5_year_month", "purchase_year_month", dates.year_month)
_on_purchase("f6_weekday_name", "purchase_weekday", dates.weekday_name)
_on_purchase("f7_hour", "purchase_hour", F.hour)


@query("f8_elapsed_days", 7)
def _(st):
    bought = F.col(PURCHASE_TIME)
    return st.tables["orders"].select(
        "order_id",
        dates.elapsed_days(F.col("order_estimated_delivery_date"), bought).alias("estimated_delivery_days"),
        dates.elapsed_days(F.col("order_delivered_customer_date"), bought).alias("actual_delivery_days"),
    )


@query("f9_approval_hours")
def _(st):
    hours = dates.elapsed_hours(F.col("order_approved_at"), F.col(PURCHASE_TIME))
    return st.tables["orders"].select("order_id", hours.alias("approval_hours"))


@query("f10_fixed_holiday")
def _(st):
    return st.tables["orders"].select(
        "order_id", dates.fixed_holiday_flag(F.col("order_approved_at")).alias("is_fixed_national_holiday")
    )


@query("f11_fixed_holiday_or_zero")
def _(st):
    return st.tables["orders"].select(
        "order_id", dates.fixed_holiday_flag_or_zero(F.col("order_approved_at")).alias("is_fixed_national_holiday")
    )


@query("f12_same_state")
def _(st):
    rows = mart.build_order_mart(st.tables, ["order_id", "customer_state", "primary_seller_state"])
    same = (F.col("customer_state") == F.col("primary_seller_state")).cast("double")
    return rows.select("order_id", same.alias("same_customer_seller_state"))


@query("f13_distance_km")
def _(st):
    points = ("customer_lat", "customer_lng", "avg_seller_lat", "avg_seller_lng")
    rows = mart.build_order_mart(st.tables, ["order_id", *points])
    return rows.select("order_id", geo.haversine_km(*[F.col(p) for p in points]).alias("customer_seller_distance_km"))


@query("f14_engineer_features", 7)
def _(st):
    return feat.engineer_features(st.labelled()).select("order_id", "is_late", *feat.ENGINEERED_FEATURES)


@query("f15_normalized_city")
def _(st):
    return st.tables["customers"].select("customer_id", text.normalized(F.col("customer_city")).alias("city"))


@query("f16_safe_float")
def _(st):
    """Latency of every log object, with text, booleans and junk mixed in."""
    return _mixed_values(st).select("event_id", jsonlog.safe_float(F.col("record"), "$.v").alias("number"))


@query("f17_error_status")
def _(st):
    return _mixed_values(st).select("event_id", jsonlog.is_error_status(F.col("record"), "$.v").alias("is_error"))


def _mixed_values(st: Stages) -> DataFrame:
    """One JSON object per event whose field ``v`` changes its kind with the id."""
    i = F.col("event_id")
    number = F.col("event_id").cast("string")
    value = (
        F.when(i % 6 == 0, number)
        .when(i % 6 == 1, F.concat(F.lit('"'), number, F.lit('"')))
        .when(i % 6 == 2, F.lit("true"))
        .when(i % 6 == 3, F.lit("null"))
        .when(i % 6 == 4, F.lit('"junk"'))
        .otherwise(F.lit("[1]"))
    )
    lines = st.log("request_log").select(i, F.concat(F.lit('{"v":'), value, F.lit("}")).alias("value"))
    return logs.scan_lines(lines).records


@query("f18_json_fields")
def _(st):
    record = F.col("record")
    return _predictions(st).records.select(
        "event_id",
        jsonlog.text_field(record, "$.event").alias("event"),
        jsonlog.safe_float(record, "$.output.late_probability").alias("late_probability"),
        jsonlog.safe_int(record, "$.output.predicted_is_late").alias("predicted_is_late"),
    )


@query("f19_to_number")
def _(st):
    as_text = F.when(F.col("product_id") % 5 == 0, F.lit("n/a")).otherwise(F.col("product_weight_g").cast("string"))
    return st.tables["products"].select("product_id", text.to_number(as_text).alias("weight"))


# --- data quality -----------------------------------------------------------------------

# Limits that fit the emulated tables instead of the real ones.
FIXTURE_RULES = quality.Rules(
    row_count=(1, 10_000_000),
    allowed={
        "order_status": ("delivered",),
        "is_late": (0, 1),
        "customer_state": tuple(f"NATION_{i}" for i in range(24)),
    },
    ranges={
        "item_count": (1, 8),
        "unique_products": (1, 10),
        "unique_sellers": (1, 10),
        "total_item_price": (0, 500000),
        "total_freight_value": (0, 40),
        "payment_total": (0, 500000),
        "payment_installments_max": (0, 7),
        "delay_days": (-20, 4),
    },
)


def only(**parts) -> quality.Rules:
    """Rules with the given parts of the fixture rules and nothing else."""
    empty = {"not_null": (), "mostly_not_null": {}, "allowed": {}, "ranges": {}}
    return replace(FIXTURE_RULES, **{**empty, **parts})


@query("d1_quality_report")
def _(st):
    return quality.validate(st.labelled(), FIXTURE_RULES)


@query("d1_quality_overall")
def _(st):
    return quality.overall(quality.validate(st.labelled(), FIXTURE_RULES))


def _rule(name: str, kinds: Sequence[str], rules: quality.Rules) -> None:
    @query(name)
    def _(st):
        return quality.validate(st.labelled(), rules).filter(F.col("rule").isin(*kinds))


_rule("d2_row_count", ["row_count_between"], only())
_rule("d3_columns", ["column_count", "column_set"], only())
_rule("d4_not_null", ["not_null"], only(not_null=FIXTURE_RULES.not_null))
_rule("d5_mostly_not_null", ["mostly_not_null"], only(mostly_not_null=FIXTURE_RULES.mostly_not_null))
_rule("d7_in_set", ["in_set"], only(allowed=FIXTURE_RULES.allowed))
_rule("d8_between", ["between"], only(ranges=FIXTURE_RULES.ranges))


@with_dir("d6_unique")
def _(spark, sf_dir):
    return checks.stack(
        [
            quality.unique_rule(commerce_table(spark, sf_dir, "orders"), "order_id"),
            quality.unique_rule(commerce_table(spark, sf_dir, "order_items"), "order_id"),
        ]
    ).select("column_name", "success", "observed_value", "unexpected_count")


@query("d9_target_consistency")
def _(st):
    """The label against the delay, with every ninth delay taken away."""
    rows = st.labelled().select(F.when(F.col("order_id") % 9 != 0, F.col("delay_days")).alias("delay_days"), "is_late")
    return quality.target_consistency(rows)


def _contract_input(st: Stages) -> DataFrame:
    """Order records as text, some of them with values that break the contract."""
    rows = _prediction_input(st, "all")
    as_text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    key = F.col("order_id").cast("bigint")
    return as_text.withColumns(
        {
            "payment_total": F.when(key % 11 == 0, F.lit("much")).otherwise(F.col("payment_total")),
            "order_approved_at": F.when(key % 13 == 0, F.lit("soon")).otherwise(F.col("order_approved_at")),
            "order_id": F.when(key % 17 == 0, F.lit("")).otherwise(F.col("order_id")),
        }
    )


@query("d11_contract_valid")
def _(st):
    valid, _ = score.check_contract(_contract_input(st))
    return valid.select("order_id", "payment_total", "customer_state", "order_approved_at")


@query("d11_contract_rejected")
def _(st):
    _, rejected = score.check_contract(_contract_input(st))
    return rejected.groupBy(F.array_join("reasons", "; ").alias("reasons")).agg(F.count(F.lit(1)).alias("rows"))


# --- preprocessing --------------------------------------------------------------------------


@query("m1_fit_imputer")
def _(st):
    return prep.fit_imputer(st.engineered("train"))


@query("m2_missing_indicators")
def _(st):
    p = st.preprocessor()
    flags = [F.struct(F.lit(i.feature).alias("feature"), prep.indicator(i.feature).alias("missing")) for i in p.indicators]
    return st.engineered("all").select("order_id", F.inline(F.array(*flags)))


@query("m3_fit_scaler")
def _(st):
    p = st.preprocessor()
    medians = {n.feature: n.median for n in p.numeric}
    return _four_places(prep.fit_scaler(st.engineered("train"), medians, [i.feature for i in p.indicators]))


@query("m4_fill_missing_category")
def _(st):
    return prep.fill_missing_category(st.engineered("all")).select("order_id", *feat.CATEGORICAL_FEATURES)


@query("m5_fit_categories")
def _(st):
    return prep.fit_categories(st.engineered("train"))


@query("m6_one_hot_categories")
def _(st):
    return prep.encoded_categories(st.engineered("all"), st.preprocessor(), ["order_id"])


@query("m7_feature_vectors")
def _(st):
    from pyspark.ml.functions import vector_to_array

    values = vector_to_array("features")
    head = len(st.preprocessor().numeric) + len(st.preprocessor().indicators)
    hot = F.slice(values, head + 1, F.size(values))
    return st.features("all").select(
        "order_id",
        "is_late",
        F.size(values).alias("width"),
        F.aggregate(F.slice(values, 1, head), F.lit(0.0), lambda a, v: a + v).alias("numeric_sum"),
        F.aggregate(hot, F.lit(0.0), lambda a, v: a + v).alias("hot_slots"),
    )


@query("m8_apply_numeric")
def _(st):
    p = replace(st.preprocessor(), indicators=())
    return prep.apply_numeric(st.engineered("all"), p, ["order_id"]).withColumnsRenamed(
        {f"numeric__{n}": n for n in feat.NUMERIC_FEATURES}
    )


@query("m9_feature_report")
def _(st):
    rows = st.features("all")
    prep.check_features(rows, st.preprocessor())
    return prep.feature_report(rows, st.preprocessor())


# --- model and metrics ------------------------------------------------------------------------


def _tied(st: Stages) -> DataFrame:
    value = ((F.col("order_id") * 37) % 101 + 15 * F.col("is_late")) / F.lit(120.0)
    return st.labelled().select("order_id", "is_late", value.alias("score"))


@query("e1_prior_model")
def _(st):
    rate = model.prior_rate(st.train())
    return st.part("validation").select("order_id", model.prior_score(rate).alias("score"))


@query("e2_logistic_coefficients")
def _(st):
    b = st.bundle()
    names = b.preprocessor.feature_names
    rows = [(i, n, w) for i, (n, w) in enumerate(zip(names, b.model.coefficients))]
    rows.append((len(rows), "intercept", b.model.intercept))
    return st.spark.createDataFrame(rows, "position INT, feature STRING, coefficient DOUBLE")


@query("e2_item_count_fits")
def _(st):
    """Fits of lateness by the number of items alone for three strengths of the penalty, on all training rows."""
    rows = st.train().where(F.col("item_count").isNotNull()).select("order_id", "is_late", array_to_vector(F.array(F.col("item_count").cast("double"))).alias("features"))
    models = model.fit_candidates(rows, [(c, None) for c in (0.001, 0.01, 1.0)])
    found = [(m.c, m.intercept, m.coefficients[0]) for m in models]
    return st.spark.createDataFrame(found, "c DOUBLE, intercept DOUBLE, item_count DOUBLE")


@query("e2_tuning_table")
def _(st):
    table = st.tuning().table
    columns = ("c", "class_weight", *metrics.METRIC_NAMES)
    kinds = ", ".join(f"{c} {'STRING' if c == 'class_weight' else 'DOUBLE'}" for c in columns)
    return st.spark.createDataFrame([tuple(r[c] for c in columns) for r in table], kinds)


@query("e3_average_precision")
def _(st):
    return metrics.average_precision(_tied(st), "score", "is_late")


@query("e4_roc_auc")
def _(st):
    return metrics.roc_auc(_tied(st), "score", "is_late")


@query("e5_best_threshold")
def _(st):
    return metrics.best_threshold(_tied(st), "score", "is_late")


@query("e6_threshold_metrics")
def _(st):
    return metrics.evaluate(_tied(st), "score", "is_late", 0.7)


@query("e7_confusion_matrix")
def _(st):
    return metrics.confusion_table(_tied(st), "score", "is_late", 0.7)


def _fixed_scores(st: Stages, parts: Sequence[str]) -> DataFrame:
    rows = [
        model.model_scores(st.engineered(p), st.preprocessor(), fixed_model(st.preprocessor()), ["order_id", "is_late"]).withColumn(
            "section", F.lit(p)
        )
        for p in parts
    ]
    return checks.stack(rows)


@query("e8_comparison_table")
def _(st):
    """Metric rows of a constant and of the fixed model on validation and test."""
    fixed = _fixed_scores(st, ["validation", "test"]).withColumn("model", F.lit("fixed"))
    constant = fixed.withColumn("model", F.lit("constant")).withColumn("score", F.lit(0.1))
    return metrics.evaluate(constant.unionByName(fixed), "score", "is_late", 0.25, ["model", "section"])


@query("e8_results_summary")
def _(st):
    return st.results_summary()


@query("e9_precision_recall_curve")
def _(st):
    return metrics.precision_recall_curve(_tied(st), "score", "is_late")


@query("e10_metric_payload")
def _(st):
    rows = metrics.evaluate(_fixed_scores(st, ["validation", "test"]), "score", "is_late", 0.25, ["section"])
    return metrics.metric_payload(rows)


@query("e11_score_orders")
def _(st):
    return score.score(st.part("test"), fixed_bundle(st))


@query("e11_score_trained")
def _(st):
    return st.scored("test")


@query("e12_positive_probability")
def _(st):
    """The same scores from a model with its classes in the other order."""
    p = st.preprocessor()
    rows = model.class_probabilities(st.engineered("all"), p, fixed_model(p)).select(
        "order_id", F.array(F.col("probability")[1], F.col("probability")[0]).alias("probability")
    )
    score.check_probabilities(rows, "probability", (1, 0))
    return rows.select("order_id", score.positive_probability(F.col("probability"), (1, 0)).alias("late_probability"))


@query("e13_apply_threshold")
def _(st):
    return _tied(st).select("order_id", score.apply_threshold(F.col("score"), 0.5).alias("predicted_is_late"))


@query("e14_score_and_log")
def _(st):
    """Rows written by the job that scores a file of all parts, one of a hundred orders with a bad value."""
    source, target, rejected, log = (run_dir(st.spark, n) for n in ("orders", "scores", "rejected", "log"))
    rows = st.labelled()
    orders = rows.select(*feat.prediction_input_columns(rows.columns))
    bad = F.when(F.col("order_id") % 100 == 0, F.lit("much")).otherwise(F.col("item_count").cast("string"))
    orders.withColumn("item_count", bad).write.option("header", True).option("compression", "gzip").csv(f"{source}/orders.csv")
    scored = score.score_and_log(st.spark, f"{source}/orders.csv", target, rejected, log, fixed_bundle(st))
    event = jsonlog.text_field(F.col("record"), "$.event")
    sinks = {
        "scored": scored.agg(F.count(F.lit(1)).alias("rows")),
        "rejected": score.read_rejected(st.spark, rejected).filter(F.array_contains("reasons", "item_count is not a number")).agg(F.count(F.lit(1)).alias("rows")),
        "logged": logs.read_jsonl(st.spark, log).records.agg(F.count_if(event == "prediction").alias("rows")),
    }
    return checks.stack([df.select(F.lit(name).alias("sink"), "rows") for name, df in sinks.items()])


@query("e14_score_file")
def _(st):
    source = run_dir(st.spark, "orders") + "/orders.csv"
    _prediction_input(st, "all").write.option("header", True).csv(source)
    return score.score_file(st.spark, source, run_dir(st.spark, "scores"), fixed_bundle(st))


# --- monitoring and streams -----------------------------------------------------------------------


@query("b1_request_metrics")
def _(st):
    return monitor.request_metrics(monitor.request_events(_requests(st).records))


@query("b2_prediction_metrics")
def _(st):
    return monitor.prediction_metrics(monitor.prediction_events(_predictions(st).records))


@query("b3_drift")
def _(st):
    return monitor.drift(monitor.prediction_metrics(monitor.prediction_events(_predictions(st).records)))


@query("b4_alerts")
def _(st):
    request_row = monitor.request_metrics(monitor.request_events(_requests(st).records))
    drift_row = monitor.drift(monitor.prediction_metrics(monitor.prediction_events(_predictions(st).records)))
    return monitor.alerts(request_row, drift_row).withColumn("alerts", F.array_join("alerts", ","))


@query("b5_monitoring_summary")
def _(st):
    return monitor.monitoring_summary(_requests(st), _predictions(st)).select(
        "status",
        "requests.*",
        "predictions.*",
        F.col("drift.status").alias("drift_status"),
        F.col("drift.predicted_late_rate_absolute_delta").alias("late_rate_absolute_delta"),
        F.col("drift.mean_late_probability_absolute_delta").alias("mean_probability_absolute_delta"),
        F.array_join("alerts", ",").alias("alerts"),
        F.col("invalid_log_records.requests").alias("invalid_requests"),
        F.col("invalid_log_records.predictions").alias("invalid_predictions"),
    )


@query("b6_baseline")
def _(st):
    return monitor.baseline(score.score_rows(st.part("test"), fixed_bundle(st)))


def _log_stream(st: Stages, name: str) -> DataFrame:
    """The log as a stream over Parquet files, with event time."""
    path = run_dir(st.spark, name)
    st.log(name).withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(path)
    lines = st.spark.readStream.schema("event_id BIGINT, ts TIMESTAMP, value STRING").parquet(path)
    return logs.scan_lines(lines).records.withColumnRenamed("ts", "event_time")


@query("b7_stream_request_windows")
def _(st):
    """One-day windows of the request stream, open ones included."""
    out, state = run_dir(st.spark, "windows"), run_dir(st.spark, "state")
    windows = stream_metrics.windowed_requests(_log_stream(st, "request_log"), "1 day", "6 hours")
    stream_metrics.publish_windows(windows, out, state).awaitTermination()
    return stream_metrics.published(st.spark, out).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        *[c for c in windows.columns if not c.startswith("window")],
    )


@query("b7_stream_prediction_windows")
def _(st):
    """One-day windows of the prediction stream, sliding by half a day, open ones included."""
    out, state = run_dir(st.spark, "windows"), run_dir(st.spark, "state")
    windows = stream_metrics.windowed_predictions(_log_stream(st, "prediction_log"), "1 day", "6 hours", "12 hours")
    stream_metrics.publish_windows(windows, out, state).awaitTermination()
    return stream_metrics.published(st.spark, out).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        *[c for c in windows.columns if not c.startswith("window")],
    )


def _order_lines(st: Stages, path: str) -> None:
    """All labelled orders as JSON Lines with fields in two orders; of every hundred, one line is no JSON, one lacks a field, one has a bad value, one a field too many."""
    rows = st.labelled()
    names = feat.prediction_input_columns(rows.columns)
    kind = F.pmod("order_id", F.lit(100))
    texts = {c: F.col(c).cast("string") for c in names}
    keep_nulls = {"ignoreNullFields": "false"}

    def line(fields: dict[str, Column]) -> Column:
        return F.to_json(F.struct(*[x.alias(c) for c, x in fields.items()]), keep_nulls)

    usual = line({c: F.col(c) for c in names})
    turned = line({c: texts[c] for c in reversed(names)})
    made = (
        F.when(kind == 1, F.concat(F.lit("order "), texts["order_id"]))
        .when(kind == 2, line({c: x for c, x in texts.items() if c != "item_count"}))
        .when(kind == 3, line(texts | {"item_count": F.lit("much")}))
        .when(kind == 4, line(texts | {"note": F.lit("x")}))
        .when(kind == 5, line(texts | {"order_id": F.lit("")}))
        .when(kind < 50, turned)
        .otherwise(usual)
    )
    rows.select(made.alias("value")).write.option("compression", "gzip").text(path)


def _streamed_lines(st: Stages) -> tuple[DataFrame, DataFrame]:
    source, scored, rejected, state = (run_dir(st.spark, n) for n in ("lines", "scores", "rejected", "state"))
    _order_lines(st, source)
    lines = stream_scoring.read_order_lines(st.spark, source, files_per_batch=3)
    tasks = st.spark.sparkContext.defaultParallelism
    stream_scoring.start_scoring_lines(lines, fixed_bundle(st), scored, rejected, state, tasks).awaitTermination()
    return stream_scoring.scored_lines(st.spark, scored), stream_scoring.rejected_lines(st.spark, rejected)


@query("b8_stream_scoring")
def _(st):
    """The valid orders among all lines, scored as a stream of files in several batches."""
    return _streamed_lines(st)[0].drop("batch")


@query("b8_stream_rejected")
def _(st):
    """The other lines of that stream by reason, and the total of both sinks."""
    scored, rejected = _streamed_lines(st)
    why = rejected.groupBy(F.array_join("reasons", "; ").alias("reasons")).agg(F.count(F.lit(1)).alias("rows"))
    whole = scored.select("batch").unionByName(rejected.select("batch")).agg(F.lit("all lines").alias("reasons"), F.count(F.lit(1)).alias("rows"))
    return why.unionByName(whole)
