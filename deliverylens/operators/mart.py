"""One row per order from the nine commerce tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.functions.dates import parse_timestamp
from deliverylens.operators.checks import assert_grains

# Date columns by table; a CSV scan delivers them as text.
DATE_COLUMNS = {
    "orders": (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "order_items": ("shipping_limit_date",),
    "order_reviews": ("review_creation_date", "review_answer_timestamp"),
}

# Order of the output columns, by the part that supplies them: fixed values of the data model.
ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
CUSTOMER_COLUMNS = (
    "customer_unique_id",
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
    "customer_lat",
    "customer_lng",
)
ITEM_COLUMNS = (
    "item_count",
    "unique_products",
    "unique_sellers",
    "total_item_price",
    "avg_item_price",
    "total_freight_value",
    "avg_freight_value",
    "max_shipping_limit_date",
    "unique_product_categories",
    "primary_product_category",
    "avg_product_weight_g",
    "max_product_weight_g",
    "avg_product_length_cm",
    "avg_product_height_cm",
    "avg_product_width_cm",
    "avg_product_photos_qty",
    "unique_seller_states",
    "primary_seller_state",
    "avg_seller_lat",
    "avg_seller_lng",
)
PAYMENT_COLUMNS = (
    "payment_records",
    "payment_types_count",
    "payment_total",
    "payment_installments_max",
    "primary_payment_type",
)
REVIEW_COLUMNS = (
    "review_count",
    "review_score_mean",
    "review_score_min",
    "review_score_max",
    "has_review_comment",
)
MART_COLUMNS = ORDER_COLUMNS + CUSTOMER_COLUMNS + ITEM_COLUMNS + PAYMENT_COLUMNS + REVIEW_COLUMNS


def _date_text(tables: dict[str, DataFrame]) -> dict[str, list[str]]:
    """Date columns that are still text, by table."""
    found = {t: [c for c, kind in tables[t].dtypes if c in columns and kind == "string"] for t, columns in DATE_COLUMNS.items() if t in tables}
    return {t: columns for t, columns in found.items() if columns}


def parse_dates(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with date text as timestamps; text that is no date becomes null."""
    text = _date_text(tables)
    return {t: df.withColumns({c: parse_timestamp(c) for c in text.get(t, ())}) if t in text else df for t, df in tables.items()}


def unparsed_dates(tables: dict[str, DataFrame]) -> dict[str, dict[str, int]]:
    """How many values of each date text :func:`parse_dates` makes null, one aggregate a table."""
    return {
        t: tables[t].agg(*[F.count_if(F.col(c).isNotNull() & parse_timestamp(c).isNull()).alias(c) for c in columns]).first().asDict()
        for t, columns in _date_text(tables).items()
    }


def zip_centroids(geolocation: DataFrame) -> DataFrame:
    """Mean coordinate per ZIP prefix. Partial sums make a hot prefix cheap."""
    return geolocation.groupBy(F.col("geolocation_zip_code_prefix").alias("zip")).agg(
        F.avg("geolocation_lat").alias("lat"), F.avg("geolocation_lng").alias("lng")
    )


def enrich_customers(customers: DataFrame, centroids: DataFrame) -> DataFrame:
    """Customers with the centroid of their ZIP prefix, null where unknown."""
    return customers.join(centroids, customers["customer_zip_code_prefix"] == centroids["zip"], "left").select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
        F.col("lat").alias("customer_lat"),
        F.col("lng").alias("customer_lng"),
    )


def item_details(
    items: DataFrame,
    products: DataFrame,
    translation: DataFrame,
    sellers: DataFrame,
    centroids: DataFrame,
) -> DataFrame:
    """Items with product, translated category, seller state and seller point.

    Product and seller dimensions are completed first, at their own size, so
    the item table takes part in two joins instead of four. Join strategies
    are left to the size statistics and to adaptive execution, which also
    splits a hot product or seller. Items may come without their number.
    """
    product_dim = products.join(translation, "product_category_name", "left").select(
        "product_id",
        "product_category_name",
        "product_category_name_english",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )
    seller_dim = sellers.join(centroids, sellers["seller_zip_code_prefix"] == centroids["zip"], "left").select(
        "seller_id",
        "seller_state",
        F.col("lat").alias("seller_lat"),
        F.col("lng").alias("seller_lng"),
    )
    return (
        items.join(product_dim, "product_id", "left")
        .join(seller_dim, "seller_id", "left")
        .select(
            "order_id",
            *[c for c in ("order_item_id",) if c in items.columns],
            "product_id",
            "seller_id",
            "shipping_limit_date",
            "price",
            "freight_value",
            "product_category_name",
            "product_category_name_english",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
            "seller_state",
            "seller_lat",
            "seller_lng",
        )
    )


def _most_frequent(value: Column, rows: Column) -> Column:
    """Most frequent non-null value over counted values, the smallest of equals."""
    return F.min(F.when(value.isNotNull(), F.struct((-rows).alias("n"), value.alias("v"))))["v"]


# Columns whose values are counted per order, by the short name of the count.
_COUNTED = {
    "product": "product_id",
    "seller": "seller_id",
    "category": "product_category_name",
    "english": "product_category_name_english",
    "state": "seller_state",
}


# Measures per order: sums, rows with a value, and largest values of item columns.
_SUMMED = (
    "price",
    "freight_value",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
    "product_photos_qty",
    "seller_lat",
    "seller_lng",
)
_LARGEST = ("shipping_limit_date", "product_weight_g")


def aggregate_items(details: DataFrame) -> DataFrame:
    """Item measures per order, 20 of them, in one pass over the items.

    Items are first combined by order and counted values, where the joins have
    left them, so an order with very many items becomes one row for each
    combination. Those rows are dealt by order once; only behind that they
    become a row for the measures and one for each value that is counted, and
    both aggregates keep the partitioning. Buffers are flat, no set of values
    is ever held in memory.
    """
    measures = [f"{how}_{c}" for how, columns in (("sum", _SUMMED), ("count", _SUMMED), ("max", _LARGEST)) for c in columns]
    combined = (
        details.groupBy("order_id", *_COUNTED.values())
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(c).alias(f"sum_{c}") for c in _SUMMED],
            *[F.count(c).alias(f"count_{c}") for c in _SUMMED],
            *[F.max(c).alias(f"max_{c}") for c in _LARGEST],
        )
        .repartition("order_id")
    )
    nothing = [F.lit(None).cast(combined.schema[c].dataType).alias(c) for c in measures]
    kinds = [F.struct(F.lit("item").alias("kind"), F.lit(None).cast("string").alias("value"), "n", *measures)]
    kinds += [F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value"), "n", *nothing) for k, c in _COUNTED.items()]
    counted = (
        combined.select("order_id", F.inline(F.array(*kinds)))
        .groupBy("order_id", "kind", "value")
        .agg(F.sum("n").alias("n"), *[(F.max(c) if c.startswith("max_") else F.sum(c)).alias(c) for c in measures])
    )
    kind, value = F.col("kind"), F.col("value")

    def distinct(name: str) -> Column:
        return F.count_if((kind == name) & value.isNotNull())

    def mode(name: str) -> Column:
        return _most_frequent(F.when(kind == name, value), F.col("n"))

    def mean(column: str) -> Column:
        return F.try_divide(F.sum(f"sum_{column}"), F.sum(f"count_{column}"))

    return counted.groupBy("order_id").agg(
        F.sum(F.when(kind == "item", F.col("n"))).alias("item_count"),
        distinct("product").alias("unique_products"),
        distinct("seller").alias("unique_sellers"),
        F.sum("sum_price").alias("total_item_price"),
        mean("price").alias("avg_item_price"),
        F.sum("sum_freight_value").alias("total_freight_value"),
        mean("freight_value").alias("avg_freight_value"),
        F.max("max_shipping_limit_date").alias("max_shipping_limit_date"),
        distinct("category").alias("unique_product_categories"),
        mode("english").alias("primary_product_category"),
        mean("product_weight_g").alias("avg_product_weight_g"),
        F.max("max_product_weight_g").alias("max_product_weight_g"),
        mean("product_length_cm").alias("avg_product_length_cm"),
        mean("product_height_cm").alias("avg_product_height_cm"),
        mean("product_width_cm").alias("avg_product_width_cm"),
        mean("product_photos_qty").alias("avg_product_photos_qty"),
        distinct("state").alias("unique_seller_states"),
        mode("state").alias("primary_seller_state"),
        mean("seller_lat").alias("avg_seller_lat"),
        mean("seller_lng").alias("avg_seller_lng"),
    )


#: Columns of the items that :func:`item_measures` reads.
ITEM_INPUTS = ("order_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value")


def item_measures(tables: dict[str, DataFrame]) -> DataFrame:
    """Item measures per order from the base tables."""
    details = item_details(
        tables["order_items"],
        tables["products"],
        tables["product_category_translation"],
        tables["sellers"],
        zip_centroids(tables["geolocation"]),
    )
    return aggregate_items(details)


def aggregate_payments(payments: DataFrame) -> DataFrame:
    """Payment measures per order, from payments summed per order and type."""
    per_type = payments.groupBy("order_id", "payment_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("payment_value").alias("value"),
        F.max("payment_installments").alias("installments"),
    )
    return per_type.groupBy("order_id").agg(
        F.sum("n").alias("payment_records"),
        F.count("payment_type").alias("payment_types_count"),
        F.sum("value").alias("payment_total"),
        F.max("installments").alias("payment_installments_max"),
        _most_frequent(F.col("payment_type"), F.col("n")).alias("primary_payment_type"),
    )


def aggregate_reviews(reviews: DataFrame) -> DataFrame:
    """Review measures per order, with a flag for any comment."""
    commented = F.when(F.col("review_comment_message").isNotNull(), 1).otherwise(0)
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("review_count"),
        F.avg("review_score").alias("review_score_mean"),
        F.min("review_score").alias("review_score_min"),
        F.max("review_score").alias("review_score_max"),
        F.max(commented).alias("has_review_comment"),
    )


def build_order_mart(
    tables: dict[str, DataFrame],
    columns: Iterable[str] = MART_COLUMNS,
    check: bool = False,
    parts: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Orders left-joined with their customer, item, payment and review parts.

    Each part has one row per key, so a part that supplies none of the wanted
    ``columns`` is not joined at all. ``check=True`` runs the one-to-one check
    on the base tables first (one job for all of them) and raises on a
    duplicate key; the aggregated parts are unique by construction. ``parts``
    has those that were aggregated and written before, by their base table.
    """
    columns, parts = list(columns), parts or {}
    wanted = set(columns)
    tables = parse_dates(tables)
    orders = tables["orders"]
    centroids = zip_centroids(tables["geolocation"])
    if check:
        assert_grains(
            [
                (orders, ["order_id"], "orders"),
                (orders, ["customer_id"], "orders"),
                (tables["customers"], ["customer_id"], "customers"),
                (tables["products"], ["product_id"], "products"),
                (tables["sellers"], ["seller_id"], "sellers"),
                (tables["product_category_translation"], ["product_category_name"], "translation"),
            ]
        )
    mart = orders.select(*ORDER_COLUMNS)
    if wanted & set(CUSTOMER_COLUMNS):
        mart = mart.join(enrich_customers(tables["customers"], centroids), "customer_id", "left")
    if wanted & set(ITEM_COLUMNS):
        items = parts["order_items"] if "order_items" in parts else item_measures(tables)
        mart = mart.join(items, "order_id", "left")
    if wanted & set(PAYMENT_COLUMNS):
        payments = parts["order_payments"] if "order_payments" in parts else aggregate_payments(tables["order_payments"])
        mart = mart.join(payments, "order_id", "left")
    if wanted & set(REVIEW_COLUMNS):
        mart = mart.join(aggregate_reviews(tables["order_reviews"]), "order_id", "left")
    return mart.select(*columns)


def first_orders_with_customers(orders: DataFrame, customers: DataFrame, rows: int) -> DataFrame:
    """First orders by id with their customer's place."""
    return (
        orders.join(customers, "customer_id")
        .select("order_id", "order_status", "customer_city", "customer_state")
        .orderBy("order_id")
        .limit(rows)
    )
