"""Scans and sinks of the commerce tables and of the stage tables."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deliverylens.errors import GrainError
from deliverylens.session import short_lived_shuffles

SOURCE_TABLES = (
    "orders",
    "customers",
    "order_items",
    "order_payments",
    "order_reviews",
    "products",
    "sellers",
    "geolocation",
    "product_category_translation",
)

# Declared schemas: dates stay text at this point and are parsed where used.
SOURCE_SCHEMAS = {
    "orders": (
        "order_id STRING, customer_id STRING, order_status STRING, order_purchase_timestamp STRING, "
        "order_approved_at STRING, order_delivered_carrier_date STRING, "
        "order_delivered_customer_date STRING, order_estimated_delivery_date STRING"
    ),
    "customers": (
        "customer_id STRING, customer_unique_id STRING, customer_zip_code_prefix BIGINT, "
        "customer_city STRING, customer_state STRING"
    ),
    "order_items": (
        "order_id STRING, order_item_id INT, product_id STRING, seller_id STRING, "
        "shipping_limit_date STRING, price DOUBLE, freight_value DOUBLE"
    ),
    "order_payments": (
        "order_id STRING, payment_sequential INT, payment_type STRING, "
        "payment_installments INT, payment_value DOUBLE"
    ),
    "order_reviews": (
        "review_id STRING, order_id STRING, review_score INT, review_comment_title STRING, "
        "review_comment_message STRING, review_creation_date STRING, review_answer_timestamp STRING"
    ),
    "products": (
        "product_id STRING, product_category_name STRING, product_name_lenght DOUBLE, "
        "product_description_lenght DOUBLE, product_photos_qty DOUBLE, product_weight_g DOUBLE, "
        "product_length_cm DOUBLE, product_height_cm DOUBLE, product_width_cm DOUBLE"
    ),
    "sellers": "seller_id STRING, seller_zip_code_prefix BIGINT, seller_city STRING, seller_state STRING",
    "geolocation": (
        "geolocation_zip_code_prefix BIGINT, geolocation_lat DOUBLE, geolocation_lng DOUBLE, "
        "geolocation_city STRING, geolocation_state STRING"
    ),
    "product_category_translation": "product_category_name STRING, product_category_name_english STRING",
}


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


@dataclass
class SourceScan:
    """Tables that were found, and the names of those that were not."""

    tables: dict[str, DataFrame]
    missing: list[str] = field(default_factory=list)


def read_sources(
    spark: SparkSession,
    directory: str,
    file_names: dict[str, str] | None = None,
    schemas: dict[str, str | T.StructType] | None = None,
) -> SourceScan:
    """Read the CSV files of a folder with declared schemas.

    ``file_names`` maps a table to its file; the default is ``<table>.csv``.
    A file that is not there is reported in ``missing`` and does not stop the
    others.
    """
    file_names = file_names or {}
    schemas = schemas or SOURCE_SCHEMAS
    scan = SourceScan({})
    for table, schema in schemas.items():
        path = os.path.join(directory, file_names.get(table, f"{table}.csv"))
        if not _path_exists(spark, path):
            scan.missing.append(table)
            continue
        scan.tables[table] = (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .option("multiLine", table == "order_reviews")
            .option("escape", '"')
            .csv(path)
        )
    return scan


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    """Replace the table at ``path``; Spark's partitions are the chunks."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str],
) -> DataFrame:
    """One relational table, read in ``partitions`` parallel key ranges."""
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties,
    )


def available_tables(spark: SparkSession) -> DataFrame:
    """Names of the tables and views the session's catalog knows."""
    names = [(t.name,) for t in spark.catalog.listTables()]
    return spark.createDataFrame(names, "table_name STRING")


def missing_tables(spark: SparkSession, expected: list[str]) -> DataFrame:
    """Expected table names the catalog does not know."""
    wanted = spark.createDataFrame([(name,) for name in expected], "table_name STRING")
    return wanted.join(available_tables(spark), "table_name", "left_anti")


def write_checked(
    df: DataFrame,
    path: str,
    key: str,
    not_null: tuple[str, ...] = (),
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """Write a stage table, read it back and check it.

    The number of rows written comes from an observation on the write itself,
    so the input is computed once, and its shuffle files go when it is written.
    The copy must have as many rows, the same columns, a unique key and no null
    in ``not_null``.
    """
    from pyspark.sql import Observation

    written = Observation()
    with short_lived_shuffles(df.sparkSession):
        write_table(df.observe(written, F.count(F.lit(1)).alias("rows")), path, partition_by)
        saved = read_table(df.sparkSession, path)
        if set(saved.columns) != set(df.columns):
            raise GrainError(f"saved columns differ from written columns: {path}")
        report = stage_report(saved, key, not_null).first()
    expected = written.get["rows"]
    if report["rows"] != expected:
        raise GrainError(f"saved {report['rows']} rows but wrote {expected}: {path}")
    if report["unique_keys"] != report["rows"]:
        raise GrainError(f"{key} is not unique in {path}")
    for name in not_null:
        if report[f"null_{name}"]:
            raise GrainError(f"{report[f'null_{name}']} null values of {name} in {path}")
    return saved.select(*df.columns)


def stage_report(df: DataFrame, key: str, not_null: tuple[str, ...] = ()) -> DataFrame:
    """One row: rows, unique keys and null counts of a stage table."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.col(key)).alias("unique_keys"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null],
    )


def write_report(df: DataFrame, path: str) -> str:
    """Replace a CSV report with header; reports are small summary tables."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_report(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
