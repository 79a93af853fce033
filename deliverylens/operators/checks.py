"""Checks of raw tables and of table grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deliverylens.errors import GrainError, LeakageError
from deliverylens.session import cut_lineage

# Fixed values of the data model, down to the leakage columns. Candidate keys by table.
CANDIDATE_KEYS = {
    "orders": ["order_id"],
    "customers": ["customer_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id", "order_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "product_category_translation": ["product_category_name"],
}

# Child table, child key, parent table, parent key.
RELATIONSHIPS = (
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("order_payments", "order_id", "orders", "order_id"),
    ("order_reviews", "order_id", "orders", "order_id"),
)

# Columns known only after the prediction point.
LEAKAGE_COLUMNS = (
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "actual_delivery_days",
    "review_count",
    "review_score_mean",
    "review_score_min",
    "review_score_max",
    "has_review_comment",
    "delay_days",
)


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns."""
    return reduce(DataFrame.unionByName, frames)


#: Fingerprints that occur more than once up to which the rows that have them are found without moving the table.
REPEATED = 500_000


def fingerprint(df: DataFrame) -> list[Column]:
    """Two hashes of a whole row, which equal rows share; nulls are told apart by their place."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    nulls = [c.isNull() for c in columns]
    return [F.xxhash64(F.lit(seed), *columns, *nulls).alias(f"_h{seed}") for seed in (1, 2)]


def repeated_rows(df: DataFrame) -> DataFrame:
    """Distinct whole rows that occur more than once, with their number ``_n``.

    Rows are counted by 16 bytes first; only rows whose fingerprint came up again
    are compared as a whole.
    """
    marks = ["_h1", "_h2"]
    again = cut_lineage(df.select(*fingerprint(df)).groupBy(*marks).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select(*marks))
    few = again.limit(REPEATED + 1).count() <= REPEATED
    marked = df.select("*", *fingerprint(df)).join(F.broadcast(again) if few else again, marks, "left_semi")
    return marked.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")


def table_overview(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and later copies of whole rows, per table."""

    def one(name: str, df: DataFrame) -> DataFrame:
        later = repeated_rows(df).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("later"))
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("rows"),
            F.lit(len(df.columns)).cast("bigint").alias("columns"),
        ).withColumn("full_row_duplicates", later.scalar())

    return stack([one(name, df) for name, df in tables.items()])


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return stack([df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")) for name, df in tables.items()])


def describe_table(name: str, df: DataFrame) -> DataFrame:
    """Column names and types of a table."""
    rows = [(name, i, column, dtype) for i, (column, dtype) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "table_name STRING, position INT, column STRING, dtype STRING")


def sample_rows(df: DataFrame, key: Sequence[str], rows: int = 3) -> DataFrame:
    """First rows by key."""
    return df.orderBy(*key).limit(rows)


def key_check(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Unique keys, later copies of a key, and rows with a null key part.

    Grouping by the key combines rows before the shuffle, so a key that many
    rows share costs one row per task. Null keys count as equal.
    """
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(
        F.lit(name).alias("table_name"),
        F.lit(" + ".join(keys)).alias("candidate_key"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("unique_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0)).alias("missing_key_rows"),
    )


def multiplicity(df: DataFrame, key: str, name: str) -> DataFrame:
    """How many rows one key has."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("orders"),
        (F.sum("_n") / F.count(F.lit(1))).alias("mean_rows_per_order"),
        F.count_if(F.col("_n") > 1).alias("orders_with_multiple_rows"),
        F.max("_n").alias("max_rows_per_order"),
    )


def orphan_rows(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct child keys without a parent, with their number of rows.

    Child keys are counted before the join, so a hot key joins once.
    """
    keys = child.filter(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_key")).agg(F.count(F.lit(1)).alias("child_rows"))
    parents = parent.select(F.col(parent_key).alias("_key"))
    return keys.join(parents, "_key", "left_anti")


def orphans(tables: Mapping[str, DataFrame], relationships=RELATIONSHIPS) -> DataFrame:
    """Child rows without a parent, for each relationship."""

    def one(child: str, child_key: str, parent: str, parent_key: str) -> DataFrame:
        return orphan_rows(tables[child], child_key, tables[parent], parent_key).agg(
            F.lit(f"{child}.{child_key} -> {parent}.{parent_key}").alias("relationship"),
            F.coalesce(F.sum("child_rows"), F.lit(0)).alias("missing_references"),
        )

    return stack([one(*r) for r in relationships])


def grain_report(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows and distinct keys of a table, and whether they are equal."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("unique_keys"),
        (F.coalesce(F.max("_n"), F.lit(0)) <= 1).alias("one_row_per_key"),
    )


def assert_grains(tables: Sequence[tuple[DataFrame, Sequence[str], str]]) -> None:
    """Raise unless every table has one row per key; one job for all of them."""
    reports = [grain_report(df, keys, name).select("rows", "unique_keys", "one_row_per_key", F.lit(i).alias("_at")) for i, (df, keys, name) in enumerate(tables)]
    bad = reduce(DataFrame.unionAll, reports).where(~F.col("one_row_per_key")).orderBy("_at").first()
    if bad:
        _, keys, name = tables[bad["_at"]]
        raise GrainError(f"{name}: {bad['rows']} rows but {bad['unique_keys']} keys {list(keys)}")


def assert_grain(df: DataFrame, keys: Sequence[str], name: str = "table") -> None:
    """Raise unless the table has one row per key."""
    assert_grains([(df, keys, name)])


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing count and percent of each column, from one pass."""
    n = F.count(F.lit(1))
    row = df.agg(n.alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return row.unpivot(["_rows"], list(columns), "column_name", "missing").select(
        "column_name", "missing", (F.col("missing") / F.col("_rows") * 100).alias("missing_pct")
    )


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in required if c not in have]


def assert_no_leakage(columns: Sequence[str], leakage: Sequence[str] = LEAKAGE_COLUMNS) -> None:
    """Raise when a selected feature is known only after the prediction point."""
    leaked = sorted(set(columns) & set(leakage))
    if leaked:
        raise LeakageError(f"features not known at the prediction point: {leaked}")


def without_leakage(df: DataFrame, leakage: Sequence[str] = LEAKAGE_COLUMNS) -> DataFrame:
    return df.drop(*leakage)


def column_kinds(
    df: DataFrame,
    id_columns: Sequence[str] = ("order_id", "customer_id", "customer_unique_id"),
    geo_code_columns: Sequence[str] = ("customer_zip_code_prefix",),
) -> dict[str, list[str]]:
    """Columns by kind; ids and geo codes are also in their type's list."""
    kinds: dict[str, list[str]] = {
        "id": [c for c in id_columns if c in df.columns],
        "geo_code": [c for c in geo_code_columns if c in df.columns],
        "numeric": [],
        "categorical": [],
        "datetime": [],
    }
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            kinds["numeric"].append(f.name)
        elif isinstance(f.dataType, T.StringType):
            kinds["categorical"].append(f.name)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            kinds["datetime"].append(f.name)
    return kinds


def dtype_histogram(df: DataFrame) -> DataFrame:
    """Number of columns per data type."""
    rows = [(dtype,) for _, dtype in df.dtypes]
    return df.sparkSession.createDataFrame(rows, "dtype STRING").groupBy("dtype").agg(F.count(F.lit(1)).alias("column_count"))


def later_copies(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Rows after the first of their key, in the given order.

    The first row per key is found by a minimum over the order columns, which
    combines before the shuffle; a hot key is never sorted in one task. The
    order columns must tell the rows of a key apart, exact copies aside: of
    equal rows all but one are copies.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    order = F.struct(*[F.col(c) for c in order_by])
    first = counted.groupBy(*keys).agg(F.min(order).alias("_first"))
    on = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys])
    marked = counted.alias("r").join(first.alias("f"), on).select(
        *[F.col(f"r.{c}") for c in columns],
        (F.col("_copies") - F.when(F.struct(*[F.col(f"r.{c}") for c in order_by]).eqNullSafe(F.col("_first")), 1).otherwise(0)).alias("later_copies"),
    )
    return marked.filter(F.col("later_copies") > 0)


def distinct_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct key rows."""
    return df.select(*keys).distinct()
