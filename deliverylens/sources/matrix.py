"""Feature vectors, labels and ids of the splits as one Parquet table per split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from deliverylens.operators.prep import Preprocessor, check_features, transform
from deliverylens.sources.tables import write_checked


def write_matrix(df: DataFrame, prep: Preprocessor, path: str, key: str = "order_id", label: str = "is_late") -> DataFrame:
    """Transform, write and re-read one split; row count, key and width are checked."""
    saved = write_checked(transform(df, prep, [key, label]), path, key, (label,))
    check_features(saved, prep)
    return saved


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
