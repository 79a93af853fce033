"""Scoring of order files as they arrive. Stateless, so any file can be re-scored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from deliverylens.operators.score import check_contract, mark_lines, score_rows, split_marked, with_version
from deliverylens.session import short_lived_shuffles
from deliverylens.sources.bundle import Bundle
from deliverylens.sources.orders_file import ORDER_FIELDS, ORDER_SCHEMA

_TEXT_SCHEMA = ", ".join(f"{c} STRING" for c in ORDER_FIELDS)
SCORED_SCHEMA = "order_id STRING, late_probability DOUBLE, predicted_is_late INT, model_version STRING"
REJECTED_SCHEMA = "line STRING, reasons ARRAY<STRING>"


def read_order_stream(spark: SparkSession, path: str, file_format: str = "json", files_per_batch: int = 1000) -> DataFrame:
    """Order records of new files in a folder (JSON Lines, CSV with header, or Parquet).

    Fields of text formats stay text, so that the contract sees a value that is no
    number. A CSV file with another column order fails.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    if file_format == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.schema(ORDER_SCHEMA if file_format == "parquet" else _TEXT_SCHEMA).format(file_format).load(path)


def read_order_lines(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The lines of new JSON Lines files in a folder, as they are."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def scored_stream(orders: DataFrame, bundle: Bundle) -> DataFrame:
    """Valid records, scored, with the model version."""
    valid, _ = check_contract(orders)
    return with_version(score_rows(valid, bundle), bundle)


def rejected_stream(orders: DataFrame) -> DataFrame:
    """The other records, each with the reasons for which it is not scored."""
    return check_contract(orders)[1]


def start_scoring(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        scored.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_scoring_lines(
    lines: DataFrame, bundle: Bundle, scored: str, rejected: str, checkpoint: str, partitions: int | None = None
) -> StreamingQuery:
    """Score lines as they arrive: every line that is not blank ends in exactly one of two folders.

    A batch is checked and written once, and both sinks come from what was written.
    Each batch has a folder of its own in both, which is replaced when the batch
    runs again after a failure, so nothing is lost or doubled. ``partitions`` is for
    batches of few compressed files, each of which one task reads: the lines of a
    batch are dealt to so many.
    """
    spark = lines.sparkSession
    for path, schema in ((scored, SCORED_SCHEMA), (rejected, REJECTED_SCHEMA)):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/batch=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = f"{checkpoint}-checked"
        dealt = batch if partitions is None else batch.repartition(partitions)
        with short_lived_shuffles(batch.sparkSession):
            mark_lines(dealt).write.mode("overwrite").parquet(checked)
        valid, bad = split_marked(batch.sparkSession.read.parquet(checked))
        with_version(score_rows(valid, bundle), bundle).write.mode("overwrite").parquet(f"{scored}/batch={batch_id}")
        bad.select("line", "reasons").write.mode("overwrite").parquet(f"{rejected}/batch={batch_id}")

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def scored_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{SCORED_SCHEMA}, batch BIGINT").parquet(path)


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{REJECTED_SCHEMA}, batch BIGINT").parquet(path)
