"""Helpers that several operators share."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

U64 = np.uint64
#: An odd multiplier and its inverse modulo 2**64, for prefix hashes.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2**64)
NO_ID = 2**63 - 1
BATCH_ROWS = 1000


def ship(module_name: str) -> None:
    """Send the functions of a module to workers by value, so they need no import path."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


def text_size(docs: DataFrame, column: str = "text") -> tuple[int, int]:
    """Rows and text bytes of a table, from one pass over the column."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(column)).alias("b")).first()
    return row["n"], row["b"] or 0


def small_batches(spark) -> None:
    """Let tasks hand texts to Python in batches of about a thousand rows, to bound a worker's memory."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(rows, "10000")) > BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)


def parts_for(spark, n_bytes: int, per_part: int = 12 << 20) -> int:
    """Partitions for so many bytes: the session's number or more, so that each stays small."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // per_part), 1)


def order_key(column: str = "doc_id") -> Column:
    """A document id for comparisons; a null id counts as the largest."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def quoted(name: str) -> Column:
    """A column by its whole name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def others(docs: DataFrame, text_column: str) -> Column:
    """All columns but the text, as the struct ``rest``, which keeps them apart from an operator's own."""
    found = [quoted(c) for c in docs.columns if c != text_column]
    return (F.struct(*found) if found else F.struct(F.lit(None).cast("int").alias("none"))).alias("rest")


def beside_rest(rows: DataFrame, fields: str) -> StructType:
    """Schema of ``rest`` with an operator's own fields."""
    return StructType([rows.schema["rest"], *StructType.fromDDL(fields)])


def as_bytes(column: str = "text") -> Column:
    """A text's UTF-8 bytes; a null text has none."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def mix(h: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit hashes."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


class Powers:
    """Powers of the base and of its inverse, made longer as longer texts come."""

    def __init__(self) -> None:
        self.size = 0
        self.up = self.down = np.ones(0, U64)

    def reach(self, n: int) -> None:
        if n > self.size:
            self.size = max(n, 1 << 16, 2 * self.size)
            self.up = np.cumprod(np.full(self.size, BASE, U64))
            self.down = np.cumprod(np.full(self.size, BASE_INVERSE, U64))


def prefix_hash(data: np.ndarray, powers: Powers) -> np.ndarray:
    """Prefix sums from which the hash of any stretch [i, j) is (p[j] - p[i]) * up[i]."""
    powers.reach(len(data) + 1)
    out = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * powers.down[: len(data)], out=out[1:])
    return out


def group_starts(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))
