"""Operator 6: document fingerprints from the quartiles of hashed byte triplets.

Every three neighbouring bytes are hashed to one of ``BUCKETS`` counters. The
fingerprint holds the quartile of each counter among all (two bits each) and a
code of the length on a logarithmic scale; equal texts have equal fingerprints.
Two fingerprints differ by the steps between their quartile codes and, at most
``LENGTH_WEIGHT``, by their lengths; the likeness is one minus the difference over
the largest that can be.

``edit_chain`` compares every text with the next one in descending order of ids.
Spark deals and sorts the documents by ranges of ids, a task streams its
neighbours, and only the first and last document of each range meet in a second
small step, so the order never passes through one task.

Defined cases: a null text is empty; the empty text has no triplets and the
code of length 0; null ids come after all others; documents with equal ids
follow one another in the order of their texts; a single document is its own next.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from deliverylens.llm.common import as_bytes, parts_for, ship, small_batches, text_size
from deliverylens.session import run_dir

ship(__name__)

BUCKET_BITS = 10
BUCKETS = 1 << BUCKET_BITS
LENGTH_WEIGHT = 0.1  # part of the likeness that the length decides


def codes(text: bytes) -> np.ndarray:
    """Quartile code (0 to 3) of every bucket."""
    x = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(x) < 3:
        return np.zeros(BUCKETS, np.uint8)
    h = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    h = (h ^ np.uint32(0x5BD1E9)) * np.uint32(0x9E3779B1)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    counts = np.bincount((h >> np.uint32(32 - BUCKET_BITS)).astype(np.int64), minlength=BUCKETS)
    ranked = np.sort(counts)
    q1, q2, q3 = (ranked[BUCKETS * k // 4 - 1] for k in (1, 2, 3))
    return ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).astype(np.uint8)


def length_code(n: int) -> int:
    return 0 if n == 0 else min(255, 1 + int(8 * math.log2(n)))


def fingerprint(text: bytes) -> str:
    """Two hex digits of length, then four buckets in each two digits."""
    c = codes(text).reshape(-1, 4)
    packed = (c[:, 0] << 6) | (c[:, 1] << 4) | (c[:, 2] << 2) | c[:, 3]
    return f"{length_code(len(text)):02x}" + packed.astype(np.uint8).tobytes().hex()


def unpacked(print_: str) -> tuple[int, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex(print_), np.uint8)
    body = raw[1:, None] >> np.array([6, 4, 2, 0], np.uint8) & 3
    return int(raw[0]), body.ravel().astype(np.int16)


def likeness(a: str, b: str) -> float:
    """From 0 to 1; 1 for equal fingerprints."""
    (la, ca), (lb, cb) = unpacked(a), unpacked(b)
    steps = float(np.abs(ca - cb).sum()) / (3 * BUCKETS)
    return 1.0 - (1 - LENGTH_WEIGHT) * steps - LENGTH_WEIGHT * min(abs(la - lb), 16) / 16


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the following text."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


DIGEST_FIELDS = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def compared(text: bytes, own: str, following: bytes, next_print: str) -> tuple:
    chars = text.decode()
    other = edited(chars, following.decode()).encode()
    other_print = fingerprint(other)
    return len(chars), hashlib.sha256(other).hexdigest(), own, other_print, likeness(own, other_print), likeness(own, next_print)


def digest_batch(rests: list, rows: list[tuple], extra: dict) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())
    names = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    columns = list(zip(*rows)) if rows else [()] * len(names)
    columns = [[v if v is None else bytes.fromhex(v) for v in c] if k == pa.binary() else c for c, k in zip(columns, kinds)]
    return pa.record_batch({"rest": pa.array(rests), **{n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)}, **extra})


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of all documents of a sorted range but the last; and one row with its first and last text."""
    from pyspark import TaskContext

    here = TaskContext.get().partitionId()
    first = last = None
    for batch in batches:
        texts = batch.column("bytes").to_pylist()
        if not texts:
            continue
        rests = batch.column("rest")
        prints = [fingerprint(t) for t in texts]
        rows = [compared(a, p, b, q) for a, p, b, q in zip(texts, prints, texts[1:], prints[1:])]
        whole = rests.slice(0, len(rows))
        if last is not None:
            rows.insert(0, compared(last[1], last[2], texts[0], prints[0]))
            whole = pa.concat_arrays([last[0], whole])
        else:
            first = texts[0]
        if rows:
            none = pa.nulls(len(rows), pa.binary())
            yield with_rest(whole, rows, pa.array([-1] * len(rows), pa.int32()), none, none)
        last = rests.slice(len(texts) - 1, 1), texts[-1], prints[-1]
    if last is not None:
        yield with_rest(last[0], [(None,) * 6], pa.array([here], pa.int32()), pa.array([first], pa.binary()), pa.array([last[1]], pa.binary()))


def with_rest(rest: pa.Array, rows: list[tuple], part: pa.Array, first: pa.Array, last: pa.Array) -> pa.RecordBatch:
    made = digest_batch([None] * len(rows), rows, {"part": part, "first": first, "last": last})
    return pa.record_batch([rest, *made.columns[1:]], names=["rest", *made.schema.names[1:]])


def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("last").to_pylist(), batch.column("following").to_pylist())
        rows = [compared(a, fingerprint(a), b, fingerprint(b)) for a, b in pairs]
        made = digest_batch([None] * len(rows), rows, {})
        yield pa.record_batch([batch.column("rest"), *made.columns[1:]], names=["rest", *made.schema.names[1:]])


def edit_chain(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Other columns of the documents in ``rest``, fingerprints of each text and of its edited text, and likenesses."""
    spark = docs.sparkSession
    small_batches(spark)
    _, total = text_size(docs, text_column)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_column)).alias("rest"), F.col(id_column).cast("long").alias("ord"), as_bytes(text_column).alias("bytes"))
    order = F.col("ord").desc_nulls_last()
    dealt = rows.repartitionByRange(parts_for(spark, total), order).sortWithinPartitions(order, "bytes")
    path = run_dir(spark, "digests")
    found = StructType.fromDDL(DIGEST_FIELDS)
    fields = StructType([rows.schema["rest"], *found])
    whole = StructType([*fields, *StructType.fromDDL("part int, first binary, last binary")])
    dealt.select("rest", "bytes").mapInArrow(neighbours, whole).write.parquet(path)
    made = spark.read.parquet(path)
    # One row for each range that has documents; the next range's first text follows, after the last the first.
    ends = made.where("part >= 0").select("rest", "part", "last")
    firsts = made.where("part >= 0").select("part", F.col("first").alias("following"))
    parts = sorted(r["part"] for r in firsts.select("part").collect())
    turn = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    pairs = ends.join(turn, "part").join(firsts.withColumnRenamed("part", "next_part"), "next_part")
    late = pairs.select("rest", "last", "following").mapInArrow(across, fields)
    both = made.where("part < 0").select(*fields.names).union(late)
    # Bytes are written, text is returned.
    return both.select("rest", *(F.lower(F.hex(f.name)).alias(f.name) if f.dataType == BinaryType() else f.name for f in found))
