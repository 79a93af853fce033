"""Operator 5: cross-entropy difference of a target and a background n-gram model.

Both models are bigram models over one vocabulary: every word of all documents.
Counts of the background are scaled to the size of the target, and both add ``ADD``
to each bigram, so they differ in what they have seen only. A document's score is
the mean over its tokens of the target's loss minus the background's; low scores
resemble the target.

1. Words are 64-bit hashes, so no task holds a vocabulary; one aggregate counts the
   distinct words and the tokens of both models. Bigrams and contexts (the word
   before a token, or the start of a text) are keys of 63 hashed bits and one bit
   for their kind.
2. Keys that a sample shows to be frequent (``HOT`` at most) are counted exactly
   over all documents and go to all tasks, so no bucket gets a row for every
   document. ``HOT`` bounds what is broadcast, not what is counted.
3. All other keys are sent, packed by blocks of documents, to the bucket of the key.
   There they are counted over all documents, and each packed row is answered by one
   packed row with its documents' shares of both losses. The answers are dealt out
   by block and added up. Nothing is dropped, merged or capped.

Defined cases: null and empty texts have no tokens and a null score; a null mark
of the target counts as background; rows with equal id and text share one
score; without target documents all scores compare with an empty target.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.llm.common import U64, Powers, as_bytes, group_starts, mix, parts_for, prefix_hash, ship, small_batches, text_size

ship(__name__)

HOT = 1 << 15
ADD = 0.1
SAMPLE_BYTES = 32 << 20
FLUSH = 1_000_000
START = U64(0)  # the context of a text's first token
CONTEXT = U64(1)  # the bit that tells contexts from bigrams

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(text: bytes, powers: Powers) -> np.ndarray:
    data = _LOWER[np.frombuffer(text, np.uint8)]
    word = np.concatenate([[False], ~_SPACE[data], [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, U64)
    p = prefix_hash(data, powers)
    return mix((p[end] - p[start]) * powers.up[start])


def summed(keys: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with their counts in target and background."""
    order = np.argsort(keys, kind="stable")
    keys, target = keys[order], target[order].astype(np.int64)
    start = group_starts(keys)
    size = np.diff(np.append(start, len(keys)))
    t = np.add.reduceat(target, start) if len(start) else np.zeros(0, np.int64)
    return keys[start], t, size - t


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers, got, marks, held = Powers(), [], [], 0

    def out() -> pa.RecordBatch:
        k, t, b = summed(np.concatenate(got), np.concatenate(marks))
        return pa.record_batch({"k": pa.array(k.view(np.int64)), "t": pa.array(t), "b": pa.array(b)})

    for batch in batches:
        for text, mark in zip(batch.column("bytes").to_pylist(), batch.column("target").to_pylist()):
            w = word_hashes(text, powers)
            got.append(w)
            marks.append(np.full(len(w), mark, bool))
            held += len(w)
        if held > FLUSH:
            yield out()
            got, marks, held = [], [], 0
    if held:
        yield out()


def keys_of(text: bytes, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the contexts and of the bigrams of a text's tokens."""
    w = word_hashes(text, powers)
    if not len(w):
        return w, w
    before = np.concatenate([np.array([START]), w[:-1]])
    return mix(before) | CONTEXT, mix(before * U64(3) + mix(w)) & ~CONTEXT


def places(hot: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted array, and whether they are in it."""
    if not len(hot):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
    return at, hot[at] == keys


def key_counts(wanted):
    """(k, t, b) of bigrams and contexts: all, or those of a sorted array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, got, marks, held = Powers(), [], [], 0
        only = None if wanted is None else wanted.value

        def out() -> pa.RecordBatch:
            k, t, b = summed(np.concatenate(got), np.concatenate(marks))
            return pa.record_batch({"k": pa.array(k.view(np.int64)), "t": pa.array(t), "b": pa.array(b)})

        for batch in batches:
            for text, mark in zip(batch.column("bytes").to_pylist(), batch.column("target").to_pylist()):
                keys = np.concatenate(keys_of(text, powers))
                if only is not None:
                    keys = keys[places(only, keys)[1]]
                got.append(keys)
                marks.append(np.full(len(keys), mark, bool))
                held += len(keys)
            if held > FLUSH:
                yield out()
                got, marks, held = [], [], 0
        if got:
            yield out()

    return run


def losses(keys: np.ndarray, t: np.ndarray, b: np.ndarray, scale: float, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits that keys add under the target and the scaled background; contexts are divisors, so theirs are negative losses."""
    context = (keys & CONTEXT).astype(bool)
    add, sign = np.where(context, ADD * words, ADD), np.where(context, 1.0, -1.0)
    return sign * np.log2(t + add), sign * np.log2(b * scale + add)


ENTRY_SCHEMA = "bucket int, block long, docs binary, tokens binary, bits binary, sizes binary, pairs binary, times binary, marks binary"
ANSWER_SCHEMA = "block long, docs binary, tokens binary, bits binary"
SHARE_SCHEMA = "key long, tokens long, target_bits double, background_bits double"


def scored_entries(hot, n_buckets: int, scale: float, words: int):
    """Packed rows of a block of documents: what the task knows of their losses, and by bucket the keys to look up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, hot_t, hot_b = hot.value
        ht, hb = losses(keys, hot_t, hot_b, scale, words)
        powers = Powers()
        known: list[tuple[int, int, float, float]] = []
        rows: list[tuple[int, bool, np.ndarray, np.ndarray]] = []
        held = 0

        def packed() -> pa.RecordBatch:
            ids, tokens, t, b = zip(*known)
            block = ids[0]  # deals the answers out; the sums go by document
            out: dict[str, list] = {c: [] for c in ("bucket", "docs", "tokens", "bits", "sizes", "pairs", "times", "marks")}

            def add(**row) -> None:
                for c, v in out.items():
                    v.append(row.get(c))

            add(bucket=block % n_buckets, docs=np.array(ids, np.int64).tobytes(), tokens=np.array(tokens, np.int64).tobytes(), bits=np.array([t, b]).tobytes())
            if rows:
                size = np.array([len(r[2]) for r in rows])
                pairs, times = np.concatenate([r[2] for r in rows]), np.concatenate([r[3] for r in rows])
                doc = np.repeat(np.arange(len(rows)), size)
                bucket = (mix(pairs) % U64(n_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")  # by document and key already
                pairs, times, doc, bucket = pairs[order], times[order], doc[order], bucket[order]
                at = group_starts(bucket)
                ids, marks = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.uint8)
                for a, z in zip(at, np.append(at[1:], len(bucket))):
                    first = group_starts(doc[a:z])
                    own = doc[a:z][first]
                    sizes = np.diff(np.append(first, z - a)).astype(np.uint32)
                    add(bucket=int(bucket[a]), docs=ids[own].tobytes(), sizes=sizes.tobytes(), pairs=pairs[a:z].tobytes(), times=times[a:z].astype(np.uint16).tobytes(), marks=marks[own].tobytes())
            return pa.record_batch({"bucket": pa.array(out.pop("bucket"), pa.int32()), "block": pa.array(np.full(len(out["docs"]), block)), **{c: pa.array(v, pa.binary()) for c, v in out.items()}})

        for batch in batches:
            for key, text, mark in zip(*(batch.column(c).to_pylist() for c in ("key", "bytes", "target"))):
                context, pairs = keys_of(text, powers)
                both = np.concatenate([context, pairs])
                at, found = places(keys, both)
                known.append((key, len(pairs), float(ht[at[found]].sum()), float(hb[at[found]].sum())))
                rest = both[~found]
                while len(rest):
                    part, rest = rest[:65535], rest[65535:]  # so that counts fit
                    own, times = np.unique(part, return_counts=True)
                    rows.append((key, bool(mark), own, times))
                    held += len(own)
            if held > FLUSH:
                yield packed()
                known.clear()
                rows.clear()
                held = 0
        if known:
            yield packed()

    return run


def looked_up(scale: float, words: int):
    """One packed answer for each packed row: its documents' losses, from counts over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, list[np.ndarray]] = {c: [] for c in ("docs", "marks", "sizes", "pairs", "times")}
        kinds = {"docs": np.int64, "marks": np.uint8, "sizes": np.uint32, "pairs": U64, "times": np.uint16}
        blocks: list[int] = []
        for batch in batches:
            asks = batch.column("pairs").is_valid()
            yield batch.filter(pc.invert(asks)).select(["block", "docs", "tokens", "bits"])
            batch = batch.filter(asks)
            blocks += batch.column("block").to_pylist()
            for c, kind in kinds.items():
                got[c] += [np.frombuffer(x, kind) for x in batch.column(c).to_pylist()]
        if not blocks:
            return
        docs = got["docs"]
        marks, sizes, pairs, times = (np.concatenate(got.pop(c)) for c in ("marks", "sizes", "pairs", "times"))
        first = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))[:-1]])
        mark = np.repeat(marks, sizes).astype(np.int64)
        order = np.argsort(pairs, kind="stable")
        start = group_starts(pairs[order])
        size = np.diff(np.append(start, len(order)))
        n = times[order].astype(np.int64)
        t = np.add.reduceat(n * mark[order], start)
        b = np.add.reduceat(n, start) - t
        lt, lb = losses(pairs[order][start], t, b, scale, words)
        bits = np.empty((2, len(order)))
        bits[0, order], bits[1, order] = np.repeat(lt, size) * n, np.repeat(lb, size) * n
        total = np.add.reduceat(bits, first, axis=1)
        at = 0
        for block, own in zip(blocks, docs):
            answer = total[:, at : at + len(own)]
            at += len(own)
            yield pa.record_batch({"block": pa.array([block], pa.int64()), "docs": pa.array([own.tobytes()], pa.binary()), "tokens": pa.array([None], pa.binary()), "bits": pa.array([answer.tobytes()], pa.binary())})

    return run


def added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the answers to the blocks of a task, a row for each document."""
    got: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def compact() -> tuple[np.ndarray, np.ndarray]:
        docs, values = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got], axis=1)
        order = np.argsort(docs, kind="stable")
        start = group_starts(docs[order])
        return docs[order][start], np.add.reduceat(values[:, order], start, axis=1)

    for batch in batches:
        for docs, tokens, bits in zip(*(batch.column(c).to_pylist() for c in ("docs", "tokens", "bits"))):
            ids = np.frombuffer(docs, np.int64)
            n = np.zeros(len(ids)) if tokens is None else np.frombuffer(tokens, np.int64).astype(float)
            got.append((ids, np.vstack([n, np.frombuffer(bits, float).reshape(2, -1)])))
            held += len(ids)
            if held > FLUSH:
                got = [compact()]
                held = 0
    if got:
        docs, (n, t, b) = compact()
        yield pa.record_batch({"key": pa.array(docs), "tokens": pa.array(n.astype(np.int64)), "target_bits": pa.array(t), "background_bits": pa.array(b)})


def score(docs: DataFrame, target: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, tokens, target_bits, background_bits, score) per document; bits are means over the tokens."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    small_batches(spark)
    _, total = text_size(docs, text_column)
    n_parts = parts_for(spark, total)
    keyed = docs.select(F.col(id_column).alias("id"), F.xxhash64(id_column, text_column).alias("key"), as_bytes(text_column).alias("bytes"), F.coalesce(target, F.lit(False)).alias("target"))

    counts = keyed.select("bytes", "target").mapInArrow(word_counts, "k long, t long, b long").groupBy("k").agg(F.sum("t").alias("t"), F.sum("b").alias("b"))
    whole = counts.agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("t"), F.sum("b").alias("b")).first()
    words = whole["n"] + 2  # and the start and a word that no text has
    scale = whole["t"] / whole["b"] if whole["t"] and whole["b"] else 1.0

    share = min(1.0, SAMPLE_BYTES / max(total, 1))
    some = keyed.where(F.pmod("key", F.lit(1_000_000)) < int(share * 1_000_000) + 1).select("bytes", "target")
    often = some.mapInArrow(key_counts(None), "k long, t long, b long").groupBy("k").agg(F.sum(F.col("t") + F.col("b")).alias("n"))
    top = np.array([r["k"] for r in often.orderBy(F.desc("n"), "k").limit(HOT).collect()], np.int64)
    wanted = np.sort(top.view(U64))
    exact = keyed.select("bytes", "target").mapInArrow(key_counts(sc.broadcast(wanted)), "k long, t long, b long")
    found = {r["k"]: (r["t"], r["b"]) for r in exact.groupBy("k").agg(F.sum("t").alias("t"), F.sum("b").alias("b")).collect()}
    sums = np.array([found[int(k)] for k in wanted.view(np.int64)], np.float64).reshape(-1, 2)

    hot = sc.broadcast((wanted, sums[:, 0], sums[:, 1]))
    # Rows with equal id and text are one document below; their counts stay those of all rows.
    entries = keyed.select("key", "bytes", "target").mapInArrow(scored_entries(hot, n_parts, scale, words), ENTRY_SCHEMA)
    answers = entries.repartitionById(n_parts, F.col("bucket")).mapInArrow(looked_up(scale, words), ANSWER_SCHEMA)
    shares = answers.repartition(n_parts, "block").mapInArrow(added_up, SHARE_SCHEMA)
    sums = shares.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("tokens", "target_bits", "background_bits")))
    mean = {c: F.when(F.col("tokens") > 0, F.col(c) / F.col("tokens")).alias(c) for c in ("target_bits", "background_bits")}
    # Repeated rows add up alike in bits and tokens, so their means are those of one row.
    return keyed.select("id", "key").join(sums, "key").select(F.col("id").alias(id_column), "tokens", *mean.values(), (mean["target_bits"] - mean["background_bits"]).alias("score"))
