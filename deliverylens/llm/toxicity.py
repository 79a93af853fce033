"""Operator 10: toxicity by compression distance, with two zstandard dictionaries.

Both dictionaries share the commonest strings of ordinary text. The toxic one
also holds strings that labelled toxic texts favour, the ordinary one those that
ordinary texts favour (a two-sample z of document shares, strings of the start of
a word up to the whole word). A window is one word with its delimiters, or one of
the overlapping pieces of a word beyond ``PIECE`` bytes: window
by window the text is compressed with either dictionary, and the bytes that the
toxic one saves are the window's gain. Zstandard neither finds matches in the last
eight bytes of its input, nor of a dictionary, and stores what it would hardly
shorten as it is. So a window stands between two strings that both dictionaries
hold, and both dictionaries end in a filling; otherwise words under seven letters
and the string that toxic texts favour most would never gain. The mean gain beyond
chance, the largest gain and the share
of windows above a threshold are calibrated by a logistic fit on labelled rows.

Both the strings and the fit use at most ``max_labelled`` labelled rows of each
label, drawn by a hash of the id; scoring reads every whole text in one pass
without a shuffle. Words that return within a task are compressed once.

Defined cases: null and empty texts have no window and get the score of no
gain; null labels are not learned from; without documents of both labels all
scores are 0; other columns of any name are carried in ``rest``.
"""

from __future__ import annotations

import math
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.llm.common import as_bytes, beside_rest, others, ship, small_batches
from deliverylens.session import run_dir

ship(__name__)

MAX_LABELLED = 6000
SEGMENT_BYTES = 1500  # of the strings that one class favours
COMMON_BYTES = 8192
LEAST_Z, LEAST_DOCS = 4.0, 3
PIECE = 32  # bytes of a window at most; longer words are cut into pieces that overlap by half
FILLING = b" and the with that from "  # ends both dictionaries, and stands behind a window where they share little
LEAD, TAIL = slice(400, 416), slice(200, 224)  # of what both dictionaries begin with: before and behind a window
CHANCE = 2  # bytes that a window gains by chance
KNOWN_WORDS = 300_000  # gains a task remembers before it starts anew

#: A word is a run of letters, digits and bytes beyond ASCII.
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    """The windows of a text; all of its words are in them."""
    out = []
    for w in WORD.findall(text.lower()):
        if len(w) <= PIECE:
            out.append(w)
        else:
            out += [w[i : i + PIECE] for i in range(0, len(w) - PIECE // 2, PIECE // 2)]
    return out


def strings(words: list[bytes]) -> set[bytes]:
    """Starts of the words, from four bytes on, with the delimiters."""
    out = set()
    for w in set(words):
        x = b" " + w + b" "
        out.update(x[:k] for k in range(5, len(x) + 1))
    return out


def string_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(string, toxic documents, ordinary documents) of a task."""
    counts = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column("bytes").to_pylist(), batch.column("label").to_pylist()):
            counts[label].update(strings(words_of(text)))
    keys = list(counts[0] | counts[1])
    yield pa.record_batch({"string": pa.array(keys, pa.binary()), "toxic": pa.array([counts[1][k] for k in keys], pa.int64()), "ordinary": pa.array([counts[0][k] for k in keys], pa.int64())})


def chosen(ranked: list[bytes]) -> bytes:
    """The first strings that fit, without those that another holds; the best stand last, where matches are nearest."""
    out: list[bytes] = []
    for s in ranked:
        if any(s in o for o in out):
            continue
        out = [o for o in out if o not in s] + [s]
        if sum(map(len, out)) > SEGMENT_BYTES:
            break
    return b"".join(out[::-1])


class Gains:
    """Bytes that the toxic dictionary saves on a word, over the ordinary one."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        setting = zstandard.ZstdCompressionParameters(
            window_log=15, hash_log=14, chain_log=14, search_log=6, min_match=4, strategy=zstandard.STRATEGY_LAZY2, target_length=64,
            write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )

        def compressor(content: bytes) -> zstandard.ZstdCompressor:
            book = zstandard.ZstdCompressionDict(content + FILLING, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            book.precompute_compress(compression_params=setting)
            return zstandard.ZstdCompressor(dict_data=book, compression_params=setting)

        self.toxic, self.ordinary = compressor(toxic), compressor(ordinary)
        shared = os.path.commonprefix([toxic, ordinary])
        self.lead, self.tail = (shared[LEAD], shared[TAIL]) if len(shared) >= LEAD.stop else (b"", FILLING)
        self.known: dict[bytes, int] = {}

    def of(self, word: bytes) -> int:
        gain = self.known.get(word)
        if gain is None:
            window = self.lead + b" " + word + b" " + self.tail
            gain = len(self.ordinary.compress(window)) - len(self.toxic.compress(window))
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            self.known[word] = gain
        return gain

    def features(self, text: bytes) -> tuple[float, ...]:
        times = Counter(words_of(text))
        if not times:
            return 0.0, 0.0, 0.0, 0.0
        n = sum(times.values())
        gains = [(self.of(w), k) for w, k in times.items()]
        total = sum(max(g - CHANCE, 0) * k for g, k in gains)
        high, higher = (sum(k for g, k in gains if g >= t) for t in (4, 6))
        return 100 * total / (n + 20), min(max(g for g, _ in gains), 12) / 4, high / math.sqrt(n + 20), higher / math.sqrt(n + 20)


def featured(toxic: bytes, ordinary: bytes, keep: list[str], weights: list[float] | None):
    """Rows with the features of their texts, or with the score where weights are given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(toxic, ordinary)
        for batch in batches:
            x = np.array([gains.features(t) for t in batch.column("bytes").to_pylist()]).reshape(-1, 4)
            columns = {c: batch.column(c) for c in keep}
            if weights is None:
                columns |= {f"x{i}": pa.array(x[:, i]) for i in range(4)}
            else:
                columns["score"] = pa.array(logistic(design(x) @ np.array(weights)))
            yield pa.record_batch(columns)

    return run


def design(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones((len(x), 1)), x, np.minimum(x[:, :1], 10) * x[:, 1:2], x[:, 2:] ** 2], axis=1)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[float]:
    """Ridge logistic fit by Newton steps; rows weigh as their label is sampled."""
    d = design(x)
    b = np.zeros(d.shape[1])
    for _ in range(50):
        p = logistic(d @ b)
        grad = d.T @ (weight * (y - p)) - 1e-2 * b
        curve = (d * (weight * p * (1 - p))[:, None]).T @ d + 1e-2 * np.eye(len(b))
        step = np.linalg.solve(curve, grad)
        b = b + step / max(1.0, float(np.abs(step).max()) / 3)
        if np.abs(step).max() < 1e-9:
            break
    return b.tolist()


class ToxicModel:
    def __init__(self, toxic: bytes, ordinary: bytes, weights: list[float]) -> None:
        self.toxic, self.ordinary, self.weights = toxic, ordinary, weights


def untaught() -> ToxicModel:
    """Scores everything 0, to twelve places."""
    return ToxicModel(b"", b"", [-30.0] + [0.0] * 7)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", learn: Column | None = None, max_labelled: int = MAX_LABELLED, id_column: str = "doc_id", text_column: str = "text") -> ToxicModel:
    known = labels.where(F.col(label).isin(0, 1) & (learn if learn is not None else F.lit(True))).select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label"))
    small_batches(docs.sparkSession)
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    picked = [known.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(max_labelled) for k in (0, 1)]
    # At most two bounded samples of ids are sent to all tasks.
    rows = docs.select(F.col(id_column).alias("id"), as_bytes(text_column).alias("bytes")).join(F.broadcast(picked[0].union(picked[1])), "id")
    n = [max(1, min(max_labelled, sizes.get(k, 0))) for k in (0, 1)]
    if not sizes.get(0) or not sizes.get(1):
        return untaught()

    counts = rows.select("bytes", "label").mapInArrow(string_counts, "string binary, toxic long, ordinary long").groupBy("string").agg(F.sum("toxic").alias("t"), F.sum("ordinary").alias("o"))
    share_t, share_o, both = (F.col("t") + 0.5) / (n[1] + 1), (F.col("o") + 0.5) / (n[0] + 1), (F.col("t") + F.col("o")) / sum(n)
    counted_at = run_dir(docs.sparkSession, "strings")  # three rankings read the counts
    counts.where(F.col("t") + F.col("o") >= LEAST_DOCS).write.parquet(counted_at)
    scored = docs.sparkSession.read.parquet(counted_at).withColumn("z", (share_t - share_o) / F.sqrt(both * (1 - both) * (1 / n[0] + 1 / n[1]) + 1e-9))

    def best(sign: int) -> list[bytes]:
        seen = F.col("t" if sign > 0 else "o") >= LEAST_DOCS
        top = scored.where((sign * F.col("z") >= LEAST_Z) & seen).orderBy(F.desc(sign * F.col("z")), F.desc(F.length("string")), "string").limit(2 * SEGMENT_BYTES)
        return [bytes(r["string"]) for r in top.select("string").collect()]

    common = [bytes(r["string"]) for r in scored.where(F.col("o") >= LEAST_DOCS).orderBy(F.desc("o"), F.desc(F.length("string")), "string").select("string").limit(COMMON_BYTES // 5).collect()]
    base = b"".join(common)[:COMMON_BYTES]
    # Strings that ordinary texts favour are mostly common ones, which both dictionaries share.
    toxic, ordinary = base + chosen(best(1)), base + chosen(best(-1))
    got = rows.select("id", "label", "bytes").mapInArrow(featured(toxic, ordinary, ["id", "label"], None), "id long, label int, x0 double, x1 double, x2 double, x3 double").collect()
    if len({r["label"] for r in got}) < 2:
        return untaught()
    got.sort(key=tuple)
    y = np.array([r["label"] for r in got], float)
    weight = np.array([sizes[int(k)] / n[int(k)] for k in y])
    return ToxicModel(toxic, ordinary, calibrate(np.array([[r[f"x{i}"] for i in range(4)] for r in got]), y, weight))


def score(docs: DataFrame, model: ToxicModel, text_column: str = "text") -> DataFrame:
    """Other columns of the documents in the struct ``rest``, and the score."""
    small_batches(docs.sparkSession)
    rows = docs.select(others(docs, text_column), as_bytes(text_column).alias("bytes"))
    return rows.mapInArrow(featured(model.toxic, model.ordinary, ["rest"], model.weights), beside_rest(rows, "score double"))
