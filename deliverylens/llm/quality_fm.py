"""Operator 3: quality classifier, a factorisation machine over hashed words, structure and metadata.

A document is a sparse vector: its distinct lower-case words hashed to
``2**BITS`` places with square-root counts of length one in total, binned
statistics of its structure (symbols, capitals, repeats, line shapes), and
binned metadata (its stored length). The score is the logistic of
``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``; the pair term takes linear
time as ``(|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2``.

The model is fitted on at most ``max_labelled`` labelled rows, drawn by a hash
of the id; that bound is its only sample. Features are made on executors, whole
texts are read, and scoring covers every row without a shuffle of texts.

Defined cases: null and empty texts get the features of a text without words;
rows whose label is null are not learned from; without labelled rows of both
classes every score is the share of label 1 there (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.llm import common
from deliverylens.llm.common import U64, as_bytes, beside_rest, group_starts, mix, others, prefix_hash, ship, small_batches, Powers

ship(__name__)

BITS = 18
FACTORS = 8
EPOCHS = 6
LEAST_STEPS = 600  # few labelled rows are gone over more often
MAX_LABELLED = 8000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MARKS = b"#*$%&|<>!?.,;:@/\\-_=+~^(){}[]\"'"
#: Bounds of the bins of every share.
_SHARE_BINS = np.array([0.0005, 0.002, 0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9])
_SIZE_BINS = np.array([1, 3, 10, 30, 60, 100, 200, 400, 800, 1600, 5000, 20000])


def statistics(data: np.ndarray, start: np.ndarray, end: np.ndarray, words: np.ndarray, lines: list[bytes]) -> tuple[list[float], list[float]]:
    """Shares (0 to 1) and sizes that describe the structure of a text."""
    n = max(len(data), 1)
    counts = np.bincount(data, minlength=256)
    letters = counts[65:91].sum() + counts[97:123].sum()
    n_words = len(start)
    filled = [x for x in lines if x.strip()]
    shares = [counts[c] / n for c in _MARKS]
    shares += [counts[65:91].sum() / max(letters, 1), counts[48:58].sum() / n, counts[128:].sum() / n, counts[10] / n]
    shares.append(1 - len(set(filled)) / max(len(filled), 1))
    shares.append(1 - len(np.unique(words)) / max(n_words, 1))
    triples = words[:-2] * U64(3) + words[1:-1] * U64(5) + words[2:] * U64(7) if n_words > 2 else words[:0]
    shares.append(1 - len(np.unique(triples)) / max(len(triples), 1))
    length = end - start
    shares.append(float((length > 20).mean()) if n_words else 0.0)
    shares.append(float((length == 1).mean()) if n_words else 0.0)
    return shares, [n_words, len(data), len(filled), 10 * (float(length.mean()) if n_words else 0.0), max(map(len, filled), default=0)]


def features(text: bytes, size: int | None, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a document's vector."""
    raw = np.frombuffer(text, np.uint8)
    data = _LOWER[raw]
    word = np.concatenate([[False], ~_SPACE[data], [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    p = prefix_hash(data, powers)
    w = mix((p[end] - p[start]) * powers.up[start]) if len(start) else np.zeros(0, U64)
    place, count = np.unique(w & U64((1 << BITS) - 1), return_counts=True)
    value = np.sqrt(count)
    value = value / max(float(np.sqrt((value**2).sum())), 1.0)
    shares, sizes = statistics(raw, start, end, w, text.split(b"\n"))
    bins = [(k, int(np.searchsorted(_SHARE_BINS, s, side="right"))) for k, s in enumerate(shares)]
    bins += [(100 + k, int(np.searchsorted(_SIZE_BINS, s, side="right"))) for k, s in enumerate(sizes)]
    bins.append((200, int(np.searchsorted(_SIZE_BINS, size, side="right")) if size is not None else 99))
    # Structure and metadata have places of their own beyond the words.
    own = np.array([k * 16 + b % 16 for k, b in bins], np.int64) % 4096 + (1 << BITS)
    return np.concatenate([place.astype(np.int64), own]), np.concatenate([value, np.full(len(own), 0.3)])


WIDTH = (1 << BITS) + 4096


def featured(batch: pa.RecordBatch, powers: Powers) -> list[tuple[np.ndarray, np.ndarray]]:
    return [features(t, n, powers) for t, n in zip(batch.column("bytes").to_pylist(), batch.column("size").to_pylist())]


def labelled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        rows = featured(batch, powers)
        yield pa.record_batch(
            {
                "ord": batch.column("ord"),
                "label": batch.column("label"),
                "place": pa.array([p.astype(np.int32).tobytes() for p, _ in rows], pa.binary()),
                "value": pa.array([v.astype(np.float32).tobytes() for _, v in rows], pa.binary()),
            }
        )


class Machine:
    """Weights of the factorisation machine."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray) -> None:
        self.w0, self.w, self.v = w0, w, v

    def raw(self, place: np.ndarray, value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic, and each row's sum of weighted factors; rows begin at ``first``."""
        vx = self.v[place] * value[:, None]
        total = np.add.reduceat(vx, first)
        pairs = 0.5 * (total**2 - np.add.reduceat(vx * vx, first)).sum(axis=1)
        return self.w0 + np.add.reduceat(self.w[place] * value, first) + pairs, total


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.1, decay: float = 1e-5) -> Machine:
    """Adaptive gradient descent on the log loss, in a fixed order; rows are (places, values)."""
    draw = np.random.default_rng(3)
    share = float(labels.mean()) if len(labels) else 0.5
    prior = float(np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
    fm = Machine(prior, np.zeros(WIDTH, np.float32), draw.normal(0, 0.05, (WIDTH, FACTORS)).astype(np.float32))
    if len(labels) == 0 or labels.min() == labels.max():
        fm.v[:] = 0
        return fm
    gw, gv, g0 = np.full(WIDTH, 1e-3, np.float32), np.full((WIDTH, FACTORS), 1e-3, np.float32), 1e-3
    batches = max(1, len(rows) // 64)
    for _ in range(max(epochs, -(-LEAST_STEPS // batches))):
        for part in np.array_split(draw.permutation(len(rows)), batches):
            place = np.concatenate([rows[i][0] for i in part])
            value = np.concatenate([rows[i][1] for i in part])
            size = np.array([len(rows[i][0]) for i in part])
            first = np.concatenate([[0], np.cumsum(size)[:-1]])
            out, total = fm.raw(place, value, first)
            error = np.repeat(logistic(out) - labels[part], size).astype(np.float32) / len(part)
            key, back = np.unique(place, return_inverse=True)
            order = np.argsort(back, kind="stable")
            starts = group_starts(back[order])
            dw = np.add.reduceat((error * value)[order], starts) + decay * fm.w[key]
            inner = np.repeat(total, size, axis=0) - fm.v[place] * value[:, None]
            dv = np.add.reduceat(((error * value)[:, None] * inner)[order], starts) + decay * fm.v[key]
            gw[key] += dw**2
            gv[key] += dv**2
            fm.w[key] -= rate * dw / np.sqrt(gw[key])
            fm.v[key] -= 0.3 * rate * dv / np.sqrt(gv[key])
            d0 = float(error[first].sum())
            g0 += d0**2
            fm.w0 -= rate * d0 / np.sqrt(g0)
    return fm


def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weights of the machine that fits the vectors of all batches."""
    rows = sorted(r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("ord", "place", "value", "label"))))
    vectors = [(np.frombuffer(place, np.int32), np.frombuffer(value, np.float32)) for _, place, value, _ in rows]
    fm = fit(vectors, np.array([r[3] for r in rows], np.float32))
    yield pa.record_batch({"w0": pa.array([float(fm.w0)]), "w": pa.array([fm.w.tobytes()], pa.binary()), "v": pa.array([fm.v.tobytes()], pa.binary())})


def keyed(docs: DataFrame, id_column: str, text_column: str, size_column: str | None) -> DataFrame:
    small_batches(docs.sparkSession)
    size = F.col(size_column).cast("long") if size_column and size_column in docs.columns else F.lit(None).cast("long")
    return docs.select(others(docs, text_column), F.col(id_column).alias("ord"), as_bytes(text_column).alias("bytes"), size.alias("size"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None, max_labelled: int = MAX_LABELLED, id_column: str = "doc_id", text_column: str = "text", size_column: str | None = "n_chars") -> Machine:
    """Fit on at most ``max_labelled`` rows of ``labels`` where ``learn`` holds."""
    known = labels.where(F.col(label).isNotNull() & (learn if learn is not None else F.lit(True)))
    chosen = known.select(F.col(id_column).alias("ord"), F.col(label).cast("int").alias("label")).orderBy(F.xxhash64("ord", "label"), "ord").limit(max_labelled)
    # The sample has a bounded size, so it may be sent to all tasks.
    picked = keyed(docs, id_column, text_column, size_column).select("ord", "bytes", "size").join(F.broadcast(chosen), "ord")
    rows = picked.select("ord", "label", "bytes", "size").mapInArrow(labelled_features, "ord long, label int, place binary, value binary")
    # One task fits the sample, and the driver sees the weights only.
    made = rows.repartition(1).mapInArrow(fitted, "w0 double, w binary, v binary").first()
    if made is None:  # an empty plan runs no task
        return fit([], np.zeros(0, np.float32))
    return Machine(made["w0"], np.frombuffer(made["w"], np.float32), np.frombuffer(made["v"], np.float32).reshape(WIDTH, FACTORS))


def scorer(model):
    """Adds the score to rows of ``keyed``; the model is a Spark broadcast of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fm, powers = Machine(*model.value), Powers()
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows = featured(part, powers)
                first = np.concatenate([[0], np.cumsum([len(p) for p, _ in rows])[:-1]])
                out, _ = fm.raw(np.concatenate([p for p, _ in rows]), np.concatenate([v for _, v in rows]), first)
                yield pa.record_batch({"rest": part.column("rest"), "bytes": part.column("bytes"), "score": pa.array(logistic(out), pa.float64())})

    return run


def score(docs: DataFrame, fm: Machine, id_column: str = "doc_id", text_column: str = "text", size_column: str | None = "n_chars") -> DataFrame:
    """(rest, bytes, score) for every document; ``rest`` holds its other columns."""
    rows = keyed(docs, id_column, text_column, size_column)
    model = docs.sparkSession.sparkContext.broadcast((fm.w0, fm.w, fm.v))
    return rows.select("rest", "bytes", "size").mapInArrow(scorer(model), beside_rest(rows, "bytes binary, score double"))
