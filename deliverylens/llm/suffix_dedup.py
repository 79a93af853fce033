"""Operator 1: removal of byte strings that an earlier document holds, by a sorted suffix array.

A string of ``LENGTH`` bytes is removed from a document when it also starts in a
document with a smaller id. All windows of that length are decided, but only
few suffixes travel: in each window the ``GRAM``-byte string with the smallest
hash is its anchor, equal windows have equal anchors at equal places, and
neighbouring windows mostly share one. So a suffix row is an anchor with the
bytes before and after it that its windows cover.

1. Anchor hashes are compared over all documents in packed rows. A task sends
   each hash once, however many of its documents hold it, so a hash that a third
   of the rows hold makes one entry a task. Anchors of one document only are
   dropped: their windows repeat nowhere.
2. Each task first decides the windows of its own rows, and sends on only those
   that no smaller document of the task covers. Sampled splitters deal the
   suffixes by their leading bytes.
3. A bucket sorts its suffixes by multikey quicksort, and the sorted contexts
   before the anchors likewise. For each distance to the anchor, the stretches
   with long enough common prefixes on both sides are the groups of equal
   windows; the smallest id of a group covers the rest.
4. Leading bytes that the sample holds too often fill several buckets; their
   windows are compared across the boundaries by an aggregate and a join that
   see a window once a bucket.

Defined cases: a null text is empty; a null id counts as larger than any other;
rows with equal ids never remove bytes from each other; texts under
``LENGTH`` bytes stay whole; extra columns are kept by ``strip_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.llm import common
from deliverylens.llm.common import NO_ID, U64, Powers, as_bytes, beside_rest, group_starts, mix, order_key, others, parts_for, prefix_hash, ship, small_batches, text_size
from deliverylens.session import run_dir

ship(__name__)

LENGTH = 50
GRAM = 16
LEFT = LENGTH - GRAM  # the anchor starts 0 to LEFT bytes after the window
FLUSH = 1_000_000  # anchors a task gathers before it sends them
SAMPLE_BYTES = 32 << 20  # text from which splitters are drawn
SENT = 6  # low bytes of a hash that are sent; a wrong hit only adds a suffix to compare
SEGMENT = 1 << 15  # up to here a stretch is sorted by all words at once


def anchors(data: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first window, last window, anchor place, anchor hash."""
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, U64)
    p = prefix_hash(data, powers)
    h = mix((p[GRAM:] - p[:-GRAM]) * powers.up[: len(p) - GRAM])
    width, low, span = LEFT + 1, h, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        rest = width - span
        low = np.minimum(low[: len(low) - rest], low[rest:])
    first = group_starts(low)
    last = np.append(first[1:], len(low)) - 1
    place = first + np.lib.stride_tricks.sliding_window_view(h, width)[first].argmin(axis=1)
    if (last > place).any():  # a hash repeats within a window: the leftmost counts
        place, best = np.arange(len(h)), h
        span = 1
        while span < width:
            step = min(span, width - span)
            keep = best[:-step] <= best[step:]
            place = np.where(keep, place[:-step], place[step:])
            best = np.where(keep, best[:-step], best[step:])
            span += step
        first = group_starts(place)
        last = np.append(first[1:], len(place)) - 1
        place = place[first]
    return first, last, place, h[place]


# Step 1: anchors that more than one document holds.


def anchor_entries(n_buckets: int):
    """Rows (bucket, kind, hashes, ids): kind 0 to compare, kind 1 known to repeat within the task."""

    def packed(hashes: list[np.ndarray], ids: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h, d = np.concatenate(hashes), np.concatenate(ids)
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        start = group_starts(h)
        size = np.diff(np.append(start, len(h)))
        many = np.minimum.reduceat(d, start) < np.maximum.reduceat(d, start)
        known = np.repeat(many, size)
        # One entry a hash; an id of -1 says that the hash is known to repeat.
        one, who = h[start], np.where(many, -1, d[start])
        for kind, x, y in ((0, one, who), (1, h[known], d[known])):
            bucket = (x >> U64(20)) % U64(n_buckets) if kind == 0 else y.astype(U64) % U64(n_buckets)
            order = np.lexsort((y, bucket))
            x, y, bucket = x[order], y[order], bucket[order]
            at = group_starts(bucket)
            ends = np.append(at[1:], len(bucket))
            if len(at):
                yield pa.record_batch(
                    {
                        "bucket": pa.array(bucket[at].astype(np.int32)),
                        "kind": pa.array(np.full(len(at), kind, np.int32)),
                        "hashes": pa.array([x[a:b].view(np.uint8).reshape(-1, 8)[:, :SENT].tobytes() for a, b in zip(at, ends)], pa.binary()),
                        "ids": pa.array([y[a:b].tobytes() for a, b in zip(at, ends)], pa.binary()),
                    }
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, hashes, ids, held = Powers(), [], [], 0
        for batch in batches:
            for key, text in zip(batch.column("ord").to_pylist(), batch.column("bytes").to_pylist()):
                h = np.unique(anchors(np.frombuffer(text, np.uint8), powers)[3])
                if len(h):
                    hashes.append(h)
                    ids.append(np.full(len(h), key, np.int64))
                    held += len(h)
            if held > FLUSH:
                yield from packed(hashes, ids)
                hashes, ids, held = [], [], 0
        if held:
            yield from packed(hashes, ids)

    return run


def short(h: np.ndarray) -> np.ndarray:
    """The low half of hashes, which tells the anchors of one document apart well enough."""
    return (h & U64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ord, h) of anchors that another document holds too."""
    hashes, ids = [], []
    for batch in batches:
        for kind, h, d in zip(*(batch.column(c).to_pylist() for c in ("kind", "hashes", "ids"))):
            d = np.frombuffer(d, np.int64)
            wide = np.zeros((len(d), 8), np.uint8)
            wide[:, :SENT] = np.frombuffer(h, np.uint8).reshape(-1, SENT)
            h = wide.view(U64).ravel()
            if kind:
                yield pa.record_batch({"ord": pa.array(d), "h": pa.array(short(h))})
            else:
                hashes.append(h)
                ids.append(d)
    if hashes:
        h, d = np.concatenate(hashes), np.concatenate(ids)
        order = np.argsort(h, kind="stable")
        h, d = h[order], d[order]
        start = group_starts(h)
        low, high = np.minimum.reduceat(d, start), np.maximum.reduceat(d, start)
        hit = np.repeat(low < high, np.diff(np.append(start, len(h)))) & (d >= 0)
        # One id and the mark of a task: it repeats as well. Marks alone need no answer.
        yield pa.record_batch({"ord": pa.array(d[hit]), "h": pa.array(short(h[hit]))})


# Steps 2 and 3: sorted suffixes.


def words(rows: np.ndarray) -> np.ndarray:
    """Bytes of each row as big-endian words, which compare as the bytes do."""
    pad = -rows.shape[1] % 8
    wide = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, pad))))
    return wide.view(">u8").astype(U64)


def multikey_quicksort(keys: np.ndarray) -> np.ndarray:
    """Order of rows of words: three-way splits at the pivot of one word, the middle goes on to the next word."""
    n, depth = keys.shape
    order = np.arange(n)
    todo = [(0, n, 0)]
    while todo:
        low, high, d = todo.pop()
        if high - low < 2 or d == depth:
            continue
        part = order[low:high]
        if high - low <= SEGMENT:
            order[low:high] = part[np.lexsort(tuple(keys[part, c] for c in range(depth - 1, d - 1, -1)))]
            continue
        w = keys[part, d]
        pivot = np.partition(w[:: max(1, len(w) // 1024)], min(len(w), 1024) // 2 - 1 if len(w) < 2048 else 511)
        pivot = pivot[len(pivot) // 2]
        less, more = w < pivot, w > pivot
        order[low:high] = np.concatenate([part[less], part[~(less | more)], part[more]])
        a, b = low + int(less.sum()), high - int(more.sum())
        todo += [(low, a, d), (a, b, d + 1), (b, high, d)]
    return order


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row and the row before; -1 for the first."""
    out = np.full(len(rows), -1)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def covered_windows(right: np.ndarray, left: np.ndarray, ids: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Bits of the windows of each suffix row that a row with a smaller id has too.

    ``right`` are the bytes from the anchor on, ``left`` those before it from
    the nearest on; bit a of ``windows`` is the window that starts a bytes
    before the anchor.
    """
    out = np.zeros(len(ids), U64)
    if len(ids) < 2:
        return out
    by_right, by_left = multikey_quicksort(words(right)), multikey_quicksort(words(left))
    right_prefix, left_prefix = common_prefixes(right[by_right]), common_prefixes(left[by_left])
    r, s = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
    for a in range(LEFT + 1):
        has = np.flatnonzero((windows >> U64(a)) & U64(1))
        if len(has) < 2:
            continue
        r[by_right] = np.cumsum(right_prefix < LENGTH - a)
        s[by_left] = np.cumsum(left_prefix < a)
        key = (r[has] << 32) | s[has]
        order = np.argsort(key, kind="stable")
        start = group_starts(key[order])
        size = np.diff(np.append(start, len(order)))
        who = ids[has][order]
        hit = who > np.repeat(np.minimum.reduceat(who, start), size)
        out[has[order[hit]]] |= U64(1 << a)
    return out


#: Columns of packed suffixes: name, number type, or the bytes of a row.
FIELDS = {"right": LENGTH, "left": LEFT, "ord": np.int64, "th": np.int32, "place": np.int32, "windows": np.uint64}
MARK = np.dtype([("ord", "<i8"), ("th", "<i4"), ("place", "<i4"), ("covered", "<u8")])
MAX_RANGES = 2048  # splitters are fewer; beyond, a range is dealt on by a hash of the leading bytes


def marks_of(ids: np.ndarray, th: np.ndarray, place: np.ndarray, covered: np.ndarray) -> np.ndarray:
    """One record a suffix row, of 24 bytes."""
    out = np.empty(len(ids), MARK)
    out["ord"], out["th"], out["place"], out["covered"] = ids, th, place, covered
    return out


def mark_batch(marks: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({c: pa.array(np.ascontiguousarray(marks[c]).view(np.int64) if c == "covered" else np.ascontiguousarray(marks[c])) for c in MARK.names})


def lead_hash(lead: np.ndarray) -> np.ndarray:
    """Scattered bits of leading bytes; equal ones have equal hashes."""
    halves = np.ascontiguousarray(lead).view(U64).reshape(-1, GRAM // 8)
    return mix(halves[:, 0] + mix(halves[:, 1]))


def suffix_rows(splitters: list[bytes] | None, n_parts: int = 1):
    """Packed suffixes to compare, one row for a task's share of a bucket, and marks already made.

    A bucket is a range between splitters, dealt on by a hash of the leading
    bytes where ``n_parts`` asks for more buckets than there are ranges.
    Suffixes without windows left are not sent. Without splitters only the
    leading bytes are returned.
    """
    bounds = None if splitters is None else np.array(splitters, dtype=f"S{GRAM}")

    def emit(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        right, left = np.concatenate([x[0] for x in rows]), np.concatenate([x[1] for x in rows])
        key, th, place, windows = (np.concatenate([x[c] for x in rows]) for c in (2, 3, 4, 5))
        done = covered_windows(right, left, key, windows)
        windows &= ~done
        lead = np.ascontiguousarray(right[:, :GRAM])
        view = lead.view(f"S{GRAM}").ravel()
        low, high = np.searchsorted(bounds, view, side="left"), np.searchsorted(bounds, view, side="right")
        low = np.where(high - low > 1, low, high)  # leading bytes drawn twice or more fill several ranges
        spread = mix(key.astype(U64) + place.astype(U64)) % (high - low + 1).astype(U64)
        each = -(-n_parts // (len(bounds) + 1))
        bucket = (low + spread.astype(np.int64)) * each + (lead_hash(lead) % U64(each)).astype(np.int64)
        send = np.flatnonzero(windows)
        send = send[np.argsort(bucket[send], kind="stable")]
        columns = {"right": right, "left": left, "ord": key, "th": th, "place": place, "windows": windows}
        start = group_starts(bucket[send])
        ends = np.append(start[1:], len(send))
        packed = {c: [v[send[i:j]].tobytes() for i, j in zip(start, ends)] for c, v in columns.items()}
        made = np.flatnonzero(done)
        if len(made):
            marks = marks_of(key[made], th[made], place[made], done[made])
            packed = {c: [*v, None] for c, v in packed.items()}
            buckets = [*bucket[send[start]], bucket[made[0]]]
            mark_column = [*[None] * len(start), marks.tobytes()]
        else:
            buckets, mark_column = bucket[send[start]], [None] * len(start)
        yield pa.record_batch({"bucket": pa.array(np.asarray(buckets, np.int32)), **{c: pa.array(v, pa.binary()) for c, v in packed.items()}, "marks": pa.array(mark_column, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, rows, held = Powers(), [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("ord", "th", "bytes"))
            lists = batch.column("hs")
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for i, (key, th, text) in enumerate(zip(*columns)):
                data = np.frombuffer(text, np.uint8)
                first, last, place, h = anchors(data, powers)
                keep = np.isin(short(h), flat[ends[i] : ends[i + 1]])
                if not keep.any():
                    continue
                first, last, place = first[keep], last[keep], place[keep]
                n = len(first)
                wide = np.zeros(LEFT + len(data) + LENGTH, np.uint8)
                wide[LEFT : LEFT + len(data)] = data
                views = np.lib.stride_tricks.sliding_window_view(wide, LEFT + LENGTH)[place]
                right, left = views[:, LEFT:].copy(), views[:, LEFT - 1 :: -1].copy() if LEFT else views[:, :0]
                right[np.arange(LENGTH) >= (last + LENGTH - place)[:, None]] = 0
                left[np.arange(LEFT) >= (place - first)[:, None]] = 0
                if bounds is None:
                    yield pa.record_batch({"lead": pa.array([x.tobytes() for x in right[:, :GRAM]], pa.binary())})
                    continue
                low, high = (place - last).astype(U64), (place - first).astype(U64)
                windows = ((U64(2) << high) - U64(1)) & ~((U64(1) << low) - U64(1))
                rows.append((right, left, np.full(n, key, np.int64), np.full(n, th, np.int32), place.astype(np.int32), windows))
                held += n
            if held > FLUSH // 8:
                yield from emit(rows)
                rows, held = [], 0
        if held:
            yield from emit(rows)

    return run


SUFFIX_SCHEMA = "bucket int, right binary, left binary, ord binary, th binary, place binary, windows binary, marks binary"
LEAD_SCHEMA = "lead binary"
MARK_SCHEMA = "ord long, th int, place int, covered long"
WINDOW_SCHEMA = "win binary, least long, most long, marks binary"


def unpacked(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
    """The suffixes of packed rows, one array a column."""
    got: dict[str, list] = {c: [] for c in FIELDS}
    for batch in batches:
        for c in FIELDS:
            got[c] += [x for x in batch.column(c).to_pylist() if x is not None]
    out = {}
    for c, kind in FIELDS.items():
        flat = b"".join(got.pop(c))
        out[c] = np.frombuffer(flat, np.uint8).reshape(-1, kind) if isinstance(kind, int) else np.frombuffer(flat, kind)
    return out


def sorted_bucket(want_windows: bool, shared: list[bytes]):
    """Marks of a bucket's suffixes; or the windows to compare with other buckets, of suffixes whose leading bytes fill several.

    A window is one row of its bucket, with the marks of all suffixes there.
    """
    shared_leads = np.array(shared, dtype=f"S{GRAM}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = []
        for batch in batches:
            for made in batch.column("marks").to_pylist():
                if made is not None and not want_windows:
                    yield mark_batch(np.frombuffer(made, MARK))
            kept.append(batch.select(list(FIELDS)))
        got = unpacked(iter(kept))
        right, left, ids, th, place, windows = (got[c] for c in FIELDS)
        if not len(ids):
            return
        edge = np.isin(np.ascontiguousarray(right[:, :GRAM]).view(f"S{GRAM}").ravel(), shared_leads)
        if not want_windows:
            inner = np.flatnonzero(~edge)
            done = covered_windows(right[inner], left[inner], ids[inner], windows[inner])
            inner, done = inner[done > 0], done[done > 0]
            yield mark_batch(marks_of(ids[inner], th[inner], place[inner], done))
            return
        edge = np.flatnonzero(edge)
        both = np.concatenate([left[edge, ::-1], right[edge]], axis=1)
        for a in range(LEFT + 1):
            has = np.flatnonzero((windows[edge] >> U64(a)) & U64(1))
            if not len(has):
                continue
            text = np.ascontiguousarray(both[has, LEFT - a : LEFT - a + LENGTH])
            order = multikey_quicksort(words(text))
            start = group_starts(np.cumsum(common_prefixes(text[order]) < LENGTH))
            ends = np.append(start[1:], len(order))
            at = edge[has[order]]
            marks = marks_of(ids[at], th[at], place[at], np.full(len(at), 1 << a, U64))
            yield pa.record_batch(
                {
                    "win": pa.array([text[i].tobytes() for i in order[start]], pa.binary()),
                    "least": pa.array(np.minimum.reduceat(ids[at], start)),
                    "most": pa.array(np.maximum.reduceat(ids[at], start)),
                    "marks": pa.array([marks[i:j].tobytes() for i, j in zip(start, ends)], pa.binary()),
                }
            )

    return run


def beyond_least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of windows that a smaller id has, from (least id, packed marks)."""
    for batch in batches:
        for least, made in zip(batch.column("least").to_pylist(), batch.column("marks").to_pylist()):
            marks = np.frombuffer(made, MARK)
            yield mark_batch(marks[marks["ord"] > least])


# The remaining bytes.

BACK = np.arange(LEFT + 1)

KEPT_FIELDS = "n_bytes long, n_removed long, n_spans long, spans array<struct<first:int,last:int>>, kept "


def cut_text(text: bytes, place: np.ndarray, bits: np.ndarray) -> tuple[int, int, np.ndarray, bytes]:
    """Bytes, removed bytes, removed stretches and what is left of one text."""
    if not len(bits):
        return len(text), 0, np.zeros((0, 2), np.int64), text
    start = (place[:, None] - BACK)[((bits[:, None] >> BACK.astype(U64)) & U64(1)) > 0]
    change = np.bincount(start, minlength=len(text) + 1) - np.bincount(start + LENGTH, minlength=len(text) + 1)
    gone = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
    return len(text), int(gone.sum()), edges.reshape(-1, 2), np.frombuffer(text, np.uint8)[~gone].tobytes()


def keep_rest(as_text: bool):
    """What is left of every text, in bytes or as text without the characters that a cut splits."""
    span = pa.struct([("first", pa.int32()), ("last", pa.int32())])
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column("marks")
            fields = marks.values
            th, place, bits = (fields.field(c).to_numpy(zero_copy_only=False) for c in ("th", "place", "covered"))
            ends = marks.offsets.to_numpy()
            found = []
            for i, (text, own) in enumerate(zip(batch.column("bytes").to_pylist(), batch.column("th").to_pylist())):
                at = ends[i] + np.flatnonzero(th[ends[i] : ends[i + 1]] == own)
                found.append(cut_text(text, place[at], bits[at].view(U64)))
            n, removed, spans, kept = zip(*found) if found else ((), (), (), ())
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in spans])]).astype(np.int32)
            flat = np.concatenate(spans).astype(np.int32) if len(spans) else np.zeros((0, 2), np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, 0])), pa.array(np.ascontiguousarray(flat[:, 1]))], fields=list(span)))
            yield pa.record_batch(
                {
                    "rest": batch.column("rest"),
                    "n_bytes": pa.array(n, pa.int64()),
                    "n_removed": pa.array(removed, pa.int64()),
                    "n_spans": pa.array([len(s) for s in spans], pa.int64()),
                    "spans": lists,
                    "kept": pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if as_text else pa.array(kept, pa.binary()),
                }
            )

    return run


def draw_splitters(keyed: DataFrame, flags: DataFrame, total: int, n_ranges: int) -> list[bytes]:
    """Leading bytes that deal the suffixes of about ``SAMPLE_BYTES`` of text evenly; fewer than ``n_ranges`` of them."""
    share = min(1.0, SAMPLE_BYTES / max(total, 1))
    some = keyed.where(F.pmod(F.xxhash64("th", "ord"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    leads = some.join(flags, "ord").select("ord", "th", "bytes", "hs").mapInArrow(suffix_rows(None), LEAD_SCHEMA)
    # A random part of the sample, of bounded size, and put together in one task: the driver gets no more than it keeps.
    drawn = leads.orderBy(F.xxhash64("lead", F.rand(7))).limit(n_ranges * 64)
    kept = [bytes(x) for x in drawn.agg(F.sort_array(F.collect_list("lead")).alias("leads")).first()["leads"]]
    step = max(1, len(kept) // n_ranges)
    return kept[step::step][: n_ranges - 1]


def mark_repeats(keyed: DataFrame, spark: SparkSession, n_parts: int, total: int) -> DataFrame:
    """Marks (ord, th, place, covered) of windows that documents with smaller ids hold."""
    entries = keyed.select("ord", "bytes").mapInArrow(anchor_entries(4 * n_parts), "bucket int, kind int, hashes binary, ids binary")
    found = entries.repartition(n_parts, "bucket").mapInArrow(repeated_anchors, "ord long, h int")
    path = run_dir(spark, "anchors")
    found.groupBy("ord").agg(F.collect_list("h").alias("hs")).write.parquet(path)
    flags = spark.read.parquet(path)
    splitters = draw_splitters(keyed, flags, total, min(n_parts, MAX_RANGES))
    n_ranges = len(splitters) + 1
    # With ``rest``, so that both joins read one exchange of the documents.
    suffixes = keyed.join(flags, "ord").select("rest", "ord", "th", "bytes", "hs").mapInArrow(suffix_rows(splitters, n_parts), SUFFIX_SCHEMA)
    dealt = suffixes.repartitionById(n_ranges * -(-n_parts // n_ranges), F.col("bucket"))
    shared = sorted({a for a, b in zip(splitters, splitters[1:]) if a == b})
    inner = dealt.mapInArrow(sorted_bucket(False, shared), MARK_SCHEMA)
    if not shared:
        return inner
    windows = dealt.mapInArrow(sorted_bucket(True, shared), WINDOW_SCHEMA)
    least = windows.groupBy("win").agg(F.min("least").alias("least"), F.max("most").alias("most")).where("least < most")
    across = windows.select("win", "marks").join(least.select("win", "least"), "win").select("least", "marks").mapInArrow(beyond_least, MARK_SCHEMA)
    return inner.union(across)


def _repeats(docs: DataFrame, id_column: str, text_column: str, as_text: bool) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    _, total = text_size(docs, text_column)
    n_parts = parts_for(spark, total)
    keyed = docs.select(
        others(docs, text_column),
        order_key(id_column).alias("ord"),
        F.hash(text_column).alias("th"),
        as_bytes(text_column).alias("bytes"),
    )
    marks = mark_repeats(keyed, spark, n_parts, total)
    per_doc = marks.groupBy("ord").agg(F.collect_list(F.struct("th", "place", "covered")).alias("marks"))
    fields = KEPT_FIELDS + ("string" if as_text else "binary")
    return keyed.join(per_doc, "ord", "left").select("rest", "th", "bytes", "marks").mapInArrow(keep_rest(as_text), beside_rest(keyed, fields))


def find_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: all its other columns in the struct ``rest``, n_bytes, n_removed, n_spans, spans (first, end) and the kept bytes."""
    return _repeats(docs, id_column, text_column, False)


def strip_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with repeated byte strings cut out of their texts; a character that a cut splits goes too."""
    found = _repeats(docs, id_column, text_column, True)
    return found.select(*(F.col("kept").alias(c) if c == text_column else F.col("rest").getField(c).alias(c) for c in docs.columns))
