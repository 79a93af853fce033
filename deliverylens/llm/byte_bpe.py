"""Operator 4: byte-level BPE encoding and decoding with a bitmap rank queue.

A text is split by the pattern, and each piece merges its pairs in the order of
their ranks, the leftmost first. Positions of a linked list wait in one bucket a
rank; a three-level bitmap marks the buckets in use, and finding the first set
bit on each level gives the next rank in constant time. A merge leaves stale
entries behind, which are skipped when they come up. So a piece of n bytes takes
about n log n steps, however long it is. A piece that is a token itself is not
merged, as in the public library. Pieces that return within a task are looked up;
their ids are kept as the bytes that a text's list of ids is joined from.

Defined cases: null and empty texts have no ids and decode to no bytes.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deliverylens.llm.common import ship, small_batches

ship(__name__)

KNOWN_PIECES = 300_000  # pieces a task remembers before it starts anew
LONG_PIECE = 1000  # characters from which a piece is not remembered
PART_ROWS, PART_CHARS = 1000, 2 << 20
POOL = 2000  # pieces that share one list
#: The public pattern, and what it means for characters below U+0250 (letters, numbers and white space there).
PUBLIC = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LETTERS, NUMBERS, BLANKS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
PUBLIC_PLAIN = f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{BLANKS}{LETTERS}{NUMBERS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


BIT = [1 << i for i in range(64)]


class RankQueue:
    """Buckets of positions by rank, and three levels of 64-bit words that mark those in use; holds ranks under 2**18."""

    def __init__(self) -> None:
        self.top, self.middle, self.low = 0, [0] * 64, [0] * 4096
        self.buckets: dict[int, list[int]] = {}

    def open(self, rank: int, positions: list[int]) -> None:
        """A bucket for a rank that has none."""
        self.buckets[rank] = positions
        word, part = rank >> 6, rank >> 12
        self.low[word] |= BIT[rank & 63]
        self.middle[part] |= BIT[word & 63]
        self.top |= BIT[part]

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.open(rank, [position])
        else:
            bucket.append(position)

    def take(self) -> tuple[int, list[int]]:
        """The smallest rank in use and its bucket, from left to right, which leaves the queue."""
        top = self.top
        part = (top & -top).bit_length() - 1
        middle = self.middle[part]
        word = (part << 6) | ((middle & -middle).bit_length() - 1)
        low = self.low[word]
        bit = low & -low
        rank = (word << 6) | (bit.bit_length() - 1)
        self.low[word] = low = low ^ bit
        if not low:
            self.middle[part] = middle = middle & (middle - 1)
            if not middle:
                self.top = top & (top - 1)
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket


def rank_table(ranks: dict[bytes, int]) -> np.ndarray:
    """Ranks of all tokens of two bytes, by 256 * first + second; -1 where there is none."""
    table = np.full(1 << 16, -1, np.int32)
    for token, rank in ranks.items():
        if len(token) == 2:
            table[token[0] << 8 | token[1]] = rank
    return table


def merge(pieces: list[bytes], ranks: dict[bytes, int], table: np.ndarray, queue: RankQueue) -> list[np.ndarray]:
    """Ids of each piece; all of them, none empty, share one linked list and one queue."""
    data, rank_of = b"".join(pieces), ranks.get
    n, size = len(data), np.array([len(p) for p in pieces])
    ends = np.cumsum(size)
    start = np.zeros(n + 1, np.uint8)  # a piece begins here, and nothing is merged across
    start[ends - size] = start[n] = 1
    code = np.frombuffer(data, np.uint8).astype(np.int32)
    # Rank of the token at a position with the one that follows; -1 if they are no token.
    pairs = np.append(table[code[:-1] << 8 | code[1:]], np.int32(-1))
    pairs[ends - 1] = -1
    single = np.array([rank_of(bytes([i]), -2) for i in range(256)], np.int32)
    token = array("i", single[code].tobytes())  # the id at a position; -1 once it is merged into one before, -2 if there is none
    for piece, low, high in zip(pieces, (ends - size).tolist(), ends.tolist()):
        rank = rank_of(piece)
        if rank is not None:
            pairs[low:high] = -1
            token[low:high] = array("i", [rank] + [-1] * (high - low - 1))
    used = np.flatnonzero(pairs >= 0)
    used = used[np.argsort(pairs[used], kind="stable")]
    own, low = np.unique(pairs[used], return_index=True)
    low, used = low.tolist(), used.tolist()
    for rank, i, j in zip(own.tolist(), low, low[1:] + [len(used)]):
        queue.open(rank, used[i:j])
    pair, start, push, take = pairs.tolist(), start.tobytes(), queue.push, queue.take
    after, before = list(range(1, n + 2)), list(range(-1, n))
    while queue.top:
        rank, bucket = take()
        for k, at in enumerate(bucket):
            if pair[at] != rank:
                continue  # stale: the token here has changed or is gone
            gone = after[at]
            after[at] = follows = after[gone]
            pair[gone] = token[gone] = -1
            token[at] = least = rank
            if start[follows]:
                pair[at] = -1
            else:
                before[follows] = at
                pair[at] = new = rank_of(data[at : after[follows]], -1)
                if new >= 0:
                    push(new, at)
                    if new < least:
                        least = new
            if not start[at]:
                prior = before[at]
                pair[prior] = new = rank_of(data[prior:follows], -1)
                if new >= 0:
                    push(new, prior)
                    if new < least:
                        least = new
            if least < rank:  # a smaller rank came up: the rest of this bucket waits
                for position in bucket[k + 1 :]:
                    push(rank, position)
                break
    token = np.frombuffer(token, np.int32)
    left = token != -1
    high = np.cumsum(left)[ends - 1].tolist()
    ids = token[left]
    return [ids[i:j] for i, j in zip([0] + high, high)]


def stretches(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts whose new pieces are merged together: at most PART_ROWS, and PART_CHARS unless one text is longer."""
    low = total = 0
    for i, text in enumerate(texts):
        if i > low and (i - low >= PART_ROWS or total + len(text) > PART_CHARS):
            yield low, i
            low, total = i, 0
        total += len(text)
    if low < len(texts):
        yield low, len(texts)


def splitter(pattern: str):
    """The pieces of a text; for the public pattern and texts below U+0250 by the same pattern in plain ranges, which is faster."""
    whole = regex.compile(pattern).findall
    if pattern != PUBLIC:
        return whole
    plain, beyond = re.compile(PUBLIC_PLAIN).findall, re.compile("[^\x00-\u024f]").search
    return lambda text: whole(text) if beyond(text) else plain(text)


def tokenizer(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(path)
        tokens = {rank: token for token, rank in ranks.items()}
        table, queue, split = rank_table(ranks), RankQueue(), splitter(pattern)
        known: dict[str, bytes] = {}  # ids as 32-bit integers
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            for low, high in stretches(texts):
                found = [split(text) for text in texts[low:high]]
                if len(known) >= KNOWN_PIECES:
                    known.clear()
                fresh = list(set(chain.from_iterable(found)).difference(known, [""]))
                for k in range(0, len(fresh), POOL):
                    pool = fresh[k : k + POOL]
                    known.update(zip(pool, [ids.tobytes() for ids in merge([p.encode() for p in pool], ranks, table, queue)]))
                ids = [np.frombuffer(b"".join(map(known.__getitem__, pieces)), np.int32) for pieces in found]
                decoded = [b"".join(map(tokens.__getitem__, own.tolist())) for own in ids]
                for piece in fresh:
                    if len(piece) > LONG_PIECE:
                        del known[piece]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                yield pa.record_batch({"rest": batch.column("rest").slice(low, high - low), "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids))), "decoded": pa.array(decoded, pa.binary())})

    return run


def encode_decode(docs: DataFrame, path: str, pattern: str, text_column: str = "text") -> DataFrame:
    """All other columns in the struct ``rest``, the ids of the text, and the bytes they decode to.

    ``path`` names the rank file, which every executor has.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*(c for c in docs.columns if c != text_column)).alias("rest"), F.col(text_column).cast("string").alias("text"))
    rest = rows.schema["rest"].dataType.simpleString()
    return rows.mapInArrow(tokenizer(path, pattern), f"rest {rest}, ids array<int>, decoded binary")
