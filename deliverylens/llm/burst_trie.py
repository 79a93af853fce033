"""Operator 11: the prefix trie of conversations, built as a burst trie.

1. Turns are ordered within a conversation and known by a 128-bit digest of role
   and text. Each conversation is rebuilt with the first turns of another one;
   equal rebuilt conversations are counted into one entry with its smallest member.
2. The root's container bursts: every entry goes to the head of its next turn. A
   head with more than ``BURST`` entries bursts in turn, level by level; an entry
   that ends at such a head is its end. All other heads keep their containers.
3. Heads are dealt over shards and Spark sorts the entries of each shard by head
   and turns. One sweep over a container, entry by entry, makes its nodes: what an
   entry shares with the one before is open already, the rest are new nodes.
   Subtree sums of a container are complete, since it holds a whole subtree.
4. The heads that burst are few (each has more than ``BURST`` entries). Every
   container reports its sums to the heads above it; Spark adds them up.
5. The ids that end at a node are written in sorted ranges as text of at most
   ``PIECE`` ids; one digest an entry runs over its pieces in order.

A task holds one container at a time, which copies of a conversation do not make
larger. A conversation's turns travel as one row of 24 bytes a turn. Rounds follow
the depth to which more than ``BURST`` different conversations stay equal.

Defined cases: rows without a conv_id belong to no conversation; a null turn comes
before all others; turns of equal number follow in the order of their digests, and
repeated rows count as often as they occur; null and empty roles and texts are the
same; an empty table has no conversations and so no nodes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deliverylens.llm.common import ship, small_batches
from deliverylens.session import run_dir

ship(__name__)

BURST = 512  # entries of a container
ID = 16  # bytes of a turn's digest
PIECE = 1000
SHARED = 20  # conversations that take their first turns from one
MOST_SHARED = 3
NOTHING = sha256(b"").hexdigest()
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, seq, words) of every conversation: the digests of its rebuilt turns as one binary, and their numbers of words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    conv = F.col("conv_id").cast("long")
    base = (conv - conv % SHARED).alias("base")
    rows = turns.where(conv.isNotNull()).select(base, conv.alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("id"), F.regexp_count(text, F.lit(WORD)).alias("words"))
    own = rows.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "words"))).alias("own"))
    # The rows of a base are together: no other exchange is needed for its first turns.
    first = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, MOST_SHARED))).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int")
    late = F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0)))
    all_turns = own.withColumn("first", first).select("conv_id", F.concat(F.coalesce(F.slice("first", F.lit(1), h), F.slice("own", 1, 0)), late).alias("all"))
    seq = F.unhex(F.array_join(F.col("all.id"), ""))
    return all_turns.select("conv_id", seq.alias("seq"), F.col("all.words").alias("words"))


def join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) to pieces of at most PIECE ids of a key, written in decimal with commas."""
    for batch in batches:
        keys, ids = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
        out, at = [], 0
        while at < len(keys):
            end = at
            while end < len(keys) and end - at < PIECE and keys[end] == keys[at]:
                end += 1
            out.append((keys[at], ids[at], ",".join(map(str, ids[at:end]))))
            at = end
        key, first, text = map(list, zip(*out)) if out else ([], [], [])
        yield pa.record_batch({"key": pa.array(key, pa.binary()), "first": pa.array(first, pa.int64()), "ids": pa.array(text, pa.string())})


def digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one digest a key."""
    now, digest = None, None
    for batch in batches:
        done = []
        for key, text in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if key == now:
                digest.update(b"," + text.encode())
                continue
            if now is not None:
                done.append((now, digest.hexdigest()))
            now, digest = key, sha256(text.encode())
        yield as_digests(done)
    if now is not None:
        yield as_digests([(now, digest.hexdigest())])


def as_digests(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.record_batch({"key": pa.array([k for k, _ in done], pa.binary()), "ends": pa.array([d for _, d in done], pa.string())})


def end_digests(members: DataFrame) -> DataFrame:
    """(key, ends): the digest of the ids of each key of (key, conv_id), in ascending order."""
    ranges = members.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = ranges.mapInArrow(join_pieces, "key binary, first long, ids string")
    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digest_pieces, "key binary, ends string")


def entries_of(convs: DataFrame) -> DataFrame:
    """One row for equal conversations: (key, seq, words, least, n, ends)."""
    keyed = convs.withColumn("key", F.unhex(F.md5("seq")))
    same = keyed.groupBy("key").agg(F.first("seq").alias("seq"), F.first("words").alias("words"), F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("n"))
    return same.join(end_digests(keyed.select("key", "conv_id")), "key")


def prefix_key(depth: int) -> Column:
    return F.unhex(F.md5(F.substring("seq", 1, ID * depth)))


def burst(entries: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """The containers of each depth of their heads, and the ends of the heads that burst.

    Containers are (head, depth, above, key, seq, words, least, n, ends); ``above``
    lists the heads that burst on the way, from the root on, with the words of their last turn.
    """
    length = (F.octet_length("seq") / ID).cast("int")
    kept, ended = [], []
    now, depth = entries.withColumn("above", F.array(F.struct(F.unhex(F.md5(F.lit(b""))).alias("head"), F.lit(0).cast("long").alias("w")))), 0
    while True:
        ended.append(now.where(length == depth).withColumn("depth", F.lit(depth)))
        going = now.where(length > depth).withColumn("head", prefix_key(depth + 1))
        sizes = going.groupBy("head").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > BURST)
        marked = written(going.join(sizes, "head", "left").withColumn("depth", F.lit(depth + 1)), "burst")
        kept.append(marked.where(F.col("held").isNull()).drop("held"))
        over = marked.where(F.col("held").isNotNull())
        if over.isEmpty():
            return kept, ended
        step = F.struct("head", F.get("words", F.lit(depth)).cast("long").alias("w"))
        now, depth = over.select(*entries.columns, F.concat("above", F.array(step)).alias("above")), depth + 1


ABOVE = "array<struct<head: binary, w: bigint>>"
NODES = f"top binary, above {ABOVE}, conv_id long, depth int, parent long, n_convs long, n_children long, n_leaves long, saved long, ends string"


class Sweep:
    """The nodes of one container, made entry by entry in sorted order."""

    def __init__(self, head: bytes, depth: int, above: list[dict]) -> None:
        self.head, self.depth, self.above = head, depth, above
        self.open: list[list] = []  # nodes from the container's top down to the last entry's end
        self.closed: list[list] = []
        self.last = b""

    def close(self, depth: int) -> None:
        """Close the open nodes below a depth; a node's sums go to its parent."""
        while self.open and self.open[-1][2] > depth:
            node = self.open.pop()
            parent, _, _, least, n, children, leaves, saved, words, _ = node
            node[6] = leaves = leaves or 1
            node[7] = saved = saved + (n - 1) * words
            if parent is not None:
                parent[3] = min(parent[3], least)
                parent[4] += n
                parent[5] += 1
                parent[6] += leaves
                parent[7] += saved
            self.closed.append(node)

    def add(self, seq: bytes, words: list[int], least: int, n: int, ends: str) -> None:
        shared, most = self.depth - 1, min(len(seq), len(self.last)) // ID
        while self.open and shared < most and seq[shared * ID : (shared + 1) * ID] == self.last[shared * ID : (shared + 1) * ID]:
            shared += 1
        self.close(shared)
        for depth in range(shared + 1, len(seq) // ID + 1):
            self.open.append([self.open[-1] if self.open else None, self.head if not self.open else None, depth, least, 0, 0, 0, 0, words[depth - 1], NOTHING])
        node = self.open[-1]  # the entry's end, always new: entries differ and shorter ones come first
        node[3], node[4], node[9] = least, n, ends
        self.last = seq

    def rows(self) -> pa.RecordBatch:
        self.close(-1)
        at = [self.above if x[1] is not None else None for x in self.closed]
        column = lambda k, kind: pa.array([x[k] for x in self.closed], kind)
        parents = pa.array([x[0][3] if x[0] is not None else None for x in self.closed], pa.int64())
        return pa.record_batch(
            [column(1, pa.binary()), pa.array(at, pa.list_(pa.struct({"head": pa.binary(), "w": pa.int64()}.items()))), column(3, pa.int64()), column(2, pa.int32()), parents, *(column(k, pa.int64()) for k in (4, 5, 6, 7)), column(9, pa.string())],
            names=["top", "above", "conv_id", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved", "ends"],
        )


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (head, seq) to nodes; the top of a container carries its head and the heads above."""
    now = None
    for batch in batches:
        for row in batch.to_pylist():
            if now is None or row["head"] != now.head:
                if now is not None:
                    yield now.rows()
                now = Sweep(row["head"], row["depth"], row["above"])
            now.add(row["seq"], row["words"], row["least"], row["n"], row["ends"])
    if now is not None:
        yield now.rows()


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row a node of the trie of rebuilt conversations; ``turns`` has conv_id, turn, role and text."""
    small_batches(turns.sparkSession)
    entries = written(entries_of(written(rebuilt(turns), "rebuilt")), "entries")
    kept, ended = burst(entries)
    dealt = union(kept).select("head", "depth", "above", "seq", "words", "least", "n", "ends")
    nodes = written(dealt.repartition("head").sortWithinPartitions("head", "seq").mapInArrow(sweep, NODES), "swept")
    tops = nodes.where(F.col("top").isNotNull())
    ends = union(ended)

    # What containers and ends report to the heads above them; a head is known by its depth and prefix.
    none = F.lit(0).cast("long")
    reports = tops.select("above", F.col("conv_id").alias("least"), F.col("n_convs").alias("n"), "n_leaves", "saved").unionByName(
        ends.select("above", "least", "n", none.alias("n_leaves"), none.alias("saved"))
    )
    spread = reports.select(F.posexplode("above").alias("depth", "at"), "above", "least", "n", "n_leaves", "saved")
    spread = spread.select("depth", F.col("at.head").alias("head"), F.col("at.w").alias("w"), F.slice("above", F.lit(1), F.col("depth") + 1).alias("above"), "least", "n", "n_leaves", "saved")
    summed = [F.min("least").alias("least"), F.sum("n").alias("n"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("below")]
    heads = written(spread.groupBy("depth", "head").agg(F.first("w").alias("w"), F.first("above").alias("above"), *summed), "heads")
    own = (F.col("n") - 1) * F.col("w")
    saved = heads.select(F.posexplode("above").alias("depth", "at"), own.alias("own")).withColumn("head", F.col("at.head")).groupBy("depth", "head").agg(F.sum("own").alias("own"))
    parent = F.col("above")[F.size("above") - 1]["head"]
    over = F.when(F.size("above") > 1, F.col("above")[F.size("above") - 2]["head"])
    children = tops.select(parent.alias("head")).unionByName(heads.select(over.alias("head")).where("head is not null")).groupBy("head").agg(F.count(F.lit(1)).alias("n_children"))
    ending = ends.select(parent.alias("head"), "ends")
    parents = heads.select(F.col("head").alias("up"), F.col("least").alias("parent"))
    found = heads.withColumn("up", over).join(parents, "up", "left").join(saved, ["depth", "head"]).join(children, "head", "left").join(ending, "head", "left")
    of_heads = found.select(
        F.col("least").alias("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.coalesce("n_children", none).alias("n_children"),
        # A head that burst has children, but for a root whose conversations are all without turns.
        F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
        (F.col("below") + F.col("own")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"),
    )
    rest = ("n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
    depth = F.col("depth").cast("long").alias("depth")
    inner = nodes.where(F.col("top").isNull()).select("conv_id", depth, F.col("parent").alias("parent_conv_id"), *rest)
    of_tops = tops.withColumn("up", parent).drop("parent").join(parents, "up").select("conv_id", depth, F.col("parent").alias("parent_conv_id"), *rest)
    return of_heads.unionByName(inner).unionByName(of_tops)
