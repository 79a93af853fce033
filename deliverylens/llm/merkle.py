"""Operator 12: a Merkle manifest of a table, with places read from ranks in bitmaps of ids.

1. Every row becomes a leaf: the digest of its fields with their lengths, and for
   the audit the digest of the changed row. Only ids and digests go on.
2. Per group, ids become compressed bitmaps: 64-bit words of which only those in
   use exist, merged by a Spark aggregate. Words are counted into containers of
   1,024 words, running sums over containers give each one's start, and a sum
   inside its container gives each word's, which together are the popcount
   directory. A leaf's place is its word's start plus the bits set below its own:
   no leaf is sorted.
3. Leaves go to the block of 512 places they belong to and into its slots by
   place, and slots are hashed eight at a time, three levels a round. Block tops
   are the nodes of the next round, so a round leaves a 512th of the rows; the
   roots of the groups are the nodes of one more tree.
4. The siblings on the way to the root come down the same rounds, one path a
   block, and the last step proves every leaf of a block.

A task holds one block (or a run of packed ones), however large a group is. Ids
that several rows share are found by their words having more rows than bits; only
these rows are counted by (id, leaf, part of the table) and numbered.

Defined cases: a null id counts as the largest one and its row is never changed;
rows with equal ids follow in the order of their leaves; a null group is a group
of its own, before all others; an empty table has no rows in its manifest.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deliverylens.llm.common import NO_ID, ship, small_batches
from deliverylens.operators.ranks import running_sums
from deliverylens.session import run_dir

ship(__name__)

FAN = 8
SPAN_BITS = 9  # 512 places a block, three levels of eight
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "g string, pos long, hash binary"


def written(df: DataFrame, name: str) -> DataFrame:
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, fields)).cast("binary"), 256))


def group_key(group: Column) -> Column:
    """A key that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def leaves_of(docs: DataFrame, changed_text: Column, changed: Column, fields=FIELDS, id_column: str = "doc_id", group_column: str = "lang", text_column: str = "text") -> DataFrame:
    """(g, id, tag, leaf, changed leaf or null) of every row, written once; ``tag`` tells rows apart."""
    own = [F.col(f"`{c}`") for c in fields]
    other = [changed_text if c == text_column else F.col(f"`{c}`") for c in fields]
    rows = docs.select(
        group_key(F.col(f"`{group_column}`")).alias("g"),
        F.col(f"`{id_column}`").cast("long").alias("id"),
        leaf_of(own).alias("leaf"),
        F.when(F.coalesce(changed, F.lit(False)), leaf_of(other)).alias("bad"),
    )
    return written(rows.withColumn("tag", F.monotonically_increasing_id()), "leaves")


def bitmaps(leaves: DataFrame) -> DataFrame:
    """The words in use of the bitmap of each group: (g, word, bits, rows)."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("key").bitwiseAND(F.lit(63)).cast("int"))
    return leaves.groupBy("g", F.shiftright("key", 6).alias("word")).agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("rows"))


def directory(words: DataFrame) -> DataFrame:
    """The words with the number of leaves before each of them in its group."""
    high = F.shiftright("word", 10).alias("high")
    containers = words.groupBy("g", high).agg(F.sum("rows").alias("held"))
    starts = running_sums(containers, [F.col("high")], ["held"], groups=["g"]).select("g", "high", (F.col("cum_held") - F.col("held")).alias("start"))
    inside = Window.partitionBy("g", "high").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    within = words.withColumn("high", high).withColumn("within", F.coalesce(F.sum("rows").over(inside), F.lit(0)))
    return within.join(starts, ["g", "high"]).select("g", "word", "bits", "rows", (F.col("start") + F.col("within")).alias("before"))


def ranked(leaves: DataFrame) -> DataFrame:
    """(g, pos, id, leaf, bad): each leaf's place in its group."""
    keyed = leaves.withColumn("key", F.coalesce("id", F.lit(NO_ID)))
    found = written(directory(bitmaps(keyed)), "directory")
    shared = F.col("rows") > F.bit_count("bits")
    below = F.col("bits").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), F.col("key").bitwiseAND(F.lit(63)).cast("int"))))
    keyed = keyed.withColumn("word", F.shiftright("key", 6))
    single = keyed.join(found.where(~shared), ["g", "word"]).select("g", (F.col("before") + F.bit_count(below)).alias("pos"), "id", "leaf", "bad")
    if found.where(shared).isEmpty():
        return single
    rows = keyed.join(found.where(shared).select("g", "word", "before"), ["g", "word"]).withColumn("part", F.shiftright("tag", 33))
    runs = rows.groupBy("g", "word", "key", "leaf", "part").agg(F.count(F.lit(1)).alias("n"))
    runs = running_sums(runs, [F.col("key"), F.col("leaf"), F.col("part")], ["n"], groups=["g", "word"])
    own = Window.partitionBy("g", "word", "key", "leaf", "part").orderBy("tag")  # at most the rows of one part of the written table
    placed = rows.withColumn("k", F.row_number().over(own)).join(runs, ["g", "word", "key", "leaf", "part"])
    return single.union(placed.select("g", (F.col("before") + F.col("cum_n") - F.col("n") + F.col("k") - 1).alias("pos"), "id", "leaf", "bad"))


def parents(level: list[str]) -> list[str]:
    return [sha256("".join(level[i : i + FAN]).encode()).hexdigest() for i in range(0, len(level), FAN)]


def levels_of(level: list[str], first: bool) -> list[list[str]]:
    """The levels of a block, as hex digests, up to its one top.

    The first block of a group ends with the only node of the group if there is
    no other block; each other one goes up all levels of a round.
    """
    out = [level]
    while len(out[-1]) > 1 if first else len(out) <= LEVELS:
        out.append(parents(out[-1]))
    return out


def hexes(blob: bytes) -> list[str]:
    text = blob.hex()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


def fill_slots(table: pa.Table, column: str = "leaf") -> tuple[np.ndarray, list[bytes]]:
    """The slot of each row within its block, and the digests by slot."""
    at = table.column("pos").to_numpy() & ((1 << SPAN_BITS) - 1)
    slots: list[bytes] = [b""] * len(at)
    for k, digest in zip(at.tolist(), table.column(column).to_pylist()):
        slots[k] = digest
    return at, slots


def pack_leaves(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One row for a block of leaves: ids, leaves and changed leaves by slot, and the block's top."""
    at, slots = fill_slots(table)
    order = np.empty_like(at)  # slot to row
    order[at] = np.arange(len(at))
    g, block = key[0].as_py(), key[1].as_py()
    top = levels_of([s.hex() for s in slots], block == 0)[-1][0]
    ids, bad = table.column("id").take(pa.array(order)).to_pylist(), table.column("bad").take(pa.array(order)).to_pylist()
    return pa.table({"g": [g], "block": pa.array([block], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())), "hashes": [b"".join(slots)], "bad": pa.array([bad], pa.list_(pa.binary())), "top": [bytes.fromhex(top)]})


def pack_nodes(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    _, slots = fill_slots(table, "hash")
    g, block = key[0].as_py(), key[1].as_py()
    top = levels_of([s.hex() for s in slots], block == 0)[-1][0]
    return pa.table({"g": [g], "block": pa.array([block], pa.int64()), "hashes": [b"".join(slots)], "top": [bytes.fromhex(top)]})


def climb(nodes: DataFrame) -> list[DataFrame]:
    """The blocks of each round, the last with one block a group."""
    rounds = []
    while True:
        blocks = written(nodes.groupBy("g", F.shiftright("pos", SPAN_BITS).alias("block")).applyInArrow(pack_nodes, "g string, block long, hashes binary, top binary"), "nodes")
        rounds.append(blocks)
        if (blocks.agg(F.max("block")).first()[0] or 0) == 0:
            return rounds
        nodes = tops(blocks)


def tops(blocks: DataFrame) -> DataFrame:
    return blocks.select("g", F.col("block").alias("pos"), F.col("top").alias("hash"))


def step(run: list[str], slot: int) -> bytes:
    """One level of a path: the slot, and the digests of the whole run."""
    return bytes([slot, len(run)]) + bytes.fromhex("".join(run))


def steps(path: bytes) -> Iterator[tuple[int, list[str]]]:
    at = 0
    while at < len(path):
        slot, n = path[at], path[at + 1]
        yield slot, hexes(path[at + 2 : at + 2 + 32 * n])
        at += 2 + 32 * n


def hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path of every node of a block: its levels within the block, then the block's own path."""
    for batch in batches:
        for row in batch.to_pylist():
            levels = levels_of(hexes(row["hashes"]), row["block"] == 0)
            paths = [row["path"]]
            for level in reversed(levels[:-1]):
                paths = [step(level[i - i % FAN : i - i % FAN + FAN], i % FAN) + paths[i // FAN] for i in range(len(level))]
            first, n = row["block"] << SPAN_BITS, len(paths)
            yield pa.record_batch({"g": pa.array([row["g"]] * n, pa.string()), "block": pa.array(range(first, first + n), pa.int64()), "path": pa.array(paths, pa.binary()), "subroot": pa.array([row["subroot"]] * n, pa.binary()), "root": pa.array([row["root"]] * n, pa.binary())})


def descend(rounds: list[DataFrame], paths: DataFrame) -> DataFrame:
    """From the paths of the groups' tops (g, block 0) to those of all nodes that entered the first round."""
    for blocks in reversed(rounds):
        paths = blocks.select("g", "block", "hashes").join(paths, ["g", "block"]).mapInArrow(hand_down, "g string, block long, path binary, subroot binary, root binary")
    return paths


def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaf, proof and the root folded from the changed leaf, for all leaves of each block."""
    for batch in batches:
        for row in batch.to_pylist():
            levels = levels_of(hexes(row["hashes"]), row["block"] == 0)
            above = list(steps(row["path"]))
            tails = ["".join(d for slot, run in above for k, d in enumerate(run) if k != slot)]
            for level in reversed(levels[:-1]):
                tails = ["".join(level[i - i % FAN : i] + level[i + 1 : i - i % FAN + FAN]) + tails[i // FAN] for i in range(len(level))]
            folded = []
            for i, (leaf, bad) in enumerate(zip(levels[0], row["bad"])):
                now, at = leaf if bad is None else bad.hex(), i
                for level in levels[:-1]:
                    low = at - at % FAN
                    now = sha256("".join([*level[low:at], now, *level[at + 1 : low + FAN]]).encode()).hexdigest()
                    at //= FAN
                for slot, run in above:
                    now = sha256("".join([*run[:slot], now, *run[slot + 1 :]]).encode()).hexdigest()
                folded.append(now)
            n, root = len(folded), row["root"].hex()
            yield pa.record_batch(
                {
                    "g": pa.array([row["g"]] * n, pa.string()),
                    "doc_id": pa.array(row["ids"], pa.int64()),
                    "leaf": pa.array(levels[0]),
                    "subroot": pa.array([row["subroot"].hex()] * n),
                    "root": pa.array([root] * n),
                    "proof_sha256": pa.array([sha256(t.encode()).hexdigest() for t in tails]),
                    "folded_root": pa.array(folded),
                    "verified": pa.array([f == root for f in folded]),
                }
            )


def manifest(docs: DataFrame, changed_text: Column, changed: Column, **columns) -> DataFrame:
    """Leaf, proof and check of every row; the group is ``g``, empty for null and else with a leading ``=``.

    ``changed`` marks the rows to check with ``changed_text`` in place of their text.
    """
    spark = docs.sparkSession
    small_batches(spark)
    by_block = ranked(leaves_of(docs, changed_text, changed, **columns)).groupBy("g", F.shiftright("pos", SPAN_BITS).alias("block"))
    blocks = written(by_block.applyInArrow(pack_leaves, "g string, block long, ids array<long>, hashes binary, bad array<binary>, top binary"), "blocks")
    rounds = climb(tops(blocks))
    subroots = rounds[-1].select(F.col("g").alias("group"), F.col("top").alias("subroot"))
    placed = running_sums(subroots.withColumn("one", F.lit(1).cast("long")), [F.col("group")], ["one"]).select("group", "subroot", (F.col("cum_one") - 1).alias("pos"))
    over = climb(placed.select(F.lit("").alias("g"), "pos", F.col("subroot").alias("hash")))
    start = over[-1].select("g", "block", F.lit(b"").alias("path"), F.lit(b"").alias("subroot"), F.col("top").alias("root"))
    to_root = descend(over, start).select(F.col("block").alias("pos"), "path", "root")
    paths = placed.join(to_root, "pos").select(F.col("group").alias("g"), F.lit(0).cast("long").alias("block"), "path", "subroot", "root")
    paths = descend(rounds, paths)
    joined = blocks.drop("top").join(paths, ["g", "block"])
    return joined.mapInArrow(prove, "g string, doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
