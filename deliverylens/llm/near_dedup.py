"""Operator 2: near-duplicate documents by MinHash with sequential Bayesian verification.

1. Every text becomes its set of hashed five-word shingles and a signature of
   128 minima. Texts with the same set are one node, found by partial sums.
2. Bands of four minima give buckets; a pair at the threshold shares none of the
   32 with a probability of 5e-6. In each bucket all nodes are candidates of one
   leader, drawn by a hash of node and band, so a group of near copies has up to
   32 leaders and no bucket emits its pairs.
3. Signatures of candidates are compared batch by batch. A pair is dropped as
   soon as its posterior probability to reach the threshold (uniform prior) is
   below ``MISS``; survivors are confirmed on the full sets.
4. Links join components. In buckets that then hold several components, a node
   stays only if the shingles it shares with other components are enough for a
   link to any size that occurs beside it; that bound is exact and takes one
   pass over the shingles. The nodes that stay are compared across components in
   blocks: on their signatures first, then survivors on their full sets, which
   the block holds. So no pair is ever a row unless it is a link, one link stands
   for all between a node and a component, and a task holds two blocks, bounded
   in nodes and in shingles, however large the bucket is.

Defined cases: a null or wordless text has an empty set and links with nothing;
texts of fewer than five words are one shingle; a null id counts as the
largest and stands alone in its output as null; rows with equal ids are told
apart by their texts, and rows equal in both have one fate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deliverylens.llm import common
from deliverylens.llm.common import NO_ID, U64, Powers, as_bytes, mix, order_key, prefix_hash, ship, small_batches
from deliverylens.llm.components import components, dealt_join
from deliverylens.session import run_dir

ship(__name__)

SHINGLE = 5
NUMERATOR, DENOMINATOR = 75, 100  # links: DENOMINATOR * intersection >= NUMERATOR * union
HASHES, ROWS = 128, 4
BANDS = HASHES // ROWS
LOOKS = range(16, HASHES + 1, 16)  # minima compared at each look at the posterior
MISS = 1e-4  # probability at which a candidate is given up
BLOCK = 1000  # nodes of a bucket that are compared with as many others in one task
BLOCK_SHINGLES = 1_000_000  # their shingles, about; a block may still be one long text

_draw = np.random.default_rng(20)
_A, _B = ((_draw.integers(0, 2**32, (HASHES, 1), np.uint64) | U64(1)).astype(np.uint32) for _ in range(2))
_K = _draw.integers(0, 2**64, SHINGLE, np.uint64) | U64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingles(text: bytes, powers: Powers) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    word = np.concatenate([[False], ~_SPACE[data], [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, U64)
    p = prefix_hash(data, powers)
    w = mix((p[end] - p[start]) * powers.up[start])
    n = min(len(w), SHINGLE)
    s = sum(w[j : len(w) - n + 1 + j] * _K[j] for j in range(n)) + U64(n)
    return np.unique(mix(s))


def signature(s: np.ndarray) -> np.ndarray:
    """The minima of a set, folded to 16 bits."""
    high, low = (s >> U64(32)).astype(np.uint32), s.astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(s), 2048):
        least = np.minimum(least, (high[i : i + 2048] * _A + low[i : i + 2048] * _B).min(axis=1))
    return (mix(least.astype(U64)) >> U64(48)).astype(np.uint16)


NODE_SCHEMA = "ord long, th int, n long, node long, sig binary"


def as_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        n, node, sig = [], [], []
        for text in batch.column("bytes").to_pylist():
            s = shingles(text, powers)
            n.append(len(s))
            if len(s):
                # A sum of scattered hashes does not depend on their order.
                total = np.add.reduce(mix(s ^ U64(common.BASE))) + U64(len(s))
                node.append(int(mix(np.array([total], U64)).view(np.int64)[0]))
                sig.append(signature(s).tobytes())
            else:
                node.append(None)
                sig.append(None)
        yield pa.record_batch(
            {"ord": batch.column("ord"), "th": batch.column("th"), "n": pa.array(n, pa.int64()), "node": pa.array(node, pa.int64()), "sig": pa.array(sig, pa.binary())}
        )


def least_matches(looks) -> list[tuple[int, int, int]]:
    """(minima compared before, now, matches below which a pair is given up) for each look.

    With a uniform prior the posterior of the similarity is a beta distribution;
    its tail above the threshold is a binomial sum.
    """
    t, out, before = NUMERATOR / DENOMINATOR, [], 0
    for n in looks:
        tail, m = (1 - t) ** (n + 1), 0
        while tail < MISS:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((before, n, m))
        before = n
    return out


def surviving(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that no batch of minima rules out, with their share of equal minima."""
    looks = least_matches(LOOKS)
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, HASHES) for c in ("sig_a", "sig_b"))
        alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
        for low, high, bound in looks:
            matches[alive] += (a[alive, low:high] == b[alive, low:high]).sum(axis=1)
            alive = alive[matches[alive] >= bound]
        kept = batch.select(["a", "b"]).take(pa.array(alive))
        yield pa.record_batch({"a": kept.column("a"), "b": kept.column("b"), "share": pa.array(matches[alive] / HASHES)})


def details(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of each node."""
    powers = Powers()
    for batch in batches:
        sets = [shingles(text, powers) for text in batch.column("bytes").to_pylist()]
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        flat = pa.array(np.concatenate([*sets, np.zeros(0, U64)]).view(np.int64))
        yield pa.record_batch({"node": batch.column("node"), "s": pa.ListArray.from_arrays(pa.array(ends), flat)})


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets without repeats reach the threshold."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both)


def block_links(block: pa.Table) -> pa.Table:
    """Confirmed links across components, of one pair of blocks of a bucket.

    A pair belongs to the first band it shares, hence comes from one bucket
    alone. Of a node's pairs with one component the likeliest are tried first,
    until one is a link.
    """
    node, label, n, f, minor, asks = (block.column(c).to_numpy() for c in ("node", "label", "n", "f", "minor", "asks"))
    sig = np.frombuffer(b"".join(block.column("sig").to_pylist()), np.uint16).reshape(-1, HASHES)
    sets = block.column("s").combine_chunks()
    values, ends = sets.values.to_numpy(), sets.offsets.to_numpy()
    band = block.column("at")[0].as_py()
    left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
    looks, found = least_matches(LOOKS), []
    for low in range(0, len(left), 64):
        x, y = left[low : low + 64, None], right[None]
        across = (label[x] != label[y]) & (~minor[y] | (node[x] < node[y]))  # two minor nodes meet twice
        a, b = np.nonzero(across & (DENOMINATOR * np.minimum(f[x], f[y]) >= NUMERATOR * (n[x] + n[y] - np.minimum(f[x], f[y]))))
        a, b = left[low + a], right[b]
        matches = np.zeros(len(a), np.int64)
        for start, end, bound in looks:
            keep = np.zeros(len(a), bool)
            for k in range(0, len(a), 8192):
                part = slice(k, k + 8192)
                matches[part] += (sig[a[part], start:end] == sig[b[part], start:end]).sum(axis=1)
                keep[part] = matches[part] >= bound
            a, b, matches = a[keep], b[keep], matches[keep]
        same = (sig[a] == sig[b]).reshape(-1, BANDS, ROWS).all(axis=2)
        own = same.argmax(axis=1) == band
        a, b, matches = a[own], b[own], matches[own]
        met = None
        for k in np.lexsort((-matches, label[b], a)):
            u, v = a[k], b[k]
            if met != (u, label[v]) and linked(values[ends[u] : ends[u + 1]], values[ends[v] : ends[v + 1]]):
                met = (u, label[v])
                found.append((node[u], node[v]))
    u, v = np.array(found, np.int64).reshape(-1, 2).T
    return pa.table({"u": u, "v": v})


def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets reach the threshold."""
    powers = Powers()
    last: tuple = (None, None)
    for batch in batches:
        keep = []
        for i, (a, ta, tb) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "text_a", "text_b")))):
            if last[0] != a:  # rows of one leader mostly follow one another
                last = a, shingles(ta, powers)
            if linked(last[1], shingles(tb, powers)):
                keep.append(i)
        kept = batch.take(pa.array(keep, pa.int64()))
        yield pa.record_batch({"u": kept.column("a"), "v": kept.column("b")})


def written(df: DataFrame, name: str) -> DataFrame:
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # no job to look for the schema


def could_link(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """(a, b, share) of the pairs that the signatures do not rule out."""
    a = signatures.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a"))
    b = signatures.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b"))
    size = F.least("n_a", "n_b") * DENOMINATOR >= F.greatest("n_a", "n_b") * NUMERATOR
    joined = dealt_join(dealt_join(pairs, b, "b"), a, "a").where(size)
    return joined.select("a", "b", "sig_a", "sig_b").mapInArrow(surviving, "a long, b long, share double")


def do_link(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(u, v) of the pairs confirmed on their full sets."""
    a = texts.select(F.col("node").alias("a"), F.col("bytes").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("bytes").alias("text_b"))
    return dealt_join(dealt_join(pairs, b, "b"), a, "a").select("a", "text_a", "text_b", "b").mapInArrow(confirmed, "u long, v long")


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose nodes have no common component yet."""
    a = labels.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
    b = labels.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
    joined = dealt_join(dealt_join(pairs, a, "a", "left"), b, "b", "left")
    return joined.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).drop("label_a", "label_b")


def mixed(placed: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components."""
    several = placed.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("band")
    return dealt_join(placed, several, "band")


def across_components(members: DataFrame, labels: DataFrame, signatures: DataFrame, texts: DataFrame) -> DataFrame:
    """(u, v): links between components whose nodes share a bucket."""
    placed = dealt_join(members.select("band", "at", "node"), labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    placed = written(dealt_join(mixed(placed), signatures.select("node", "n"), "node"), "mixed")

    # A link's shingles lie in both components, so a node needs enough that do.
    nodes = written(placed.groupBy("node").agg(F.min("label").alias("label"), F.min("n").alias("n")), "mixed")
    full = written(dealt_join(texts, nodes.select("node"), "node").mapInArrow(details, "node long, s array<long>"), "details")
    each = dealt_join(full, nodes.select("node", "label"), "node").select("node", F.explode("s").alias("h"), "label")
    both = each.groupBy("h").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("h")
    shared = written(dealt_join(each, both, "h").groupBy("node").agg(F.count(F.lit(1)).alias("f")), "shared")
    # The least size beside a node, in any of its buckets, that a link allows.
    beside = placed.groupBy("band").agg(F.min("n").alias("low"))
    low = dealt_join(placed, beside, "band").groupBy("node").agg(F.min("low").alias("low"))
    able = dealt_join(dealt_join(nodes, shared, "node"), low, "node")
    other = F.greatest(F.ceil(F.col("n") * NUMERATOR / DENOMINATOR), F.col("low"))
    able = able.where(F.col("f") * (DENOMINATOR + NUMERATOR) >= NUMERATOR * (F.col("n") + other)).select("node", "f")
    left = written(mixed(dealt_join(placed, able, "node")), "able")

    # Nodes outside the largest component of a bucket (minor) meet all of the bucket, in blocks by a hash of the node.
    sizes = left.groupBy("band", "label").agg(F.count(F.lit(1)).alias("count"), F.sum("n").alias("size"))
    top = F.max(F.struct("count", "label", "size"))
    sizes = sizes.groupBy("band").agg(top.alias("top"), F.sum("count").alias("all"), F.sum("size").alias("shingles"))
    rows = dealt_join(left, sizes, "band").withColumn("minor", F.col("label") != F.col("top.label"))
    blocks_of = lambda count, size: F.ceil(F.greatest(count / BLOCK, size / BLOCK_SHINGLES))
    asking = blocks_of(F.col("all") - F.col("top.count"), F.col("shingles") - F.col("top.size"))
    asked = blocks_of(F.col("all"), F.col("shingles"))
    block, blocks = lambda c: F.pmod(F.xxhash64("node"), c), lambda c: F.explode(F.sequence(F.lit(0).cast("long"), c - 1))
    use = ("band", "at", "node", "label", "n", "f", "minor")
    queries = rows.where("minor").select(*use, F.lit(True).alias("asks"), block(asking).alias("i"), asked.alias("c")).select("*", blocks(F.col("c")).alias("j"))
    others = rows.select(*use, F.lit(False).alias("asks"), block(asked).alias("j"), asking.alias("c")).select("*", blocks(F.col("c")).alias("i"))
    sets = dealt_join(full, signatures.select("node", "sig"), "node")
    pairs_of_blocks = dealt_join(queries.drop("c").unionByName(others.drop("c")), sets, "node").groupBy("band", "i", "j")
    return pairs_of_blocks.applyInArrow(block_links, "u long, v long")


def as_links(labels: DataFrame) -> DataFrame:
    """Links that hold components together, for a search that goes on with more links."""
    return labels.where("node <> label").select(F.col("node").alias("u"), F.col("label").alias("v"))


def find_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(ord, th, n, least): for each distinct id and text its set size and the least id of its group.

    ``ord`` is the id or the largest number, ``th`` a hash of the text.
    """
    small_batches(docs.sparkSession)
    keyed = docs.select(order_key(id_column).alias("ord"), F.hash(text_column).alias("th"), as_bytes(text_column).alias("bytes"))
    nodes = written(keyed.mapInArrow(as_nodes, NODE_SCHEMA), "nodes")

    # Buckets of more than one node, each with its leader.
    one = nodes.where("node is not null").select("node", "n", "sig").dropDuplicates(["node"])
    keys = F.array(*(F.xxhash64(F.lit(i), F.substring("sig", 1 + 2 * ROWS * i, 2 * ROWS)) for i in range(BANDS)))
    bands = one.select("node", F.posexplode(keys).alias("at", "band"))
    # The leader of a bucket is its node with the least hash together with the band.
    turn = F.xxhash64("node", "band")
    leaders = bands.groupBy("band").agg(F.min(F.struct(turn.alias("t"), "node")).alias("first"), F.count(F.lit(1)).alias("size"))
    leaders = leaders.where("size > 1").select("band", F.col("first.node").alias("leader"))
    members = written(dealt_join(bands, leaders, "band"), "members")

    # What the checks need of these nodes: signature, size, and the text of one document each.
    wanted = members.select("node").distinct()
    signatures = written(dealt_join(one, wanted, "node"), "signatures")
    picked = dealt_join(nodes, wanted, "node").groupBy("node").agg(F.min(F.struct("ord", "th")).alias("d")).select("node", "d.ord", "d.th")
    texts = written(dealt_join(keyed, picked, ["ord", "th"]).select("node", "bytes").dropDuplicates(["node"]), "texts")

    # Candidates of leaders; first the best of each node, then what is still apart.
    stars = members.where("node <> leader").groupBy(F.col("leader").alias("a"), F.col("node").alias("b")).agg(F.lit(1).alias("x")).drop("x")
    likely = written(could_link(stars, signatures), "likely")
    best = likely.groupBy("b").agg(F.max_by("a", F.struct("share", "a")).alias("a"))
    links = written(do_link(best, texts), "links")
    labels = written(components(links), "labels")
    links2 = written(do_link(apart(dealt_join(likely, best, ["a", "b"], "left_anti"), labels), texts), "links")
    labels = written(components(as_links(labels).union(links2)), "labels")

    links3 = written(across_components(members, labels, signatures, texts), "links")
    if not links3.isEmpty():
        labels = written(components(as_links(labels).union(links3)), "labels")

    placed = dealt_join(nodes.select("ord", "th", "n", "node"), labels, "node", "left")
    alone = F.xxhash64("ord", "th")  # a text without words has no node
    placed = placed.withColumn("group", F.struct(F.col("node").isNull().alias("bare"), F.coalesce("label", "node", alone).alias("g")))
    least = placed.where("node is not null").groupBy("group").agg(F.min("ord").alias("low"))
    return dealt_join(placed, least, "group", "left").select("ord", "th", "n", F.coalesce("low", "ord").alias("least"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    number = F.when(F.col("ord") != NO_ID, F.col("ord"))
    group = F.when(F.col("least") != NO_ID, F.col("least"))
    return find_groups(docs, id_column, text_column).select(
        number.alias("doc_id"), F.col("n").alias("n_shingles"), group.alias("component_id"), (F.col("ord") == F.col("least")).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that are the first of their group; a bare text is a group of its own."""
    gone = find_groups(docs, id_column, text_column).where("ord > least").select(F.col("ord").alias("gone_ord"), F.col("th").alias("gone_th")).distinct()
    here = (order_key(id_column) == F.col("gone_ord")) & (F.hash(text_column) == F.col("gone_th"))
    return dealt_join(docs, gone, here, "left_anti")
