"""Operator 9: mixing sources to target weights by Pfair scheduling.

The documents of a source, in the order of a hash of their ids, form blocks. With
weight w, block k of a source is released at slot floor(k / w) and due by slot
ceil((k + 1) / w); in each slot the released block with the earliest deadline is
taken. So after t slots a source is less than one block from w * t. Weights are
the exact target weights: they are made whole by a common factor, and releases and
deadlines come from whole numbers without rounding, so the bound holds however
long a phase is. When a source has no blocks left, a new phase begins with the
weights of the others scaled up, so every document is placed exactly once.

A schedule follows from slot to slot, so one task makes it, from one count per
source: a step for a block of ``block`` documents, memory for the sources, and
blocks as they come. Spark joins them to the rows. The driver sees one number.
Places within a source come from counts of hash ranges and a row number within
each range, so a source with most of the rows is split over many tasks.

Defined cases: a null source is the source ''; a null id sorts first; equal rows
get neighbouring places; sources without a given weight get the smallest.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from math import ceil, lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deliverylens.llm.common import quoted, ship

ship(__name__)

BLOCK = 64
RANGE_ROWS = 4000  # rows of one source that one window sorts, about
SENT_BLOCKS = 100_000  # blocks in a batch of the schedule


def shares(weights: dict[str, float], period: int) -> dict[str, int]:
    """Whole shares of the period, at least one each, by largest remainders; for schedules that have to repeat."""
    total = sum(weights.values())
    exact = {s: max(1.0, w / total * period) for s, w in weights.items()}
    out = {s: int(x) for s, x in exact.items()}
    missing = period - sum(out.values())
    for s in sorted(out, key=lambda s: (out[s] - exact[s], s))[: max(0, missing)]:
        out[s] += 1
    while missing < 0:  # minimum shares took too much
        s = max(out, key=lambda s: (out[s], s))
        out[s] -= 1
        missing += 1
    return out


def earliest_deadlines(weight: dict[str, int], length: int) -> Iterator[tuple[str, int]]:
    """The source and its block's number for each slot; weights are whole numbers of any sum."""
    total = sum(weight.values())
    waiting = [(-(-total // w), s, 0) for s, w in weight.items()]
    heapq.heapify(waiting)
    coming: list[tuple[int, int, str, int]] = []
    for t in range(length):
        while coming and coming[0][0] <= t:
            heapq.heappush(waiting, heapq.heappop(coming)[1:])
        _, s, k = heapq.heappop(waiting)
        yield s, k
        # The next block of a source has a later deadline, so it need not wait before this one is placed.
        heapq.heappush(coming, ((k + 1) * total // weight[s], -(-(k + 2) * total // weight[s]), s, k + 1))


def one_period(share: dict[str, int], period: int) -> dict[str, list[int]]:
    """Slots of each source within a period, by earliest deadline first."""
    slots: dict[str, list[int]] = {s: [] for s in share}
    for t, (s, _) in enumerate(earliest_deadlines(share, period)):
        slots[s].append(t)
    return slots


def schedule(blocks: dict[str, int], weights: dict[str, float]) -> Iterator[tuple[str, int, int]]:
    """(source, block, slot) of all blocks, in the order of the slots."""
    exact = {s: Fraction(weights[s]) for s in blocks}
    factor = lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * factor) for s, w in exact.items()}
    left, done, slot = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0
    while left:
        weight = {s: whole[s] for s in left}
        total = sum(weight.values())
        length = min(n * total // weight[s] for s, n in left.items())
        took = dict.fromkeys(left, 0)
        for s, k in earliest_deadlines(weight, length):
            yield s, done[s] + k, slot
            took[s] += 1
            slot += 1
        for s, n in took.items():
            done[s] += n
            left[s] -= n
            if not left[s]:
                del left[s]


def target_weights(counts: dict[str, int], weights: dict[str, float] | None, exponent: float) -> dict[str, float]:
    given = weights or {s: n**exponent for s, n in counts.items()}
    least = min((w for w in given.values() if w > 0), default=1.0)
    return {s: max(given.get(s, least), least * 1e-6) for s in counts}


def scheduled(weights: dict[str, float] | None, exponent: float, block: int):
    """Blocks and slots from the counts of all sources, which one task reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            counts.update(zip(batch.column("s").to_pylist(), batch.column("n").to_pylist()))
        if not counts:
            return

        def sent(rows: list[tuple[str, int, int]]) -> pa.RecordBatch:
            s, k, slot = zip(*rows)
            return pa.record_batch({"p_source": pa.array(s, pa.string()), "p_block": pa.array(k, pa.int64()), "slot": pa.array(slot, pa.int64())})

        rows = []
        for row in schedule({s: ceil(n / block) for s, n in counts.items()}, target_weights(counts, weights, exponent)):
            rows.append(row)
            if len(rows) == SENT_BLOCKS:
                yield sent(rows)
                rows = []
        if rows:
            yield sent(rows)

    return run


def own_names(columns: list[str]) -> tuple[str, str, str]:
    """Names of source_block, slot and place; one that a document column has gets underscores until it is free."""
    taken = {c.lower() for c in columns}

    def free(name: str) -> str:
        return free(name + "_") if name in taken else name

    return free("source_block"), free("slot"), free("place")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, exponent: float = 0.5, block: int = BLOCK, source_column: str = "source", id_column: str = "doc_id", seed: int = 9) -> DataFrame:
    """All columns of the documents, with source_block, slot and place in the mixture (both from 0).

    ``weights`` are target weights by source; without them a source of n rows
    weighs n ** exponent. Rows are not sorted; ``in_order`` does that.
    """
    source: Column = F.coalesce(F.col(source_column).cast("string"), F.lit(""))
    names = own_names(docs.columns)
    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("doc"), source.alias("s"), F.xxhash64(F.lit(seed), id_column).alias("h"), F.col(id_column).alias("id"))
    counts = rows.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.agg(F.max("n")).first()[0]
    if not largest:
        return docs.withColumns({c: F.lit(0).cast("long") for c in names})
    plan = counts.repartition(1).mapInArrow(scheduled(weights, exponent, block), "p_source string, p_block long, slot long")

    # A row's number within its source: rows of smaller hash ranges, then those of its own.
    ranges = max(1, ceil(largest / RANGE_ROWS))
    part = F.shiftrightunsigned("h", 33) * ranges / F.lit(2.0**31)
    rows = rows.withColumn("r", F.floor(part).cast("int"))
    before = rows.groupBy("s", "r").count().select("s", "r", (F.sum("count").over(Window.partitionBy("s").orderBy("r")) - F.col("count")).alias("before"))
    own = F.row_number().over(Window.partitionBy("s", "r").orderBy("h", "id"))
    numbered = rows.withColumn("own", own - 1).join(before, ["s", "r"]).withColumn("number", F.col("before") + F.col("own"))
    numbered = numbered.withColumn("k", F.floor(F.col("number") / block).cast("long"))

    placed = numbered.join(plan, (F.col("s") == F.col("p_source")) & (F.col("k") == F.col("p_block")))
    place = F.col("slot") * block + F.col("number") % block
    return placed.select(*(F.col("doc")[c].alias(c) for c in docs.columns), *(c.alias(n) for c, n in zip((F.col("k"), F.col("slot"), place), names)))


def in_order(docs: DataFrame, **options) -> DataFrame:
    """The documents, sorted by their place in the mixture."""
    return mix(docs, **options).orderBy(quoted(own_names(docs.columns)[2])).select(*map(quoted, docs.columns))
