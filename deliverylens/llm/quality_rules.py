"""Operator 7: quality rules whose cutoffs are chosen with a bound on false rejection.

A rule rejects a document when a statistic lies above a cutoff. For each stratum
and rule the cutoffs of a fixed grid are tested from the mildest to the strictest
on all labelled documents: the exact (Clopper-Pearson) upper bound on the share of
good documents that the cutoff rejects has to stay within ``RISK`` / rules. The
tests of one rule are a fixed sequence that stops at the first failure, so they
need no correction among themselves; over rules and strata the error is divided
(Bonferroni). Hence, with probability 1 - ``ERROR``, no stratum loses more than
``RISK`` of its good documents to the rules. A rule is used only if it then rejects
some bad document; strata with too few labels reject nothing beyond the base.

Every stratum is judged on its own, however many there are. Counts come from all
labelled rows through one Spark aggregate; tasks choose the cutoffs of the strata
they hold, and the table of cutoffs is joined to the documents. The driver gets
the number of strata only. Statistics are made once per document, whole texts are
read, and no text is shuffled.

Defined cases: a null or empty text has no words and fails the base; a null
stratum is the stratum ''; null labels are not counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.llm import common
from deliverylens.llm.common import U64, Powers, as_bytes, mix, prefix_hash, ship, small_batches
from deliverylens.session import run_dir

ship(__name__)

RISK, ERROR = 0.05, 0.05
MIN_WORDS, REPEAT_SHARE = 50, 50  # the base: fewer words, or a larger share (percent) of repeated ones, fails
#: Grid of every rule, strictest first; statistics are shares of words, characters or lines.
GRID = [round(x, 3) for x in np.linspace(0.01, 1.0, 100)]
SYMBOLS = np.zeros(256, np.int64)
SYMBOLS[list(b"#*$%&|<>")] = 1

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_letters", "n_marks", "n_bare")


def counted(text: bytes, powers: Powers) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS."""
    data = np.frombuffer(text, np.uint8)
    word = np.concatenate([[False], ~_SPACE[data], [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    n = len(start)
    points = int(((data & 0xC0) != 0x80)[word[1:-1]].sum())
    kinds = np.bincount(data, minlength=256)
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
    repeated = 0
    if n > 2:
        p = prefix_hash(data, powers)
        w = mix((p[end] - p[start]) * powers.up[start])
        triple = mix(w[:-2] * U64(3) + mix(w[1:-1] * U64(5) + mix(w[2:])))
        _, back, times = np.unique(triple, return_inverse=True, return_counts=True)
        many = np.concatenate([[0, 0], times[back] > 1, [0, 0]])
        repeated = int((many[:-2] + many[1:-1] + many[2:] > 0).sum())
    capitals, letters = int(kinds[65:91].sum()), int(kinds[65:91].sum() + kinds[97:123].sum())
    bare = int((end - start == 1).sum())
    return n, points, int((kinds * SYMBOLS).sum()), len(lines) - len(set(lines)), repeated, len(lines), capitals, letters, int(kinds[33]), bare


def counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        rows = [counted(t, powers) for t in batch.column("bytes").to_pylist()]
        columns = zip(*rows) if rows else [()] * len(COUNTS)
        yield pa.record_batch({"rest": batch.column("rest"), **{c: pa.array(v, pa.int64()) for c, v in zip(COUNTS, columns)}})


def statistics(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Other columns in the struct ``rest``, and the counts of each text."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*(c for c in docs.columns if c != text_column)).alias("rest"), as_bytes(text_column).alias("bytes"))
    schema = ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(counter, f"rest {rows.schema['rest'].dataType.simpleString()}, {schema}")


def rules() -> dict[str, Column]:
    """The statistic of each rule, from the counts."""

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return {
        "symbols": share("n_symbols", "word_chars"),
        "duplicate_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "capitals": share("n_capitals", "n_letters"),
        "exclamations": share("n_marks", "word_chars"),
        "bare_words": share("n_bare", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words"))


def upper_bound(k: int, n: int, error: float) -> float:
    """Exact upper bound on a share after k hits in n, wrong with a probability of ``error`` at most."""
    if k >= n:
        return 1.0

    def log_at_most(p: float) -> float:
        logs = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p) for j in range(k + 1)]
        top = max(logs)
        return top + math.log(sum(math.exp(x - top) for x in logs))

    low, high, goal = k / n, 1.0 - 1e-12, math.log(error)
    for _ in range(60):
        middle = (low + high) / 2
        if middle <= 0 or log_at_most(middle) > goal:
            low = middle
        else:
            high = middle
    return high


def choose(counts: dict[tuple[str, str], tuple[np.ndarray, np.ndarray]], strata: int, risk: float = RISK, error: float = ERROR, n_rules: int | None = None) -> dict[tuple[str, str], float]:
    """Cutoffs by stratum and rule; ``counts`` are good and bad documents by grid step (statistic <= step)."""
    n_rules = n_rules or len({r for _, r in counts})
    out = {}
    for (stratum, rule), (good, bad) in sorted(counts.items()):
        n, limit, each = int(good.sum()), risk / max(n_rules, 1), error / max(1, strata * n_rules)
        if upper_bound(0, n, each) > limit:
            continue
        best = None
        for i in range(len(GRID) - 1, -1, -1):  # from the mildest
            over = int(good[i + 1 :].sum())
            if over > limit * n or upper_bound(over, n, each) > limit:
                break
            best = i
        if best is not None and bad[best + 1 :].sum() > 0:
            out[stratum, rule] = GRID[best]
    return out


def chooser(strata: int, n_rules: int, risk: float, error: float):
    """(s, rule, cut) of the strata and rules of a task, from counts by grid step; rows of one stratum and rule are in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for s, rule, step, good, n in zip(*(batch.column(c).to_pylist() for c in ("s", "rule", "step", "good", "count"))):
                of = counts.setdefault((s, rule), (np.zeros(len(GRID) + 1, np.int64), np.zeros(len(GRID) + 1, np.int64)))
                of[0 if good == 1 else 1][step] += n
        rows = [(s, r, GRID.index(cut)) for (s, r), cut in choose(counts, strata, risk, error, n_rules).items()]
        if rows:
            s, r, cut = zip(*rows)
            yield pa.record_batch({"s": pa.array(s, pa.string()), "rule": pa.array(r, pa.string()), "cut": pa.array(cut, pa.int32())})

    return run


def judge(docs: DataFrame, labels: DataFrame, label: str = "quality", stratum: str = "lang", id_column: str = "doc_id", text_column: str = "text", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Columns of the documents in ``rest``, their counts, base_failed, stratum, failed_rules and kept."""
    spark = docs.sparkSession
    path = run_dir(spark, "statistics")
    statistics(docs, text_column).write.parquet(path)
    made = spark.read.parquet(path).withColumn("s", F.coalesce(F.col(f"rest.`{stratum}`").cast("string"), F.lit("")))
    stats = rules()
    known = labels.where(F.col(label).isNotNull()).select(F.col(id_column).alias("labelled"), F.col(label).cast("int").alias("good"))
    tested = made.where(~base_failed()).join(known, F.col(f"rest.`{id_column}`") == F.col("labelled"))
    # Step i holds statistics in (GRID[i - 1], GRID[i]]; the last has what lies above the grid.
    step = {r: F.least(F.greatest(F.ceil(F.round(s * 100, 6)) - 1, F.lit(0)), F.lit(len(GRID))).cast("int") for r, s in stats.items()}
    long = tested.select("s", "good", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), s.alias("step")) for r, s in step.items()))).alias("x"))
    counts = long.groupBy("s", "x.rule", "x.step", "good").count()
    counted_at = run_dir(spark, "rule_counts")
    counts.write.parquet(counted_at)
    counts = spark.read.parquet(counted_at)
    strata = counts.select("s").distinct().count()
    chosen = counts.repartition("s", "rule").mapInArrow(chooser(strata, len(stats), risk, error), "s string, rule string, cut int")
    cutoffs = chosen.groupBy("s").agg(*(F.max(F.when(F.col("rule") == r, F.col("cut"))).alias(f"cut_{r}") for r in stats))
    made = made.join(cutoffs, "s", "left")
    failed = F.array_compact(F.array(*(F.when(step[r] > F.col(f"cut_{r}"), F.lit(r)) for r in stats)))
    judged = made.withColumn("base_failed", base_failed()).withColumn("failed_rules", failed)
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    return judged.select("rest", *COUNTS, F.col("s").alias("stratum"), "base_failed", "failed_rules", "kept")
