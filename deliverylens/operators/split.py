"""Chronological train / validation / test split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deliverylens.errors import SplitError
from deliverylens.operators.ranks import rows_at

SPLITS = ("train", "validation", "test")


@dataclass(frozen=True)
class SplitCuts:
    """First row of the validation and of the test part, in (time, key) order."""

    rows: int
    train_end: int
    validation_end: int
    validation_start: tuple
    test_start: tuple


def find_cuts(
    df: DataFrame,
    ts: str,
    key: str,
    train: float = 0.70,
    validation: float = 0.85,
) -> SplitCuts:
    """Locate the two cut rows.

    Days are counted first; only the day that holds a cut is sorted, by time
    and then key. A day with a third of all rows is still a distributed sort
    of two narrow columns. Collected: one count per calendar day.
    """
    days = {
        r["day"]: r["n"]
        for r in df.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n")).collect()
    }
    if days.get(None):
        raise SplitError(f"{days[None]} rows without {ts}")
    n = sum(days.values())
    ends = (int(n * train), int(n * validation))
    if not 0 < ends[0] < ends[1] < n:
        raise SplitError(f"{n} rows are too few for three non-empty parts")
    by_day: dict = {}
    start = 0
    for day in sorted(days):
        inside = [(i, e - start) for i, e in enumerate(ends) if start <= e < start + days[day]]
        if inside:
            by_day[day] = inside
        start += days[day]
    cuts: list = [None, None]
    for day, inside in by_day.items():
        one_day = df.filter(F.to_date(ts) == F.lit(day))
        for (index, _), row in zip(inside, rows_at(one_day, [ts, key], [p for _, p in inside])):
            cuts[index] = (row[ts], row[key])
    return SplitCuts(n, ends[0], ends[1], cuts[0], cuts[1])


def _at_or_after(ts: str, key: str, cut: tuple) -> Column:
    return (F.col(ts) > F.lit(cut[0])) | ((F.col(ts) == F.lit(cut[0])) & (F.col(key) >= F.lit(cut[1])))


def split_column(cuts: SplitCuts, ts: str, key: str) -> Column:
    """Name of the part a row belongs to: two comparisons, no shuffle."""
    return (
        F.when(_at_or_after(ts, key, cuts.test_start), "test")
        .when(_at_or_after(ts, key, cuts.validation_start), "validation")
        .otherwise("train")
    )


def chronological_split(df: DataFrame, ts: str, key: str, train: float = 0.70, validation: float = 0.85) -> DataFrame:
    """Add ``split``: the earliest ``train`` share, then up to ``validation``, then the rest."""
    return df.withColumn("split", split_column(find_cuts(df, ts, key, train, validation), ts, key))


def split_summary(df: DataFrame, ts: str) -> DataFrame:
    """Rows, share, period and label counts per part."""
    per_split = df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(ts).alias("start_date"),
        F.max(ts).alias("end_date"),
        F.sum(1 - F.col("is_late")).alias("on_time_orders"),
        F.sum("is_late").alias("late_orders"),
        (F.avg("is_late") * 100).alias("late_rate_pct"),
    )
    whole = F.sum("rows").over(Window.partitionBy(F.lit(0)))
    return per_split.select(
        "split",
        "rows",
        (F.col("rows") / whole * 100).alias("percentage"),
        "start_date",
        "end_date",
        "on_time_orders",
        "late_orders",
        "late_rate_pct",
    )


def split_report(df: DataFrame, ts: str, key: str) -> DataFrame:
    """Per part: rows, unique keys, null labels and dates, first and last time."""
    per_key = df.groupBy("split", key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("is_late").isNull()).alias("_no_label"),
        F.count_if(F.col(ts).isNull()).alias("_no_date"),
        F.min(ts).alias("_first"),
        F.max(ts).alias("_last"),
    )
    return per_key.groupBy("split").agg(
        F.sum("_n").alias("rows"),
        F.count(F.lit(1)).alias("unique_orders"),
        F.sum(F.col("_n") - 1).alias("duplicates"),
        F.sum("_no_label").alias("missing_labels"),
        F.sum("_no_date").alias("missing_dates"),
        F.min("_first").alias("min_date"),
        F.max("_last").alias("max_date"),
    )


def check_split(df: DataFrame, ts: str, key: str, expected_rows: int | None = None) -> None:
    """Raise unless the parts are whole, disjoint, non-empty and in time order."""
    found = {r["split"]: r for r in split_report(df, ts, key).collect()}
    if set(found) != set(SPLITS):
        raise SplitError(f"parts found: {sorted(found)}")
    total = sum(r["rows"] for r in found.values())
    if expected_rows is not None and total != expected_rows:
        raise SplitError(f"parts hold {total} rows, expected {expected_rows}")
    for name, r in found.items():
        if r["duplicates"] or r["missing_labels"] or r["missing_dates"]:
            raise SplitError(f"{name}: {r.asDict()}")
    for earlier, later in zip(SPLITS, SPLITS[1:]):
        if found[earlier]["max_date"] > found[later]["min_date"]:
            raise SplitError(f"{earlier} ends after {later} starts")
    shared = sum(r["shared_orders"] for r in split_overlap(df, key).collect())
    if shared:
        raise SplitError(f"{shared} orders occur in more than one part")


def split_overlap(df: DataFrame, key: str, pairs: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Keys two parts share, for each pair of parts; one aggregate by key."""
    pairs = pairs or [("train", "validation"), ("train", "test"), ("validation", "test")]
    member = df.groupBy(key).agg(*[F.max(F.when(F.col("split") == s, 1).otherwise(0)).alias(s) for s in SPLITS])
    row = member.agg(*[F.count_if((F.col(a) == 1) & (F.col(b) == 1)).alias(f"{a} - {b}") for a, b in pairs])
    return row.unpivot([], row.columns, "pair", "shared_orders")


def time_range(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("earliest_order"), F.max(ts).alias("latest_order"))
