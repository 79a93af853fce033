"""Global order at scale: running sums, positions and exact quantiles.

No window here spans all rows. Rows are range-partitioned and sorted by Spark,
written once (so partition numbers stay fixed), summed inside each range and
shifted by the totals of the ranges before it. Inputs are pre-aggregated by
value first, so a value that many rows share is a single row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deliverylens.session import cut_lineage

_PART = "_range"


def _sorted_ranges(df: DataFrame, order_by: Sequence[Column]) -> DataFrame:
    """``df`` range-partitioned by ``order_by``, with the range number added."""
    ranges = df.repartitionByRange(*order_by).withColumn(_PART, F.spark_partition_id())
    return cut_lineage(ranges)


def running_sums(
    df: DataFrame,
    order_by: Sequence[Column],
    measures: Sequence[str],
    groups: Sequence[str] = (),
    prefix: str = "cum_",
) -> DataFrame:
    """Add the running sum of each measure in the given order, per group.

    ``order_by`` must be unique within a group. A large group is spread over
    many ranges. The range totals, one row per group and range, are the only
    rows a window sees together across ranges.
    """
    ranges = _sorted_ranges(df, [*[F.col(g) for g in groups], *order_by])
    before = Window.partitionBy(*groups).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranges.groupBy(*groups, _PART).agg(*[F.sum(m).alias(f"_total_{m}") for m in measures])
    offsets = totals.select(
        *groups,
        _PART,
        *[F.coalesce(F.sum(f"_total_{m}").over(before), F.lit(0)).alias(f"_before_{m}") for m in measures],
    )
    inside = Window.partitionBy(*groups, _PART).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranges.select("*", *[F.sum(m).over(inside).alias(f"_inside_{m}") for m in measures])
    return summed.join(offsets, [*groups, _PART]).select(
        *df.columns,
        *[(F.col(f"_inside_{m}") + F.col(f"_before_{m}")).alias(prefix + m) for m in measures],
    )


def rows_at(df: DataFrame, order_by: Sequence[str], positions: Sequence[int]) -> list:
    """The rows at the given zero-based positions of the total order.

    Collects one count per range and one row per position.
    """
    ordered = df.select(*order_by).orderBy(*order_by).withColumn("_row", F.monotonically_increasing_id())
    ordered = cut_lineage(ordered)
    range_of = F.shiftright("_row", 33)
    counts = {r["r"]: r["n"] for r in ordered.groupBy(range_of.alias("r")).agg(F.count("*").alias("n")).collect()}
    wanted: dict[int, list[int]] = {}
    start = 0
    for part in sorted(counts):
        for index, position in enumerate(positions):
            if start <= position < start + counts[part]:
                wanted.setdefault((part << 33) + position - start, []).append(index)
        start += counts[part]
    found = ordered.filter(F.col("_row").isin(list(wanted))).collect()
    result = [None] * len(positions)
    for row in found:
        for index in wanted[row["_row"]]:
            result[index] = row
    return result


def value_weights(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """Distinct non-null values per group with their number of rows."""
    return df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_weight"))


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probabilities: dict[str, float],
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per probability.

    ``probabilities`` maps output names to fractions. A group without values
    has no row. Only the ranges that hold a wanted position are summed row by
    row.
    """
    groups = list(groups)
    weights = value_weights(df, groups, value)
    ranges = _sorted_ranges(weights, [F.col(c) for c in (*groups, value)])
    totals = ranges.groupBy(*groups, _PART).agg(F.sum("_weight").alias("_in_range"))
    # One row per group and range: small, and bounded by groups plus ranges.
    group_window = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    totals = totals.select(
        *groups,
        _PART,
        "_in_range",
        F.coalesce(
            F.sum("_in_range").over(group_window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_before"),
        F.sum("_in_range").over(group_window).alias("_all"),
    )
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("name"), (F.lit(float(p)) * (F.col("_all") - 1)).alias("at"))
            for name, p in probabilities.items()
        ]
    )
    targets = (
        totals.select("*", F.explode(wanted).alias("_q"))
        .select(
            *groups,
            _PART,
            "_before",
            F.col("_q.name").alias("_name"),
            (F.col("_q.at") - F.floor("_q.at")).alias("_fraction"),
            F.floor("_q.at").alias("_low"),
            F.ceil("_q.at").alias("_high"),
            "_in_range",
        )
        .filter(
            ((F.col("_low") >= F.col("_before")) & (F.col("_low") < F.col("_before") + F.col("_in_range")))
            | ((F.col("_high") >= F.col("_before")) & (F.col("_high") < F.col("_before") + F.col("_in_range")))
        )
    )
    inside = Window.partitionBy(*groups, _PART).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    hit_ranges = targets.select(*groups, _PART).distinct()
    located = ranges.join(hit_ranges, [*groups, _PART], "left_semi").withColumn("_upto", F.sum("_weight").over(inside))
    matched = located.join(targets, [*groups, _PART])
    last = F.col("_before") + F.col("_upto")
    first = last - F.col("_weight")
    low_value = F.max(F.when((F.col("_low") >= first) & (F.col("_low") < last), F.col(value)))
    high_value = F.max(F.when((F.col("_high") >= first) & (F.col("_high") < last), F.col(value)))
    per_name = matched.groupBy(*groups, "_name").agg(
        low_value.alias("_v_low"), high_value.alias("_v_high"), F.max("_fraction").alias("_fraction")
    )
    interpolated = F.col("_v_low") + (F.col("_v_high") - F.col("_v_low")) * F.col("_fraction")
    return per_name.groupBy(*groups).agg(
        *[F.max(F.when(F.col("_name") == name, interpolated)).alias(name) for name in probabilities]
    )
