"""Exact quantiles of many columns without moving their values.

A mergeable sketch gives, for each wanted position, two values around it. One more
pass counts the values below the lower one, at both, and by value between them, and
the counts give the exact values at the position. Where more than ``FEW`` values may
lie between, passes before that count them and sketch them again with a grid of
cut points, each of which keeps a few hundredths; a hot value becomes an end of its
bracket and is a single count.

The state is a row for each group, column and position. Passes unfold the columns
inside a task and combine there, so a shuffle sees counts, sketches and the distinct
values inside the last brackets, never the columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deliverylens.session import cut_lineage

ACCURACY = 2000
GRID = 200
FEW = 20_000
#: State rows of about 100 bytes up to which the driver keeps them and hands them to every task; more are a written table.
STATE_ROWS = 20_000


def _held(state: DataFrame, most_of: str) -> tuple[DataFrame, bool, int]:
    """The state with its lineage cut, whether it is small, and the largest value of a column."""
    rows = state.limit(STATE_ROWS + 1).toArrow()
    if rows.num_rows <= STATE_ROWS:
        return state.sparkSession.createDataFrame(rows, state.schema), True, pc.max(rows[most_of]).as_py() or 0
    state = cut_lineage(state)
    return state, False, state.agg(F.max(most_of)).first()[0]


def _unfolded(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """A row for each row and column with a value: (by, _i, _x)."""
    values = F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("_i", "_x")
    return df.select(*by, values).where(F.col("_x").isNotNull())


def _same(left: DataFrame, right: DataFrame, key: Sequence[str], how: str = "inner", small: bool = False) -> DataFrame:
    """A join on keys of which the groups may be null."""
    other = right.select(*[F.col(c).alias(f"_on{c}") for c in key], *[c for c in right.columns if c not in key])
    same = reduce(lambda x, y: x & y, [F.col(c) == F.col(f"_on{c}") if c in ("_i", "_k") else F.col(c).eqNullSafe(F.col(f"_on{c}")) for c in key])
    return left.join(F.broadcast(other) if small else other, same, how).drop(*[f"_on{c}" for c in key])


def _zone() -> Column:
    """Where a value lies: below the bracket, at its lower end, inside, at its upper end, above."""
    x, a, b = F.col("_x"), F.col("_a"), F.col("_b")
    return F.when(x < a, 0).when(x == a, 1).when(x < b, 2).when(x == b, 3).otherwise(4)


def _narrowed(rows: DataFrame, state: DataFrame, by: list[str], small: bool) -> tuple[DataFrame, bool, int]:
    """The state with smaller brackets, and the most values inside one that a position needs."""
    key = [*by, "_i", "_k"]
    a, b = F.col("_a"), F.col("_b")
    met = _same(rows, state.select(*key, "_a", "_b"), [*by, "_i"], small=small)
    counts = met.groupBy(*key, _zone().alias("_zone")).agg(F.count(F.lit(1)).alias("_c"))
    by_zone = [F.coalesce(F.sum(F.when(F.col("_zone") == z, F.col("_c"))), F.lit(0)).alias(c) for z, c in enumerate(("_below", "_at_a", "_between", "_at_b"))]
    counted = _same(state, counts.groupBy(*key).agg(*by_zone), key, "left")
    inside = F.col("_below") + F.col("_at_a")
    after = inside + F.col("_between")
    first, last = F.col("_first"), F.col("_last")
    # Beyond the bracket, which the sketch's bound rules out: take the range up to it.
    low = F.when(first < F.col("_below"), F.col("_least")).when(first >= after, b).otherwise(a)
    high = F.when(last >= after + F.col("_at_b"), F.col("_most")).when(last < inside, a).otherwise(b)
    needed = F.when((last >= inside) & (first < after), F.col("_between")).otherwise(F.lit(0))
    state = counted.withColumns({"_inside": inside, "_after": after, "_open": needed, "_a": low, "_b": high})
    state, small, most = _held(state.drop("_below", "_at_a", "_between", "_at_b"), "_open")
    if most > FEW:
        x, many = F.col("_x"), F.col("_open") > FEW
        met = _same(rows, state.where(many).select(*key, "_a", "_b"), [*by, "_i"], small=small).where((x > a) & (x < b))
        grids = met.groupBy(*key).agg(F.percentile_approx("_x", [i / GRID for i in range(GRID + 1)], 20 * GRID).alias("_grid"))
        step = F.try_divide(F.lit(GRID), F.col("_open"))
        at_low = F.greatest(F.floor((first - F.col("_inside")) * step) - 1, F.lit(0)).cast("int")
        at_high = F.least(F.ceil((last + 1 - F.col("_inside")) * step) + 1, F.lit(GRID)).cast("int")
        low = F.when(first >= F.col("_inside"), F.get("_grid", at_low))
        high = F.when(last < F.col("_after"), F.get("_grid", at_high))
        narrower = _same(state, grids, key, "left").withColumns({"_a": F.coalesce(low, a), "_b": F.coalesce(high, b)}).drop("_grid")
        state, small, _ = _held(narrower, "_open")
    return state.drop("_inside", "_after", "_open"), small, most


def column_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float], by: Sequence[str] = (), name: str = "feature") -> DataFrame:
    """One row per column and group with exact quantiles, linearly interpolated.

    ``probabilities`` maps output names to fractions. Nulls are left out; a column
    without values in a group has no row.
    """
    by, columns, shares = list(by), list(columns), [float(p) for p in probabilities.values()]
    rows = _unfolded(df, columns, by)
    key = [*by, "_i", "_k"]

    margin = 1.5 / ACCURACY
    around = [f for p in shares for f in (max(0.0, p - margin), min(1.0, p + margin))]
    sketched = rows.groupBy(*by, "_i").agg(F.count("_x").alias("_n"), F.min("_x").alias("_least"), F.max("_x").alias("_most"), F.percentile_approx("_x", around, ACCURACY).alias("_s"))
    spots = sketched.select("*", F.posexplode(F.array(*map(F.lit, shares))).alias("_k", "_p"))
    position = F.col("_p") * (F.col("_n") - 1)
    # The sketch is wrong by n / ACCURACY places at most; with few values that is less than the place after.
    few = F.col("_n") < 4 * ACCURACY
    state, small, most = _held(
        spots.select(
            *key,
            F.floor(position).alias("_first"),
            F.ceil(position).alias("_last"),
            (position - F.floor(position)).alias("_share"),
            "_n",
            "_least",
            "_most",
            F.when(few, F.col("_least")).otherwise(F.get("_s", 2 * F.col("_k"))).alias("_a"),
            F.when(few, F.col("_most")).otherwise(F.get("_s", 2 * F.col("_k") + 1)).alias("_b"),
        ),
        "_n",
    )
    most *= 5 * margin
    while most > FEW:
        state, small, most = _narrowed(rows, state, by, small)

    met = _same(rows, state.select(*key, "_a", "_b"), [*by, "_i"], small=small)
    zone = _zone()
    value = F.when(zone == 2, F.col("_x")).when(zone == 1, F.col("_a")).when(zone == 3, F.col("_b"))
    counts = met.select(*key, zone.alias("_zone"), value.alias("_v")).where("_zone < 4").groupBy(*key, "_zone", "_v").agg(F.count(F.lit(1)).alias("_c"))
    up_to = F.sum("_c").over(Window.partitionBy(*key).orderBy("_zone", "_v").rowsBetween(Window.unboundedPreceding, 0))
    placed = _same(counts.withColumn("_up_to", up_to).where("_zone > 0"), state.select(*key, "_first", "_last", "_share"), key, small=small)
    at = lambda c: F.max(F.when((F.col(c) >= F.col("_up_to") - F.col("_c")) & (F.col(c) < F.col("_up_to")), F.col("_v")))
    picked = placed.groupBy(*key).agg(at("_first").alias("_low"), at("_last").alias("_high"), F.first("_share").alias("_share"))
    low, high = (F.coalesce(c, F.raise_error(F.lit("a quantile lies outside its bracket"))) for c in ("_low", "_high"))
    exact = picked.withColumn("_value", low + (high - low) * F.col("_share"))
    found = exact.groupBy(*by, "_i").agg(*[F.max(F.when(F.col("_k") == k, F.col("_value"))).alias(w) for k, w in enumerate(probabilities)])
    return found.select(F.get(F.array(*map(F.lit, columns)), F.col("_i")).alias(name), *by, *probabilities)
