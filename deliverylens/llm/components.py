"""Connected components by alternating star contraction, on edges that stay in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from deliverylens.session import run_dir


def dealt_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join that deals out both sides, so that the driver neither gathers nor broadcasts one, however small it is."""
    return left.join(right.hint("merge"), on, how)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the least of its neighbours and itself; edges have u > v."""
    both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    least = both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.col("w")).alias("m"))
    return dealt_join(edges.select(F.col("v").alias("w"), "u"), least, "w").select("u", F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the least of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = dealt_join(down, least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _stored(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges, written and read again, with their number and a sum over them, which come with the write."""
    spark, state = edges.sparkSession, Observation()
    path = run_dir(spark, "stars")
    edges.observe(state, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).write.parquet(path)
    return spark.read.schema(edges.schema).parquet(path), state.get


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (u, v); the label is the least node of its component.

    Each round is one job that writes to shared storage; the driver sees one
    sum a round, which that job brings along. A hub takes one row per partial
    aggregate, and its join can be split.
    """
    (now, state), seen = _stored(_small_star(edges)), None
    while state["n"] and state != seen:
        seen = state
        now, state = _stored(_small_star(_large_star(now)))
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select("v", "v").distinct())
