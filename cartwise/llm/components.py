"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import Scratch


def _smallest(pairs: DataFrame) -> DataFrame:
    """Each node's smallest neighbour or itself; partial minima before the shuffle."""
    return pairs.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    pairs = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return pairs.join(_smallest(pairs).hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(pairs)
    moved = pairs.join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one neighbour of a smaller number, which has none itself; partial sums before the shuffle."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("top")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("top")))
    nodes = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("top").alias("top"))
    return not nodes.agg(F.max((F.col("below") > 1) | (F.col("below") > 0) & (F.col("top") > 0))).first()[0]


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(u, v): every node that has an edge, except a component's smallest, and that smallest node.

    Each round is written, so that lineage stays short; rounds grow with the
    logarithm of the longest path, and none is run on edges that are stars already. Joins are merge joins: neighbours and minima are
    grouped by node on executors and never broadcast.
    """
    now = scratch.write(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0")
    step = 0
    while not _stars(now):
        step += 1
        now = scratch.write(_small_star(_large_star(now)), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
    return now
