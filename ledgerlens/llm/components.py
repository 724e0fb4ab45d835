"""Connected components by alternating large-star and small-star steps, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one node at most, and none that hangs has others hung on it.

    Both steps leave such links, and no others, as they are: no round is needed to find that out.
    """
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return not nodes.agg(F.max(F.expr("hangs > 1 or hangs = 1 and holds = 1"))).first()[0]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node with a link; the component is its smallest node.

    Links may be repeated and in either direction; loops and null ends are ignored, and no links give
    an empty frame. Every round is written to the shared folder, so a lost executor costs a task only.
    """
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    now = materialize(_small_star(now), "components")
    while not _are_stars(now):
        now = materialize(_small_star(_large_star(now)), "components")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
