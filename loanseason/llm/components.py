"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanseason.session import stored


def _with_least_neighbour(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) with m, the least of u and all its v.

    The least neighbours are written first, so the join sees their size and may split a node
    that very many others are linked to.
    """
    least, _ = stored(pairs.groupBy("u").agg(F.min("v").alias("m")), "star-least")
    return pairs.join(least.withColumn("m", F.least("u", "m")), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least_neighbour(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _with_least_neighbour(down)
    moved = near.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(near.select("u", F.col("m").alias("v")))


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or has exactly one edge, to a centre."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("centre")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    ends = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("centre").alias("centre"))
    return ends.filter(F.col("down") + F.col("centre") > 1).limit(1).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Map every node of the edges (u, v) to the least node it is connected with: (node, component).

    Both steps replace a node's neighbours by the least of them until only stars are left. The
    number of rounds grows with the logarithm of the longest path; every round is written to the
    shared folder, so a lost executor costs one round at most. Loops and repeated edges are
    harmless; edges with a NULL end are ignored; without edges there are no rows.
    """
    simple = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    now, _ = stored(simple, "star-edges")
    while not _all_stars(now):
        now, _ = stored(_small_star(_large_star(now)).filter("u > v").distinct(), "star-edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
