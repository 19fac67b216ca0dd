"""Connected components of an edge table, in rounds of large stars and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.store import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least node around it."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.where("v > u").join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node with an edge; the component is its least node.

    ``edges`` has two whole-number columns. Loops and repeats do no harm, rows with nulls
    are left out. Each round is a handful of aggregates and joins on node ids, written to
    the workspace; a node with very many neighbours is an ordinary skewed join key. The
    number of rounds grows with the logarithm of the components' sizes.
    """
    a, b = edges.columns
    pairs = edges.where(f"`{a}` <> `{b}`").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    state, before = materialize(pairs, "components"), None
    while True:
        sums = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if sums == before or not sums[0]:
            break
        before = sums
        state = materialize(_small_star(_large_star(state)), "components")
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
