"""Connected components of a graph given by its edges, as a loop of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.shared import written


def components(edges: DataFrame) -> DataFrame:
    """node and root (smallest node of its component) of every node that has an edge.

    ``edges``: two columns of ids in any order.  Each round hangs the larger neighbours of
    a node, then the smaller ones, on its smallest neighbour, until only stars are left;
    the number of rounds grows with the logarithm of the graph.  Minima are taken before
    the shuffle, so a node may have any number of neighbours.  Rounds are written to the
    shared folder: nothing of the graph passes through the driver.
    """
    a, b = edges.columns
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs = written(pairs.filter("u != v").distinct(), "edges")
    before = _state(pairs)
    while True:
        pairs = written(_hang_smaller(_hang_larger(pairs)), "edges")
        after = _state(pairs)
        if after == before:
            break
        before = after
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.withColumn("root", F.col("node"))
    )


def _state(pairs: DataFrame) -> tuple:
    mark = F.bit_xor(F.xxhash64("u", "v"))
    return tuple(pairs.agg(F.count("*"), mark).first())


def _hang_larger(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    hung = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.distinct()


def _hang_smaller(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    inner = pairs.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
