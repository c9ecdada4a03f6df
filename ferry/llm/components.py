"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.sources.scratch import materialize


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).collect()[0]
    return tuple(row)


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, for each node of an edge.

    ``edges`` has u and v of one type; loops and repeats do no harm. Neighbours
    are joined to smaller and smaller nodes by turns of large and small stars,
    which take about as many rounds as the logarithm of a component's width. Each
    round is stored, and a hub's edges are joined, never gathered.
    """
    ordered = edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges = materialize(ordered.distinct(), "edges")
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u")
        large = large.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large = materialize(large, "large")
        least = _least(large)
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = materialize(small, "small")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
