"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def contract(links: DataFrame) -> DataFrame:
    """``(u, v)`` for the links ``(u, v)``: every node of a component with a link, but for
    the smallest one, together with that smallest node. Links are contracted to stars; a step
    costs aggregates by node and joins back to them, so a node with very many links is
    pre-aggregated and its join is split."""
    edges = cut_lineage(links.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        # stars: no node is the smallest of one component and a member of another
        inner = edges.select("u").distinct().join(
            edges.select(F.col("v").alias("u")).distinct(), "u")
        twice = edges.groupBy("u").agg(F.count("v").alias("n")).where("n > 1").select("u")
        if inner.unionAll(twice).isEmpty():
            return edges
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("k")).where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        near = large.join(low, F.col("u") == F.col("k"))
        small = near.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.unionAll(low.select(
            F.col("k").alias("u"), F.col("m").alias("v"))).distinct())
