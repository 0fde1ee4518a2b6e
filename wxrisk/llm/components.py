"""Connected components of a link table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame, stage) -> DataFrame:
    """(node, label) for every node of ``links`` (x, y); the label is the smallest node of its component.

    Each step points neighbours at the smallest node around: large stars first, then small
    ones. Only minima are grouped, so a node with many links costs a partial aggregate and a
    join that adaptive execution can split. Steps are written tables, so lineage stays short.
    """
    edges = stage(
        links.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("w")), F.struct(F.col("v").alias("u"), F.col("m").alias("w")))).alias("e")
        ).select(F.col("e.u").alias("u"), F.col("e.w").alias("v"))
        edges = stage(small.where("u <> v").distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or tuple(now) == before:
            break
        before = tuple(now)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
