"""Connected components by alternating star operations, on tables that are written between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.tables import staged


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node that each node of ``links`` (a, b) reaches, itself included.

    Large-star joins each node's greater neighbours to its least neighbour, small-star its lesser ones; in
    the end every component is a star around its least node. Minima are partial aggregates and the joins
    may be split, so a node that a third of all rows link to is no task of its own."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = staged(edges, "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        least = least.withColumn("low", F.least("a", "low"))
        edges = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .where("a <> b").distinct())
        low = edges.groupBy("a").agg(F.min("b").alias("low"))
        edges = staged(edges.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
                              F.struct(F.col("a").alias("a"), F.col("low").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct(), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
