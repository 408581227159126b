"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import materialise


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One round over undirected edges (a, b): neighbours of a node move to its smallest neighbour or itself.

    A large star moves the larger neighbours and sees both directions; a small star moves the smaller ones.
    Neither gathers a node's neighbours: a minimum per node is aggregated and joined back.
    """
    if larger:
        sided = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    else:
        sided = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = sided.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("low", "a"))
    moved = sided.join(least, "a")
    if larger:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(least.select("a", F.col("low").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(sig, label) of every node of the links (a, b); label is the smallest node of its component.

    Rounds run until the links no longer change; their number grows with the logarithm of the longest chain.
    Every round is written to the shared folder, so lost executors cost at most one round. Nodes without a
    link to another node are absent.
    """
    edges = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        edges = materialise(_stars(_stars(edges, True), False), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("sig"), F.col("b").alias("label")).unionByName(
                edges.select(F.col("b").alias("sig"), F.col("b").alias("label"))).distinct()
        state = now
