"""Connected components of an edge list by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.sources.working import working_table


def _smallest(directed: DataFrame) -> DataFrame:
    """Each node with its smallest neighbour or itself; the minimum is combined on the map side."""
    return directed.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("low"))


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: hang all larger neighbours of a node on its smallest one. Small star: hang the
    node and its smaller neighbours there. A node with most of the edges is one key of a join."""
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    directed = edges.unionByName(turned) if large else edges
    joined = directed.join(_smallest(directed), F.col("u") == F.col("node"))
    if large:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        moved = joined.select(F.explode(F.array(F.struct("u", F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e")).select("e.*")
    return moved.where(F.col("u") > F.col("v")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``links`` (``a, b``) that
    is not its component's smallest.

    The number of rounds grows with the logarithm of the graph's diameter. Each round's edges are
    written to the shared folder; a count and a checksum per round reach the driver.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(F.col("u") != F.col("v")).distinct()
    edges, seen = working_table(edges, "edges"), None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = mark
        edges = working_table(_step(_step(edges, True), False), "edges")
