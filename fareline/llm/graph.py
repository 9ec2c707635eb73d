"""Connected components of a large edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.session import pin


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(least.select("u", F.col("m").alias("v")))


def _is_done(edges: DataFrame) -> bool:
    """Whether each node has one edge at most, and none has one that another node points at."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("in"))
    )
    ends = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return not ends.agg(F.count_if((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("in") > 0)))).first()[0]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge to another one; a component's name is its smallest node.

    Alternates two star operations until every edge points at a node without an edge of its own, which takes about as
    many rounds as the logarithm of the longest path. Edges stay in tables in the shared folder; the driver sees a
    number a round. Loops, repeated edges and edges with a null end are allowed and change nothing.
    """
    at = pin(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    while not _is_done(at):
        at = pin(_small_star(_large_star(at).distinct()).distinct())
    return at.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        at.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
