"""Connected components by alternating large-star and small-star.

The steps' width follows the number of links: a task for each ``LINKS_PER_TASK`` of them. From as
many as fill all shuffle partitions on, the joins run as Spark plans them, and partitions of a node
with very many links stay split; fewer links are not worth the start of so many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import shuffle_partitions, stored, unstore

LINKS_PER_TASK = 250_000


def _few(df: DataFrame, links: int) -> DataFrame:
    tasks = max(4, -(-links // LINKS_PER_TASK))
    return df.coalesce(tasks) if tasks < shuffle_partitions(df.sparkSession) else df


def _star(edges: DataFrame, large: bool, links: int) -> DataFrame:
    """One step over edges (u, v) with u > v: neighbours are linked to the least of their neighbourhood.

    Large-star links each larger neighbour of a node, small-star each smaller one
    and the node itself. The least neighbours are a table of their own, so that the
    join of a node with a third of all edges is one that Spark splits.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    least = stored(_few(least, links), "star-least")
    joined = both.join(least, "u")
    if large:
        linked = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        linked = linked.filter(F.col("u") > F.col("v")).distinct()
    out = stored(_few(linked, links), "star-edges")
    unstore(least)
    return out


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and those that have one are nobody's."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    counts = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counts.filter((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1))).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of the edges (a, b), stored; a component is named by its least node."""
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = stored(links.filter(F.col("u") > F.col("v")).distinct(), "star-edges")
    count = links.count()
    while not _is_forest_of_stars(links):
        for large in (True, False):
            before, links = links, _star(links, large, count)
            unstore(before)
    ends = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    every = ends.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
    out = stored(_few(every, count), "components")
    unstore(links)
    return out
