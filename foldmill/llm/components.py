"""Connected components of a graph of any size, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foldmill.llm.store import settle


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Links the neighbours of every node to the least of them and the node itself.

    ``large`` moves the neighbours above the node, ``small`` those up to it. A node's least
    neighbour is found by partial aggregation and joined back, so no neighbourhood is gathered;
    Spark splits the join where one node has very many neighbours.
    """
    both = edges if small else edges.union(edges.select("low", "high").toDF("high", "low"))
    # In an edge of `both`, "high" is the node and "low" its neighbour.
    least = both.groupBy("high").agg(F.min("low").alias("least"))
    least = least.withColumn("least", F.least("least", "high"))
    joined = both.join(least, "high")
    if small:
        moved = joined.select(F.explode(F.array("high", "low")).alias("high"),
                              F.col("least").alias("low"))
    else:
        moved = joined.filter("low > high").select(F.col("low").alias("high"),
                                                   F.col("least").alias("low"))
    return moved.filter("high > low").distinct()


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())


def component_labels(edges: DataFrame, one: str | Column, other: str | Column) -> DataFrame:
    """``node, component`` for every node with a link; the component is its smallest node.

    Needs about log(size) rounds, after each of which the edges are written to the shared
    folder. Links of a node to itself and null ends count for nothing.
    """
    edges = edges.select(F.greatest(one, other).alias("high"), F.least(one, other).alias("low"))
    edges = settle(edges.filter("high > low").distinct())
    mark = _mark(edges)
    while mark[0]:
        edges = settle(_stars(_stars(edges, small=False), small=True))
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())
