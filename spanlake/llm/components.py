"""Connected components of a graph of links, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.llm.frames import table

def _follow(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """node, root with each root replaced by its own root in parents, if it has one."""
    above = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return nodes.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))


def _ordered(edges: DataFrame, a: str, b: str) -> DataFrame:
    return edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()


def extend(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """The least node that each linked node can reach, but for those that are the least themselves: node, root.

    roots: the result for earlier links, or None; links: further ones (a, b). Each round gives every node its least
    smaller neighbour as parent, follows parents to the top by doubling, and contracts the links to the tops. What is
    left shrinks round by round; nothing is gathered in one place.
    """
    if roots is not None:
        known = roots.select(F.col("node").alias("k"), F.col("root").alias("top"))
        links = links.join(known.withColumnRenamed("k", "a").withColumnRenamed("top", "a_top"), "a", "left").join(known.withColumnRenamed("k", "b").withColumnRenamed("top", "b_top"), "b", "left")
        links = links.select(F.coalesce("a_top", "a").alias("a"), F.coalesce("b_top", "b").alias("b"))
    edges = table(_ordered(links, "a", "b"))
    out = roots
    while not edges.isEmpty():
        parents = table(edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")))
        while True:  # each turn doubles the steps that a node looks up
            above = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
            turn = table(parents.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")))
            parents = turn.drop("moved")
            if turn.where("moved").isEmpty():
                break
        tops = parents.select(F.col("node").alias("hi"), F.col("root").alias("hi_top"))
        lows = parents.select(F.col("node").alias("lo"), F.col("root").alias("lo_top"))
        edges = table(_ordered(edges.join(tops, "hi").join(lows, "lo", "left").select("hi_top", F.coalesce("lo_top", "lo").alias("lo_top")), "hi_top", "lo_top"))
        # a node gets a parent once only: those of earlier rounds are no ends of contracted links
        out = parents if out is None else table(_follow(out, parents).unionByName(parents.join(out, "node", "left_anti")))
    return out if out is not None else edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
