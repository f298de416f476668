"""Connected components of a table of links, as joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; the component is its smallest node.

    Alternating large-star and small-star steps: each round is two shuffles of the links that are left, and their
    number never grows, whatever the size or the diameter of a component. Every round is written to the shared folder.
    Null ends and links from a node to itself are ignored.
    """
    edges = links.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = _print(edges)
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter(F.col("u") != F.col("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        after = cut(small.select("e.u", "e.v").filter(F.col("u") != F.col("v")).distinct())
        edges, last, before = after, before, _print(after)
        if last == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _print(edges: DataFrame) -> tuple:
    """Three numbers that tell whether a set of edges changed."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first())
