"""Connected components of a link table by alternating large and small stars.

Each round halves path lengths with two shuffles of the links; a node's many links are
reduced to their minimum before the shuffle and joined back on the node; the minima are
written first, so that adaptive execution can split the links of a hot node. Rounds are written to the shared scratch folder, which
cuts the lineage; the loop ends when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tables import materialise


def _signature(edges: DataFrame) -> tuple:
    """Names a table of distinct links; exclusive or, unlike a sum, has no number of links at which it overflows."""
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64(F.lit(1), "a", "b"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``links`` has long columns a and b. Returns (node, component) for every node of a link
    between different nodes; the component is its smallest node. Null ends are ignored."""
    edges = links.select("a", "b").where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialise(edges, "links")
    before = _signature(edges)
    while before[0]:
        # Large star: every larger neighbour of a node is linked to the node's smallest neighbour.
        both = edges.union(edges.select("b", "a")).toDF("a", "b")
        least = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")),
                            "star-heads")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct())
        edges = materialise(small, "stars")
        after = _signature(edges)
        if after == before:
            break
        before = after
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(edges.select("b", "b").distinct()))
