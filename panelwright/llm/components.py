"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut

#: Edges in a written file, and the fewest files: a round writes three tables, none larger than twice the first edges.
EDGES, FILES = 100_000, 8


def _nearest(edges: DataFrame, files: int) -> DataFrame:
    """(u, m): the smallest of u and its neighbours. Written, so that the join with the edges exchanges both sides and
    Spark can split a node with very many neighbours."""
    return cut(edges.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m")).coalesce(files))


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) to (node, root), root being the smallest node reachable, for every node with a link.

    Each round joins a node's neighbours to the smallest of them; the number of rounds grows with the logarithm of a
    component's diameter. Rows only ever meet in aggregations and equi joins, whose large keys Spark can split, and
    every round is written to the shared checkpoint folder.
    """
    edges = cut(links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state, files = None, max(FILES, -(-edges.count() // EDGES))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_nearest(both, files), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = _nearest(large, files)
        small = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct().coalesce(files))
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return cut(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()).coalesce(files))
