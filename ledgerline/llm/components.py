"""Connected components of an edge list, with DataFrame operations and checkpointed rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Alternating star contraction: each round links every node's larger neighbours to its smallest neighbour, then every
    node's smaller neighbours. It needs about log(n) rounds; a round's edges are stored in the shared folder, and the
    driver sees two numbers per round. Minima are aggregated map-side and joined back, so a node with very many
    neighbours is no group of its own in any task. Self loops and repeated edges don't matter; no edges, no rows.
    """

    def hang(pairs: DataFrame) -> DataFrame:
        """Pairs (u, v) to (v, smallest of u and its v)."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), F.least("u", "m").alias("m"))
        # shiftright by 0: both sides get an exchange of their own, so that AQE can split a node with very many pairs
        return pairs.join(least, F.col("u") == F.shiftright("of", 0)).select("u", "v", "m")

    clean = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, seen = stored(clean, name), None
    while not now.isEmpty():
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = hang(both).where("v > u and v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        hung = hang(large.select(F.col("a").alias("u"), F.col("b").alias("v")))
        small = hung.select(F.col("v").alias("a"), F.col("m").alias("b")).union(hung.select(F.col("u").alias("a"), F.col("m").alias("b")))
        now = stored(small.where("a <> b").distinct(), name)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    # at the fixed point every node hangs on its component's smallest node
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
