"""Connected components of an edge table, without gathering edges or a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.durable import stored

#: Edges in a file of a round.
FILE = 500_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over (u, v)."""
    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hung = edges.join(least, "u")
    if large:
        return hung.where("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return hung.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root) for every node that has an edge; root is the least node of its component.

    edges: columns u and v of one orderable type, no nulls, either direction, repeats allowed.
    Alternates large-star and small-star (Kiveris et al., "Connected components in MapReduce and
    beyond") until nothing changes; each round is written to shared storage, in as many files as its
    edges are worth. Self-loops are kept as isolated nodes only if the node has no other edge.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            break
        before = state
        now = stored(_star(_star(now, True), False).coalesce(1 + state["n"] // FILE), "edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
