"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import staged


def _hub_rounds(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (a, b) with a > b."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    # Every larger neighbour of a node is hung under the least of the node and its neighbours.
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    large = large.where("a > b").distinct()
    # A node and its smaller neighbours are hung under the least of those.
    lower = large.groupBy("a").agg(F.min("b").alias("least"))
    under = large.join(lower, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return under.unionByName(lower.select("a", F.col("least").alias("b"))).where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b): root is the component's least node.

    Alternating star steps; the edges of each round are a written table, so a lost executor
    never replays earlier rounds. Nodes without edges don't occur. Neighbours of a hub are
    reduced to a minimum with map-side combine; the joins may be split by adaptive execution.
    """
    now = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    state = None
    while True:
        seen = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if seen == state or not seen[0]:
            break
        state = seen
        now = staged(_hub_rounds(now), "edges")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
