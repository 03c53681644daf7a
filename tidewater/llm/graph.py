"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import discard, durable

#: Rounds shrink the graph; their tables have about so many edges in a file.
EDGES_A_FILE = 500_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge, as a durable table; root is the least node of its component.

    Each round points all larger neighbours of a node at its least neighbour, then all smaller ones; rounds grow with the
    logarithm of the longest path. Nothing but a count and a checksum of the edges reaches the driver.
    """
    edges = edges.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high")).where("low < high").distinct()
    edges = durable(edges, "edges")
    before = _fingerprint(edges)
    while before[0]:
        files = -(-before[0] // EDGES_A_FILE)
        both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).union(edges.select("low", "high"))
        # The least neighbours are written, so that the joins see two plain exchanges and can split the neighbours of a hub.
        least = durable(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(files), "least")
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("low"), F.col("v").alias("high"))
        large = durable(large.where("low < high").distinct().coalesce(files), "edges")
        lower = durable(large.groupBy("high").agg(F.min("low").alias("m")).coalesce(files), "least")
        small = large.join(lower, "high").select("m", "low", "high")
        small = small.select(F.col("m").alias("low"), F.explode(F.array("low", "high")).alias("high"))
        contracted = durable(small.where("low < high").distinct().coalesce(files), "edges")
        discard(edges, large, least, lower)
        edges, after = contracted, _fingerprint(contracted)
        if after == before:
            break
        before = after
    roots = edges.groupBy("high").agg(F.min("low").alias("root")).select(F.col("high").alias("node"), "root")
    out = durable(roots.union(edges.select("low", F.col("low").alias("root")).distinct()), "roots")
    discard(edges)
    return out


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
    return row[0], row[1]
