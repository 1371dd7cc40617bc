"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, so no node's neighbours meet in one task;
the edges are written to the shared scratch folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

MAX_ROUNDS = 60


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that has a link; component is its smallest reachable node.

    Self links, repeated links and links with a null end are ignored. Nodes without
    a link don't appear: they are their own component.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(u, v).distinct()
    edges = materialize(edges, "links")
    before = _signature(edges)
    for _ in range(MAX_ROUNDS if before[0] else 0):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        after = _signature(edges)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
