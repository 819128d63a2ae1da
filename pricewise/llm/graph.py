"""Connected components of a link table by alternating large and small stars.

Each round is two aggregations by node (minimum over neighbours, combined before
the shuffle) and a join back, so a node with very many links is never gathered;
adaptive execution splits its rows in the join. Rounds grow with the logarithm of
the longest path. Every round is written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step on distinct links (u, v). Large: every larger neighbour of u is
    linked to u's smallest neighbour or u. Small: every smaller one, and u itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else \
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    if larger:
        out = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = both.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, label) for every node with a link; label is the smallest node reachable.

    Null nodes and links of a node with itself are dropped; repeated links count once.
    """
    now = cut_lineage(edges.select(F.col(u).alias("u"), F.col(v).alias("v"))
                      .where("u is not null and v is not null and u <> v").distinct(), "links")
    before = None
    while True:
        now = cut_lineage(_star(_star(now, larger=True), larger=False), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select("v", "v").distinct())
