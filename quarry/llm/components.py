"""Connected components of a link table, as joins and minimum aggregates.

Alternating large-star and small-star rounds: every node points its larger
neighbours, then itself and its smaller ones, at the smallest one it knows.
A round is a map-side-combined minimum and one equi-join, so a node with
millions of links is pre-aggregated and its join partition can be split; no
neighbour list is ever built.  Each round is written to the shared checkpoint
folder; only two totals come back to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of one orderable type -> (node, root): the smallest
    node reachable, for every node with a link to another one.  Self links,
    repeated links and both directions are allowed; no links, no rows."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = cut_lineage(edges)
    before = None
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)))
        # stars whose links did not change in number or sum of ends are final
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = tuple(now)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    up = both.where("v > u").join(low, "u")
    return up.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return down.union(low.select("u", F.col("m").alias("v"))).distinct()
