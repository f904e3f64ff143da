"""Connected components of an edge table in a logarithmic number of rounds.

Alternates the large-star and small-star steps: each keeps the components and
pulls every node closer to the smallest node it knows, until the edges are stars
around the component's minimum.  A round is two aggregations and two joins on the
edge table (no component is ever collected), written to the checkpoint folder so
that lost executors recompute one round only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them (edges come as u > v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """`(node, component)`: the smallest node reachable over undirected edges.

    Only nodes with an edge to another node are returned; null ends and loops are
    left out.  Node columns must be of one orderable type."""
    a, b = F.col(src), F.col(dst)
    now = edges.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    before = None
    while True:
        seen = Observation()
        now = cut_lineage(now.observe(seen, F.count(F.lit(1)).alias("n"),
                                      F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h")))
        state = (seen.get["n"], seen.get["h"])
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
        now = _small_star(_large_star(now))
