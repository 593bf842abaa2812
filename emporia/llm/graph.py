"""Connected components by joins (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import cut


def _star(both: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of ``u`` to the smallest id around ``u``; sums are combined before the shuffle."""
    # Dealt out anew, so that the join is not bound to the aggregate's partitions and Spark can split a hub.
    around = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).repartition("m", "u")
    joined = both.join(around, "u")
    if large:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = around.filter("m < u").select("u", F.col("m").alias("v"))
    return joined.filter("v < u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (u, v: bigint) with a link.

    Every round makes each node point at the smallest id among its
    neighbours, first for the larger neighbours, then for the smaller
    ones; rounds grow with the logarithm of the longest path. Hubs are
    never gathered: a node's neighbours meet only in a minimum and in a
    join that Spark can split. Null ends, loops and repeated links do
    not matter; no link gives an empty result. Only counts reach the
    driver.
    """
    now = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
              .filter("u is not null and v is not null and u != v").distinct())
    state = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, True).filter("u != v").distinct()
        now = cut(_star(large, False).filter("u != v").distinct())
        new = now.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("u", "v") % 1000003)).first()
        if new == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = new
    raise RuntimeError("components did not settle")
