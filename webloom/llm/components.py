"""Connected components of a link table, without bringing links or labels to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import discard, free_shuffles, materialize


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 50) -> DataFrame:
    """(node, component) of every node that a link names; component is the smallest node reachable.

    Alternates two steps until nothing changes. Large star: each node hands its larger neighbours to
    the smallest node of its neighbourhood. Small star: it hands its smaller neighbours and itself to
    the smallest. Both keep components as they are; the number of rounds grows with the logarithm of
    the longest path. Neighbourhoods are only ever folded to their minimum, with partial sums before
    the shuffle; the join that hands minima back is split by AQE where a node has very many links.
    Each step is written to the shared folder, so a lost executor costs a reread, and goes once the
    next one is written.
    """
    spark = links.sparkSession
    edges = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct()
    edges = materialize(edges, "links")
    seen = None
    for _ in range(most_rounds):
        for star in (_large_star, _small_star):
            least, handed = star(edges)
            following = materialize(handed, "links")
            discard(edges, least)
            edges = following
        free_shuffles(spark)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("hi", "lo").cast("long")), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    nodes = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return nodes.union(roots)


def _large_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stored minima, new edges)."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = materialize(least, "least")  # a stored side leaves the join plain exchanges, which AQE can split
    up = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).join(least, "u")
    return least, up.where("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stored minima, new edges)."""
    least = materialize(edges.groupBy("hi").agg(F.min("lo").alias("m")), "least")
    down = edges.join(least, "hi")
    handed = down.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return least, handed.union(least.select("hi", F.col("m").alias("lo"))).distinct()
