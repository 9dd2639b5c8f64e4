"""PageRank by power iteration: global or personalised.

Edges are dealt by source once, parallel ones merged and weighted by their share of the out-degree,
and kept in that layout. Edges of the few sources with very many of them are kept apart, in any
layout, and meet their sources' ranks by a broadcast; there are at most HEAVY such sources.

A state row is (id, w, sink, rank). The next state is one join and one aggregation away, and the mass
of dangling nodes and the change are summed while it is written, so an iteration is one job. Each
state is stored in the shared folder: lineage and plans don't grow, and a lost executor costs a reread.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from webloom.operators.graph import out_degrees
from webloom.session import remove_path, scratch_path, snapshot

STATE = "id long, w double, sink boolean, rank double"
#: Sources whose edges are kept apart, at most: those with more than this share of all edges each.
HEAVY = 10_000
#: Edges that a source has at least before they are kept apart.
LEAST_HEAVY = 100_000


def validate_teleport(teleport: DataFrame, n_vertices: int) -> None:
    """A teleport vector is non-null, non-negative, unique by id, sums to 1 and stays in [0, n)."""
    bad = F.col("w").isNull() | F.isnan("w") | F.col("id").isNull()
    r = teleport.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(bad).alias("bad"),
        F.min(F.when(~bad, F.col("w"))).alias("least"),
        F.count_distinct("id").alias("ids"),
        F.coalesce(F.sum("w"), F.lit(0.0)).alias("total"),
        F.min("id").alias("min_id"),
        F.max("id").alias("max_id"),
    ).first()
    if r.bad:
        raise ValueError(f"teleport has {r.bad} null/NaN rows")
    if r.least is not None and r.least < 0:
        raise ValueError("teleport has negative weights")
    if r.ids != r.n:
        raise ValueError("teleport has duplicate ids")
    if abs(r.total - 1.0) > 1e-6:
        raise ValueError(f"teleport is not normalized: it sums to {r.total}")
    if r.min_id < 0 or r.max_id >= n_vertices:
        raise ValueError(f"teleport has ids outside [0, {n_vertices})")


def power_iteration(
    edges: DataFrame,
    nodes: DataFrame,
    *,
    max_iter: int,
    tol: float,
    damping: float = 0.85,
    teleport: DataFrame | None = None,
    checkpoint_every: int = 4,
    edge_partitions: int | None = None,
    n_vertices: int | None = None,
    start: DataFrame | None = None,
) -> DataFrame:
    """(id, rank) after at most max_iter steps, or once the L1 change is below tol.

    rank' = (1-d)/n + d*D/n + d*inflow; with a teleport vector w: ((1-d) + d*D)*w + d*inflow, where D
    is the mass of nodes without edges out. start (id, rank) resumes from a snapshot, which must have
    every node. n_vertices overrides the count of nodes. Every checkpoint_every-th state stays in the
    shared folder until the session ends, to resume from (0: none); the others go once they have been
    used. So does the result stay.
    """
    if not 0 < damping < 1:
        raise ValueError(f"damping {damping} is not in (0, 1)")
    n = n_vertices if n_vertices is not None else nodes.count()
    if n == 0:
        raise ValueError("the graph has no nodes")
    if max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    spark = edges.sparkSession
    partitions = edge_partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    pairs = edges.select("from_id", "to_id")
    degree = out_degrees(pairs).persist(StorageLevel.MEMORY_AND_DISK)
    base = nodes.select("id")
    if teleport is None:
        base = base.withColumn("w", F.lit(1.0 / n))
    else:
        validate_teleport(teleport, n)
        base = base.join(teleport.select("id", "w"), "id", "left").select("id", F.coalesce("w", F.lit(0.0)).alias("w"))
    base = base.join(degree, "id", "left").select("id", "w", F.col("out_degree").isNull().alias("sink"))
    if start is not None:
        base = base.join(start.select("id", "rank"), "id", "left")
    else:
        base = base.withColumn("rank", F.col("w"))
    weighted, heavy = shares(pairs, degree, partitions)

    def inflow(ranks: DataFrame) -> DataFrame:
        sources = ranks.select(F.col("id").alias("from_id"), "rank")
        sent = weighted.join(sources, "from_id").select("to_id", (F.col("rank") * F.col("share")).alias("part"))
        if heavy is not None:
            few = sources.join(F.broadcast(heavy.select("from_id").distinct()), "from_id", "left_semi")
            sent = sent.union(heavy.join(F.broadcast(few), "from_id").select("to_id", (F.col("rank") * F.col("share")).alias("part")))
        return sent.groupBy(F.col("to_id").alias("id")).agg(F.sum("part").alias("inflow"))

    def store(state: DataFrame, *sums) -> tuple[str, DataFrame, dict]:
        seen, path = Observation(), scratch_path(spark, "pagerank")
        state.observe(seen, *sums).select("id", "w", "sink", "rank").write.parquet(path)
        return path, spark.read.schema(STATE).parquet(path), seen.get

    dangling = F.sum(F.when(F.col("sink"), F.col("rank"))).alias("dangling")
    try:
        path, state, seen = store(base, dangling, F.count_if(F.col("rank").isNull()).alias("missing"))
        if seen["missing"]:
            raise ValueError(f"start lacks {seen['missing']} nodes of the graph")
        for step in range(1, max_iter + 1):
            spread = (1.0 - damping) + damping * (seen["dangling"] or 0.0)
            rank = F.lit(spread) * F.col("w") + F.lit(damping) * F.coalesce("inflow", F.lit(0.0))
            following = state.join(inflow(state), "id", "left").select("id", "w", "sink", F.col("rank").alias("old"), rank.alias("rank"))
            last = path
            path, state, seen = store(following, dangling, F.sum(F.abs(F.col("rank") - F.col("old"))).alias("change"))
            if step == 1 or not checkpoint_every or (step - 1) % checkpoint_every:
                remove_path(spark, last)
            if tol > 0 and (seen["change"] or 0.0) < tol:
                break
        return state.select("id", "rank")
    finally:
        weighted.unpersist()
        degree.unpersist()


def shares(pairs: DataFrame, degree: DataFrame, partitions: int, least: int = LEAST_HEAVY) -> tuple[DataFrame, DataFrame | None]:
    """Edges (from_id, to_id, share of the source's out-degree), dealt by source, and apart those of heavy sources, if any.

    Parallel edges are merged. A source is heavy if it has more than `least` edges and more than one
    of HEAVY parts of all.
    """
    total, most = degree.agg(F.coalesce(F.sum("out_degree"), F.lit(0)), F.coalesce(F.max("out_degree"), F.lit(0))).first()
    limit = max(least, total // HEAVY)
    merged = pairs.groupBy("from_id", "to_id").agg(F.count(F.lit(1)).alias("n"))
    out = degree.select(F.col("id").alias("from_id"), "out_degree")
    share = ("from_id", "to_id", (F.col("n") / F.col("out_degree")).alias("share"))
    light = merged.join(out.where(F.col("out_degree") <= limit), "from_id").select(*share)
    light = light.repartition(partitions, "from_id").persist(StorageLevel.MEMORY_AND_DISK)
    if most <= limit:
        return light, None
    heavy = merged.join(F.broadcast(out.where(F.col("out_degree") > limit)), "from_id").select(*share)
    return light, snapshot(heavy, "heavy-edges")
