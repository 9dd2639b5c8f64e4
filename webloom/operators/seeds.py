"""Seed lists and teleport vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.errors import DataSourceError

WEIGHTS = ("log_rank", "sqrt_rank", "uniform", "score")


def validate_seed(seed: DataFrame) -> None:
    """Reject an empty seed, blank domains, and NaN or negative scores."""
    bad_domain = F.col("domain").isNull() | (F.trim("domain") == "")
    bad_score = F.isnan("consensus") | (F.col("consensus") < 0)
    r = seed.agg(F.count(F.lit(1)).alias("n"), F.count_if(bad_domain).alias("domains"), F.count_if(bad_score).alias("scores")).first()
    if r.n == 0:
        raise DataSourceError("seed: it has no ranked rows")
    if r.domains:
        raise DataSourceError(f"seed: {r.domains} domains are null or blank")
    if r.scores:
        raise DataSourceError(f"seed: {r.scores} scores are NaN or negative")


def rank_weight(kind: str, rank: Column, score: Column) -> Column:
    if kind not in WEIGHTS:
        raise ValueError(f"unknown seed weight {kind!r}; known: {', '.join(WEIGHTS)}")
    by_kind = {
        "log_rank": lambda: F.lit(1.0) / F.log2(rank + 1),
        "sqrt_rank": lambda: F.lit(1.0) / F.sqrt(rank.cast("double")),
        "uniform": lambda: F.lit(1.0),
        "score": lambda: score,
    }
    return by_kind[kind]()


def numbered(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Rows with 1, 2, ... in order. For rows already cut to a number that one task can hold."""
    from pyspark.sql import Window as W

    return df.withColumn(name, F.row_number().over(W.orderBy(*order)))


def seed_weights(seed: DataFrame, weight: str = "log_rank", size: int = 10_000) -> DataFrame:
    """(domain, rank, w) of the best `size` domains by consensus, ties by domain.

    Rows without a score are unranked and dropped; a domain's best score counts. The list is cut by a
    partial top-N before it is numbered, so no task sorts all of it.
    """
    ranked = seed.where(F.col("consensus").isNotNull())
    validate_seed(ranked)
    best = ranked.groupBy("domain").agg(F.max("consensus").alias("consensus"))
    order = (F.col("consensus").desc(), F.col("domain").asc())
    top = numbered(best.orderBy(*order).limit(size), *order)
    out = top.select("domain", "rank", rank_weight(weight, F.col("rank"), F.col("consensus")).alias("w"))
    if weight == "score" and not out.agg(F.max("w") > 0).first()[0]:
        raise DataSourceError("seed: score weights need a positive score")
    return out


def teleport_vector(weights: DataFrame, vertices: DataFrame) -> DataFrame:
    """(id, w) of the seed domains on the graph, weights scaled to sum 1. Adaptive execution broadcasts the seed where it is small."""
    on = vertices.join(weights.select("domain", "w"), "domain").select("id", "w")
    total = on.agg(F.sum("w")).first()[0]
    if not total:
        raise DataSourceError("seed: none of its domains is on the graph")
    return on.select("id", (F.col("w") / F.lit(total)).alias("w"))


def seed_coverage(weights: DataFrame, vertices: DataFrame) -> DataFrame:
    """One row: n_seed, n_on_graph, coverage."""
    on = weights.select("domain").distinct().join(vertices.select("domain", F.lit(1).alias("hit")), "domain", "left")
    return on.agg(F.count(F.lit(1)).alias("n_seed"), F.count("hit").alias("n_on_graph")).withColumn("coverage", F.coalesce(F.try_divide("n_on_graph", "n_seed"), F.lit(0.0)))
