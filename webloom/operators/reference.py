"""External reference scores: normalised to registered domains and joined to ours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.psl import registered_domains
from webloom.sources.readers import only_crawl


def normalise_trust(rows: DataFrame, host: str, trust: str, volume: str, status: str = "status", ref_domains: str = "ref_domains", ext_backlinks: str = "ext_backlinks") -> DataFrame:
    """One row for each registered domain: the maximum of each number and the most telling status.

    Rows whose trust isn't a number, or whose host has no registered domain, are dropped; zero trust stays.
    """
    names = registered_domains(rows.select(F.col(host).alias("host")))
    typed = rows.select(
        F.col(host).alias("host"),
        F.col(trust).try_cast("double").alias("ref_trust"),
        F.col(volume).try_cast("double").alias("ref_volume"),
        F.col(ref_domains).try_cast("long").alias("ref_domains"),
        F.col(ext_backlinks).try_cast("long").alias("ext_backlinks"),
        F.col(status).alias("status"),
    ).where("ref_trust is not null")
    order = F.when(F.col("status") == "Found", 3).when(F.col("status") == "MayExist", 2).when(F.col("status") == "NotFound", 1).otherwise(0)
    named = typed.join(names, "host").where("domain is not null")
    best = F.max(F.struct(order.alias("o"), "status"))["status"]
    return named.groupBy("domain").agg(*[F.max(c).alias(c) for c in ("ref_trust", "ref_volume", "ref_domains", "ext_backlinks")], best.alias("status"))


def normalise_rank_csv(rows: DataFrame, domain: str = "Domain", score: str = "Open Page Rank") -> DataFrame:
    """(domain, score) of a public rank list: registered domains, best score of each; what isn't a number is dropped."""
    names = registered_domains(rows.select(F.col(domain).alias("host")))
    typed = rows.select(F.col(domain).alias("host"), F.col(score).try_cast("double").alias("opr_score")).where("opr_score is not null")
    return typed.join(names, "host").where("domain is not null").groupBy("domain").agg(F.max("opr_score").alias("opr_score"))


def overlap(ours: DataFrame, theirs: DataFrame, crawl: str | None = None, pr_col: str = "pagerank_score", domain_map: DataFrame | None = None) -> DataFrame:
    """(domain, our_pr, opr_score[, n_hosts], crawl if there): domains in both. ours may be (id, rank) with a domain_map (id, domain)."""
    rows = only_crawl(ours, crawl)
    if domain_map is not None:
        rows, pr_col = rows.join(domain_map, "id"), pr_col if pr_col in rows.columns else "rank"
    extra = [c for c in ("n_hosts", "crawl") if c in rows.columns]
    return rows.select("domain", F.col(pr_col).alias("our_pr"), *extra).join(theirs, "domain").select("domain", "our_pr", "opr_score", *extra)


def authority_vs_trust(authority: DataFrame, vertices: DataFrame, trust: DataFrame, k: int | None = None) -> DataFrame:
    """(domain, open_authority, ref_trust) of the k best by authority (all if None), joined to a trust reference."""
    named = authority.join(vertices, "id").select("domain", F.col("rank").alias("open_authority"))
    top = named.orderBy(F.desc("open_authority"), "domain").limit(k) if k else named
    return top.join(trust, "domain").select("domain", "open_authority", "ref_trust")


def lift_over_global(personal: DataFrame, overall: DataFrame, vertices: DataFrame, k: int) -> DataFrame:
    """The k best by personalised rank with their global rank and lift, ties by domain."""
    from webloom.functions.urls import lift

    named = personal.select("id", F.col("rank").alias("open_authority")).join(vertices, "id")
    top = named.orderBy(F.desc("open_authority"), "domain").limit(k)
    both = top.join(overall.select("id", F.col("rank").alias("global_rank")), "id")
    return both.select("domain", "open_authority", "global_rank", lift(F.col("open_authority"), F.col("global_rank")).alias("lift"))


def output_stats(rows: DataFrame, score: str = "pagerank_score") -> DataFrame:
    """One row: rows, mass, min, max, null scores and null domains of an output."""
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(score).alias("mass"), F.min(score).alias("min_score"), F.max(score).alias("max_score"), F.count_if(F.col(score).isNull()).alias("null_scores"), F.count_if(F.col("domain").isNull()).alias("null_domains")
    )


def boundary_mismatches(hosts: DataFrame) -> DataFrame:
    """(registered, n): names (domain) that aren't their own registered domain, clustered by what they'd be."""
    names = registered_domains(hosts.select(F.col("domain").alias("host")))
    off = names.where(~F.col("domain").eqNullSafe(F.col("host")))
    return off.groupBy(F.col("domain").alias("registered")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "registered")


def subdomains_of(names: DataFrame, domain: str) -> DataFrame:
    """Canary: names below a domain, which a domain-grain table must not hold."""
    return names.where(F.col("domain").endswith("." + domain))
