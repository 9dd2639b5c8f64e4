"""From raw URL links to domain pairs: each distinct host is resolved once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.psl import registered_domains
from webloom.functions.urls import has_rel, host_of, is_empty_anchor


def with_hosts(links: DataFrame) -> DataFrame:
    """links with host_from and host_to; rows without either are dropped before anything is joined."""
    rows = links.withColumns({"host_from": host_of(F.col("url_from")), "host_to": host_of(F.col("url_to"))})
    return rows.where(F.col("host_from").isNotNull() & F.col("host_to").isNotNull())


def host_map(links: DataFrame, psl_path: str | None = None) -> DataFrame:
    """(host, domain) of every distinct host at either end, in one pass over the links."""
    return registered_domains(links.select(F.explode(F.array("host_from", "host_to")).alias("host")), psl_path)


def _named(links: DataFrame, names: DataFrame, end: str) -> DataFrame:
    """links with the domain of one end in place of its host."""
    return links.join(names.toDF(f"host_{end}", f"domain_{end}"), f"host_{end}", "left").drop(f"host_{end}")


def resolve_domains(links: DataFrame, psl_path: str | None = None, keep_unresolved: bool = False) -> DataFrame:
    """links with domain_from and domain_to; unless kept, rows with an unresolved end are dropped. Self-links stay."""
    rows = with_hosts(links)
    names = host_map(rows, psl_path)
    for end in ("from", "to"):
        rows = _named(rows, names, end)
    return rows if keep_unresolved else rows.dropna(subset=["domain_from", "domain_to"])


def aggregate_pairs(links: DataFrame) -> DataFrame:
    """Links by (domain_from, domain_to): link_count and how many are dofollow, ugc and sponsored."""
    rel = F.col("rel")
    return links.groupBy("domain_from", "domain_to").agg(
        F.count(F.lit(1)).alias("link_count"),
        F.count_if(~has_rel(rel, "nofollow")).alias("dofollow_count"),
        F.count_if(has_rel(rel, "ugc")).alias("ugc_count"),
        F.count_if(has_rel(rel, "sponsored")).alias("sponsored_count"),
    )


def pair_totals(pairs: DataFrame) -> DataFrame:
    """One row: domain_pair_rows, link_count_total."""
    return pairs.agg(F.count(F.lit(1)).alias("domain_pair_rows"), F.coalesce(F.sum("link_count"), F.lit(0)).alias("link_count_total"))


def null_domain_rates(resolved: DataFrame) -> DataFrame:
    """Shares of rows (unresolved kept) without a domain at either end."""
    return resolved.agg(*[F.coalesce(F.try_divide(F.count_if(F.col(c).isNull()), F.count(F.lit(1))), F.lit(0.0)).alias(f"{c}_null_rate") for c in ("domain_from", "domain_to")])


def host_parse_failures(links: DataFrame) -> DataFrame:
    """Shares of non-null URLs whose host can't be parsed."""
    return links.agg(
        *[
            F.coalesce(F.try_divide(F.count_if(F.col(u).isNotNull() & host_of(F.col(u)).isNull()), F.count(u)), F.lit(0.0)).alias(f"{u}_parse_fail_rate")
            for u in ("url_from", "url_to")
        ]
    )


def scope_totals(pairs: DataFrame, scope: DataFrame) -> DataFrame:
    """One row: pairs and links in all, and of those into scope (domain). One pass: scope is a flag, not a filter."""
    inside = scope.select(F.col("domain").alias("domain_to"), F.lit(True).alias("_in")).distinct()
    rows = pairs.join(inside, "domain_to", "left")
    hit = F.col("_in").isNotNull()
    zero = F.lit(0).cast("long")
    return rows.agg(
        F.count(F.lit(1)).alias("global_pairs"),
        F.coalesce(F.sum("link_count"), zero).alias("global_links"),
        F.count_if(hit).alias("scoped_pairs"),
        F.coalesce(F.sum(F.when(hit, F.col("link_count"))), zero).alias("scoped_links"),
    )


def skew_top(pairs: DataFrame, by: list[str], n: int) -> DataFrame:
    """The n largest groups by summed link_count, ties by key."""
    return pairs.groupBy(*by).agg(F.sum("link_count").alias("links")).orderBy(F.desc("links"), *by).limit(n)


def cardinalities(links: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct hosts and domains at each end."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return links.agg(*[count(c).alias(f"n_{c}") for c in ("host_from", "host_to", "domain_from", "domain_to") if c in links.columns])


def flagged(links: DataFrame) -> DataFrame:
    """links with is_nofollow, is_ugc and is_sponsored."""
    return links.withColumns({f"is_{t}": has_rel(F.col("rel"), t) for t in ("nofollow", "ugc", "sponsored")})


def backlinks_into(links: DataFrame, sources: DataFrame, targets: DataFrame, psl_path: str | None = None) -> DataFrame:
    """Links from source domains into target domains, with rel flags; domain_from is given, domain_to is resolved."""
    kept = links.join(sources.select(F.col("registered_domain").alias("domain_from")), "domain_from", "left_semi")
    kept = kept.withColumn("host_to", host_of(F.col("url_to"))).where(F.col("host_to").isNotNull())
    names = registered_domains(kept.select(F.col("host_to").alias("host")), psl_path).select(F.col("host").alias("host_to"), F.col("domain").alias("domain_to"))
    named = kept.join(names, "host_to").where(F.col("domain_to").isNotNull())
    hit = named.join(targets.select(F.col("registered_domain").alias("domain_to")), "domain_to", "left_semi")
    return flagged(hit).select("domain_from", "domain_to", "url_from", "url_to", "anchor", "rel", "is_nofollow", "is_ugc", "is_sponsored")


def backlink_counters(backlinks: DataFrame) -> DataFrame:
    """One row: backlinks, empty_anchor, nofollow, ugc, sponsored."""
    return backlinks.agg(
        F.count(F.lit(1)).alias("backlinks"),
        F.count_if(is_empty_anchor(F.col("anchor"))).alias("empty_anchor"),
        *[F.count_if(F.col(f"is_{t}")).alias(t) for t in ("nofollow", "ugc", "sponsored")],
    )
