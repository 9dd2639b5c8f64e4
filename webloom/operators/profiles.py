"""Link profiles of domains and URL-grain link marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.urls import has_rel, host_of, ratio, tld, tld_class


def shares(values: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """(key, out): array of (value, share) by falling share, ties by value."""
    counts = values.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    lists = counts.groupBy(key).agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), value, "n"))).alias("xs"))
    return lists.select(key, F.transform("xs", lambda x: F.struct(x[value].alias(value), (x.n / F.col("total")).alias("share"))).alias(out))


def inbound_profile(links: DataFrame, languages: DataFrame | None = None, top_domains: DataFrame | None = None, ranks: DataFrame | None = None) -> DataFrame:
    """Counters of the links into each domain. links: domain_from, domain_to, rel[, ip].

    languages (domain, dominant), top_domains (domain) and ranks (domain, pagerank_score) add the
    columns that need them. IP counters are null without an ip column, for which no source is named.
    """
    rel, source = F.col("rel"), F.col("domain_from")
    n = F.count(F.lit(1))
    counts = {"n": n, "follow": F.count_if(~has_rel(rel, "nofollow")), "ugc": F.count_if(has_rel(rel, "ugc")), "sponsored": F.count_if(has_rel(rel, "sponsored"))}
    pairs = links.groupBy("domain_to", "domain_from").agg(*[c.alias(f"_{k}") for k, c in counts.items()])  # all that follows is over pairs
    rows = pairs
    if top_domains is not None:
        rows = rows.join(top_domains.select(source_name(top_domains)).distinct().withColumn("_top", F.lit(True)), "domain_from", "left")
    if languages is not None:
        a = languages.select(F.col("domain").alias("domain_from"), F.col("dominant").alias("_lang_from"))
        b = languages.select(F.col("domain").alias("domain_to"), F.col("dominant").alias("_lang_to"))
        rows = rows.join(a, "domain_from", "left").join(b, "domain_to", "left")
    if ranks is not None:
        rows = rows.join(ranks.select(F.col("domain").alias("domain_from"), F.col("pagerank_score").alias("_pr")), "domain_from", "left")

    def links_where(condition):
        return F.sum(F.when(condition, F.col("_n")).otherwise(0))

    total = F.sum("_n")
    aggs = [
        F.count("domain_from").alias("referring_domains"),
        total.alias("inbound_links_total"),
        F.sum("_follow").alias("dofollow_links"),
        ratio(F.sum("_follow"), total).alias("dofollow_ratio"),
        F.count(F.when(F.col("_follow") > 0, source)).alias("dofollow_referring_domains"),
        F.sum("_ugc").alias("ugc_links"),
        F.sum("_sponsored").alias("sponsored_links"),
        links_where(tld_class(source) == "gov").alias("gov_links"),
        links_where(tld_class(source) == "edu").alias("edu_links"),
        F.count_distinct(tld(source)).alias("tld_diversity_score"),
    ]
    if top_domains is not None:
        aggs.append(ratio(links_where(F.col("_top").isNotNull()), total).alias("inbound_top10k_ratio"))
    if languages is not None and ranks is not None:
        foreign = F.col("_lang_from").isNotNull() & F.col("_lang_to").isNotNull() & (F.col("_lang_from") != F.col("_lang_to"))
        weight = F.col("_pr") * F.col("_n")
        aggs.append(ratio(F.sum(F.when(foreign, weight).otherwise(0.0)), F.sum(weight)).alias("cross_language_authority"))
    out = rows.groupBy("domain_to").agg(*aggs).withColumnRenamed("domain_to", "domain")
    for name, value in (("referring_ips", F.col("ip")), ("referring_subnets", F.regexp_extract("ip", r"^(\d+\.\d+\.\d+)\.", 1))) if "ip" in links.columns else ():
        distinct = links.select(F.col("domain_to").alias("domain"), value.alias("_value")).where("_value is not null").distinct()
        out = out.join(distinct.groupBy("domain").agg(F.count(F.lit(1)).alias(name)), "domain", "left").fillna(0, [name])
    if "ip" not in links.columns:
        out = out.withColumns({c: F.lit(None).cast("long") for c in ("referring_ips", "referring_subnets")})
    if languages is not None:
        sources = rows.select(F.col("domain_to").alias("domain"), "domain_from", F.col("_lang_from").alias("lang"))
        out = out.join(shares(sources, "domain", "lang", "inbound_lang_distribution"), "domain", "left")
    return out


def source_name(df: DataFrame):
    return F.col("domain").alias("domain_from")


def outbound_profile(links: DataFrame, languages: DataFrame | None = None, ranks: DataFrame | None = None) -> DataFrame:
    """Counters of the links out of each domain. links: domain_from, domain_to, rel[, is_broken, is_lost]."""
    n = F.count(F.lit(1))
    rows = links
    for flag in ("is_broken", "is_lost"):
        if flag not in rows.columns:
            rows = rows.withColumn(flag, F.lit(False))
    aggs = [
        n.alias("outbound_links_total"),
        F.count_distinct("domain_to").alias("linked_domains"),
        ratio(F.count_if(~has_rel(F.col("rel"), "nofollow")), n).alias("outbound_dofollow_ratio"),
        F.count_if("is_broken").alias("outbound_broken_count"),
        ratio(F.count_if("is_broken"), n).alias("outbound_broken_ratio"),
        F.count_if("is_lost").alias("outbound_lost_count"),
    ]
    if ranks is not None:
        rows = rows.join(ranks.select(F.col("domain").alias("domain_to"), F.col("pagerank_score").alias("_pr")), "domain_to", "left")
        aggs += [F.avg("_pr").alias("avg_target_pagerank"), ratio(F.count("_pr"), n).alias("indexed_targets_ratio")]
    out = rows.groupBy("domain_from").agg(*aggs).withColumnRenamed("domain_from", "domain")
    targets = rows.select(F.col("domain_from").alias("domain"), tld(F.col("domain_to")).alias("tld"), tld_class(F.col("domain_to")).alias("class"))
    out = out.join(shares(targets, "domain", "tld", "outbound_tld_distribution"), "domain", "left")
    out = out.join(shares(targets, "domain", "class", "outbound_tld_class_dist"), "domain", "left")
    if languages is not None:
        named = rows.join(languages.select(F.col("domain").alias("domain_to"), F.col("dominant").alias("lang")), "domain_to").select(F.col("domain_from").alias("domain"), "lang")
        out = out.join(shares(named, "domain", "lang", "outbound_lang_distribution"), "domain", "left")
    return out


def crawl_frequency(pages: DataFrame) -> DataFrame:
    """(domain, first_seen, crawl_frequency): average URLs in a month of presence. pages: domain, crawl_date."""
    months = F.count_distinct(F.trunc("crawl_date", "month"))
    return pages.groupBy("domain").agg(F.min("crawl_date").alias("first_seen"), (F.count(F.lit(1)) / months).alias("crawl_frequency"))


def link_profile(inbound: DataFrame, outbound: DataFrame) -> DataFrame:
    """Both profiles of every domain that has one."""
    return inbound.join(outbound, "domain", "full")


def _link_rows(links: DataFrame, languages: DataFrame) -> DataFrame:
    rel = F.col("rel")
    a = languages.select(F.col("domain").alias("domain_from"), F.col("languages").alias("source_languages"), F.col("dominant").alias("_a"))
    b = languages.select(F.col("domain").alias("domain_to"), F.col("languages").alias("target_languages"), F.col("dominant").alias("_b"))
    first = F.struct(F.col("crawl"), F.col("anchor"), rel)
    once = links.groupBy("domain_from", "domain_to", "url_from", "url_to", "crawl").agg(F.min(first).alias("x")).select("domain_from", "domain_to", "url_from", "url_to", "crawl", "x.anchor", "x.rel")
    path = F.try_parse_url("url_from", F.lit("PATH"))
    flags = once.withColumns(
        {
            "is_dofollow": ~has_rel(rel, "nofollow"),
            "is_ugc": has_rel(rel, "ugc"),
            "is_sponsored": has_rel(rel, "sponsored"),
            "is_canonical": has_rel(rel, "canonical"),
            "is_alternate": has_rel(rel, "alternate"),
            "is_homepage_link": host_of(F.col("url_from")).isNotNull() & F.coalesce(path, F.lit("")).isin("", "/"),
            "tld_class_source": tld_class(F.col("domain_from")),
            "tld_class_target": tld_class(F.col("domain_to")),
        }
    )
    both = flags.join(a, "domain_from", "left").join(b, "domain_to", "left")
    return both.withColumn("is_cross_language", F.col("_a") != F.col("_b")).drop("_a", "_b")


def backlinks_mart(links: DataFrame, scope: DataFrame, languages: DataFrame) -> DataFrame:
    """One row for each (url_from, url_to, crawl) into the scope's domains, with flags, languages and first_seen."""
    inside = links.join(scope.select(F.col("domain").alias("domain_to")), "domain_to", "left_semi")
    first = inside.groupBy("url_from", "url_to").agg(F.min("crawl").alias("first_seen"))
    return _link_rows(inside, languages).join(first, ["url_from", "url_to"])


def outbound_mart(links: DataFrame, scope: DataFrame, languages: DataFrame, authority: DataFrame, latest: str, broken: DataFrame | None = None) -> DataFrame:
    """One row for each (url_from, url_to, crawl) out of the scope's domains, with history and what is known of the target.

    authority: domain, pagerank_score, open_authority, in_degree. broken: (url_to) of targets that
    don't answer; is_broken is null, not false, without it.
    """
    from webloom.operators.crawls import link_status

    inside = links.join(scope.select(F.col("domain").alias("domain_from")), "domain_from", "left_semi")
    status = link_status(inside, ["url_from", "url_to"], "url_from", latest, broken, "url_to")
    if broken is None:
        status = status.withColumn("is_broken", F.lit(None).cast("boolean"))
    target = authority.select(F.col("domain").alias("domain_to"), F.col("pagerank_score").alias("target_pagerank_score"), F.col("open_authority").alias("target_open_authority"), F.col("in_degree").alias("target_referring_domains"), F.lit(True).alias("_known"))
    rows = _link_rows(inside, languages).join(status, ["url_from", "url_to"]).join(target, "domain_to", "left")
    return rows.withColumn("is_target_indexed", F.col("_known").isNotNull()).drop("_known").withColumnRenamed("domain_to", "target_domain")
