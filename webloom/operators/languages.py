"""Languages of domains, and which domains a language segment holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.urls import primary_language, wat_path


def language_shares(pages: DataFrame, min_share: float = 0.05) -> DataFrame:
    """(domain, lang, pages, share) of languages with at least min_share of a domain's pages that have one."""
    counts = pages.where("domain is not null and lang is not null").groupBy("domain", "lang").agg(F.count(F.lit(1)).alias("pages"))
    from pyspark.sql import Window as W

    share = F.col("pages") / F.sum("pages").over(W.partitionBy("domain"))
    return counts.withColumn("share", share).where(F.col("share") >= min_share)


def domain_languages(pages: DataFrame, min_share: float = 0.05) -> DataFrame:
    """(domain, languages array<struct<lang, share>> best first, page_count, dominant)."""
    counts = pages.where("domain is not null").groupBy("domain", "lang").agg(F.count(F.lit(1)).alias("pages"))
    known = F.col("lang").isNotNull()
    by_domain = counts.groupBy("domain").agg(
        F.sum("pages").alias("page_count"),
        F.sum(F.when(known, F.col("pages"))).alias("known"),
        F.collect_list(F.when(known, F.struct((-F.col("pages")).alias("minus"), "lang", "pages"))).alias("all"),
    )
    ordered = F.transform(F.array_sort("all"), lambda x: F.struct(x.lang.alias("lang"), (x.pages / F.col("known")).alias("share")))
    kept = F.filter(ordered, lambda x: x.share >= min_share)
    return by_domain.select("domain", kept.alias("languages"), "page_count", F.get(kept, F.lit(0))["lang"].alias("dominant"))


def coverage(pages: DataFrame) -> DataFrame:
    """One row: total, with_lang, ok, ok_with_lang, in one pass over (status, primary_lang)."""
    ok, lang = F.col("status") == "200", F.col("primary_lang").isNotNull()
    return pages.agg(F.count(F.lit(1)).alias("total"), F.count_if(lang).alias("with_lang"), F.count_if(ok).alias("ok"), F.count_if(ok & lang).alias("ok_with_lang"))


def distribution(pages: DataFrame, column: str = "lang", top: int | None = 20) -> DataFrame:
    """(lang, pages) by count, ties by language."""
    out = pages.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("lang")).agg(F.count(F.lit(1)).alias("pages")).orderBy(F.desc("pages"), "lang")
    return out.limit(top) if top else out


def qualify_targets(projection: DataFrame, targets: list[str], min_share: float) -> DataFrame:
    """Domains with a page whose primary language is a target: total_200_pages, target_language_pages, language_share, meets_share."""
    hit = primary_language(F.col("content_languages")).isin(targets)
    counts = projection.groupBy("registered_domain").agg(F.count(F.lit(1)).alias("total_200_pages"), F.count_if(hit).alias("target_language_pages"))
    share = F.col("target_language_pages") / F.col("total_200_pages")
    return counts.where("target_language_pages > 0").withColumns({"language_share": share, "meets_share": share >= min_share})


def in_segment(crawl_shares: DataFrame, langs: list[str], min_share: float, min_crawls: int) -> DataFrame:
    """Domains whose share of target languages is at least min_share in at least min_crawls crawls.

    crawl_shares: (domain, crawl, lang, share).
    """
    per_crawl = crawl_shares.where(F.col("lang").isin(langs)).groupBy("domain", "crawl").agg(F.sum("share").alias("share"))
    return per_crawl.groupBy("domain").agg(F.count_if(F.col("share") >= min_share).alias("crawls_met")).where(F.col("crawls_met") >= min_crawls)


def stability(crawl_dominant: DataFrame) -> DataFrame:
    """(domain, language_stability_score): share of crawls that have the most frequent dominant language. The formula is ours."""
    counts = crawl_dominant.where("dominant is not null").groupBy("domain", "dominant").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("domain").agg((F.max("n") / F.sum("n")).alias("language_stability_score"))


def source_wat_files(projection: DataFrame, sources: DataFrame) -> DataFrame:
    """Distinct (registered_domain, wat_path) of the files that hold pages of source domains."""
    rows = projection.join(sources.select("registered_domain"), "registered_domain", "left_semi")
    return rows.select("registered_domain", wat_path(F.col("warc_filename")).alias("wat_path")).where(F.col("wat_path").isNotNull()).distinct()


def wat_stats(files: DataFrame, all_files: int, mean_bytes: float) -> DataFrame:
    """One row: sources, files, crawl_fraction and estimated bytes of a derived file list."""
    n = F.count_distinct("wat_path")
    return files.agg(F.count_distinct("registered_domain").alias("sources"), n.alias("files"), (n / F.lit(all_files)).alias("crawl_fraction"), (n * F.lit(mean_bytes)).alias("estimated_bytes"))
