"""URL, host and link-attribute expressions; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """Host of a URL as written; null for relative, malformed and null URLs."""
    return F.try_parse_url(url, F.lit("HOST"))


def unreverse(name: Column) -> Column:
    """com.example -> example.com; null becomes the empty string."""
    return F.concat_ws(".", F.reverse(F.split(name, "[.]")))


def naive_root(host: Column) -> Column:
    """Last two labels; a host of one label is itself."""
    labels = F.split(host, "[.]")
    return F.when(host.isNotNull(), F.concat_ws(".", F.slice(labels, -F.least(F.lit(2), F.size(labels)), F.lit(2))))


def tld(domain: Column) -> Column:
    return F.element_at(F.split(domain, "[.]"), -1)


def tld_class(domain: Column) -> Column:
    """gov, edu or normal. Our rule: a gov or edu label at the end, or before a two-letter country label."""
    return (
        F.when(domain.isNull(), F.lit(None))
        .when(domain.rlike(r"(^|\.)(gov|mil)(\.[a-z]{2})?$"), "gov")
        .when(domain.rlike(r"(^|\.)(edu|ac)(\.[a-z]{2})?$") & ~domain.rlike(r"(^|\.)ac$"), "edu")
        .otherwise("normal")
    )


def primary_language(languages: Column) -> Column:
    """First of a comma-separated list, trimmed and lower-cased; empty is null."""
    return F.nullif(F.lower(F.trim(F.split(languages, ",")[0])), F.lit(""))


def wat_path(warc: Column) -> Column:
    """Path of the WAT file beside a WARC file; null for a path of another shape."""
    fits = warc.contains("/warc/") & warc.endswith(".warc.gz")
    return F.when(fits, F.regexp_replace(F.regexp_replace(warc, r"^(.*?)/warc/", "$1/wat/"), r"\.warc\.gz$", ".warc.wat.gz"))


def rel_tokens(rel: Column) -> Column:
    return F.split(F.trim(F.lower(F.coalesce(rel, F.lit("")))), r"\s+")


def has_rel(rel: Column, token: str) -> Column:
    return F.array_contains(rel_tokens(rel), token)


def is_empty_anchor(anchor: Column) -> Column:
    return anchor.isNull() | (F.length(F.trim(anchor)) == 0)


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, null where bottom is zero or null."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def lift(score: Column, baseline: Column) -> Column:
    """ln(score / baseline); null unless both are positive."""
    return F.when((score > 0) & (baseline > 0), F.ln(score / baseline))
