"""Column contracts of the stored tables, as Spark DDL."""

from __future__ import annotations

from pyspark.sql import types as T

VERTICES_TSV = "id long, rev_domain string, num_hosts long"
EDGES_TSV = "from_id long, to_id long"
HOST_VERTICES_TSV = "id long, rev_host string"

VERTICES = "id bigint, domain string"
EDGES = "from_id bigint, to_id bigint"
TELEPORT = "id bigint, w double"
RANKS = "id bigint, rank double"
RAW_LINKS = "url_from string, url_to string, anchor string, rel string"

DOMAIN_PAGERANK = "domain string, crawl string, pagerank_score double, in_degree bigint, out_degree bigint"
DOMAIN_AUTHORITY = "domain string, crawl string, open_authority double, open_volume double"
DOMAIN_LANGUAGES = "domain string, crawl string, languages array<struct<lang:string,share:double>>, page_count bigint"
LINK_PAIRS = "domain_from string, domain_to string, link_count bigint, dofollow_count bigint, ugc_count bigint, sponsored_count bigint"


def struct(ddl: str) -> T.StructType:
    """A DDL string as a StructType."""
    return T.StructType.fromDDL(ddl)


def columns(ddl: str) -> dict[str, str]:
    """Column name -> type string, as DataFrame.dtypes has them."""
    return {f.name: f.dataType.simpleString() for f in struct(ddl)}
