"""The authority mart as SQL views over the two metric tables, in dependency order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webloom.errors import JobError
from webloom.operators.dq import Test, between, not_null, unique

#: View name -> SQL; each may use those before it. Sources: cc_domain_pagerank, cc_domain_authority.
MODELS: dict[str, str] = {
    "stg_cc_domain_pagerank": """
        SELECT cast(domain AS string) AS domain, cast(crawl AS string) AS crawl,
               cast(pagerank_score AS double) AS pagerank_score,
               cast(in_degree AS bigint) AS in_degree, cast(out_degree AS bigint) AS out_degree
        FROM cc_domain_pagerank""",
    "stg_cc_domain_authority": """
        SELECT cast(domain AS string) AS domain, cast(crawl AS string) AS crawl,
               cast(open_authority AS double) AS open_authority, cast(open_volume AS double) AS open_volume
        FROM cc_domain_authority""",
    "int_pagerank": """
        SELECT p.domain, p.crawl, p.pagerank_score, a.open_volume, a.open_authority,
               CASE WHEN a.open_volume <> 0 THEN a.open_authority / a.open_volume END AS authority_ratio
        FROM stg_cc_domain_pagerank p
        LEFT JOIN stg_cc_domain_authority a ON p.domain = a.domain AND p.crawl = a.crawl""",
    "int_crawl_window": """
        SELECT crawl AS window_id, crawl AS window_end_crawl, array(crawl) AS window_crawls
        FROM (SELECT DISTINCT crawl FROM stg_cc_domain_pagerank)""",
    "mart_domain_authority": """
        SELECT i.domain, w.window_id, w.window_end_crawl, w.window_crawls,
               i.pagerank_score, i.open_volume, i.open_authority, i.authority_ratio
        FROM int_pagerank i JOIN int_crawl_window w ON i.crawl = w.window_end_crawl""",
}

TESTS: dict[str, list[Test]] = {
    "stg_cc_domain_pagerank": [unique("domain", "crawl"), not_null("domain"), not_null("crawl"), not_null("pagerank_score"), not_null("in_degree"), not_null("out_degree")],
    "stg_cc_domain_authority": [unique("domain", "crawl"), not_null("domain"), not_null("crawl"), not_null("open_authority"), not_null("open_volume")],
    "int_pagerank": [unique("domain", "crawl"), not_null("domain"), between("authority_ratio", 0)],
    "int_crawl_window": [unique("window_id"), not_null("window_id"), not_null("window_crawls")],
    "mart_domain_authority": [
        unique("domain", "window_id"),
        not_null("domain"),
        not_null("window_id"),
        between("pagerank_score", 0, 1),
        between("open_authority", 0, 1, where="open_authority IS NOT NULL"),
        between("open_volume", 0),
        between("authority_ratio", 0, where="authority_ratio IS NOT NULL"),
    ],
}


def build_views(spark: SparkSession, pagerank: DataFrame, authority: DataFrame) -> DataFrame:
    """Create the sources and all views in this session; returns the mart. Views stay lazy."""
    pagerank.createOrReplaceTempView("cc_domain_pagerank")
    authority.createOrReplaceTempView("cc_domain_authority")
    for name, sql in MODELS.items():
        try:
            spark.sql(sql).createOrReplaceTempView(name)
        except Exception as error:
            raise JobError(f"model {name}: {error}") from error
    return spark.table("mart_domain_authority")


def test_views(spark: SparkSession) -> DataFrame:
    """(model, test, failures) of all models."""
    from pyspark.sql import functions as F

    from webloom.operators.dq import run_tests

    parts = [run_tests(spark.table(model), tests).select(F.lit(model).alias("model"), "test", "failures") for model, tests in TESTS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_mart(mart: DataFrame, path: str) -> None:
    """Overwrite only the windows that the mart has."""
    from webloom.sources.sinks import write_crawl_partitions

    write_crawl_partitions(mart, path, "window_id")
