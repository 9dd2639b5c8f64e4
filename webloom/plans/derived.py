"""Web-shaped inputs derived from the driver's tables, in Spark and as SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ITERATIONS = 10


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vertices(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers, then customers, as sites."""
    s, c = t(spark, sf, "supplier"), t(spark, sf, "customer")
    n = s.count()
    a = s.select(F.col("s_suppkey").alias("id"), F.concat(F.lit("s"), "s_suppkey", F.lit(".com")).alias("domain"))
    return a.union(c.select((F.col("c_custkey") + n).alias("id"), F.concat(F.lit("c"), "c_custkey", F.lit(".org")).alias("domain")))


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier -> customer for kept line items, customer -> supplier for returned ones. Parallel edges stay."""
    return crawl_edges(spark, sf).select("from_id", "to_id")


def crawl_edges(spark: SparkSession, sf: str) -> DataFrame:
    """The same edges, each seen in one of three crawls."""
    n = t(spark, sf, "supplier").count()
    rows = t(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_linenumber").join(t(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    back = F.col("l_returnflag") == "R"
    s, c = F.col("l_suppkey"), F.col("o_custkey") + n
    return rows.select(F.when(back, c).otherwise(s).alias("from_id"), F.when(back, s).otherwise(c).alias("to_id"), F.concat(F.lit("crawl-"), F.col("l_linenumber") % 3).alias("crawl"))


GRAPH_SQL = """
V AS (SELECT s_suppkey AS id, 's' || s_suppkey || '.com' AS domain FROM supplier
      UNION ALL SELECT c_custkey + (SELECT count(*) FROM supplier), 'c' || c_custkey || '.org' FROM customer),
E AS (SELECT CASE WHEN l_returnflag = 'R' THEN o_custkey + (SELECT count(*) FROM supplier) ELSE l_suppkey END AS from_id,
             CASE WHEN l_returnflag = 'R' THEN l_suppkey ELSE o_custkey + (SELECT count(*) FROM supplier) END AS to_id
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE true),
N AS (SELECT count(*)::DOUBLE AS n FROM V),
O AS (SELECT from_id AS id, count(*) AS out_degree FROM E GROUP BY 1),
I AS (SELECT to_id AS id, count(*) AS in_degree FROM E GROUP BY 1)"""


#: The graph of the two latest crawls, merged.
WINDOW_GRAPH_SQL = GRAPH_SQL.replace("E AS (SELECT CASE", "E AS (SELECT DISTINCT CASE").replace("WHERE true", "WHERE l_linenumber % 3 > 0")


def rank_sql(weights: str, name: str) -> str:
    """Recursive CTEs of ITERATIONS steps; weights is SQL of (id, w) for every node."""
    return f"""
{name}_w AS MATERIALIZED ({weights}),
{name}_a AS MATERIALIZED (SELECT from_id, to_id, 1.0::DOUBLE / out_degree * count(*) AS share FROM E JOIN O ON from_id = O.id GROUP BY from_id, to_id, out_degree),
{name} AS (
  SELECT 0 AS step, id, w AS rank FROM {name}_w
  UNION ALL
  SELECT s.step + 1, s.id, (0.15 + 0.85 * (1.0 - s.sent)) * s.w + 0.85 * s.inflow
  FROM (SELECT r.step, r.id, r.w, coalesce(f.inflow, 0.0) AS inflow, sum(coalesce(f.inflow, 0.0)) OVER () AS sent
        FROM (SELECT {name}.step, {name}.id, {name}_w.w FROM {name} JOIN {name}_w ON {name}.id = {name}_w.id) r
        LEFT JOIN (SELECT a.to_id, sum(x.rank * a.share) AS inflow FROM {name} x JOIN {name}_a a ON x.id = a.from_id GROUP BY a.to_id) f ON r.id = f.to_id
        WHERE r.step < {ITERATIONS}) s
)"""


def seed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Balances as scores of sites; negative ones have none."""
    s = t(spark, sf, "supplier").select(F.concat(F.lit("s"), "s_suppkey", F.lit(".com")).alias("domain"), F.col("s_acctbal").alias("b"))
    c = t(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey", F.lit(".org")).alias("domain"), F.col("c_acctbal").alias("b"))
    off = spark.createDataFrame([("off-graph.net", 1e9)], "domain string, b double")
    return s.union(c).union(off).select("domain", F.when(F.col("b") >= 0, F.col("b")).alias("consensus"))


SEED_SQL = """
SEED AS (SELECT 's' || s_suppkey || '.com' AS domain, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS consensus FROM supplier
         UNION ALL SELECT 'c' || c_custkey || '.org', CASE WHEN c_acctbal >= 0 THEN c_acctbal END FROM customer
         UNION ALL SELECT 'off-graph.net', 1e9),
SW AS (SELECT domain, rn AS rank, 1.0 / log2(rn + 1) AS w, consensus FROM (
         SELECT domain, consensus, row_number() OVER (ORDER BY consensus DESC, domain) AS rn
         FROM (SELECT domain, max(consensus) AS consensus FROM SEED WHERE consensus IS NOT NULL GROUP BY domain)) WHERE rn <= 100)"""


def links(spark: SparkSession, sf: str) -> DataFrame:
    """A link from every page to another one, on many sites, with rel attributes and some broken URLs."""
    p = t(spark, sf, "pages").select("page_id", F.replace("url", F.lit(".example."), F.lit(".")).alias("url"))
    n = p.count()
    target = p.select(F.col("page_id").alias("to_page"), F.col("url").alias("url_to"))
    rows = p.withColumn("to_page", (F.col("page_id") * 7 + 3) % n).join(target, "to_page")
    k = F.col("page_id") % 5
    rel = F.when(k == 1, "nofollow ugc").when(k == 2, "sponsored").when(k == 3, "NOFOLLOW").when(k == 4, "")
    to = F.when(F.col("page_id") % 17 == 0, "/relative").otherwise(F.col("url_to"))
    anchor = F.when(F.col("page_id") % 3 == 0, "").when(F.col("page_id") % 3 == 1, "more")
    crawl = F.concat(F.lit("2024-"), F.lpad((F.col("page_id") % 4 + 1).cast("string"), 2, "0"))
    return rows.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url_from"), to.alias("url_to"), anchor.alias("anchor"), rel.alias("rel"), crawl.alias("crawl"))


LINKS_SQL = r"""
P AS (SELECT page_id, replace(url, '.example.', '.') AS url FROM pages),
L AS (SELECT p.page_id, p.url AS url_from, CASE WHEN p.page_id % 17 = 0 THEN '/relative' ELSE q.url END AS url_to,
             CASE p.page_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'more' END AS anchor,
             CASE p.page_id % 5 WHEN 1 THEN 'nofollow ugc' WHEN 2 THEN 'sponsored' WHEN 3 THEN 'NOFOLLOW' WHEN 4 THEN '' END AS rel,
             '2024-' || lpad((p.page_id % 4 + 1)::VARCHAR, 2, '0') AS crawl
      FROM P p JOIN P q ON q.page_id = (p.page_id * 7 + 3) % (SELECT count(*) FROM P)),
H AS (SELECT *, nullif(regexp_extract(url_from, '^[a-z]+://([^/?#]+)', 1), '') AS host_from, nullif(regexp_extract(url_to, '^[a-z]+://([^/?#]+)', 1), '') AS host_to FROM L),
R AS (SELECT *, nullif(regexp_extract(host_from, '([^.]+\.[^.]+)$', 1), '') AS domain_from, nullif(regexp_extract(host_to, '([^.]+\.[^.]+)$', 1), '') AS domain_to,
             list_contains(string_split_regex(trim(lower(coalesce(rel, ''))), '\s+'), 'nofollow') AS nf,
             list_contains(string_split_regex(trim(lower(coalesce(rel, ''))), '\s+'), 'ugc') AS ug,
             list_contains(string_split_regex(trim(lower(coalesce(rel, ''))), '\s+'), 'sponsored') AS sp
      FROM H WHERE host_from IS NOT NULL AND host_to IS NOT NULL),
PAIRS AS (SELECT domain_from, domain_to, count(*)::BIGINT AS link_count, count(*) FILTER (WHERE NOT nf)::BIGINT AS dofollow_count,
                 count(*) FILTER (WHERE ug)::BIGINT AS ugc_count, count(*) FILTER (WHERE sp)::BIGINT AS sponsored_count
          FROM R GROUP BY 1, 2)"""


def crawl_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events as sightings of a domain in daily crawls."""
    e = t(spark, sf, "events")
    return e.select(F.concat(F.lit("u"), "user_id").alias("domain"), F.col("event_type").alias("target"), F.date_format("ts", "yyyy-MM-dd").alias("crawl"), "value")


CRAWL_SQL = "C AS (SELECT 'u' || user_id AS domain, event_type AS target, strftime(ts, '%Y-%m-%d') AS crawl, value FROM events)"


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with two scores that agree in part and have ties."""
    p = t(spark, sf, "part")
    return p.select(F.concat(F.lit("p"), "p_partkey", F.lit(".com")).alias("domain"), F.col("p_retailprice").alias("a"), (F.col("p_size") * 10 + F.col("p_retailprice") / 100).alias("raw"), F.col("p_size").cast("double").alias("b"))


#: A number in [0, 1) from the md5 of a domain.
CHANCE_SQL = "(('0x' || substr(md5(domain), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
SCORED_SQL = "S AS (SELECT 'p' || p_partkey || '.com' AS domain, p_retailprice AS a, p_size::DOUBLE AS b FROM part)"
