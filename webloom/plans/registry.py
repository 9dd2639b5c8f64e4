"""Every operator as a query over the driver's tables, with the SQL that it is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.config import Authority
from webloom.functions import psl, urls
from webloom.operators import crawls, dq, graph, languages, links, profiles, publish, rankstats, recall, reference, sampling, scope, seeds
from webloom.operators.pagerank import power_iteration
from webloom.plans import derived as d
from webloom.plans import jobs, marts
from webloom.session import scratch_path, snapshot
from webloom.sources import readers, sinks, wat

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


# ---- graph and PageRank -------------------------------------------------------------------------

GLOBAL_W = "SELECT id, 1.0 / n AS w FROM V, N"
SEED_W = "SELECT V.id, coalesce(x.w, 0.0) AS w FROM V LEFT JOIN (SELECT V.id, SW.w / sum(SW.w) OVER () AS w FROM SW JOIN V ON SW.domain = V.domain) x ON V.id = x.id"


def _ranks(spark, sf, teleport=None):
    v = d.vertices(spark, sf)
    return power_iteration(d.edges(spark, sf), v.select("id"), max_iter=d.ITERATIONS, tol=0.0, teleport=teleport)


def _teleport(spark, sf):
    weights = seeds.seed_weights(d.seed_rows(spark, sf), "log_rank", 100)
    return snapshot(seeds.teleport_vector(weights, d.vertices(spark, sf)), "teleport")


@query(
    f"""WITH RECURSIVE {d.GRAPH_SQL}, {d.rank_sql(GLOBAL_W, "G")}
SELECT V.domain, 'c1' AS crawl, round(G.rank, 10) AS pagerank_score, coalesce(I.in_degree, 0)::BIGINT AS in_degree, coalesce(O.out_degree, 0)::BIGINT AS out_degree
FROM G JOIN V ON G.id = V.id LEFT JOIN I ON V.id = I.id LEFT JOIN O ON V.id = O.id WHERE G.step = {d.ITERATIONS}"""
)
def global_pagerank(spark, sf):
    v, e = d.vertices(spark, sf), d.edges(spark, sf)
    out = jobs.pagerank_rows(v, _ranks(spark, sf), graph.degrees(v.select("id"), e), "c1")
    return out.withColumn("pagerank_score", F.round("pagerank_score", 10))


@query(
    f"""WITH RECURSIVE {d.GRAPH_SQL}, {d.SEED_SQL}, {d.rank_sql(SEED_W, "G")}
SELECT V.domain, 'c1' AS crawl, round(G.rank, 10) AS open_authority, round(ln(1.0 + coalesce(I.in_degree, 0)), 10) AS open_volume
FROM G JOIN V ON G.id = V.id LEFT JOIN I ON V.id = I.id WHERE G.step = {d.ITERATIONS}"""
)
def personalised_authority(spark, sf):
    v, e = d.vertices(spark, sf), d.edges(spark, sf)
    out = jobs.authority_rows(v, _ranks(spark, sf, _teleport(spark, sf)), graph.in_degrees(v.select("id"), e), "c1")
    return out.withColumns({"open_authority": F.round("open_authority", 10), "open_volume": F.round("open_volume", 10)})


@query(f"WITH {d.GRAPH_SQL} SELECT V.id::BIGINT AS id, coalesce(in_degree, 0)::BIGINT AS in_degree, coalesce(out_degree, 0)::BIGINT AS out_degree FROM V LEFT JOIN I ON V.id = I.id LEFT JOIN O ON V.id = O.id")
def graph_degrees(spark, sf):
    return graph.degrees(d.vertices(spark, sf).select("id"), d.edges(spark, sf))


@query(
    f"""WITH {d.GRAPH_SQL}
SELECT (SELECT count(*) FROM V)::BIGINT AS n_vertices, (SELECT count(DISTINCT domain) FROM V)::BIGINT AS n_domains, (SELECT max(id) FROM V)::BIGINT AS max_id, (SELECT count(*) FROM E)::BIGINT AS n_edges"""
)
def graph_validation(spark, sf):
    v, e = d.vertices(spark, sf), d.edges(spark, sf)
    n = graph.validate_vertices(v)
    m = graph.validate_edges(e, n)
    return v.agg(F.count(F.lit(1)).alias("n_vertices"), F.count_distinct("domain").alias("n_domains"), F.max("id").alias("max_id"), F.lit(m).cast("long").alias("n_edges"))


@query(
    f"""WITH {d.GRAPH_SQL} SELECT (SELECT count(*) FROM V)::BIGINT AS n_nodes, (SELECT count(*) FROM E)::BIGINT AS n_edges,
(SELECT max(in_degree) FROM I)::BIGINT AS in_max, (SELECT 1.0::DOUBLE * (n - (SELECT count(*) FROM O)) / n FROM N) AS dangling_ratio"""
)
def graph_statistics(spark, sf):
    stats = graph.graph_stats(d.vertices(spark, sf).select("id"), d.edges(spark, sf), 10_000)
    return stats.select("n_nodes", "n_edges", "in_max", "dangling_ratio")


@query(f"WITH {d.GRAPH_SQL} SELECT quantile_disc(in_degree, 0.5)::BIGINT AS in_p50, quantile_disc(in_degree, 0.9)::BIGINT AS in_p90, quantile_disc(in_degree, 0.99)::BIGINT AS in_p99, quantile_disc(in_degree, 0.999)::BIGINT AS in_p999 FROM I")
def graph_in_degree_quantiles(spark, sf):
    return graph.graph_stats(d.vertices(spark, sf).select("id"), d.edges(spark, sf), 100_000).select("in_p50", "in_p90", "in_p99", "in_p999")


HOSTS = "M AS (SELECT id, 'd' || (id % 37) || '.net' AS domain, id < 37 AS is_apex FROM V)"


def _host_map(spark, sf):
    return d.vertices(spark, sf).select("id", F.concat(F.lit("d"), F.col("id") % 37, F.lit(".net")).alias("domain"), (F.col("id") < 37).alias("is_apex"))


@query(
    f"""WITH {d.GRAPH_SQL}, {HOSTS}, X AS (SELECT DISTINCT a.domain AS f, b.domain AS t FROM E JOIN M a ON from_id = a.id JOIN M b ON to_id = b.id WHERE a.domain <> b.domain),
K AS (SELECT domain, row_number() OVER (ORDER BY domain) - 1 AS id FROM (SELECT f AS domain FROM X UNION SELECT t FROM X))
SELECT a.id::BIGINT AS from_id, b.id::BIGINT AS to_id FROM X JOIN K a ON f = a.domain JOIN K b ON t = b.domain"""
)
def graph_collapse(spark, sf):
    return graph.collapse(d.edges(spark, sf), _host_map(spark, sf))[1]


@query(f"WITH {d.GRAPH_SQL}, {HOSTS} SELECT count(*)::BIGINT AS n, sum(from_id)::BIGINT AS f, sum(to_id)::BIGINT AS t FROM E JOIN M a ON from_id = a.id JOIN M b ON to_id = b.id WHERE a.domain <> b.domain")
def graph_cross_domain_edges(spark, sf):
    return graph.cross_domain_edges(d.edges(spark, sf), _host_map(spark, sf)).agg(F.count(F.lit(1)).alias("n"), F.sum("from_id").alias("f"), F.sum("to_id").alias("t"))


@query(
    f"""WITH RECURSIVE {d.GRAPH_SQL}, {d.rank_sql(GLOBAL_W, "G")}, {HOSTS}
SELECT domain, round(sum(rank), 9) AS pr_sum, round(sum(CASE WHEN is_apex THEN rank ELSE 0 END), 9) AS pr_apex, count(*)::BIGINT AS n_hosts FROM G JOIN M ON G.id = M.id WHERE step = {d.ITERATIONS} GROUP BY domain"""
)
def graph_host_to_domain(spark, sf):
    return graph.host_to_domain(_ranks(spark, sf), _host_map(spark, sf)).withColumns({"pr_sum": F.round("pr_sum", 9), "pr_apex": F.round("pr_apex", 9)})


@query(
    f"""WITH {d.GRAPH_SQL} SELECT domain, in_degree::BIGINT AS in_degree, in_degree::DOUBLE / n AS fraction FROM (SELECT to_id AS id, count(*) AS in_degree FROM (SELECT DISTINCT from_id, to_id FROM E) GROUP BY 1) x JOIN V ON x.id = V.id, N WHERE in_degree::DOUBLE / n > 0.02"""
)
def graph_boilerplate(spark, sf):
    v = d.vertices(spark, sf)
    return graph.boilerplate_targets(d.edges(spark, sf), v, 0.02, v.count())


@query(
    f"""WITH RECURSIVE {d.GRAPH_SQL}, {d.rank_sql(GLOBAL_W, "G")} SELECT domain, round(rank, 9) AS rank FROM G JOIN V ON G.id = V.id WHERE step = {d.ITERATIONS} ORDER BY G.rank DESC, domain LIMIT 20"""
)
def graph_top_ranked(spark, sf):
    return graph.top_ranked(_ranks(spark, sf), d.vertices(spark, sf), 20).withColumn("rank", F.round("rank", 9))


@query(f"WITH {d.SEED_SQL} SELECT domain, rank::INTEGER AS rank, round(w, 12) AS w FROM SW")
def seed_weights(spark, sf):
    return seeds.seed_weights(d.seed_rows(spark, sf), "log_rank", 100).withColumn("w", F.round("w", 12))


@query(f"WITH {d.SEED_SQL} SELECT domain, round(1.0 / sqrt(rank), 12) AS sqrt_rank, 1.0::DOUBLE AS uniform, consensus AS score FROM SW")
def seed_weight_kinds(spark, sf):
    s = d.seed_rows(spark, sf)
    a = seeds.seed_weights(s, "sqrt_rank", 100).select("domain", F.round("w", 12).alias("sqrt_rank"))
    b = seeds.seed_weights(s, "uniform", 100).select("domain", F.col("w").alias("uniform"))
    return a.join(b, "domain").join(seeds.seed_weights(s, "score", 100).select("domain", F.col("w").alias("score")), "domain")


@query(f"WITH {d.GRAPH_SQL}, {d.SEED_SQL} SELECT V.id::BIGINT AS id, round(SW.w / sum(SW.w) OVER (), 12) AS w FROM SW JOIN V ON SW.domain = V.domain")
def seed_teleport(spark, sf):
    return _teleport(spark, sf).withColumn("w", F.round("w", 12))


@query(f"WITH {d.GRAPH_SQL}, {d.SEED_SQL} SELECT count(*)::BIGINT AS n_seed, count(V.id)::BIGINT AS n_on_graph, count(V.id)::DOUBLE / count(*) AS coverage FROM SW LEFT JOIN V ON SW.domain = V.domain")
def seed_coverage(spark, sf):
    return seeds.seed_coverage(seeds.seed_weights(d.seed_rows(spark, sf), "log_rank", 100), d.vertices(spark, sf))


# ---- mart and data quality ----------------------------------------------------------------------

MART_IN = f"""{d.CRAWL_SQL},
PR AS (SELECT domain, crawl, round(count(*) / 10000.0::DOUBLE, 10) AS pagerank_score, count(*)::BIGINT AS in_degree, count(DISTINCT target)::BIGINT AS out_degree FROM C GROUP BY 1, 2),
OA AS (SELECT domain, crawl, round(count(*) / 20000.0::DOUBLE, 10) AS open_authority, round(ln(1.0 + count(*) FILTER (WHERE target <> 'error')), 10) AS open_volume FROM C WHERE target <> 'purchase' GROUP BY 1, 2)"""


def _mart_inputs(spark, sf):
    rows = d.crawl_rows(spark, sf)
    pr = rows.groupBy("domain", "crawl").agg(F.round(F.count(F.lit(1)) / 10000.0, 10).alias("pagerank_score"), F.count(F.lit(1)).alias("in_degree"), F.count_distinct("target").alias("out_degree"))
    oa = rows.where("target <> 'purchase'").groupBy("domain", "crawl")
    return pr, oa.agg(F.round(F.count(F.lit(1)) / 20000.0, 10).alias("open_authority"), F.round(F.log1p(F.count_if(F.col("target") != "error").cast("double")), 10).alias("open_volume"))


@query(
    f"""WITH {MART_IN} SELECT PR.domain, PR.crawl AS window_id, PR.crawl AS window_end_crawl, PR.crawl AS window_crawls, pagerank_score, open_volume, open_authority,
round(CASE WHEN open_volume <> 0 THEN open_authority / open_volume END, 10) AS authority_ratio FROM PR LEFT JOIN OA ON PR.domain = OA.domain AND PR.crawl = OA.crawl"""
)
def mart_domain_authority(spark, sf):
    mart = marts.build_views(spark, *_mart_inputs(spark, sf))
    return mart.withColumns({"window_crawls": F.array_join("window_crawls", ","), "authority_ratio": F.round("authority_ratio", 10)})


@query(
    f"""WITH {MART_IN}, T AS (SELECT PR.domain, PR.crawl, pagerank_score, open_volume FROM PR LEFT JOIN OA ON PR.domain = OA.domain AND PR.crawl = OA.crawl)
SELECT 'not_null(open_volume)' AS test, count(*) FILTER (WHERE open_volume IS NULL)::BIGINT AS failures FROM T
UNION ALL SELECT 'between(open_volume,1,None)', count(*) FILTER (WHERE open_volume < 1)::BIGINT FROM T
UNION ALL SELECT 'unique(domain)', (SELECT count(*) FROM (SELECT domain FROM T GROUP BY 1 HAVING count(*) > 1))::BIGINT"""
)
def dq_tests(spark, sf):
    pr, oa = _mart_inputs(spark, sf)
    rows = pr.join(oa, ["domain", "crawl"], "left")
    return dq.run_tests(rows, [dq.not_null("open_volume"), dq.between("open_volume", 1), dq.unique("domain")])


@query(f"WITH {d.CRAWL_SQL} SELECT DISTINCT crawl AS window_id, crawl AS window_end_crawl, crawl AS window_crawls FROM C")
def crawl_windows(spark, sf):
    return crawls.crawl_windows(d.crawl_rows(spark, sf)).withColumn("window_crawls", F.array_join("window_crawls", ","))


@query(f"WITH {MART_IN} SELECT count(*)::BIGINT AS n_rows, round(sum(pagerank_score), 8) AS mass, min(pagerank_score) AS min_score, max(pagerank_score) AS max_score, 0::BIGINT AS null_scores, 0::BIGINT AS null_domains FROM PR")
def output_statistics(spark, sf):
    return reference.output_stats(_mart_inputs(spark, sf)[0]).withColumn("mass", F.round("mass", 8))


@query(f"WITH {MART_IN} SELECT row_number() OVER (ORDER BY open_authority DESC, domain)::INTEGER AS rank, domain, open_authority, open_volume, crawl AS window_id FROM OA WHERE crawl = (SELECT min(crawl) FROM OA) ORDER BY open_authority DESC, domain LIMIT 15")
def publish_top_list(spark, sf):
    mart = _mart_inputs(spark, sf)[1].withColumnRenamed("crawl", "window_id")
    window = publish.resolve_window(publish.available_windows(mart), mart.agg(F.min("window_id")).first()[0])
    return publish.top_list(publish.public_index(mart, window), 15)


# ---- links --------------------------------------------------------------------------------------


@query(f"WITH {d.LINKS_SQL} SELECT * FROM PAIRS")
def link_pairs(spark, sf):
    return links.aggregate_pairs(links.resolve_domains(d.links(spark, sf)))


@query(f"WITH {d.LINKS_SQL} SELECT count(*)::BIGINT AS domain_pair_rows, sum(link_count)::BIGINT AS link_count_total FROM PAIRS")
def link_pair_totals(spark, sf):
    return links.pair_totals(link_pairs(spark, sf))


@query(f"WITH {d.LINKS_SQL} SELECT domain_from, sum(link_count)::BIGINT AS links FROM PAIRS GROUP BY 1 ORDER BY links DESC, domain_from LIMIT 10")
def link_skew_top(spark, sf):
    return links.skew_top(link_pairs(spark, sf), ["domain_from"], 10)


@query(
    f"""WITH {d.LINKS_SQL} SELECT count(*)::BIGINT AS global_pairs, sum(link_count)::BIGINT AS global_links, count(*) FILTER (WHERE domain_to LIKE '%.com')::BIGINT AS scoped_pairs,
coalesce(sum(link_count) FILTER (WHERE domain_to LIKE '%.com'), 0)::BIGINT AS scoped_links FROM PAIRS"""
)
def link_scope_totals(spark, sf):
    pairs = link_pairs(spark, sf)
    inside = pairs.where(F.col("domain_to").endswith(".com")).select(F.col("domain_to").alias("domain")).distinct()
    return links.scope_totals(pairs, inside)


@query(f"WITH {d.LINKS_SQL} SELECT 0.0::DOUBLE AS url_from_parse_fail_rate, count(*) FILTER (WHERE host_to IS NULL)::DOUBLE / count(*) AS url_to_parse_fail_rate FROM H")
def link_host_parse_failures(spark, sf):
    return links.host_parse_failures(d.links(spark, sf))


@query(f"WITH {d.LINKS_SQL} SELECT count(*) FILTER (WHERE domain_from IS NULL)::DOUBLE / count(*) AS domain_from_null_rate, count(*) FILTER (WHERE domain_to IS NULL)::DOUBLE / count(*) AS domain_to_null_rate FROM R")
def link_null_domain_rates(spark, sf):
    return links.null_domain_rates(links.resolve_domains(d.links(spark, sf), keep_unresolved=True))


@query(f"WITH {d.LINKS_SQL} SELECT count(DISTINCT host_from)::BIGINT AS n_host_from, count(DISTINCT host_to)::BIGINT AS n_host_to FROM R")
def link_cardinalities(spark, sf):
    return links.cardinalities(links.with_hosts(d.links(spark, sf)))


@query(
    f"""WITH {d.LINKS_SQL} SELECT domain_from, domain_to, url_from, url_to, anchor, rel, nf AS is_nofollow, ug AS is_ugc, sp AS is_sponsored FROM R
WHERE domain_from LIKE '%.net' AND domain_to LIKE '%.com'"""
)
def link_backlinks_into(spark, sf):
    rows = snapshot(links.resolve_domains(d.links(spark, sf)), "links")
    src = rows.where(F.col("domain_from").endswith(".net")).select(F.col("domain_from").alias("registered_domain")).distinct()
    dst = rows.where(F.col("domain_to").endswith(".com")).select(F.col("domain_to").alias("registered_domain")).distinct()
    return links.backlinks_into(rows.drop("domain_to"), src, dst)


@query(
    f"""WITH {d.LINKS_SQL} SELECT count(*)::BIGINT AS backlinks, count(*) FILTER (WHERE anchor IS NULL OR trim(anchor) = '')::BIGINT AS empty_anchor, count(*) FILTER (WHERE nf)::BIGINT AS nofollow,
count(*) FILTER (WHERE ug)::BIGINT AS ugc, count(*) FILTER (WHERE sp)::BIGINT AS sponsored FROM R WHERE domain_from LIKE '%.net' AND domain_to LIKE '%.com'"""
)
def link_backlink_counters(spark, sf):
    return links.backlink_counters(link_backlinks_into(spark, sf))


@query(r"""SELECT DISTINCT host, regexp_extract(host, '([^.]+\.[^.]+)$', 1) AS domain, host = regexp_extract(host, '([^.]+\.[^.]+)$', 1) AS is_apex
FROM (SELECT regexp_extract(replace(url, '.example.', '.'), '^[a-z]+://([^/?#]+)', 1) AS host FROM pages) WHERE host <> ''""")
def url_registered_domains(spark, sf):
    hosts = d.links(spark, sf).select(urls.host_of(F.col("url_from")).alias("host"))
    return psl.registered_domains(hosts).withColumn("is_apex", psl.is_apex(F.col("host"), F.col("domain")))


@query(
    r"""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1), '([^.]+\.[^.]+)$', 1) AS root, regexp_extract(url, '^[a-z]+://[^/?#]*\.([a-z]+)', 1) AS tld,
'crawl-data/x/segments/1/wat/' || page_id || '.warc.wat.gz' AS wat FROM pages"""
)
def url_functions(spark, sf):
    host = urls.host_of(F.col("url"))
    path = F.concat(F.lit("crawl-data/x/segments/1/warc/"), "page_id", F.lit(".warc.gz"))
    return d.t(spark, sf, "pages").select("page_id", host.alias("host"), urls.naive_root(host).alias("root"), urls.tld(host).alias("tld"), urls.wat_path(path).alias("wat"))


@query("SELECT o_orderkey, array_to_string(list_reverse(string_split('k' || o_orderkey || '.' || lower(o_orderstatus) || '.com', '.')), '.') AS domain FROM orders")
def url_unreverse(spark, sf):
    name = F.concat(F.lit("k"), "o_orderkey", F.lit("."), F.lower("o_orderstatus"), F.lit(".com"))
    return d.t(spark, sf, "orders").select("o_orderkey", urls.unreverse(name).alias("domain"))


# ---- sources and sinks --------------------------------------------------------------------------


@query("SELECT CASE WHEN page_id % 3 = 0 THEN '404' ELSE '200' END AS status, url, lower(trim(split_part('ENG, fra', ',', 1))) AS primary_lang FROM pages")
def source_cdxj(spark, sf):
    body = F.to_json(F.struct(F.when(F.col("page_id") % 3 == 0, "404").otherwise("200").alias("status"), "url", F.lit("ENG, fra").alias("languages")))
    lines = d.t(spark, sf, "pages").select(F.concat(F.lit("com,x)/ 20240101000000 "), body).alias("value"))
    return readers.parse_cdxj(lines).select("status", "url", "primary_lang")


@query(
    f"WITH {d.LINKS_SQL} SELECT url_from, url_to, anchor, rel FROM L"
)
def source_wat_json(spark, sf):
    """Link records as WAT payloads, read by the JVM extractor: the image beside each anchor isn't a link."""
    x = d.links(spark, sf)
    anchor = F.struct(F.lit("A@/href").alias("path"), F.col("url_to").alias("url"), F.col("anchor").alias("text"), F.col("rel").alias("rel"))
    image = F.struct(F.lit("IMG@/src").alias("path"), F.lit("i.png").alias("url"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("rel"))
    html = F.struct(F.array(anchor, image).alias("Links"))
    meta = F.struct(F.struct(html.alias("HTML-Metadata")).alias("HTTP-Response-Metadata"))
    head = F.struct(F.col("url_from").alias("WARC-Target-URI")).alias("WARC-Header-Metadata")
    payload = F.to_json(F.struct(F.struct(head, meta.alias("Payload-Metadata")).alias("Envelope")))
    return wat.links_from_json(x.select(payload.alias("value")))


@query(f"WITH {d.GRAPH_SQL} SELECT from_id::BIGINT AS from_id, to_id::BIGINT AS to_id, count(*)::BIGINT AS n FROM E GROUP BY 1, 2")
def source_strict_edges(spark, sf):
    """Edges through TSV and Parquet and back by the strict reader."""
    tsv, out = scratch_path(spark, "edges-tsv"), scratch_path(spark, "edges")
    d.edges(spark, sf).write.option("sep", "\t").csv(tsv)
    sinks.write_table(readers.read_edges_tsv(spark, tsv), out)
    return readers.read_edges(spark, out).groupBy("from_id", "to_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {d.CRAWL_SQL} SELECT crawl, CASE WHEN crawl = (SELECT min(crawl) FROM C) THEN 1 ELSE count(*) END::BIGINT AS n FROM C GROUP BY 1")
def sink_partition_overwrite(spark, sf):
    """Writing one crawl again replaces it alone."""
    out = scratch_path(spark, "crawls")
    rows = d.crawl_rows(spark, sf)
    sinks.write_crawl_partitions(rows, out)
    first = rows.agg(F.min("crawl")).first()[0]
    sinks.write_crawl_partitions(rows.where(F.col("crawl") == first).orderBy("domain", "target", "value").limit(1), out)
    return readers.read_partitioned(spark, out).groupBy(F.col("crawl").cast("string").alias("crawl")).agg(F.count(F.lit(1)).alias("n"))


# ---- languages ----------------------------------------------------------------------------------


def _pages(spark, sf):
    return d.t(spark, sf, "documents").select(F.col("source").alias("domain"), "lang", "doc_id")


LANG_SHARES = "X AS (SELECT source AS domain, lang, count(*) AS pages, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY source) AS share FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL GROUP BY 1, 2)"


@query(f"WITH {LANG_SHARES} SELECT domain, lang, pages::BIGINT AS pages, round(share, 12) AS share FROM X WHERE share >= 0.05")
def language_shares(spark, sf):
    return languages.language_shares(_pages(spark, sf)).withColumn("share", F.round("share", 12))


@query(
    f"""WITH {LANG_SHARES} SELECT domain, string_agg(lang || ':' || pages, ',' ORDER BY pages DESC, lang) FILTER (WHERE share >= 0.05) AS languages, sum(pages)::BIGINT AS page_count,
first(lang ORDER BY pages DESC, lang) FILTER (WHERE share >= 0.05) AS dominant FROM X GROUP BY domain"""
)
def language_arrays(spark, sf):
    out = languages.domain_languages(_pages(spark, sf))
    text = F.array_join(F.transform("languages", lambda x: F.concat_ws(":", x.lang, F.round(x.share * F.col("page_count")).cast("long").cast("string"))), ",")
    return out.select("domain", text.alias("languages"), "page_count", "dominant")


@query("SELECT count(*)::BIGINT AS total, count(lang)::BIGINT AS with_lang, count(*) FILTER (WHERE doc_id % 3 <> 0)::BIGINT AS ok, count(lang) FILTER (WHERE doc_id % 3 <> 0)::BIGINT AS ok_with_lang FROM documents")
def language_coverage(spark, sf):
    status = F.when(F.col("doc_id") % 3 == 0, "404").otherwise("200")
    return languages.coverage(_pages(spark, sf).select(status.alias("status"), F.col("lang").alias("primary_lang")))


@query("SELECT lang, count(*)::BIGINT AS pages FROM documents WHERE lang IS NOT NULL GROUP BY 1 ORDER BY pages DESC, lang LIMIT 20")
def language_distribution(spark, sf):
    return languages.distribution(_pages(spark, sf))


QUALIFIED = "Q AS (SELECT source AS registered_domain, count(*)::BIGINT AS total_200_pages, count(*) FILTER (WHERE lang IN ('de', 'es'))::BIGINT AS target_language_pages FROM documents GROUP BY 1)"


def _projection(spark, sf):
    p = d.t(spark, sf, "documents")
    return p.select(F.col("source").alias("registered_domain"), F.concat(F.upper("lang"), F.lit(", eng")).alias("content_languages"), F.lit(200).alias("fetch_status"), F.concat(F.lit("a/warc/f"), F.col("doc_id") % 11, F.lit(".warc.gz")).alias("warc_filename"))


@query(f"WITH {QUALIFIED} SELECT *, target_language_pages::DOUBLE / total_200_pages AS language_share, target_language_pages::DOUBLE / total_200_pages >= 0.25 AS meets_share FROM Q WHERE target_language_pages > 0")
def language_qualify(spark, sf):
    return languages.qualify_targets(_projection(spark, sf), ["de", "es"], 0.25)


@query("SELECT DISTINCT source AS registered_domain, 'a/wat/f' || (doc_id % 11) || '.warc.wat.gz' AS wat_path FROM documents WHERE source IN (SELECT source FROM documents WHERE lang = 'de')")
def language_source_files(spark, sf):
    p = _projection(spark, sf)
    german = p.where(urls.primary_language(F.col("content_languages")) == "de").select("registered_domain").distinct()
    return languages.source_wat_files(p, german)


@query("SELECT count(DISTINCT source)::BIGINT AS sources, count(DISTINCT doc_id % 11)::BIGINT AS files, count(DISTINCT doc_id % 11) / 100.0::DOUBLE AS crawl_fraction, count(DISTINCT doc_id % 11) * 2.5::DOUBLE AS estimated_bytes FROM documents WHERE source IN (SELECT source FROM documents WHERE lang = 'de')")
def language_wat_stats(spark, sf):
    return languages.wat_stats(language_source_files(spark, sf), 100, 2.5)


CRAWL_LANG = "CL AS (SELECT source AS domain, (doc_id % 3)::VARCHAR AS crawl, lang, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY source, doc_id % 3) AS share, count(*) AS n FROM documents GROUP BY source, doc_id % 3, lang)"


def _crawl_shares(spark, sf):
    from pyspark.sql import Window as W

    c = _pages(spark, sf).groupBy("domain", (F.col("doc_id") % 3).cast("string").alias("crawl"), "lang").agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy("domain", "crawl")))


@query(f"WITH {CRAWL_LANG} SELECT domain, count(*)::BIGINT AS crawls_met FROM (SELECT domain, crawl, sum(share) AS s FROM CL WHERE lang IN ('en') GROUP BY 1, 2) WHERE s >= 0.25 GROUP BY 1 HAVING count(*) >= 2")
def language_in_segment(spark, sf):
    return languages.in_segment(_crawl_shares(spark, sf), ["en"], 0.25, 2)


@query(
    f"""WITH {CRAWL_LANG}, D AS (SELECT domain, crawl, first(lang ORDER BY n DESC, lang) AS dominant FROM CL GROUP BY 1, 2), K AS (SELECT domain, dominant, count(*) AS n FROM D GROUP BY 1, 2)
SELECT domain, max(n)::DOUBLE / sum(n)::DOUBLE AS language_stability_score FROM K GROUP BY 1"""
)
def language_stability(spark, sf):
    c = _crawl_shares(spark, sf)
    dominant = c.groupBy("domain", "crawl").agg(F.min(F.struct((-F.col("n")).alias("m"), "lang"))["lang"].alias("dominant"))
    return languages.stability(dominant)


# ---- recall -------------------------------------------------------------------------------------

RECALL_SQL = f"""{d.GRAPH_SQL}, X AS (SELECT DISTINCT a.domain AS domain_from, b.domain AS domain_to FROM E JOIN V a ON from_id = a.id JOIN V b ON to_id = b.id WHERE b.domain LIKE 's%'),
F AS (SELECT domain_from, domain_to FROM X WHERE md5(domain_from || domain_to) < '8' UNION SELECT domain_to, domain_from FROM X WHERE md5(domain_from || domain_to) < '2'),
S AS (SELECT 'c' || c_custkey || '.org' AS domain FROM customer WHERE c_mktsegment = 'BUILDING')"""


def _recall_inputs(spark, sf):
    """Links into all suppliers, a part of them found, and the customers of one market segment as parsed sources."""
    v = d.vertices(spark, sf)
    targets = v.where(F.col("domain").startswith("s")).select(F.col("domain").alias("registered_domain"))
    parsed = d.t(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.concat(F.lit("c"), "c_custkey", F.lit(".org")).alias("registered_domain"))
    x = snapshot(recall.expected_edges(d.edges(spark, sf), v, targets), "expected")
    h = F.md5(F.concat("domain_from", "domain_to").cast("binary"))
    found = x.where(h < "8").union(x.where(h < "2").select("domain_to", "domain_from")).distinct()
    return found, x, parsed


@query(f"WITH {RECALL_SQL} SELECT * FROM X")
def recall_expected_edges(spark, sf):
    return _recall_inputs(spark, sf)[1]


@query(
    f"""WITH {RECALL_SQL} SELECT count(*)::BIGINT AS expected, count(F.domain_from)::BIGINT AS found, count(F.domain_from)::DOUBLE / count(*) AS recall
FROM X LEFT JOIN F ON X.domain_from = F.domain_from AND X.domain_to = F.domain_to WHERE X.domain_from IN (SELECT domain FROM S)"""
)
def recall_conditional(spark, sf):
    return recall.conditional_recall(*_recall_inputs(spark, sf))


@query(f"WITH {RECALL_SQL} SELECT * FROM F INTERSECT SELECT * FROM X")
def recall_intersect(spark, sf):
    f, x, _ = _recall_inputs(spark, sf)
    return recall.found_and_expected(f, x)


@query(f"WITH {RECALL_SQL} SELECT * FROM F EXCEPT SELECT * FROM X")
def recall_only_found(spark, sf):
    f, x, _ = _recall_inputs(spark, sf)
    return recall.only_found(f, x)


@query(
    f"""WITH {RECALL_SQL}, T AS (SELECT domain_to FROM (SELECT DISTINCT domain_to FROM X) ORDER BY md5(domain_to), domain_to LIMIT 10), Y AS (SELECT DISTINCT domain_from FROM X WHERE domain_to IN (SELECT * FROM T))
SELECT 10::BIGINT AS targets, count(DISTINCT domain)::BIGINT AS sources, count(DISTINCT id % 50)::BIGINT AS files, count(DISTINCT id % 50) / 50.0::DOUBLE AS crawl_fraction FROM V WHERE domain IN (SELECT * FROM Y)"""
)
def recall_selectivity(spark, sf):
    x = _recall_inputs(spark, sf)[1]
    files = d.vertices(spark, sf).select(F.col("domain").alias("registered_domain"), F.concat(F.lit("w"), F.col("id") % 50).alias("wat_path"))
    return recall.selectivity(x, files, 10, 50)


# ---- samples ------------------------------------------------------------------------------------

DECADES = "B AS (SELECT domain, b / 1000.0 AS oa, floor(log10(b / 1000.0))::INTEGER AS bucket FROM S)"


@query(f"WITH {d.SCORED_SQL}, {DECADES} SELECT bucket, domain, oa FROM (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY md5(domain), domain) AS rn FROM B) WHERE rn <= 20")
def sample_by_bucket(spark, sf):
    return sampling.bucket_sample(d.scored(spark, sf).select("domain", (F.col("b") / 1000.0).alias("oa")), 20)


@query(
    f"""WITH {d.SCORED_SQL}, {DECADES}, T AS (SELECT domain FROM B ORDER BY oa DESC, domain LIMIT 20), R AS (SELECT *, count(*) OVER (PARTITION BY bucket) AS n FROM B WHERE domain NOT IN (SELECT domain FROM T) AND oa > 0),
D AS (SELECT domain FROM R WHERE {d.CHANCE_SQL} < least(1.0::DOUBLE, 50.0::DOUBLE / n) ORDER BY md5(domain), domain LIMIT 80) SELECT domain FROM T UNION ALL SELECT domain FROM D"""
)
def sample_stratified(spark, sf):
    return sampling.stratified_list(d.scored(spark, sf).select("domain", (F.col("b") / 1000.0).alias("oa")), 20, 50, 100, "md5")


@query(f"WITH {d.SCORED_SQL} SELECT domain, a, b FROM S WHERE {d.CHANCE_SQL} * 10 < 1")
def sample_by_hash(spark, sf):
    return sampling.hash_sample(d.scored(spark, sf).select("domain", "a", "b"), "domain", 10)


@query(f"WITH {d.SCORED_SQL} SELECT 0::BIGINT AS n_foreign, true AS same_again, count(*) > 0 AS is_near_share FROM S")
def sample_rows(spark, sf):
    """A Bernoulli sample: rows of the table only, the same ones again, about as many as asked for."""
    rows = d.scored(spark, sf).select("domain")
    sample = snapshot(sampling.row_sample(rows, 0.1), "sample")
    again = sampling.row_sample(rows, 0.1).select("domain")
    n, drawn = rows.count(), sample.count()
    same = sample.exceptAll(again).isEmpty() and again.exceptAll(sample).isEmpty()
    near = abs(drawn - 0.1 * n) <= 6 * (n * 0.09) ** 0.5
    return sample.join(rows, "domain", "left_anti").agg(F.count(F.lit(1)).alias("n_foreign"), F.lit(same).alias("same_again"), F.lit(near).alias("is_near_share"))


@query(f"WITH {d.SCORED_SQL} SELECT 25::BIGINT AS n, 0::BIGINT AS n_foreign, true AS same_again FROM (SELECT 1)")
def sample_random_rows(spark, sf):
    rows = d.scored(spark, sf).select("domain")
    drawn = snapshot(sampling.random_rows(rows, 25), "drawn")
    same = drawn.exceptAll(sampling.random_rows(rows, 25)).isEmpty()
    known = rows.withColumn("known", F.lit(1))
    return drawn.join(known, "domain", "left").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("known").isNull()).alias("n_foreign"), F.lit(same).alias("same_again"))


# ---- rank agreement -----------------------------------------------------------------------------

RANKED = f"{d.SCORED_SQL}, K AS (SELECT *, rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb, rank() OVER (ORDER BY a DESC) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS da, rank() OVER (ORDER BY b DESC) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS db FROM S)"


@query(f"WITH {RANKED} SELECT count(*)::BIGINT AS n, round(corr(ra::DOUBLE, rb::DOUBLE), 9) AS spearman FROM K")
def rank_spearman(spark, sf):
    return rankstats.spearman(d.scored(spark, sf), "a", "b").withColumn("spearman", F.round("spearman", 9))


@query(
    f"""WITH {RANKED}, Z(lo, hi) AS (VALUES (1, 101), (101, 501), (501, 2001)), Y AS (SELECT lo, hi, rank() OVER (PARTITION BY lo ORDER BY a) + (count(*) OVER (PARTITION BY lo, a) - 1) / 2.0 AS x, rank() OVER (PARTITION BY lo ORDER BY b) + (count(*) OVER (PARTITION BY lo, b) - 1) / 2.0 AS y FROM K JOIN Z ON floor(db) >= lo AND floor(db) < hi)
SELECT lo::BIGINT AS lo, hi::BIGINT AS hi, count(*)::BIGINT AS n, round(corr(x::DOUBLE, y::DOUBLE), 9) AS spearman FROM Y GROUP BY 1, 2 HAVING count(*) > 2"""
)
def rank_bucket_spearman(spark, sf):
    out = rankstats.bucket_spearman(d.scored(spark, sf), "a", "b", [(1, 101), (101, 501), (501, 2001)])
    return out.withColumn("spearman", F.round("spearman", 9))


@query(
    f"""WITH {d.SCORED_SQL}, P AS (SELECT sign(x.a - y.a) * sign(x.b - y.b) AS s, x.a <> y.a AS na, x.b <> y.b AS nb FROM S x JOIN S y ON x.domain < y.domain)
SELECT round(sum(s) / sqrt((count(*) FILTER (WHERE na))::DOUBLE * (count(*) FILTER (WHERE nb))::DOUBLE), 9) AS kendall_tau_b FROM P"""
)
def rank_kendall(spark, sf):
    value = rankstats.kendall(d.scored(spark, sf), "a", "b")
    return spark.range(1).select(F.round(F.lit(value), 9).alias("kendall_tau_b"))


@query(
    f"""WITH {d.SCORED_SQL}, A AS (SELECT domain, row_number() OVER (ORDER BY a DESC, domain) AS i FROM S), B AS (SELECT domain, row_number() OVER (ORDER BY b DESC, domain) AS j FROM S), Q(k) AS (VALUES (50), (200)),
M AS (SELECT k, count(*) AS c FROM A JOIN B ON A.domain = B.domain JOIN Q ON i <= k AND j <= k GROUP BY k)
SELECT Q.k::BIGINT AS k, coalesce(c, 0)::DOUBLE / (2 * Q.k - coalesce(c, 0)) AS jaccard FROM Q LEFT JOIN M ON Q.k = M.k"""
)
def rank_top_jaccard(spark, sf):
    return rankstats.top_jaccard(d.scored(spark, sf), "a", "b", [50, 200])


@query(
    f"""WITH {d.SCORED_SQL}, A AS (SELECT domain, row_number() OVER (ORDER BY a DESC, domain) AS i FROM S), B AS (SELECT domain, row_number() OVER (ORDER BY b DESC, domain) AS j FROM S),
M AS (SELECT greatest(i, j) AS m, count(*) AS c FROM A JOIN B ON A.domain = B.domain WHERE i <= 1000 AND j <= 1000 GROUP BY 1), D AS (SELECT unnest(range(1, 1 + least(1000, (SELECT count(*) FROM S)))) AS i),
O AS (SELECT D.i, sum(coalesce(c, 0)) OVER (ORDER BY D.i) AS o FROM D LEFT JOIN M ON D.i = M.m)
SELECT round(0.01 * sum(o::DOUBLE / i * pow(0.99, i - 1)), 9) AS rbo FROM O"""
)
def rank_rbo(spark, sf):
    return rankstats.rbo(d.scored(spark, sf), "a", "b", 0.99, 1000).withColumn("rbo", F.round("rbo", 9))


@query(f"WITH {RANKED} SELECT quantile_cont(abs(floor(da) - floor(db))::DOUBLE, 0.5) AS median_abs_delta, round(quantile_cont(abs(floor(da) - floor(db))::DOUBLE, 0.9), 6) AS p90_abs_delta FROM K")
def rank_displacement(spark, sf):
    return rankstats.displacement(d.scored(spark, sf), "a", "b").withColumn("p90_abs_delta", F.round("p90_abs_delta", 6))


@query(
    f"""WITH {RANKED}, U AS (SELECT count(*) FILTER (WHERE b > 25) AS p, count(*) FILTER (WHERE b <= 25) AS n, sum(ra) FILTER (WHERE b > 25) AS s FROM K)
SELECT p::BIGINT AS n_pos, n::BIGINT AS n_neg, round((s - p * (p + 1) / 2.0)::DOUBLE / (p * n), 9) AS auc FROM U"""
)
def rank_auc(spark, sf):
    rows = d.scored(spark, sf).withColumn("pos", F.col("b") > 25)
    return rankstats.auc(rows, "a", "pos").withColumn("auc", F.round("auc", 9))


@query(
    f"""WITH {d.SCORED_SQL}, Q AS (SELECT quantile_cont(a, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS c FROM S)
SELECT (len(list_distinct(c)) + 1 - len(list_filter(list_distinct(c), lambda x: a > x)))::BIGINT AS decile, count(*)::BIGINT AS n, round(avg((b > 25)::INTEGER), 9) AS rate FROM S, Q GROUP BY 1"""
)
def rank_decile_rates(spark, sf):
    rows = d.scored(spark, sf).withColumn("pos", F.col("b") > 25)
    return rankstats.decile_rates(rows, "a", "pos").withColumn("rate", F.round("rate", 9))


@query(f"WITH {d.SCORED_SQL} SELECT avg((domain IN ('p1.com', 'p900.com', 'p950.com'))::INTEGER)::DOUBLE AS share FROM (SELECT domain FROM S ORDER BY a DESC, domain LIMIT 100)")
def rank_share_in_top(spark, sf):
    return rankstats.share_in_top(d.scored(spark, sf), "a", ["p1.com", "p900.com", "p950.com"], 100)


@query("SELECT count(*)::BIGINT AS n, round(regr_slope(l_extendedprice, l_quantity), 5) AS slope, round(regr_r2(l_extendedprice, l_quantity), 9) AS r2 FROM lineitem")
def rank_ladder_fit(spark, sf):
    out = rankstats.ladder_fit(d.t(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return out.select("n", F.round("slope", 5).alias("slope"), F.round("r2", 9).alias("r2"))


# ---- references ---------------------------------------------------------------------------------

TRUST_SQL = r"T AS (SELECT regexp_extract(replace(url, '.example.', '.'), '^[a-z]+://[^/?#]*?([^./]+\.[^./?#]+)([/?#]|$)', 1) AS domain, CASE WHEN page_id % 7 = 0 THEN 'n/a' ELSE (page_id % 50)::VARCHAR END AS trust, CASE page_id % 4 WHEN 0 THEN 'Found' WHEN 1 THEN 'MayExist' WHEN 2 THEN 'NotFound' ELSE 'odd' END AS status, page_id FROM pages)"


def _trust(spark, sf):
    p = d.t(spark, sf, "pages")
    k = F.col("page_id")
    return p.select(
        urls.host_of(F.replace("url", F.lit(".example."), F.lit("."))).alias("host"), F.when(k % 7 == 0, "n/a").otherwise((k % 50).cast("string")).alias("trust"), k.cast("string").alias("volume"),
        F.when(k % 4 == 0, "Found").when(k % 4 == 1, "MayExist").when(k % 4 == 2, "NotFound").otherwise("odd").alias("status"), k.cast("string").alias("ref_domains"), (k * 2).cast("string").alias("ext_backlinks"),
    )


@query(
    f"""WITH {TRUST_SQL} SELECT domain, max(trust::DOUBLE) AS ref_trust, max(page_id)::DOUBLE AS ref_volume, max(page_id)::BIGINT AS ref_domains, (2 * max(page_id))::BIGINT AS ext_backlinks,
CASE max(CASE status WHEN 'Found' THEN 3 WHEN 'MayExist' THEN 2 WHEN 'NotFound' THEN 1 ELSE 0 END) WHEN 3 THEN 'Found' WHEN 2 THEN 'MayExist' WHEN 1 THEN 'NotFound' ELSE 'odd' END AS status FROM T WHERE trust <> 'n/a' GROUP BY domain"""
)
def reference_trust(spark, sf):
    return reference.normalise_trust(_trust(spark, sf), "host", "trust", "volume")


@query(f"WITH {TRUST_SQL} SELECT domain, max(trust::DOUBLE) AS opr_score FROM T WHERE trust <> 'n/a' GROUP BY domain")
def reference_rank_list(spark, sf):
    return reference.normalise_rank_csv(_trust(spark, sf), "host", "trust")


@query(
    f"""WITH RECURSIVE {d.GRAPH_SQL}, {d.SEED_SQL}, {d.rank_sql(SEED_W, "A")}, {d.rank_sql(GLOBAL_W, "G")}
SELECT domain, round(A.rank, 8) AS open_authority, round(G.rank, 8) AS global_rank, round(ln(A.rank / G.rank), 6) AS lift FROM A JOIN V ON A.id = V.id JOIN G ON A.id = G.id AND A.step = G.step WHERE A.step = {d.ITERATIONS} ORDER BY A.rank DESC, domain LIMIT 20"""
)
def reference_lift(spark, sf):
    v = d.vertices(spark, sf)
    out = reference.lift_over_global(_ranks(spark, sf, _teleport(spark, sf)), _ranks(spark, sf), v, 20)
    return out.withColumns({"open_authority": F.round("open_authority", 8), "global_rank": F.round("global_rank", 8), "lift": F.round("lift", 6)})


@query(f"WITH {d.SCORED_SQL} SELECT S.domain, a AS our_pr, b AS opr_score FROM S WHERE b > 10")
def reference_overlap(spark, sf):
    s = d.scored(spark, sf)
    return reference.overlap(s.select("domain", F.col("a").alias("pagerank_score")), s.where("b > 10").select("domain", F.col("b").alias("opr_score")))


@query(r"SELECT regexp_extract(host, '([^.]+\.[^.]+)$', 1) AS registered, count(DISTINCT host)::BIGINT AS n FROM (SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages) WHERE host <> regexp_extract(host, '([^.]+\.[^.]+)$', 1) GROUP BY 1")
def reference_boundaries(spark, sf):
    return reference.boundary_mismatches(d.t(spark, sf, "pages").select(urls.host_of(F.col("url")).alias("domain")))


# ---- crawls, scope, profiles --------------------------------------------------------------------


@query(
    """WITH R AS (SELECT strftime(o_orderdate, '%Y-%m') AS crawl, max(o_orderdate) AS made FROM orders GROUP BY 1), K AS (SELECT *, row_number() OVER (ORDER BY made DESC, crawl DESC) AS rn, year(made) || CASE WHEN month(made) <= 6 THEN 'H1' ELSE 'H2' END AS half FROM R)
SELECT crawl, true AS is_recent, false AS is_anchor FROM K WHERE rn <= 6
UNION ALL SELECT crawl, false, true FROM (SELECT *, row_number() OVER (PARTITION BY half ORDER BY made DESC, crawl DESC) AS r2 FROM K WHERE rn > 6) WHERE r2 = 1"""
)
def crawl_select_window(spark, sf):
    o = d.t(spark, sf, "orders")
    return crawls.select_window(o.select(F.date_format("o_orderdate", "yyyy-MM").alias("crawl"), F.col("o_orderdate").alias("crawl_date")), 6)


@query(f"WITH {d.CRAWL_SQL} SELECT DISTINCT length(domain)::INTEGER AS from_id, target AS to_id FROM C WHERE crawl >= '2024-01-03'")
def crawl_merged_edges(spark, sf):
    rows = d.crawl_rows(spark, sf)
    window = rows.where("crawl >= '2024-01-03'").select("crawl").distinct()
    return crawls.merged_edges(rows.select(F.length("domain").alias("from_id"), F.col("target").alias("to_id"), "crawl"), window)


@query(
    f"""WITH {d.CRAWL_SQL}, Z AS (SELECT max(crawl) AS z FROM C), Y AS (SELECT domain, target, min(crawl) AS first_seen_crawl, max(crawl) AS last_seen_crawl, count(DISTINCT crawl)::BIGINT AS crawls_active FROM C GROUP BY 1, 2)
SELECT Y.*, last_seen_crawl = z AS is_active, last_seen_crawl <> z AND domain IN (SELECT domain FROM C, Z WHERE crawl = z) AS is_lost, last_seen_crawl = z AND target = 'error' AS is_broken FROM Y, Z"""
)
def crawl_link_status(spark, sf):
    rows = d.crawl_rows(spark, sf)
    latest = rows.agg(F.max("crawl")).first()[0]
    return crawls.link_status(rows, ["domain", "target"], "domain", latest, rows.where("target = 'error'").select("target"), "target")


@query(
    f"""WITH RECURSIVE {d.WINDOW_GRAPH_SQL}, {d.rank_sql(GLOBAL_W, "G")}
SELECT V.domain, 'crawl-2' AS crawl, round(G.rank, 10) AS pagerank_score, coalesce(I.in_degree, 0)::BIGINT AS in_degree, coalesce(O.out_degree, 0)::BIGINT AS out_degree
FROM G JOIN V ON G.id = V.id LEFT JOIN I ON V.id = I.id LEFT JOIN O ON V.id = O.id WHERE G.step = {d.ITERATIONS}"""
)
def crawl_window_pagerank(spark, sf):
    e = d.crawl_edges(spark, sf)
    window = e.select("crawl").distinct().orderBy(F.desc("crawl")).limit(2)
    out = jobs.windowed_pagerank(d.vertices(spark, sf), e, window, "crawl-2", Authority(max_iter=d.ITERATIONS), tol=0.0)
    return out.withColumn("pagerank_score", F.round("pagerank_score", 10))


@query(f"WITH {d.CRAWL_SQL} SELECT domain, count(DISTINCT crawl)::BIGINT AS crawls_active FROM C GROUP BY 1 HAVING count(DISTINCT crawl) >= 2")
def crawl_active_domains(spark, sf):
    return crawls.active_in(d.crawl_rows(spark, sf), "domain", 2)


@query(
    f"""WITH {d.CRAWL_SQL}, X AS (SELECT domain, crawl, max(value) > 50 AS high FROM C GROUP BY 1, 2), Y AS (SELECT *, row_number() OVER w AS rn, lag(high) OVER w AS p FROM X WINDOW w AS (PARTITION BY domain ORDER BY crawl)),
Z AS (SELECT * FROM Y WHERE rn = 1 OR high IS DISTINCT FROM p) SELECT domain, high, crawl AS valid_from, lead(crawl) OVER (PARTITION BY domain ORDER BY crawl) AS valid_to, lead(crawl) OVER (PARTITION BY domain ORDER BY crawl) IS NULL AS is_current FROM Z"""
)
def crawl_history_type2(spark, sf):
    x = d.crawl_rows(spark, sf).groupBy("domain", "crawl").agg((F.max("value") > 50).alias("high"))
    return crawls.history_type2(x, "domain", "high", "crawl")


@query("SELECT doc_id FROM documents WHERE (lang IN ('de', 'fr') OR ('d' || (doc_id % 5) || '.' || (CASE doc_id % 2 WHEN 0 THEN 'com' ELSE 'gov' END)) LIKE '%.gov') AND n_chars >= 500")
def scope_filter(spark, sf):
    p = d.t(spark, sf, "documents").withColumns({"domain": F.concat(F.lit("d"), F.col("doc_id") % 5, F.when(F.col("doc_id") % 2 == 0, ".com").otherwise(".gov")), "referring_domains": F.col("n_chars")})
    rule = {"all_of": [{"any_of": [{"language": ["de", "fr"]}, {"tld_class": "gov"}]}, {"min_referring_domains": 500}]}
    return p.where(scope.compile_scope(rule)).select("doc_id")


@query(
    f"""WITH {d.LINKS_SQL} SELECT domain_to AS domain, count(DISTINCT domain_from)::BIGINT AS referring_domains, count(*)::BIGINT AS inbound_links_total, count(*) FILTER (WHERE NOT nf)::BIGINT AS dofollow_links,
count(*) FILTER (WHERE NOT nf)::DOUBLE / count(*) AS dofollow_ratio, count(DISTINCT domain_from) FILTER (WHERE NOT nf)::BIGINT AS dofollow_referring_domains, count(*) FILTER (WHERE ug)::BIGINT AS ugc_links,
count(*) FILTER (WHERE sp)::BIGINT AS sponsored_links, count(DISTINCT regexp_extract(domain_from, '[^.]+$'))::BIGINT AS tld_diversity_score, count(DISTINCT page_id % 50)::BIGINT AS referring_ips,
count(DISTINCT page_id % 10)::BIGINT AS referring_subnets, count(*) FILTER (WHERE domain_from LIKE '%.com')::DOUBLE / count(*) AS inbound_top10k_ratio FROM R GROUP BY 1"""
)
def profile_inbound(spark, sf):
    k = F.col("page_id")
    ip = F.concat(F.lit("10.0."), k % 10, F.lit("."), F.floor(k % 50 / 10).cast("int"))
    rows = snapshot(links.resolve_domains(d.links(spark, sf)).withColumn("ip", ip), "links")
    top = rows.where(F.col("domain_from").endswith(".com")).select(F.col("domain_from").alias("domain"))
    out = profiles.inbound_profile(rows, top_domains=top)
    return out.select("domain", "referring_domains", "inbound_links_total", "dofollow_links", "dofollow_ratio", "dofollow_referring_domains", "ugc_links", "sponsored_links", "tld_diversity_score", "referring_ips", "referring_subnets", "inbound_top10k_ratio")


@query(
    f"""WITH {d.LINKS_SQL}, Y AS (SELECT domain_from, regexp_extract(domain_to, '[^.]+$') AS tld, count(*) AS n FROM R GROUP BY 1, 2), Z AS (SELECT domain_from, string_agg(tld || ':' || n, ',' ORDER BY n DESC, tld) AS tlds FROM Y GROUP BY 1)
SELECT R.domain_from AS domain, count(*)::BIGINT AS outbound_links_total, count(DISTINCT domain_to)::BIGINT AS linked_domains, count(*) FILTER (WHERE NOT nf)::DOUBLE / count(*) AS outbound_dofollow_ratio, any_value(tlds) AS tlds FROM R JOIN Z ON R.domain_from = Z.domain_from GROUP BY 1"""
)
def profile_outbound(spark, sf):
    out = profiles.outbound_profile(links.resolve_domains(d.links(spark, sf)))
    text = F.array_join(F.transform("outbound_tld_distribution", lambda x: F.concat_ws(":", x.tld, F.round(x.share * F.col("outbound_links_total")).cast("long").cast("string"))), ",")
    return out.select("domain", "outbound_links_total", "linked_domains", "outbound_dofollow_ratio", text.alias("tlds"))


def _site_languages(spark, sf):
    rows = links.resolve_domains(d.links(spark, sf))
    return rows.select(F.col("domain_from").alias("domain"), F.regexp_extract("url_from", r"^[a-z]+://[^/]+/([a-z]+)/", 1).alias("lang"))


SITE_LANG = "SL AS (SELECT domain_from AS domain, first(lang ORDER BY n DESC, lang) AS dominant FROM (SELECT domain_from, regexp_extract(url_from, '^[a-z]+://[^/]+/([a-z]+)/', 1) AS lang, count(*) AS n FROM R GROUP BY 1, 2) GROUP BY 1)"


@query(
    f"""WITH {d.LINKS_SQL}, {SITE_LANG} SELECT domain_to, url_from, url_to, crawl, bool_and(NOT nf) AS is_dofollow, bool_and(a.dominant <> b.dominant) AS is_cross_language, min(min(crawl)) OVER (PARTITION BY url_from, url_to) AS first_seen
FROM R LEFT JOIN SL a ON domain_from = a.domain LEFT JOIN SL b ON domain_to = b.domain WHERE domain_to LIKE '%.com' GROUP BY domain_to, url_from, url_to, crawl"""
)
def mart_backlinks(spark, sf):
    rows = snapshot(links.resolve_domains(d.links(spark, sf)), "links")
    inside = rows.where(F.col("domain_to").endswith(".com")).select(F.col("domain_to").alias("domain")).distinct()
    out = profiles.backlinks_mart(rows, inside, languages.domain_languages(_site_languages(spark, sf)))
    return out.select("domain_to", "url_from", "url_to", "crawl", "is_dofollow", "is_cross_language", "first_seen")


@query(
    f"""WITH {d.LINKS_SQL}, Y AS (SELECT url_from, url_to, min(crawl) AS first_seen_crawl, max(crawl) AS last_seen_crawl, count(DISTINCT crawl)::BIGINT AS crawls_active FROM R GROUP BY 1, 2), A AS (SELECT DISTINCT url_from FROM R WHERE crawl = '2024-04'),
K AS (SELECT DISTINCT domain_from AS domain FROM R)
SELECT domain_from, domain_to AS target_domain, R.url_from, R.url_to, R.crawl, bool_and(NOT nf) AS is_dofollow, any_value(first_seen_crawl) AS first_seen_crawl, any_value(last_seen_crawl) AS last_seen_crawl, any_value(crawls_active) AS crawls_active,
any_value(last_seen_crawl) = '2024-04' AS is_active, any_value(last_seen_crawl) <> '2024-04' AND R.url_from IN (SELECT url_from FROM A) AS is_lost, any_value(last_seen_crawl) = '2024-04' AND domain_to LIKE '%.org' AS is_broken, domain_to IN (SELECT domain FROM K) AS is_target_indexed
FROM R JOIN Y ON R.url_from = Y.url_from AND R.url_to = Y.url_to GROUP BY domain_from, domain_to, R.url_from, R.url_to, R.crawl"""
)
def mart_outbound_links(spark, sf):
    rows = snapshot(links.resolve_domains(d.links(spark, sf)), "links")
    inside = rows.select(F.col("domain_from").alias("domain")).distinct()
    known = inside.select("domain", F.lit(0.1).alias("pagerank_score"), F.lit(0.2).alias("open_authority"), F.lit(3).cast("long").alias("in_degree"))
    out = profiles.outbound_mart(rows, inside, languages.domain_languages(_site_languages(spark, sf)), known, "2024-04", rows.where(F.col("domain_to").endswith(".org")).select("url_to"))
    return out.select("domain_from", "target_domain", "url_from", "url_to", "crawl", "is_dofollow", "first_seen_crawl", "last_seen_crawl", "crawls_active", "is_active", "is_lost", "is_broken", "is_target_indexed")
