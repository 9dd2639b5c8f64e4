"""Queries that put sources, sinks, jobs and guards to the proof: written, read back and held against SQL."""

from __future__ import annotations

import gzip
import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom import cli, config
from webloom.config import Authority, Seed
from webloom.errors import WebloomError
from webloom.functions import psl, urls
from webloom.operators import graph, publish, rankstats, sampling, scope, seeds
from webloom.operators.pagerank import power_iteration
from webloom.plans import derived as d
from webloom.plans import jobs
from webloom.plans.registry import GLOBAL_W, MART_IN, RANKED, SEED_W, _mart_inputs, query
from webloom.session import scratch_path, snapshot
from webloom.sources import readers, sinks, wat


def _rows(spark, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _outcome(f, *args, **options) -> str:
    """What a call returns as text, or the kind of error that it raises."""
    try:
        return str(f(*args, **options))
    except (WebloomError, ValueError) as error:
        return type(error).__name__


def _values(rows: list[tuple[str, str]], *names: str) -> str:
    """SQL of a list of text rows."""
    listed = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {listed}) t({', '.join(names)})"


# ---- sources ------------------------------------------------------------------------------------


@query("SELECT form, 'c' || c_custkey || '.org' AS domain, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS consensus FROM customer, (VALUES ('csv'), ('csv.gz'), ('parquet')) f(form)")
def source_seed_files(spark, sf):
    """A seed list as CSV, as gzip and as Parquet; what isn't a number is null."""
    c = d.t(spark, sf, "customer")
    score = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")).otherwise("n/a")
    rows = c.select(F.concat(F.lit("c"), "c_custkey", F.lit(".org")).alias("registered_domain"), score.alias("consensus_score"))
    root, out = scratch_path(spark, "seeds"), None
    for form in ("csv", "csv.gz", "parquet"):
        path = f"{root}/seed.{form}"
        writer = rows.write.option("header", True).option("compression", "gzip" if form == "csv.gz" else "snappy" if form == "parquet" else "none")
        writer.format("parquet" if form == "parquet" else "csv").save(path)
        part = readers.read_seed(spark, path).select(F.lit(form).alias("form"), "domain", "consensus")
        out = part if out is None else out.union(part)
    return out


@query(f"WITH {d.GRAPH_SQL} SELECT id::BIGINT AS id, domain FROM V")
def source_vertices_tsv(spark, sf):
    """Vertices through gzipped TSV with reversed names, and back."""
    path = scratch_path(spark, "vertices-tsv")
    d.vertices(spark, sf).select("id", urls.unreverse(F.col("domain")).alias("rev_domain"), F.lit(1).alias("num_hosts")).write.option("sep", "\t").option("compression", "gzip").csv(path)
    return graph.vertices_of_tsv(readers.read_vertices_tsv(spark, path))


@query(f"WITH {d.GRAPH_SQL} SELECT form, from_id::BIGINT AS from_id, count(*)::BIGINT AS n, sum(to_id)::BIGINT AS total FROM E, (VALUES ('tsv'), ('parquet')) f(form) GROUP BY 1, 2")
def source_host_edges(spark, sf):
    """Edges of a host graph: gzipped TSV, or Parquet where the path says so."""
    root, out = scratch_path(spark, "host-edges"), None
    for form in ("tsv", "parquet"):
        writer = d.edges(spark, sf).write.option("compression", "gzip")
        writer.parquet(f"{root}/{form}") if form == "parquet" else writer.option("sep", "\t").csv(f"{root}/{form}")
        part = readers.read_host_edges(spark, f"{root}/{form}").groupBy("from_id").agg(F.count(F.lit(1)).alias("n"), F.sum("to_id").alias("total"))
        part = part.select(F.lit(form).alias("form"), "from_id", "n", "total")
        out = part if out is None else out.union(part)
    return out


@query(f"WITH {d.GRAPH_SQL} SELECT id::BIGINT AS id, domain, id % 2 = 0 AS is_apex FROM V")
def source_host_vertices(spark, sf):
    """Host vertices from TSV, dealt out, named and mapped to registered domains: the id -> domain map."""
    path = scratch_path(spark, "host-vertices")
    host = F.when(F.col("id") % 2 == 0, F.col("domain")).otherwise(F.concat(F.lit("www.shop."), "domain"))
    d.vertices(spark, sf).select("id", urls.unreverse(host)).write.option("sep", "\t").option("compression", "gzip").csv(path)
    hosts = readers.read_host_vertices(spark, path, 8).select("id", urls.unreverse(F.col("rev_host")).alias("host"))
    named = hosts.join(psl.registered_domains(hosts.select("host")), "host").withColumn("is_apex", psl.is_apex(F.col("host"), F.col("domain")))
    out = scratch_path(spark, "host-map")
    sinks.write_table(named.select("id", "domain", "is_apex"), out)
    return spark.read.parquet(out)


@query("SELECT form, 'd' || (page_id % 7) || '.com' AS registered_domain, 'eng,l' || (page_id % 5) AS content_languages, 200::INTEGER AS fetch_status, 'a/warc/' || page_id || '.warc.gz' AS warc_filename FROM pages, (VALUES ('text'), ('array')) f(form) WHERE page_id % 3 <> 0")
def source_crawl_index(spark, sf):
    """The columnar index with languages as text and as an array; pages of other status never come."""
    k = F.col("page_id")
    langs = F.concat(F.lit("l"), k % 5)
    forms = {"text": F.concat_ws(",", F.lit("eng"), langs), "array": F.array(F.lit("eng"), langs)}
    root, out = scratch_path(spark, "crawl-index"), None
    for form, value in forms.items():
        rows = d.t(spark, sf, "pages").select(
            F.concat(F.lit("d"), k % 7, F.lit(".com")).alias("url_host_registered_domain"), value.alias("content_languages"), F.when(k % 3 == 0, 404).otherwise(200).alias("fetch_status"), F.concat(F.lit("a/warc/"), k, F.lit(".warc.gz")).alias("warc_filename"), "html"
        )
        rows.write.parquet(f"{root}/{form}")
        part = readers.read_crawl_index(spark, f"{root}/{form}").select(F.lit(form).alias("form"), "registered_domain", "content_languages", "fetch_status", "warc_filename")
        out = part if out is None else out.union(part)
    return out


@query(f"WITH {d.SCORED_SQL} SELECT domain AS \"Domain\", b::INTEGER::VARCHAR AS \"Open Page Rank\" FROM S")
def source_reference_csv(spark, sf):
    path = scratch_path(spark, "reference-csv")
    rows = d.scored(spark, sf).select(F.col("domain").alias("Domain"), F.col("b").cast("int").alias("Open Page Rank"))
    rows.write.option("header", True).csv(path)
    return readers.read_reference_csv(spark, path)


PATHS = "SELECT page_id, CASE WHEN page_id % 10 = 0 THEN 'store://other/' || page_id || '.wat.gz' ELSE 'seg/' || page_id || '.wat.gz' END AS path FROM pages"


@query(
    f"""WITH P AS ({PATHS}) SELECT CASE WHEN path LIKE 'store:%' THEN path ELSE 'store://crawl/' || path END AS path, row_number() OVER (ORDER BY page_id) - 1 AS place,
(SELECT sha256(string_agg(path || chr(10), '' ORDER BY page_id)) FROM P) AS digest FROM P"""
)
def source_path_list(spark, sf):
    """A gzipped list with blanks: lines in order, resolved under a prefix, and the list's digest."""
    k = F.col("page_id")
    path = F.when(k % 10 == 0, F.concat(F.lit("store://other/"), k, F.lit(".wat.gz"))).otherwise(F.concat(F.lit("seg/"), k, F.lit(".wat.gz")))
    lines = F.concat(F.lit("  "), path, F.when(k % 4 == 0, F.lit("\n\n  ")).otherwise(F.lit(" ")))
    folder = scratch_path(spark, "paths")
    d.t(spark, sf, "pages").select(lines.alias("value"), "page_id").coalesce(1).sortWithinPartitions("page_id").select("value").write.option("compression", "gzip").text(folder)
    listed = readers.read_path_list(spark, folder)
    digest = sinks.manifest_digest([f" {p}\n" for p in listed] + [" "])
    return _rows(spark, [(sinks.resolve_path(p, "store://crawl/"), i, digest) for i, p in enumerate(listed)], "path string, place long, digest string")


@query(f"WITH {d.CRAWL_SQL} SELECT crawl, count(*)::BIGINT AS n, round(sum(value), 6) AS total FROM C GROUP BY 1")
def source_catalog(spark, sf):
    """A partitioned dataset as an external catalog table; registered twice, as a rerun does."""
    path, name = scratch_path(spark, "sightings"), f"proof_{uuid.uuid4().hex}"
    sinks.write_crawl_partitions(d.crawl_rows(spark, sf), path)
    for _ in range(2):
        readers.register_external(spark, name, {"sightings": path})
    rows = spark.table(f"{name}.sightings").groupBy(F.col("crawl").cast("string").alias("crawl")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))
    out = snapshot(rows, "catalog")
    spark.sql(f"DROP DATABASE `{name}` CASCADE")
    return out


def _payloads(spark, sf) -> DataFrame:
    """(page_id, payload): each link of the derived tables as a WAT record's JSON, with an image that is no link."""
    x = d.links(spark, sf)
    anchor = F.struct(F.lit("A@/href").alias("path"), F.col("url_to").alias("url"), F.col("anchor").alias("text"), F.col("rel").alias("rel"))
    image = F.struct(F.lit("IMG@/src").alias("path"), F.lit("i.png").alias("url"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("rel"))
    meta = F.struct(F.struct(F.struct(F.array(image, anchor).alias("Links")).alias("HTML-Metadata")).alias("HTTP-Response-Metadata"))
    head = F.struct(F.col("url_from").alias("WARC-Target-URI")).alias("WARC-Header-Metadata")
    return x.select("page_id", F.to_json(F.struct(F.struct(head, meta.alias("Payload-Metadata")).alias("Envelope"))).alias("payload"))


WAT_FILES = 3


def _wat_files(spark, sf) -> list[str]:
    """WAT files of the payloads in the shared folder; each also has a record without links and one that isn't JSON."""
    folder = scratch_path(spark, "wat")

    def record(kind: str, body: bytes) -> bytes:
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nContent-Length: {len(body)}\r\n\r\n".encode()
        return gzip.compress(head + body + b"\r\n\r\n")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.wat.gz"
        with store.open_output_stream(posixpath.join(root, name), compression=None) as out:
            out.write(record("warcinfo", b"software: none"))
            out.write(record("metadata", b'{"Envelope": {}}') + record("metadata", b"{not json"))
            for batch in batches:
                for payload in batch.column(0).to_pylist():
                    out.write(record("metadata", payload.encode()))
        yield pa.record_batch([pa.array([f"{folder}/{name}"])], names=["path"])

    dealt = _payloads(spark, sf).repartitionByRange(WAT_FILES, "page_id").select("payload")
    return sorted(r.path for r in dealt.mapInArrow(write, "path string").collect())


@query(f"WITH {d.LINKS_SQL} SELECT url_from, url_to, anchor, rel FROM L")
def source_wat_file(spark, sf):
    """Links of gzipped WARC files, record by record."""
    return wat.link_rows(snapshot(wat.read_wat(spark, _wat_files(spark, sf)), "raw-links"))


@query(f"SELECT {WAT_FILES}::BIGINT AS files_attempted, count(*)::BIGINT AS raw_link_rows, (count(*) + 2 * {WAT_FILES})::BIGINT AS records_seen, {WAT_FILES}::BIGINT AS malformed_records, {WAT_FILES}::BIGINT AS records_with_no_links, 0::BIGINT AS files_unreadable FROM pages")
def source_wat_counts(spark, sf):
    counts = wat.extraction_counts(snapshot(wat.read_wat(spark, _wat_files(spark, sf)), "raw-links"))
    return _rows(spark, [tuple(counts.values())], ", ".join(f"{k} long" for k in counts))


@query(f"WITH {d.LINKS_SQL} SELECT domain_from, domain_to, link_count, dofollow_count, ugc_count, sponsored_count, (SELECT count(*) FROM PAIRS)::BIGINT AS domain_pair_rows, (SELECT sum(link_count) FROM PAIRS)::BIGINT AS link_count_total, {WAT_FILES}::BIGINT AS n_wat_files FROM PAIRS")
def job_backlinks(spark, sf):
    """The whole job: listed WAT files to stored pairs of one crawl, with its metrics beside them."""
    listed, out = scratch_path(spark, "wat-list"), f"{scratch_path(spark, 'job')}/pairs"
    sinks.write_list(_rows(spark, [(p,) for p in _wat_files(spark, sf)], "path string"), listed)
    jobs.backlinks(spark, listed, "unused", out, "c1", "run-1")
    m = spark.read.json(sinks.metrics_path(out)).first()
    kept = readers.read_partitioned(spark, out, "c1").drop("crawl")
    return kept.withColumns({c: F.lit(m[c]).cast("long") for c in ("domain_pair_rows", "link_count_total", "n_wat_files")})


# ---- sinks --------------------------------------------------------------------------------------


@query(
    f"""WITH {d.SCORED_SQL} SELECT 'table' AS sink, count(*)::BIGINT AS n_rows, round(sum(a), 4) AS total FROM S UNION ALL SELECT 'json', 1, round(sum(a), 4) FROM S
UNION ALL SELECT 'list', count(*), round(sum(b), 4) FROM S UNION ALL SELECT 'csv', count(*), round(sum(a), 4) FROM S"""
)
def sink_files(spark, sf):
    """A table overwritten by a rerun, one JSON record, one list and one CSV file, all read back."""
    rows, root = d.scored(spark, sf).select("domain", "a", "b"), scratch_path(spark, "sinks")
    for _ in range(2):
        sinks.write_table(rows, f"{root}/table")
    table = spark.read.parquet(f"{root}/table")
    sinks.write_json(spark, {"total": table.agg(F.sum("a")).first()[0], "kind": object}, f"{root}/json")
    sinks.write_list(rows.select(F.col("b").cast("int")), f"{root}/list")
    sinks.write_csv_file(rows.select("domain", "a"), f"{root}/csv")
    found = {
        "table": table.select("a"),
        "json": spark.read.json(f"{root}/json").select("total"),
        "list": spark.read.text(f"{root}/list").select(F.col("value").cast("double")),
        "csv": spark.read.schema("domain string, a double").csv(f"{root}/csv").select("a"),
    }
    out = None
    for name, df in found.items():
        part = df.agg(F.lit(name).alias("sink"), F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(df.columns[0]), 4).alias("total"))
        out = part if out is None else out.union(part)
    return out


@query("SELECT 0::BIGINT AS n_foreign, count(*) > 0 AS is_near_share FROM pages")
def sink_link_sample(spark, sf):
    """A stored Bernoulli sample of links: rows of the table only, about as many as asked for."""
    links, out = d.links(spark, sf), scratch_path(spark, "link-sample")
    sinks.write_link_sample(links, out, 0.5)
    sample, n = spark.read.parquet(out), links.count()
    near = abs(sample.count() - 0.5 * n) <= 6 * (n * 0.25) ** 0.5
    return sample.join(links, "page_id", "left_anti").agg(F.count(F.lit(1)).alias("n_foreign"), F.lit(near).alias("is_near_share"))


GUARDED = [
    ("metrics beside", "/data/out/_metrics/pairs"), ("metrics, slash at the end", "/data/out/_metrics/pairs"), ("metrics of a root", "ConfigError"), ("output", "/data/out"),
    ("output in fixtures", "ConfigError"), ("absolute path", "store://a/b"), ("relative path", "store://c/a/b"), ("blank path", "ConfigError"), ("no prefix", "ConfigError"),
]


@query(_values(GUARDED, "what", "result"))
def sink_guards(spark, sf):
    calls = [
        (sinks.metrics_path, "/data/out/pairs"), (sinks.metrics_path, "/data/out/pairs/"), (sinks.metrics_path, "store://data"), (config.guard_output, "/data/out"),
        (config.guard_output, "/x/tests/fixtures/y"), (sinks.resolve_path, "store://a/b", "store://c/"), (sinks.resolve_path, "/a/b", "store://c/"), (sinks.resolve_path, " ", "store://c"), (sinks.resolve_path, "a", " "),
    ]
    return _rows(spark, [(what, _outcome(*call)) for (what, _), call in zip(GUARDED, calls, strict=True)], "what string, result string")


@query(f"WITH {MART_IN} SELECT PR.crawl AS window_id, count(*)::BIGINT AS n, round(sum(pagerank_score), 8) AS mass, count(open_authority)::BIGINT AS n_authority FROM PR LEFT JOIN OA ON PR.domain = OA.domain AND PR.crawl = OA.crawl GROUP BY 1")
def job_mart(spark, sf):
    """The mart job: tested views, written by window; a rerun replaces its windows."""
    root = scratch_path(spark, "mart")
    for name, df in zip(("pr", "oa"), _mart_inputs(spark, sf), strict=True):
        sinks.write_crawl_partitions(df, f"{root}/{name}")
    for _ in range(2):
        jobs.authority_mart(spark, f"{root}/pr", f"{root}/oa", f"{root}/mart")
    mart = spark.read.parquet(f"{root}/mart")
    return mart.groupBy(F.col("window_id").cast("string").alias("window_id")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("pagerank_score"), 8).alias("mass"), F.count("open_authority").alias("n_authority"))


PUBLISHED = f"""WITH {MART_IN}, W AS (SELECT min(crawl) AS w FROM OA), X AS (SELECT *, row_number() OVER (ORDER BY open_authority DESC, domain) AS rank FROM OA, W WHERE crawl = w)"""


def _published(spark, sf):
    root = scratch_path(spark, "published")
    mart = _mart_inputs(spark, sf)[1].withColumnRenamed("crawl", "window_id")
    sinks.write_table(mart, f"{root}/mart")
    return root, publish.extract_public_index(spark, f"{root}/mart", f"{root}/out", 10, mart.agg(F.min("window_id")).first()[0])


@query(f"{PUBLISHED} SELECT (SELECT w FROM W) AS window_id, (SELECT count(*) FROM X)::BIGINT AS row_count, (SELECT count(*) FROM OA)::BIGINT AS source_row_count, 10::BIGINT AS top_n, (SELECT count(DISTINCT crawl) FROM OA)::BIGINT AS n_windows, 'index,metadata,top' AS artifacts")
def publish_record(spark, sf):
    """The metadata as it was stored, and which parts were published."""
    root, _ = _published(spark, sf)
    parts = sorted({a["path"].split("/")[0] for a in publish.artifact_record(spark, f"{root}/out") if a["bytes"] > 0})
    record = spark.read.json(f"{root}/out/metadata")
    return record.select("window_id", "row_count", "source_row_count", "top_n", F.size("available_windows").cast("long").alias("n_windows"), F.lit(",".join(parts)).alias("artifacts"))


@query(f"{PUBLISHED} SELECT rank::INTEGER AS rank, domain, open_authority, open_volume, w AS window_id FROM X WHERE rank <= 10")
def publish_top_file(spark, sf):
    root, _ = _published(spark, sf)
    return spark.read.option("header", True).schema("rank int, domain string, open_authority double, open_volume double, window_id string").csv(f"{root}/out/top")


@query(f"""{PUBLISHED} SELECT unnest(['# Domain authority index', '', 'Window: ' || (SELECT w FROM W), 'Rows: ' || format('{{:,}}', (SELECT count(*) FROM X)), 'Top list: 10']) AS line, unnest([0, 1, 2, 3, 4])::BIGINT AS place""")
def publish_card(spark, sf):
    """The first lines of the text that goes with an index."""
    lines = publish.dataset_card(_published(spark, sf)[1]).splitlines()[:5]
    return _rows(spark, list(zip(lines, range(5), strict=True)), "line string, place long")


WINDOW_CASES = [("wanted", "b"), ("wanted and missing", "ConfigError"), ("only one", "a"), ("one of two", "ConfigError"), ("no rows wanted", "ConfigError"), ("upload without an id", "ConfigError"), ("upload", "[['dataset-upload', '--id', 'x', 'o/index', 'o/top', 'o/metadata']]"), ("nothing to upload", "[]")]


@query(_values(WINDOW_CASES, "what", "result"))
def publish_guards(spark, sf):
    calls = [
        (publish.resolve_window, ["a", "b"], "b"), (publish.resolve_window, ["a"], "c"), (publish.resolve_window, ["a"], None), (publish.resolve_window, ["a", "b"], None),
        (publish.top_list, spark.range(1), 0), (publish.upload_commands, "o", " "), (publish.upload_commands, "o", "x"), (publish.upload_commands, "o"),
    ]
    return _rows(spark, [(what, _outcome(*call)) for (what, _), call in zip(WINDOW_CASES, calls, strict=True)], "what string, result string")


# ---- samples, scope, guards, jobs ---------------------------------------------------------------


@query("SELECT n::BIGINT AS n, n::BIGINT AS drawn, true AS is_sorted, true AS is_inside_next, true AS same_again FROM (VALUES (5), (20), (40)) t(n)")
def sample_paths(spark, sf):
    """One draw cut at several sizes, and a plain draw of paths: sorted, nested, the same again."""
    paths = [r.p for r in d.t(spark, sf, "pages").select(F.concat(F.lit("p"), "page_id").alias("p")).orderBy("page_id").collect()]
    ladder = sampling.nested_ladder(paths, [5, 20, 40])
    following = {5: ladder[20], 20: ladder[40], 40: paths}
    again = sampling.nested_ladder(paths, [5, 20, 40])
    same = all(sampling.path_sample(paths, n) == sampling.path_sample(paths, n) and len(sampling.path_sample(paths, n)) == n for n in ladder) and sampling.path_sample(paths, len(paths) + 1) == sorted(paths)
    rows = [(n, len(x), x == sorted(x), set(x) <= set(following[n]), again[n] == x and same) for n, x in ladder.items()]
    return _rows(spark, rows, "n long, drawn long, is_sorted boolean, is_inside_next boolean, same_again boolean")


SCOPED = "D AS (SELECT *, 'd' || (doc_id % 5) || CASE doc_id % 2 WHEN 0 THEN '.com' ELSE '.gov' END AS domain FROM documents)"


@query(
    f"""WITH {SCOPED} SELECT 'classify' AS stage, count(*) FILTER (WHERE lang IN ('de', 'fr') OR domain LIKE '%.gov')::BIGINT AS n FROM D
UNION ALL SELECT 'crawls', count(*) FILTER (WHERE doc_id % 4 >= 2)::BIGINT FROM D UNION ALL SELECT 'metrics', count(*) FILTER (WHERE n_chars >= 500)::BIGINT FROM D
UNION ALL SELECT 'all', count(*) FILTER (WHERE (lang IN ('de', 'fr') OR domain LIKE '%.gov') AND doc_id % 4 >= 2 AND n_chars >= 500)::BIGINT FROM D"""
)
def scope_stages(spark, sf):
    """One scope, its predicates by stage."""
    k = F.col("doc_id")
    p = d.t(spark, sf, "documents").withColumns({"domain": F.concat(F.lit("d"), k % 5, F.when(k % 2 == 0, ".com").otherwise(".gov")), "referring_domains": F.col("n_chars"), "crawls_active": k % 4})
    rule = {"all_of": [{"any_of": [{"language": ["de", "fr"]}, {"tld_class": "gov"}]}, {"min_crawls_active": 2}, {"min_referring_domains": 500}]}
    stages = {s: scope.compile_scope(rule, None if s == "all" else s) for s in ("classify", "crawls", "metrics", "all")}
    counts = p.agg(*[F.count_if(c).alias(s) for s, c in stages.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(s).alias("stage"), F.col(s).alias("n")) for s in stages])).alias("x")).select("x.*")


@query(
    """WITH H AS (SELECT page_id, 'd' || (page_id % 5) || '.com' AS domain, CASE page_id % 3 WHEN 0 THEN 'www.' WHEN 1 THEN 'shop.' ELSE '' END || 'd' || (page_id % 5) || '.com' AS host FROM pages)
SELECT 'aggregate' AS handling, domain AS key, count(*)::BIGINT AS n FROM H GROUP BY 2 UNION ALL SELECT 'include', host, count(*)::BIGINT FROM H GROUP BY 2
UNION ALL SELECT 'root_only', CASE WHEN page_id % 3 <> 1 THEN domain END, count(*)::BIGINT FROM H GROUP BY 2"""
)
def scope_subdomains(spark, sf):
    k = F.col("page_id")
    domain = F.concat(F.lit("d"), k % 5, F.lit(".com"))
    rows = d.t(spark, sf, "pages").select(domain.alias("domain"), F.concat(F.when(k % 3 == 0, "www.").when(k % 3 == 1, "shop.").otherwise(""), domain).alias("host"))
    out = None
    for handling in ("aggregate", "include", "root_only"):
        part = rows.groupBy(scope.subdomain_key(handling).alias("key")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(handling).alias("handling"), "key", "n")
        out = part if out is None else out.union(part)
    return out


@query(f"WITH RECURSIVE {d.GRAPH_SQL}, {d.rank_sql(GLOBAL_W, 'G')} SELECT id::BIGINT AS id, round(rank, 10) AS rank FROM G WHERE step = {d.ITERATIONS}")
def pagerank_resumed(spark, sf):
    """Four steps, a stored snapshot, then the rest from it: what an uninterrupted run gives."""
    nodes, edges = d.vertices(spark, sf).select("id"), d.edges(spark, sf)
    first = snapshot(power_iteration(edges, nodes, max_iter=4, tol=0.0, checkpoint_every=0), "ranks")
    return power_iteration(edges, nodes, max_iter=d.ITERATIONS - 4, tol=0.0, start=first).select("id", F.round("rank", 10).alias("rank"))


@query(
    f"""WITH RECURSIVE {d.GRAPH_SQL}, {d.rank_sql(GLOBAL_W, "G")}
SELECT V.domain, 'c1' AS crawl, round(G.rank, 10) AS pagerank_score, coalesce(I.in_degree, 0)::BIGINT AS in_degree, coalesce(O.out_degree, 0)::BIGINT AS out_degree
FROM G JOIN V ON G.id = V.id LEFT JOIN I ON V.id = I.id LEFT JOIN O ON V.id = O.id WHERE G.step = {d.ITERATIONS}"""
)
def job_pagerank(spark, sf):
    """The job from stored vertices and edges, with a declared number of vertices, to stored ranks of a crawl."""
    root, v = scratch_path(spark, "job-pagerank"), d.vertices(spark, sf)
    sinks.write_table(v, f"{root}/v")
    sinks.write_table(d.edges(spark, sf), f"{root}/e")
    jobs.global_pagerank(spark, f"{root}/v", f"{root}/e", f"{root}/out", "c1", Authority(max_iter=d.ITERATIONS, tol=1e-300), v.count())
    return readers.read_partitioned(spark, f"{root}/out", "c1").withColumn("pagerank_score", F.round("pagerank_score", 10))


@query(
    f"""WITH RECURSIVE {d.GRAPH_SQL}, {d.SEED_SQL}, {d.rank_sql(SEED_W, "G")}
SELECT V.domain, 'c1' AS crawl, round(G.rank, 10) AS open_authority, round(ln(1.0 + coalesce(I.in_degree, 0)), 10) AS open_volume FROM G JOIN V ON G.id = V.id LEFT JOIN I ON V.id = I.id WHERE G.step = {d.ITERATIONS}"""
)
def job_authority(spark, sf):
    """The job from stored vertices, edges and seed list to stored authorities of a crawl."""
    root = scratch_path(spark, "job-authority")
    sinks.write_table(d.vertices(spark, sf), f"{root}/v")
    sinks.write_table(d.edges(spark, sf), f"{root}/e")
    sinks.write_table(d.seed_rows(spark, sf).select(F.col("domain").alias("registered_domain"), F.col("consensus").alias("consensus_score")), f"{root}/seed")
    jobs.personalised_authority(spark, f"{root}/v", f"{root}/e", f"{root}/seed", f"{root}/out", "c1", Authority(max_iter=d.ITERATIONS, tol=1e-300), Seed(size=100))
    out = readers.read_partitioned(spark, f"{root}/out", "c1")
    return out.withColumns({"open_authority": F.round("open_authority", 10), "open_volume": F.round("open_volume", 10)})


@query("SELECT count(*)::BIGINT AS n_lines FROM pages WHERE page_id % 5 <> 0")
def job_count_lines(spark, sf):
    path = scratch_path(spark, "lines")
    d.t(spark, sf, "pages").select(F.when(F.col("page_id") % 5 == 0, "  ").otherwise(F.col("url")).alias("value")).write.option("compression", "gzip").text(path)
    return _rows(spark, [(jobs.count_index_lines(spark, path),)], "n_lines long")


FAULTS = [
    ("null weight", "teleport has 1 null/NaN rows"), ("NaN before negative", "teleport has 1 null/NaN rows"), ("negative weight", "teleport has negative weights"), ("duplicate id", "teleport has duplicate ids"),
    ("sum", "teleport is not normalized: it sums to 0.5"), ("range", "teleport has ids outside [0, 3)"), ("damping", "damping 1.0 is not in (0, 1)"), ("no nodes", "the graph has no nodes"), ("no steps", "max_iter must be at least 1"),
    ("start", "start lacks 2 nodes of the graph"), ("empty seed", "seed: it has no ranked rows"), ("blank seed", "seed: 1 domains are null or blank"), ("negative seed", "seed: 1 scores are NaN or negative"),
    ("sparse ids", "vertices: ids aren't dense: 0 to 2 for 2 rows"), ("declared", "vertices: 3 declared, 2 found"), ("edge outside", "edges: ends from 0 to 9 aren't all in [0, 2)"),
]


@query(_values(FAULTS, "what", "message"))
def graph_faults(spark, sf):
    """Every guard of the graph jobs, by its message."""

    def t(*rows):
        return _rows(spark, list(rows), "id long, w double")

    nodes, edges = spark.range(3), _rows(spark, [(0, 1), (1, 2)], "from_id long, to_id long")

    def run(**options):
        return power_iteration(edges, options.pop("nodes", nodes), **{"max_iter": 1, "tol": 0.0} | options)

    def vertices(*ids):
        return _rows(spark, [(i, f"d{i}.com") for i in ids], "id long, domain string")

    def seed(*rows):
        return lambda: seeds.validate_seed(_rows(spark, list(rows), "domain string, consensus double"))

    calls = [
        lambda: run(teleport=t((0, None), (1, 1.0))), lambda: run(teleport=t((0, float("nan")), (1, -1.0))), lambda: run(teleport=t((0, -1.0), (1, 2.0))), lambda: run(teleport=t((0, 0.5), (0, 0.5))),
        lambda: run(teleport=t((0, 0.5))), lambda: run(teleport=t((0, 0.5), (3, 0.5))), lambda: run(damping=1.0), lambda: run(nodes=spark.range(0)), lambda: run(max_iter=0),
        lambda: run(start=_rows(spark, [(0, 1.0)], "id long, rank double")), seed(), seed(("a", 1.0), (" ", 1.0)), seed(("a", -1.0)),
        lambda: graph.validate_vertices(vertices(0, 2)), lambda: graph.validate_vertices(vertices(0, 1), 3), lambda: graph.validate_edges(_rows(spark, [(0, 9)], "from_id long, to_id long"), 2),
    ]
    out = []
    for (what, _), call in zip(FAULTS, calls, strict=True):
        try:
            call()
            out.append((what, "none"))
        except (WebloomError, ValueError) as error:
            out.append((what, str(error)))
    return _rows(spark, out, "what string, message string")


SETTINGS = [
    ("default damping", "0.85"), ("override", "0.5"), ("bad override", "ConfigError"), ("no steps", "ConfigError"), ("unknown key", "ConfigError"), ("missing file", "ConfigError"), ("unknown environment", "ConfigError"),
    ("storage", "data/marts"), ("languages", "bul,ron"), ("run name", "run-1.a"), ("bad run name", "ArgumentTypeError"), ("error kinds", "ConfigError DataSourceError JobError ScopeFilterError"),
]


@query(_values(SETTINGS, "what", "value"))
def job_settings(spark, sf):
    """Configuration files, overrides checked as a whole, run names and the kinds of errors."""
    import argparse

    found = config.find_config("pipeline.yml")
    pipeline = config.load_pipeline(found)

    def named(value):
        try:
            return cli.run_name(value)
        except argparse.ArgumentTypeError as error:
            return type(error).__name__

    values = [
        _outcome(lambda: pipeline.authority.damping), _outcome(lambda: config.with_overrides(pipeline.authority, damping=0.5, tol=None).damping), _outcome(config.with_overrides, pipeline.authority, damping=0.5, tol=-1.0),
        _outcome(config.with_overrides, pipeline.authority, max_iter=0), _outcome(config._validated, config.Authority, {"dampnig": 0.5}, "x"), _outcome(config.find_config, "none.yml"), _outcome(config.load_storage, config.find_config("storage.yml"), "moon"),
        _outcome(lambda: config.load_storage(config.find_config("storage.yml"), "local").marts), ",".join(pipeline.languages.targets), named("run-1.a"), named("../x"), " ".join(sorted(c.__name__ for c in WebloomError.__subclasses__())),
    ]
    return _rows(spark, [(what, value) for (what, _), value in zip(SETTINGS, values, strict=True)], "what string, value string")


@query(
    f"""WITH {RANKED}, P AS (SELECT sign(x.a - y.a) * sign(x.b - y.b) AS s, x.a <> y.a AS na, x.b <> y.b AS nb FROM S x JOIN S y ON x.domain < y.domain),
U AS (SELECT count(*) FILTER (WHERE b > 0) AS p FROM K)
SELECT (SELECT count(*) FROM S)::BIGINT AS n, (SELECT round(corr(ra::DOUBLE, rb::DOUBLE), 9) FROM K) AS spearman, (SELECT round(sum(s) / sqrt((count(*) FILTER (WHERE na))::DOUBLE * (count(*) FILTER (WHERE nb))::DOUBLE), 9) FROM P) AS kendall_tau_b,
(SELECT round(quantile_cont(abs(floor(da) - floor(db))::DOUBLE, 0.5), 6) FROM K) AS median_abs_delta, (SELECT p FROM U)::BIGINT AS n_positive, 'ValueError' AS of_one_row"""
)
def rank_profiles(spark, sf):
    """The profile of two rankings as one record, and the trust profile's Spearman over positives."""
    rows = d.scored(spark, sf).select("domain", "a", "b")
    p = rankstats.rank_profile(rows, "a", "b", depth=100)
    trust = rankstats.trust_profile(rows, "a", "b", 10)
    n = rows.where("b > 0").count()
    assert abs(trust["kendall_tau_b"] - p["kendall_tau_b"]) < 1e-9
    record = (p["n"], round(p["spearman"], 9), round(p["kendall_tau_b"], 9), round(p["median_abs_delta"], 6), n, _outcome(rankstats.rank_profile, rows.limit(1), "a", "b"))
    return _rows(spark, [record], "n long, spearman double, kendall_tau_b double, median_abs_delta double, n_positive long, of_one_row string")


@query(f"WITH {RANKED} SELECT 'blocks' AS form, round(sum(s) / sqrt((count(*) FILTER (WHERE na))::DOUBLE * (count(*) FILTER (WHERE nb))::DOUBLE), 9) AS tau FROM (SELECT sign(x.a - y.a) * sign(x.b - y.b) AS s, x.a <> y.a AS na, x.b <> y.b AS nb FROM S x JOIN S y ON x.domain < y.domain)")
def rank_kendall_blocks(spark, sf):
    """Kendall's tau-b as it is computed beyond one block, with blocks of 300 rows."""
    value = rankstats.kendall(d.scored(spark, sf), "a", "b", 300)
    return _rows(spark, [("blocks", round(value, 9))], "form string, tau double")
