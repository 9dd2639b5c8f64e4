"""Readers, sinks, config, marts, statistics, crawls, scope, publishing, streaming, the registry."""

from __future__ import annotations

import gzip
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from webloom import config
from webloom.errors import ConfigError, DataSourceError, JobError, ScopeFilterError
from webloom.operators import crawls, dq, languages, profiles, publish, rankstats, reference, sampling, scope
from webloom.plans import jobs, marts
from webloom.sources import readers, sinks


def test_strict_reader(spark, tmp_path):
    out = str(tmp_path / "e")
    spark.createDataFrame([(1, 2, "x")], "from_id long, to_id long, more string").write.parquet(out)
    df = readers.read_edges(spark, out)
    assert df.columns == ["from_id", "to_id"]
    assert "more" not in df._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    with pytest.raises(DataSourceError, match="missing"):
        readers.read_vertices(spark, out)
    spark.createDataFrame([(1, 2)], "from_id int, to_id long").write.parquet(str(tmp_path / "f"))
    with pytest.raises(DataSourceError, match="int"):
        readers.read_edges(spark, str(tmp_path / "f"))


def test_seed_reader(spark, tmp_path):
    (tmp_path / "s.csv").write_text("registered_domain,consensus_score\na.com,0.9\nb.org,n/a\n")
    with gzip.open(tmp_path / "s.csv.gz", "wt") as f:
        f.write("registered_domain,consensus_score\na.com,0.9\n")
    assert [tuple(r) for r in readers.read_seed(spark, str(tmp_path / "s.csv")).collect()] == [("a.com", 0.9), ("b.org", None)]
    assert readers.read_seed(spark, str(tmp_path / "s.csv.gz")).count() == 1
    with pytest.raises(DataSourceError):
        readers.read_seed(spark, str(tmp_path / "s.csv"), "nope")


def test_ingest_and_authority_jobs(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    (tmp_path / "v.tsv").write_text("0\tcom.a\t5\n1\torg.b\t3\n2\tnet.c\t1\n3\tio.d\t1\n")
    (tmp_path / "e.tsv").write_text("1\t0\n2\t0\n2\t1\n3\t0\n")
    (tmp_path / "seed.csv").write_text("registered_domain,consensus_score\na.com,0.9\nz.io,0.5\n")
    jobs.ingest(spark, p("v.tsv"), p("e.tsv"), p("v"), p("e"))
    jobs.global_pagerank(spark, p("v"), p("e"), p("pr"), "C1")
    jobs.personalised_authority(spark, p("v"), p("e"), p("seed.csv"), p("oa"), "C1")
    rows = {r.domain: r for r in readers.read_partitioned(spark, p("pr"), "C1").collect()}
    assert (rows["a.com"].in_degree, rows["a.com"].out_degree) == (3, 0)
    assert sum(r.pagerank_score for r in rows.values()) == pytest.approx(1)
    assert readers.read_partitioned(spark, p("oa")).columns[-1] == "crawl"
    jobs.authority_mart(spark, p("pr"), p("oa"), p("mart"))
    assert spark.read.parquet(p("mart")).count() == 4
    record = publish.extract_public_index(spark, p("mart"), p("pub"), 2)
    assert record["row_count"] == 4 and record["window_id"] == "C1" and "C1" in publish.dataset_card(record)
    assert spark.read.option("header", True).csv(p("pub") + "/top").count() == 2
    with pytest.raises(DataSourceError):  # the seed is looked at first
        (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
        jobs.personalised_authority(spark, p("missing"), p("missing"), p("bad.csv"), p("x"), "C1")
    with pytest.raises(ConfigError):
        jobs.global_pagerank(spark, p("v"), p("e"), "tests/fixtures/x", "C1")


def test_partition_overwrite(spark, tmp_path):
    out = str(tmp_path / "t")
    sinks.write_crawl_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "x long, crawl string"), out)
    sinks.write_crawl_partitions(spark.createDataFrame([(3, "b")], "x long, crawl string"), out)
    assert sorted(map(tuple, readers.read_partitioned(spark, out).collect())) == [(1, "a"), (3, "b")]
    assert readers.read_partitioned(spark, out, "a").count() == 1
    assert readers.only_crawl(spark.range(3), "a").count() == 3


def test_cdxj_and_lines(spark):
    lines = spark.createDataFrame([('com,ex)/ 2024 {"status": "200", "url": "http://a.b.ex.com/x", "languages": "bul,eng"}',), ("  ",), ("junk",), (None,)], "value string")
    assert readers.non_blank(lines).count() == 2
    rows = readers.parse_cdxj(readers.non_blank(lines)).collect()
    assert (rows[0].status, rows[0].domain, rows[0].primary_lang) == ("200", "ex.com", "bul") and rows[1].url is None
    assert readers.languages_as_text(spark.createDataFrame([(["a", "b"],)], "content_languages array<string>")).first()[0] == "a,b"


def test_catalog(spark, tmp_path):
    sinks.write_crawl_partitions(spark.createDataFrame([(1, "a")], "x long, crawl string"), str(tmp_path / "t"))
    readers.register_external(spark, "web", {"t": str(tmp_path / "t")})
    readers.register_external(spark, "web", {"t": str(tmp_path / "t")})
    assert spark.table("web.t").count() == 1


def test_config(tmp_path, monkeypatch):
    path = config.find_config("pipeline.yml")
    assert config.load_pipeline(path).scope_params.min_language_share == 0.25
    (tmp_path / "bad.yml").write_text("scope: {}\nmore: 1\n")
    (tmp_path / "list.yml").write_text("- 1\n")
    for name in ("bad.yml", "list.yml", "none.yml"):
        with pytest.raises(ConfigError):
            config.load_pipeline(tmp_path / name)
    with pytest.raises(ConfigError):
        config.with_overrides(config.Authority(), max_iter=0)
    assert config.with_overrides(config.Authority(), tol=0.5, damping=None).tol == 0.5
    storage = config.find_config("storage.yml")
    monkeypatch.setenv("RAW_PATH", "/elsewhere")
    assert config.load_storage(storage).raw == "/elsewhere"
    with pytest.raises(ConfigError):
        config.load_storage(storage, "moon")


def test_mart_and_its_tests(spark):
    pr = spark.createDataFrame([("a", "c1", 0.5, 1, 1), ("b", "c1", 0.5, 0, 1), ("a", "c2", 1.5, 1, 1), ("a", "c2", 0.1, 1, 1)], "domain string, crawl string, pagerank_score double, in_degree long, out_degree long")
    oa = spark.createDataFrame([("a", "c1", 0.25, 0.5), ("b", "c1", 0.1, 0.0)], "domain string, crawl string, open_authority double, open_volume double")
    got = {(r.domain, r.window_id): r.authority_ratio for r in marts.build_views(spark, pr, oa).where("window_id = 'c1'").collect()}
    assert got == {("a", "c1"): 0.5, ("b", "c1"): None}
    failed = {(r.model, r.test): r.failures for r in marts.test_views(spark).where("failures > 0").collect()}
    assert failed[("mart_domain_authority", "unique(domain,window_id)")] == 1 and failed[("mart_domain_authority", "between(pagerank_score,0,1)")] == 1
    with pytest.raises(AssertionError, match="unique"):
        dq.assert_none(pr, [dq.unique("domain", "crawl")])


def test_rank_statistics(spark):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 30, 200), rng.integers(0, 30, 200)
    s = sum(np.sign(a[i] - a[j]) * np.sign(b[i] - b[j]) for i in range(200) for j in range(i))
    na, nb = (sum(x[i] != x[j] for i in range(200) for j in range(i)) for x in (a, b))
    assert rankstats.tau_b(a, b) == pytest.approx(s / (na * nb) ** 0.5)
    assert rankstats.tau_b(a, a) == pytest.approx(1) and rankstats.tau_b(a, -a) == pytest.approx(-1)
    df = spark.createDataFrame([(f"d{i:03d}", float(x), float(y)) for i, (x, y) in enumerate(zip(a, b, strict=True))], "domain string, a double, b double")
    order = lambda x: np.array([(np.sum(x < v) + np.sum(x <= v) + 1) / 2 for v in x])
    assert rankstats.spearman(df, "a", "b").first().spearman == pytest.approx(np.corrcoef(order(a), order(b))[0, 1])
    assert rankstats.rbo(df, "a", "a", 0.9, 50).first().rbo == pytest.approx(1 - 0.9**50)
    pos = df.withColumn("p", F.col("b") > 15)
    u = np.mean([(x > y) + (x == y) / 2 for x in a[b > 15] for y in a[b <= 15]])
    assert rankstats.auc(pos, "a", "p").first().auc == pytest.approx(u)
    assert rankstats.top_jaccard(df, "a", "a", [10]).first().jaccard == 1
    assert set(rankstats.rank_profile(df, "a", "b", [10, 50], depth=100)) == {"n", "spearman", "kendall_tau_b", "rbo", "top_jaccard", "median_abs_delta", "p90_abs_delta"}
    with pytest.raises(ValueError):
        rankstats.rank_profile(df.limit(1), "a", "b")
    trust = rankstats.trust_profile(df.withColumn("t", F.greatest(F.col("b") - 15, F.lit(0.0))), "a", "t", 10, ["d001"])
    assert 0 <= trust["auc"] <= 1 and len(trust["decile_rates"]) > 1


def test_ladder(spark):
    points = spark.createDataFrame([(1.0, 12.0), (2.0, 22.0), (3.0, 32.0)], "size double, value double")
    fit, at, warnings = rankstats.predict_ladder(points, "size", "value", 10.0)
    assert (fit["slope"], at, warnings) == (pytest.approx(10), pytest.approx(102), [])
    assert rankstats.predict_ladder(points.limit(2), "size", "value", 1.0)[2] == ["fewer than 3 points"]
    with pytest.raises(ValueError):
        rankstats.predict_ladder(points.limit(1), "size", "value", 1.0)


def test_samples(spark):
    paths = [f"p{i}" for i in range(20)]
    assert sampling.path_sample(paths, 50) == sorted(paths) and len(sampling.path_sample(paths, 5)) == 5
    ladder = sampling.nested_ladder(paths, [2, 5, 9])
    assert set(ladder[2]) <= set(ladder[5]) <= set(ladder[9]) and ladder[5] == sorted(ladder[5])
    with pytest.raises(ValueError):
        sampling.nested_ladder(paths, [21])
    df = spark.createDataFrame([("top1", 0.1), ("top2", 0.1)] + [(f"d{i}", 0.001) for i in range(1000)], "domain string, oa double")
    got = [r.domain for r in sampling.stratified_list(df, 2, 100, 50).collect()]
    assert {"top1", "top2"} <= set(got) and len(got) == len(set(got)) == 50


def test_scope(spark):
    df = spark.createDataFrame([("a.com", "bul", 5, 3), ("b.gov", "ron", 1, 3), ("c.com", "eng", 9, 1), ("d.com", None, 9, 9)], "domain string, lang string, referring_domains long, crawls_active long")
    rule = {"all_of": [{"any_of": {"language": ["bul"], "tld_class": "gov"}}, {"min_referring_domains": 2}]}
    assert [r.domain for r in df.where(scope.compile_scope(rule)).collect()] == ["a.com"]
    assert {r.domain for r in df.where(scope.compile_scope(rule, "classify")).collect()} == {"a.com", "b.gov"}
    floors_in_any = {"any_of": [{"language": "eng"}, {"language": "bul"}, {"min_crawls_active": 2}]}
    assert [r.domain for r in df.where(scope.compile_scope(floors_in_any)).collect()] == ["a.com"]  # thresholds always hold by AND
    for bad in ({"nope": 1}, {"all_of": [3]}, {"all_of": 3}, {"min_pagerank": "x"}):
        with pytest.raises(ScopeFilterError):
            scope.compile_scope(bad)
    with pytest.raises(ScopeFilterError):
        scope.subdomain_key("x")


def test_crawl_histories(spark):
    rows = spark.createDataFrame([("s", "t1", "c1"), ("s", "t2", "c1"), ("s", "t2", "c2"), ("gone", "t1", "c1")], "f string, t string, crawl string")
    got = {(r.f, r.t): (r.is_active, r.is_lost, r.is_broken) for r in crawls.link_status(rows, ["f", "t"], "f", "c2", spark.createDataFrame([("t2",)], "t string"), "t").collect()}
    assert got == {("s", "t1"): (False, True, False), ("s", "t2"): (True, False, True), ("gone", "t1"): (False, False, False)}
    h = spark.createDataFrame([("a", 1, "c1"), ("a", 1, "c2"), ("a", 2, "c3"), ("a", None, "c4")], "d string, v int, c string")
    assert [tuple(r) for r in crawls.history_type2(h, "d", "v", "c").orderBy("valid_from").collect()] == [("a", 1, "c1", "c3", False), ("a", 2, "c3", "c4", False), ("a", None, "c4", None, True)]


def test_profiles(spark):
    rows = [("x.gov", "a.com", "nofollow", "1.2.3.4"), ("y.com", "a.com", None, "1.2.3.9"), ("y.com", "a.com", "ugc", "5.6.7.8")]
    links = spark.createDataFrame(rows, "domain_from string, domain_to string, rel string, ip string")
    langs = spark.createDataFrame([("a.com", "en"), ("y.com", "de"), ("x.gov", "en")], "domain string, dominant string")
    ranks = spark.createDataFrame([("y.com", 0.3), ("x.gov", 0.4)], "domain string, pagerank_score double")
    r = profiles.inbound_profile(links, langs, spark.createDataFrame([("y.com",)], "domain string"), ranks).first()
    assert (r.referring_domains, r.referring_ips, r.referring_subnets, r.inbound_links_total, r.dofollow_links, r.gov_links) == (2, 3, 2, 3, 2, 1)
    assert r.inbound_top10k_ratio == pytest.approx(2 / 3) and r.cross_language_authority == pytest.approx(0.6)
    o = profiles.outbound_profile(links, langs, ranks).where("domain = 'y.com'").first()
    assert (o.outbound_links_total, o.linked_domains, o.outbound_lang_distribution[0].lang) == (2, 1, "en")


def test_reference_tables(spark):
    rows = [("www.a.com", "5", "n/a", "MayExist", "1", "2"), ("a.com", "3", "7", "Found", "x", "9"), ("b.com", "n/a", "1", "Found", "1", "1"), ("c.com", "0", None, "odd", None, None)]
    got = {r.domain: tuple(r)[1:] for r in reference.normalise_trust(spark.createDataFrame(rows, "host string, trust string, volume string, status string, ref_domains string, ext_backlinks string"), "host", "trust", "volume").collect()}
    assert got == {"a.com": (5.0, 7.0, 1, 9, "Found"), "c.com": (0.0, None, None, None, "odd")}
    opr = spark.createDataFrame([("Facebook.com", "9.0"), ("www.facebook.com", "9.5"), ("fonts.googleapis.com", "6.5"), ("x.com", "?")], "Domain string, `Open Page Rank` string")
    assert {r.domain: r.opr_score for r in reference.normalise_rank_csv(opr).collect()} == {"facebook.com": 9.5, "googleapis.com": 6.5}


def test_domain_languages(spark):
    pages = spark.createDataFrame([("a", "en")] * 18 + [("a", "de")] + [("a", None)] * 3, "domain string, lang string")
    r = languages.domain_languages(pages, 0.1).first()
    assert r.dominant == "en" and len(r.languages) == 1 and r.page_count == 22


def test_windows_to_publish():
    assert publish.resolve_window(["w1"], None) == "w1" and publish.resolve_window(["w1", "w2"], "w2") == "w2"
    for windows, wanted in ((["w1", "w2"], None), (["w1"], "w3"), ([], None)):
        with pytest.raises(ConfigError):
            publish.resolve_window(windows, wanted)
    with pytest.raises(ConfigError):
        publish.upload_commands("o", " ")


def test_streamed_pairs_equal_a_batch(spark, tmp_path):
    from webloom.operators.links import aggregate_pairs, resolve_domains
    from webloom.streaming.pairs import stored_pairs, stream_pairs

    rows = [(f"http://a{i % 3}.com/{i}", f"http://b{i % 2}.org/", None, None) for i in range(20)]
    df = spark.createDataFrame(rows, "url_from string, url_to string, anchor string, rel string")
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        stream_pairs(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), "C1", 1).awaitTermination(120)
    got = {(r.domain_from, r.domain_to): r.link_count for r in stored_pairs(spark, str(tmp_path / "out")).collect()}
    assert got == {(r.domain_from, r.domain_to): r.link_count for r in aggregate_pairs(resolve_domains(df)).collect()}


def test_cli_arguments():
    from webloom import cli

    a = cli.parser().parse_args(["pagerank", "--vertices", "v", "--edges", "e", "--out", "o", "--crawl", "c", "--tol", "0.1"])
    assert a.tol == 0.1
    for bad in (["backlinks", "--list", "l", "--out", "o", "--crawl", "c", "--run-id", "../x"], ["pagerank"], []):
        with pytest.raises(SystemExit):
            cli.parser().parse_args(bad)


def test_job_errors(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("\n")
    with pytest.raises(JobError):
        jobs.backlinks(spark, str(tmp_path / "empty.txt"), "p", str(tmp_path / "o"), "c")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_kendall_in_blocks(spark, seed):
    """Ties of all sizes, values with more rows than a block among them."""
    rng = np.random.default_rng(seed)
    x = rng.integers(0, [5, 60, 1000][seed - 1], 700)
    y = np.where(rng.random(700) < 0.6, x, rng.integers(0, 300, 700)) // [1, 7, 1][seed - 1]
    x[: 200 * (seed % 2)] = 3
    df = spark.createDataFrame(list(zip(x.astype(float).tolist(), y.astype(float).tolist(), strict=True)), "a double, b double").repartition(5)
    for block in (40, 300):
        assert rankstats.kendall_in_blocks(df, block) == pytest.approx(rankstats.tau_b(x, y), abs=1e-12)


def test_weighted_inversions():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 90):
        v, w = rng.integers(0, 20, n), rng.integers(1, 5, n)
        assert rankstats.weighted_inversions(v, w) == sum(int(w[i] * w[j]) for i in range(n) for j in range(i + 1, n) if v[i] > v[j])


def test_quantiles_are_exact(spark):
    values = [3.5, -1.0, 3.5, 8.0, None, 2.25, 7.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    at = [0, 0.1, 0.25, 0.5, 0.9, 1]
    assert rankstats.quantiles(df, "v", at) == pytest.approx(np.quantile([v for v in values if v is not None], at).tolist())
    assert rankstats.quantiles(df.limit(0), "v", [0.5]) == [None]


def test_ranks_within_groups(spark):
    rows = [(i % 3 if i % 7 else None, float(i * i % 11)) for i in range(60)]
    got = rankstats.with_rank(spark.createDataFrame(rows, "g int, v double").repartition(4), "v", "r", by="g").collect()
    assert len(got) == 60
    for r in got:
        mine = [v for g, v in rows if g == r.g]
        assert r.r == sum(v < r.v for v in mine) + (1 + sum(v == r.v for v in mine)) / 2


def test_the_package_reaches_workers(spark):
    import webloom
    from webloom import session

    sent = []

    class Context:
        addPyFile = staticmethod(lambda path: sent.append((path, __import__("zipfile").ZipFile(path).namelist())))

    class Session:
        sparkContext = Context

    session.ship_package(Session)
    assert "webloom/operators/pagerank.py" in sent[0][1] and webloom


def test_a_cluster_needs_a_shared_folder():
    from webloom import session

    def fake(master, folder=None):
        class Conf:
            get = staticmethod(lambda key, default=None: folder)

        class Context:
            pass

        class Session:
            conf, sparkContext = Conf, Context

        Context.master = master
        return Session

    assert session.shared_dir(fake("local[4]")) == session.FALLBACK_DIR
    assert session.shared_dir(fake("spark://x:1", "hdfs://shared/")) == "hdfs://shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake("local-cluster[2,1,1000]"))


def test_published_files_and_commit(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "out" / "index"))
    record = publish.artifact_record(spark, str(tmp_path / "out"))
    assert record and all(a["path"].startswith("index/part-") and a["bytes"] > 0 for a in record)
    assert publish.current_commit(str(tmp_path)) is None
    (tmp_path / ".git" / "refs").mkdir(parents=True)
    (tmp_path / ".git" / "HEAD").write_text("ref: refs/main\n")
    (tmp_path / ".git" / "refs" / "main").write_text("abc\n")
    assert publish.current_commit(str(tmp_path / "out")) == "abc"
    (tmp_path / ".git" / "refs" / "main").unlink()
    (tmp_path / ".git" / "packed-refs").write_text("def refs/main\n")
    assert publish.current_commit(str(tmp_path)) == "def"


#: A query of each family; the driver compares all of them.
COMPARED = ("graph_degrees", "link_pairs", "language_arrays", "crawl_link_status", "rank_kendall", "mart_domain_authority", "scope_filter", "sample_stratified", "source_wat_file", "source_path_list", "publish_record", "graph_faults", "job_settings", "scope_stages")


@pytest.mark.parametrize("name", COMPARED)
def test_against_sql(spark, sf, name):
    import duckdb

    from webloom.plans import proofs, registry

    assert proofs
    con = duckdb.connect()
    for table in os.listdir(sf):
        con.execute(f"CREATE VIEW {table.split('.')[0]} AS SELECT * FROM '{sf}/{table}'")
    result = con.execute(registry.ORACLE[name])
    names = [c[0] for c in result.description]
    want = sorted((tuple(r) for r in result.fetchall()), key=repr)
    got = sorted((tuple(r) for r in registry.QUERIES[name](spark, sf).select(*names).collect()), key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert [x if not isinstance(x, float) else pytest.approx(x) for x in w] == list(g)


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["domain", "crawl", "pagerank_score", "in_degree", "out_degree"]


def test_spearman_of_constant_scores(spark):
    """A bucket in which a score is constant has no correlation: nan as in SQL, not an error."""
    rows = [(float(i % 7), 3.0 if i < 8 else float(8 - i)) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(4)
    got = {r.lo: r for r in rankstats.bucket_spearman(df, "a", "b", [(1, 9), (9, 21)]).collect()}
    assert got[1].n == 8 and np.isnan(got[1].spearman)
    rest = df.where("b <= 0").toPandas().rank()
    assert got[9].n == 12 and got[9].spearman == pytest.approx(np.corrcoef(rest.a, rest.b)[0, 1], abs=1e-12)
    whole = rankstats.spearman(df.withColumn("b", F.lit(1.0)), "a", "b").first()
    assert whole.n == 20 and np.isnan(whole.spearman)
    assert rankstats.spearman(df.limit(0), "a", "b").first().spearman is None
