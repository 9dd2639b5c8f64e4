"""Hosts, registered domains, link pairs, WAT files."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from webloom.errors import ConfigError
from webloom.functions import psl, urls
from webloom.operators import links
from webloom.plans import jobs
from webloom.sources import readers, sinks, wat

HOSTS = {
    "example.com": "example.com", "www.facebook.com": "facebook.com", "bbc.co.uk": "bbc.co.uk", "www.bbc.co.uk": "bbc.co.uk", "a.b.c.example.com": "example.com", "WWW.Example.COM": "example.com",
    "example.com.": "example.com", " x.com ": "x.com", "": None, "   ": None, "8.8.8.8": None, "2001:4860:4860::8888": None, "[::1]": None, "foo.localhost": None, "host.local": None, "bare": None, "a\x00b.com": None,
    "münchen.de": "xn--mnchen-3ya.de", "a.bg": None, "target.bg": "target.bg", "co.uk": None, "www.ck": "www.ck", "foo.bar.ck": "foo.bar.ck", "x.foo.bar.ck": "foo.bar.ck", "bar.ck": None,
    "a.city.kawasaki.jp": "city.kawasaki.jp", "x.github.io": "github.io", "a..com": None, "x" * 250 + ".com": None, "-": None,
}


def test_registered_domains(spark):
    hosts = spark.createDataFrame([(h,) for h in [*HOSTS, None, "example.com"]], "host string")
    assert {r.host: r.domain for r in psl.registered_domains(hosts).collect()} == HOSTS


def test_suffix_list_shape():
    kinds = [k for _, k in psl.suffix_rules()]
    assert len(kinds) > 5000 and kinds.count("exception") > 3 and kinds.count("wildcard") > 10


def test_url_functions(spark):
    df = spark.createDataFrame([(u,) for u in ["http://A.b.com/x", "not a url", "not-a-url", "::::", None, "/rel", "//cdn.x.com/a", "http://ex.com|y"]], "u string")
    assert [r[0] for r in df.select(urls.host_of(F.col("u"))).collect()] == ["A.b.com", None, None, None, None, None, "cdn.x.com", None]
    df = spark.createDataFrame([("c/warc/a/warc/x.warc.gz",), ("c/warc/x.gz",), (None,)], "p string")
    assert [r[0] for r in df.select(urls.wat_path(F.col("p"))).collect()] == ["c/wat/a/warc/x.warc.wat.gz", None, None]
    df = spark.createDataFrame([("com.example",), (None,), ("uk.co.bbc",)], "r string")
    assert [r[0] for r in df.select(urls.unreverse(F.col("r"))).collect()] == ["example.com", "", "bbc.co.uk"]
    df = spark.createDataFrame([("x.gov",), ("x.gov.uk",), ("a.edu",), ("a.ac.uk",), ("a.ac",), ("gov.com",), (None,)], "d string")
    assert [r[0] for r in df.select(urls.tld_class(F.col("d"))).collect()] == ["gov", "gov", "edu", "edu", "normal", "normal", None]
    df = spark.createDataFrame([(" ENG ,fra",), ("",), (None,), (",x",)], "l string")
    assert [r[0] for r in df.select(urls.primary_language(F.col("l"))).collect()] == ["eng", None, None, None]


def test_pair_counts(spark):
    rows = [("a", "b", None), ("a", "b", "nofollow ugc"), ("a", "b", "sponsored"), ("a", "a", "NOFOLLOW"), ("c", "d", "\tnofollow  x"), ("c", "d", "")]
    got = {(r.domain_from, r.domain_to): tuple(r)[2:] for r in links.aggregate_pairs(spark.createDataFrame(rows, "domain_from string, domain_to string, rel string")).collect()}
    assert got == {("a", "b"): (3, 2, 1, 1), ("a", "a"): (1, 0, 0, 0), ("c", "d"): (2, 1, 0, 0)}


def test_resolution_and_its_plan(spark):
    rows = [("http://www.a.com/x", "http://b.co.uk/y"), ("http://a.com", "/rel"), ("http://8.8.8.8/", "http://b.com"), ("garbage in", "http://b.com"), (None, "http://b.com"), ("http://a.com/1", "http://x.a.com/2")]
    df = spark.createDataFrame([(*r, "t", None) for r in rows], "url_from string, url_to string, anchor string, rel string")
    got = links.resolve_domains(df)
    assert sorted((r.domain_from, r.domain_to) for r in got.collect()) == [("a.com", "a.com"), ("a.com", "b.co.uk")]
    assert links.resolve_domains(df, keep_unresolved=True).count() == 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python; hosts are resolved by joins


def payload(source, *found):
    return {"Envelope": {"WARC-Header-Metadata": {"WARC-Target-URI": source}, "Payload-Metadata": {"HTTP-Response-Metadata": {"HTML-Metadata": {"Links": list(found)}}}}}


def record(body: bytes, kind="metadata"):
    return b"WARC/1.0\r\nWARC-Type: " + kind.encode() + b"\r\nContent-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def wat_file(path, *bodies, zipped=True):
    parts = [record(b"software: x\r\n", "warcinfo"), *[record(b if isinstance(b, bytes) else json.dumps(b).encode()) for b in bodies]]
    path.write_bytes(b"".join(gzip.compress(p) for p in parts) if zipped else b"".join(parts))
    return str(path)


A = payload("http://src1.com/page", {"path": "A@/href", "url": "http://a.bg/x", "rel": "nofollow"}, {"path": "IMG@/src", "url": "http://i.com/i.png"})
B = payload("http://src1.com/other", {"path": "A@/href", "url": "http://x.net/y", "text": "hi"}, {"path": "A@/href", "url": ""}, "odd")


def test_wat_files(spark, tmp_path):
    good = wat_file(tmp_path / "good.wat.gz", A, B, payload("http://none.com"), {"Envelope": None}, [1])
    bad = wat_file(tmp_path / "bad.wat", A, b"{no json", zipped=False)
    rows = wat.read_wat(spark, [good, bad, str(tmp_path / "missing.gz")]).cache()
    assert sorted(map(tuple, wat.link_rows(rows).collect()), key=repr) == sorted([("http://src1.com/page", "http://a.bg/x", None, "nofollow")] * 2 + [("http://src1.com/other", "http://x.net/y", "hi", None)], key=repr)
    counts = wat.extraction_counts(rows)
    assert counts == {"files_attempted": 3, "raw_link_rows": 3, "records_seen": 7, "malformed_records": 1, "records_with_no_links": 3, "files_unreadable": 1}


def test_corrupt_files_and_unknown_stores(spark, tmp_path):
    good = gzip.compress(record(json.dumps(A).encode()))
    noise = bytearray(gzip.compress(record(json.dumps({"x": list(range(3000))}).encode())))
    noise[40:80] = b"\xff" * 40
    (tmp_path / "corrupt.gz").write_bytes(good + bytes(noise))
    rows = wat.read_wat(spark, [str(tmp_path / "corrupt.gz")]).cache()
    assert wat.link_rows(rows).count() == 1
    assert wat.extraction_counts(rows)["files_unreadable"] == 1
    with pytest.raises(wat.UnknownStoreError):
        wat.open_stream("nowhere://x/y")


def test_the_suffix_list_says_where_it_is_from(tmp_path, monkeypatch):
    from webloom.functions import psl

    (tmp_path / "psl.dat").write_text("// VERSION: 2024-05-01\n// ===BEGIN ICANN DOMAINS===\ncom\n*.uk\n!x.uk\n// ===END ICANN DOMAINS===\nown.net\n")
    path = str(tmp_path / "psl.dat")
    assert psl.suffix_list(path)[1] == f"{path}, 2024-05-01"
    assert psl.suffix_rules(path) == (("com", "exact"), ("uk", "wildcard"), ("x.uk", "exception"))
    assert ".jar, " in psl.suffix_list()[1]


def test_s3a_is_s3(monkeypatch):
    from pyarrow import fs

    asked = []

    class Store:
        @staticmethod
        def from_uri(uri):
            asked.append(uri)
            raise FileNotFoundError(uri)

    monkeypatch.setattr(fs, "FileSystem", Store)
    for path in ("s3a://b/x.gz", "s3n://b/x.gz", "s3://b/x.gz"):
        with pytest.raises(OSError):
            wat.open_stream(path)
    assert asked == ["s3://b/x.gz"] * 3


def test_json_extraction_agrees_with_the_parser(spark):
    bodies = [A, B, payload("http://none.com"), {"Envelope": None}]
    df = spark.createDataFrame([(json.dumps({**b}),) for b in bodies if b is not B], "value string")
    want = [tuple(x.values()) for b in bodies if b is not B for x in wat.links_of(b)]
    assert [tuple(r) for r in wat.links_from_json(df).collect()] == want


def test_backlink_job(spark, tmp_path):
    wat_file(tmp_path / "one.wat.gz", A, B)
    (tmp_path / "list.txt").write_text("\n one.wat.gz \n\n")
    out = str(tmp_path / "out" / "pairs")
    m = jobs.backlinks(spark, str(tmp_path / "list.txt"), str(tmp_path), out, "C1", "run-1")
    assert [(r.domain_from, r.domain_to, r.link_count) for r in readers.read_partitioned(spark, out).collect()] == [("src1.com", "x.net", 1)]
    assert m["raw_link_rows"] == 2 and m["domain_pair_rows"] == 1 and m["link_count_total"] == 1 and len(m) == 15
    assert json.loads(spark.read.text(sinks.metrics_path(out)).first()[0])["crawl"] == "C1"


def test_backlink_job_in_a_shared_folder_without_a_scheme(spark, sf, tmp_path, monkeypatch):
    from webloom import session
    from webloom.plans import proofs, registry

    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path / "shared"))
    assert session.scratch_path(spark, "x").startswith(f"file://{tmp_path}/shared/x-")
    got = proofs.job_backlinks(spark, sf).select("domain_from", "domain_to", "link_count").collect()
    assert got and sorted(got) == sorted(registry.link_pairs(spark, sf).select("domain_from", "domain_to", "link_count").collect())


def test_backlink_job_without_pairs(spark, tmp_path):
    """Unreadable files and pages without links make no pairs, which the metrics say."""
    wat_file(tmp_path / "one.wat.gz", payload("http://none.com"))
    (tmp_path / "list.txt").write_text("one.wat.gz\nmissing.wat.gz\n")
    m = jobs.backlinks(spark, str(tmp_path / "list.txt"), str(tmp_path), str(tmp_path / "out" / "pairs"), "C1", "run-1")
    assert (m["domain_pair_rows"], m["link_count_total"], m["files_unreadable"], m["raw_link_rows"]) == (0, 0, 1, 0)


def test_paths():
    assert sinks.resolve_path("s3://b/x", "gs://p") == "s3://b/x"
    assert sinks.resolve_path("/x/y", "gs://p/") == "gs://p/x/y"
    for bad in (("", "p"), (" ", "p"), ("x", "")):
        with pytest.raises(ConfigError):
            sinks.resolve_path(*bad)
    assert sinks.metrics_path("gs://b/m/pairs/") == "gs://b/m/_metrics/pairs"
    assert sinks.metrics_path("/d/pairs") == "/d/_metrics/pairs"
    assert sinks.metrics_path("pairs") == "_metrics/pairs"
    for bad in ("gs://", "gs://bucket", "/", ""):
        with pytest.raises(ConfigError):
            sinks.metrics_path(bad)
    import hashlib

    assert sinks.manifest_digest([" a ", "", "b"]) == hashlib.sha256(b"a\nb\n").hexdigest()
