"""Crawl metadata (WAT) files: WARC `metadata` records whose JSON payload lists a page's links.

Files are read as a Python data source: one task for each file, records decoded one at a time from
the stream, so memory holds one record. Counts of what was seen are rows of the same read (kind
`status`), so a retried task can't count twice.
"""

from __future__ import annotations

import gzip
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any, BinaryIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from webloom import schemas

STATUS = "records_seen long, malformed_records long, records_with_no_links long, files_unreadable long"
ROWS = f"kind string, path string, {schemas.RAW_LINKS}, {STATUS}"


class UnknownStoreError(Exception):
    """A path that no file system reads; the job fails instead of counting it as unreadable."""


def open_stream(path: str) -> BinaryIO:
    """A local file or file: URI, or whatever pyarrow's file systems reach (s3a is its s3); gzip by magic number.

    An address that no file system knows is a ValueError of its own kind, not an unreadable file.
    """
    from pyarrow import fs

    if "://" in path and not path.startswith("file:"):
        try:
            store, at = fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))
        except ValueError as e:
            raise UnknownStoreError(f"no file system for {path}") from e
        raw: Any = store.open_input_file(at)
    else:
        raw = open(path.removeprefix("file://").removeprefix("file:"), "rb")  # noqa: SIM115
    magic = raw.read(2)
    raw.seek(0)
    return gzip.GzipFile(fileobj=raw) if magic == b"\x1f\x8b" else raw


def warc_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, body) of each record; names of headers are lower-case. Ends at a truncated record."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers: dict[str, str] = {}
        while (line := stream.readline()) and line.strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers.get("content-length", "0") or 0)
        body = stream.read(length)
        yield headers, body
        if len(body) < length:
            return


def _below(data: Any, *keys: str) -> Any:
    for key in keys:
        data = data.get(key) if isinstance(data, dict) else None
    return data


def links_of(payload: Any) -> list[dict[str, str | None]]:
    """Anchor links of one decoded payload; any missing level gives none."""
    source = _below(payload, "Envelope", "WARC-Header-Metadata", "WARC-Target-URI")
    links = _below(payload, "Envelope", "Payload-Metadata", "HTTP-Response-Metadata", "HTML-Metadata", "Links")
    found = [x for x in links if isinstance(x, dict) and x.get("path") == "A@/href" and x.get("url")] if isinstance(links, list) else []
    return [{"url_from": source, "url_to": x["url"], "anchor": x.get("text"), "rel": x.get("rel")} for x in found]


@dataclass
class Counts:
    records_seen: int = 0
    malformed_records: int = 0
    records_with_no_links: int = 0


def raw_links(stream: BinaryIO, counts: Counts) -> Iterator[dict[str, str | None]]:
    """Link rows of a stream; records that aren't JSON are counted and skipped."""
    for headers, body in warc_records(stream):
        if headers.get("warc-type") != "metadata":
            continue
        counts.records_seen += 1
        try:
            payload = json.loads(body)
        except ValueError:
            counts.malformed_records += 1
            continue
        links = links_of(payload)
        counts.records_with_no_links += not links
        yield from links


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self):
        return [_File(p) for p in self.paths]

    def read(self, partition):
        counts, unreadable = Counts(), 0
        try:
            with open_stream(partition.path) as stream:
                for x in raw_links(stream, counts):
                    yield ("link", partition.path, x["url_from"], x["url_to"], x["anchor"], x["rel"], None, None, None, None)
        except (OSError, EOFError, ValueError, zlib.error):
            unreadable = 1
        yield ("status", partition.path, None, None, None, None, counts.records_seen, counts.malformed_records, counts.records_with_no_links, unreadable)


class WatSource(DataSource):
    """`spark.read.format("wat").option("paths", <JSON list>)`"""

    @classmethod
    def name(cls) -> str:
        return "wat"

    def schema(self) -> str:
        return ROWS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(json.loads(self.options.get("paths", "[]")))


def read_wat(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Link and status rows of the files. Persist or write it before using both kinds: a read parses all files."""
    spark.dataSource.register(WatSource)
    return spark.read.format("wat").option("paths", json.dumps(paths)).load()


def link_rows(rows: DataFrame) -> DataFrame:
    return rows.where("kind = 'link'").select("url_from", "url_to", "anchor", "rel")


def extraction_counts(rows: DataFrame) -> dict[str, int]:
    """Totals of the status rows, and the number of link rows."""
    names = ["records_seen", "malformed_records", "records_with_no_links", "files_unreadable"]
    row = rows.agg(F.count_if(F.col("kind") == "status").alias("files_attempted"), F.count_if(F.col("kind") == "link").alias("raw_link_rows"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
    return row.asDict()


#: Schema of the payload for the JVM-side form of the same extraction.
PAYLOAD = (
    "Envelope struct<`WARC-Header-Metadata`: struct<`WARC-Target-URI`: string>, "
    "`Payload-Metadata`: struct<`HTTP-Response-Metadata`: struct<`HTML-Metadata`: struct<Links: array<struct<path: string, url: string, text: string, rel: string>>>>>>"
)


def links_from_json(payloads: DataFrame, column: str = "value") -> DataFrame:
    """The same link rows from a column of JSON payloads, without Python."""
    e = F.from_json(column, PAYLOAD)["Envelope"]
    links = e["Payload-Metadata"]["HTTP-Response-Metadata"]["HTML-Metadata"]["Links"]
    anchors = F.filter(links, lambda x: (x["path"] == "A@/href") & (F.coalesce(x["url"], F.lit("")) != ""))
    rows = payloads.select(e["WARC-Header-Metadata"]["WARC-Target-URI"].alias("url_from"), F.explode(anchors).alias("x"))
    return rows.select("url_from", F.col("x.url").alias("url_to"), F.col("x.text").alias("anchor"), F.col("x.rel").alias("rel"))
