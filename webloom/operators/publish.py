"""The public index: one window of the mart as Parquet, a top list as CSV, and a record of what it is."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.errors import ConfigError
from webloom.operators.seeds import numbered
from webloom.sources.sinks import write_json

COLUMNS = ("domain", "open_authority", "open_volume", "window_id")


def available_windows(mart: DataFrame) -> list[str]:
    return [r.window_id for r in mart.select("window_id").distinct().orderBy("window_id").collect()]


def resolve_window(windows: list[str], wanted: str | None) -> str:
    """The wanted window if it is there; without a wish the only one; else an error."""
    if wanted is not None:
        if wanted not in windows:
            raise ConfigError(f"window {wanted!r} is not in the mart; it has {windows}")
        return wanted
    if len(windows) != 1:
        raise ConfigError(f"name a window; the mart has {windows}")
    return windows[0]


def public_index(mart: DataFrame, window: str) -> DataFrame:
    return mart.where(F.col("window_id") == window).select(*COLUMNS)


def top_list(index: DataFrame, n: int) -> DataFrame:
    """The n best by authority with rank, ties by domain: a partial top-N, numbered after it is cut."""
    if n <= 0:
        raise ConfigError(f"top_n must be positive, not {n}")
    order = (F.col("open_authority").desc(), F.col("domain").asc())
    return numbered(index.orderBy(*order).limit(n), *order).select("rank", *COLUMNS)


def extract_public_index(spark: SparkSession, mart_path: str, out: str, top_n: int = 100_000, window_id: str | None = None) -> dict[str, Any]:
    """Write index Parquet, top CSV and metadata below out; returns the metadata."""
    if top_n <= 0:
        raise ConfigError(f"top_n must be positive, not {top_n}")
    mart = spark.read.parquet(mart_path)
    windows = available_windows(mart)
    window = resolve_window(windows, window_id)
    index = public_index(mart, window)
    index.write.mode("overwrite").parquet(f"{out}/index")
    written = spark.read.parquet(f"{out}/index")
    top_list(written, top_n).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out}/top")
    record = {"window_id": window, "available_windows": windows, "row_count": written.count(), "source_row_count": mart.count(), "top_n": top_n, "columns": list(COLUMNS)}
    write_json(spark, record, f"{out}/metadata")
    return record


def artifact_record(spark: SparkSession, out: str) -> list[dict[str, Any]]:
    """(path below out, bytes) of every published data file, in the order of paths."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(out)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base, found = fs.makeQualified(root).toString(), []
    files = fs.listFiles(root, True)
    while files.hasNext():
        file = files.next()
        name = file.getPath().toString().removeprefix(base).lstrip("/")
        if not name.rpartition("/")[2].startswith(("_", ".")):
            found.append({"path": name, "bytes": file.getLen()})
    return sorted(found, key=lambda x: x["path"])


def current_commit(folder: str = ".") -> str | None:
    """The commit checked out in the git repository that holds a folder, read from its files; None outside of one."""
    from pathlib import Path

    for place in (Path(folder).resolve(), *Path(folder).resolve().parents):
        head = place / ".git" / "HEAD"
        if head.is_file():
            text = head.read_text().strip()
            if not text.startswith("ref: "):
                return text
            ref = text.removeprefix("ref: ")
            if (place / ".git" / ref).is_file():
                return (place / ".git" / ref).read_text().strip()
            packed = place / ".git" / "packed-refs"
            lines = packed.read_text().splitlines() if packed.is_file() else []
            return next((x.split(" ")[0] for x in lines if x.endswith(f" {ref}")), None)
    return None


def dataset_card(record: dict[str, Any], title: str = "Domain authority index") -> str:
    """Text that goes with a published index."""
    lines = [f"# {title}", "", f"Window: {record['window_id']}", f"Rows: {record['row_count']:,}", f"Top list: {record['top_n']:,}", "", "| column | meaning |", "| --- | --- |"]
    meaning = {"domain": "registered domain", "open_authority": "personalised PageRank", "open_volume": "ln(1 + linking domains)", "window_id": "crawl window"}
    return "\n".join(lines + [f"| {c} | {meaning[c]} |" for c in record["columns"]]) + "\n"


def upload_commands(out: str, dataset: str | None = None, release: str | None = None) -> list[list[str]]:
    """Commands that would publish the files; nothing is run here. A target without an id is an error."""
    commands = []
    for target, words in ((dataset, ["dataset-upload", "--id"]), (release, ["release-upload", "--tag"])):
        if target is not None:
            if not target.strip():
                raise ConfigError(f"{words[0]} needs an id")
            commands.append([*words, target, f"{out}/index", f"{out}/top", f"{out}/metadata"])
    return commands
