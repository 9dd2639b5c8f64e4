"""Writers: partitioned overwrite, single small files, manifests, and the paths they go to."""

from __future__ import annotations

import hashlib
import json
import re
from typing import Any
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.config import guard_output
from webloom.errors import ConfigError


def write_crawl_partitions(df: DataFrame, path: str, partition: str = "crawl") -> None:
    """Overwrite only the partitions in df; rows are dealt by partition so that each gets few files."""
    (df.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(partition).parquet(guard_output(path)))


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(guard_output(path))


def write_json(spark: SparkSession, record: dict[str, Any], path: str) -> None:
    """One small JSON file; values that JSON lacks become their str()."""
    text = json.dumps(record, default=str, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(guard_output(path))


def write_list(df: DataFrame, path: str) -> None:
    """One file of one value a line without a header, for lists that people or tools read."""
    df.select(F.col(df.columns[0]).cast("string").alias("value")).coalesce(1).write.mode("overwrite").text(guard_output(path))


def write_csv_file(df: DataFrame, path: str, header: bool = False) -> None:
    df.coalesce(1).write.mode("overwrite").option("header", header).csv(guard_output(path))


def write_link_sample(links: DataFrame, path: str, fraction: float, seed: int = 42) -> None:
    """A Bernoulli sample of URL-grain links."""
    links.sample(False, fraction, seed).write.mode("overwrite").parquet(guard_output(path))


def metrics_path(output: str) -> str:
    """Where a dataset's metrics go: <parent>/_metrics/<leaf>. A scheme's root has no parent."""
    trimmed = output.rstrip("/")
    root = re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/*", output)
    parent, _, leaf = trimmed.rpartition("/")
    if not leaf or (root and len(parent) < len(root[0])):
        raise ConfigError(f"no place for metrics beside {output!r}")
    return f"{trimmed[: len(trimmed) - len(leaf)]}_metrics/{leaf}"


def resolve_path(path: str, prefix: str) -> str:
    """A listed path under a prefix: absolute URIs stay, relative ones get one slash, blank is an error."""
    if not path or not path.strip():
        raise ConfigError("blank path in the list")
    if urlparse(path).scheme and "://" in path:
        return path
    if not prefix or not prefix.strip():
        raise ConfigError(f"{path} is relative and there is no prefix")
    return f"{prefix.rstrip('/')}/{path.lstrip('/')}"


def manifest_digest(paths: list[str]) -> str:
    """SHA-256 of a path list: stripped, without blanks, in order, each line ended."""
    kept = [p.strip() for p in paths if p.strip()]
    return hashlib.sha256("".join(f"{p}\n" for p in kept).encode()).hexdigest()
