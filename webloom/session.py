"""Session factory and storage that outlives executors."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

FALLBACK_DIR = "file:///tmp/checkpoints/webloom"


def build_session(app: str = "webloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; on a cluster the submit command sets sizes."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.filterPushdown": "true",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers of a session, for clusters and folders where it isn't installed."""
    import shutil
    import tempfile
    from pathlib import Path

    root = Path(__file__).resolve().parent
    with tempfile.TemporaryDirectory() as folder:
        archive = shutil.make_archive(f"{folder}/webloom", "zip", root.parent, root.name)
        spark.sparkContext.addPyFile(archive)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a local master uses FALLBACK_DIR; a cluster has none."""
    root, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not root and master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (root or FALLBACK_DIR).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends. Always a whole URI, whatever the setting says:
    a path without a scheme is on Spark's default file system, which other readers don't know."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if "://" not in path:
        path = re.sub("^([^:/]+):/(?!/)", r"\1:///", fs.makeQualified(at).toString())
    fs.mkdirs(at.getParent())
    fs.deleteOnExit(at)
    return path


def snapshot(df: DataFrame, name: str = "snapshot") -> DataFrame:
    """Cut lineage: write to the shared folder and read back with the same schema."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch path before the session ends."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
