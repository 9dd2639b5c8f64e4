"""Helpers that the training-data operators share: shared storage, word splitting, hashing."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words, as a regular-expression class and as plain characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_RE = re.compile(r"[\x20\x09-\x0D]+")
WORD_RE = re.compile(r"[^\x20\x09-\x0D]+")

#: Text tables hold documents of megabytes beside documents of bytes, so Arrow batches stay short.
ARROW_ROWS = "1000"
#: Where results are cut when the session names no shared folder (tests, notebooks on one machine).
FALLBACK_DIR = "file:///tmp/checkpoints/webloom"


#: White space of str.split() that doesn't separate words here.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def words_of(text: str | None) -> list[str]:
    """Words of a text; None has none. Splits at ASCII white space only."""
    if not text:
        return []
    return WORD_RE.findall(text) if _ODD_SPACE.search(text) else text.split()


def tune(spark: SparkSession) -> None:
    """Short Arrow batches, unless the session has chosen its own size."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors reach: spark.checkpoint.dir of the session.

    Where it is unset, a local master uses FALLBACK_DIR; a cluster has no folder that all reach, so
    that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (root or FALLBACK_DIR).rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; Hadoop removes it when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(at.getParent())
    fs.deleteOnExit(at)
    return path


def materialize(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends at replicated files."""
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def part_of(stored: DataFrame, folder: str, schema: str) -> DataFrame:
    """One folder of a partitioned stored frame as a frame of its own; empty if nothing was written there."""
    spark, path = stored.sparkSession, f"{stored.stored_at}/{folder}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)
    out = spark.read.schema(schema).parquet(path)
    out.stored_at = path
    return out


def discard(*stored: DataFrame) -> None:
    """Remove stored frames that no later step reads: all that was made from them is stored itself."""
    for df in stored:
        at = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let the context cleaner drop shuffle files of finished steps now instead of at some later GC."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def word_array(text: Column) -> Column:
    """Words of a text column as an array; null and blank texts give an empty array."""
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(plain, " "), "")


def let(value: Column, body) -> Column:
    """body(value) with value computed once, although body's lambdas use it many times."""
    return F.transform(F.array(value), body)[0]
