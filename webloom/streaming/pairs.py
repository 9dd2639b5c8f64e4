"""Link pairs of newly arrived link files, by micro-batches over the batch operators.

Crawls are batches, so nothing here is windowed by time: each file adds to its crawl. A micro-batch's
pairs are stored under its number, so that a repeated one replaces its own rows and counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom import schemas
from webloom.operators.links import aggregate_pairs, resolve_domains
from webloom.sources.sinks import write_crawl_partitions


def stream_pairs(spark: SparkSession, links_path: str, out: str, checkpoint: str, crawl: str, max_files: int = 100):
    """Start a query over a folder of one crawl's raw links; it ends when every file there has been read."""
    arriving = spark.readStream.schema(schemas.RAW_LINKS).option("maxFilesPerTrigger", max_files).parquet(links_path)

    def store(batch: DataFrame, number: int) -> None:
        pairs = aggregate_pairs(resolve_domains(batch))
        write_crawl_partitions(pairs.withColumns({"crawl": F.lit(crawl), "batch": F.lit(number)}), out, "batch")

    return arriving.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_pairs(spark: SparkSession, out: str) -> DataFrame:
    """Pairs summed over all micro-batches."""
    counts = ["link_count", "dofollow_count", "ugc_count", "sponsored_count"]
    return spark.read.parquet(out).groupBy("domain_from", "domain_to", "crawl").agg(*[F.sum(c).alias(c) for c in counts])
