"""Samples that come out the same each time."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chance(column: str) -> Column:
    """A number in [0, 1) from the md5 of a value: the same draw in every engine and layout."""
    return F.conv(F.substring(F.md5(F.col(column).cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


#: Orders in which places up to the cap are filled.
FILL = {"crc32": lambda c: F.crc32(F.col(c).cast("binary")), "md5": lambda c: F.md5(F.col(c).cast("binary"))}


def stratified_list(scores: DataFrame, head: int, per_bucket: int, cap: int, fill: str = "crc32") -> DataFrame:
    """domains for a reference list: the `head` best always, then a sample of each decade of the score.

    scores: (domain, oa). Rows beside the head fall in buckets floor(log10(oa)); each is drawn with
    probability min(1, per_bucket / size), by the hash of its domain, and places up to `cap` are
    filled in the order of crc32 (or md5).
    """
    top = scores.orderBy(F.desc("oa"), "domain").limit(head)
    rest = scores.join(top.select("domain"), "domain", "left_anti").where("oa > 0").withColumn("bucket", F.floor(F.log10("oa")).cast("int"))
    sizes = {r.bucket: r["count"] for r in rest.groupBy("bucket").count().collect()}  # decades of a double: under 640
    share = F.create_map(*[F.lit(x) for b, n in sorted(sizes.items()) for x in (b, min(1.0, per_bucket / n))]) if sizes else F.lit(None)
    sample = rest.where(chance("domain") < share[F.col("bucket")]) if sizes else rest
    filled = sample.select("domain").orderBy(FILL[fill]("domain"), "domain").limit(max(0, cap - head))
    return top.select("domain").union(filled)


def bucket_sample(scores: DataFrame, per_bucket: int) -> DataFrame:
    """The sample that every engine draws alike: the first per_bucket of each decade in the order of md5(domain)."""
    from pyspark.sql import Window as W

    rows = scores.where("oa > 0").withColumn("bucket", F.floor(F.log10("oa")).cast("int"))
    place = F.row_number().over(W.partitionBy("bucket").orderBy(F.md5(F.col("domain").cast("binary")), "domain"))
    return rows.withColumn("place", place).where(F.col("place") <= per_bucket).select("bucket", "domain", "oa")


def hash_sample(df: DataFrame, column: str, mod: int) -> DataFrame:
    """About one row in mod, by the md5 of a column."""
    return df.where(chance(column) * mod < 1)


def row_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(False, fraction, seed)


def random_rows(df: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """k rows in a random order that the seed fixes for one layout of the input."""
    return df.orderBy(F.rand(seed)).limit(k)


def path_sample(paths: Sequence[str], n: int, seed: int = 42) -> list[str]:
    """n of the paths, sorted; all of them if n is no less."""
    return sorted(paths) if n >= len(paths) else sorted(random.Random(seed).sample(list(paths), n))


def nested_ladder(paths: Sequence[str], sizes: Sequence[int], seed: int = 42) -> dict[int, list[str]]:
    """One draw cut at each size, so that smaller samples lie in larger ones; each is sorted."""
    most = max(sizes, default=0)
    if most > len(paths):
        raise ValueError(f"{most} paths wanted, {len(paths)} there")
    drawn = random.Random(seed).sample(list(paths), most)
    return {n: sorted(drawn[:n]) for n in sizes}
