"""Several crawls: windows, merged graphs, link histories, slowly changing dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def crawl_windows(crawls: DataFrame) -> DataFrame:
    """Every crawl as its own window: window_id, window_end_crawl, window_crawls."""
    c = F.col("crawl")
    return crawls.select("crawl").where(c.isNotNull()).distinct().select(c.alias("window_id"), c.alias("window_end_crawl"), F.array(c).alias("window_crawls"))


def select_window(crawls: DataFrame, recent: int = 6, anchors: bool = True) -> DataFrame:
    """(crawl, is_recent, is_anchor): the latest crawls, and the last one of each half-year before them.

    crawls: (crawl, crawl_date). There is one row for each crawl ever made, so one task orders them.
    """
    rows = crawls.groupBy("crawl").agg(F.max("crawl_date").alias("crawl_date"))
    place = F.row_number().over(W.orderBy(F.desc("crawl_date"), F.desc("crawl")))
    half = F.concat(F.year("crawl_date"), F.when(F.month("crawl_date") <= 6, "H1").otherwise("H2"))
    ranked = rows.withColumns({"is_recent": place <= recent, "half": half})
    last = F.row_number().over(W.partitionBy("half").orderBy(F.desc("crawl_date"), F.desc("crawl")))
    older = ranked.where("not is_recent").withColumn("is_anchor", (last == 1) & F.lit(anchors))
    newest = ranked.where("is_recent").withColumn("is_anchor", F.lit(False))
    return newest.unionByName(older).where("is_recent or is_anchor").select("crawl", "is_recent", "is_anchor")


def merged_edges(edges: DataFrame, window: DataFrame) -> DataFrame:
    """Distinct edges of all crawls of a window; edges: (from_id, to_id, crawl)."""
    return edges.join(window.select("crawl"), "crawl", "left_semi").select("from_id", "to_id").distinct()


def link_history(links: DataFrame, key: list[str]) -> DataFrame:
    """Each link's first_seen_crawl, last_seen_crawl and crawls_active."""
    return links.groupBy(*key).agg(F.min("crawl").alias("first_seen_crawl"), F.max("crawl").alias("last_seen_crawl"), F.count_distinct("crawl").alias("crawls_active"))


def link_status(links: DataFrame, key: list[str], source: str, latest: str, broken: DataFrame | None = None, target: str | None = None) -> DataFrame:
    """link_history with is_active, is_lost and is_broken as of crawl `latest`.

    A link is lost if it is gone although its source was crawled in `latest`. It is broken if it is
    there and its target is in `broken` (one column named like target).
    """
    history = link_history(links, key)
    alive = links.where(F.col("crawl") == latest).select(source).distinct().withColumn("_alive", F.lit(True))
    out = history.join(alive, source, "left").withColumn("is_active", F.col("last_seen_crawl") == latest)
    out = out.withColumn("is_lost", ~F.col("is_active") & F.col("_alive").isNotNull()).drop("_alive")
    if broken is None:
        return out.withColumn("is_broken", F.lit(False))
    marks = broken.select(target).distinct().withColumn("_broken", F.lit(True))
    return out.join(marks, target, "left").withColumn("is_broken", F.col("is_active") & F.col("_broken").isNotNull()).drop("_broken")


def active_in(rows: DataFrame, key: str, min_crawls: int) -> DataFrame:
    """Keys seen in at least min_crawls crawls."""
    return rows.groupBy(key).agg(F.count_distinct("crawl").alias("crawls_active")).where(F.col("crawls_active") >= min_crawls)


def history_type2(snapshots: DataFrame, key: str, value: str, at: str) -> DataFrame:
    """Type-2 history: a row for each run of an unchanged value, valid_from, valid_to (null: current), is_current."""
    order = W.partitionBy(key).orderBy(at)
    before = F.lag(value).over(order)
    first = F.row_number().over(order) == 1
    starts = snapshots.withColumn("_new", first | ~F.col(value).eqNullSafe(before)).where("_new")
    after = F.lead(at).over(order)
    return starts.select(key, value, F.col(at).alias("valid_from"), after.alias("valid_to"), after.isNull().alias("is_current"))
