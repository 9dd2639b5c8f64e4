"""Agreement of two rankings, without sorting a whole table in one task.

Ranks come from counts of distinct scores: scores are dealt by ranges, summed range by range, and
only one count for each range goes through the driver.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from webloom.operators.seeds import numbered
from webloom.session import snapshot


def placed(df: DataFrame, score: str, descending: bool = False, by: str | None = None) -> DataFrame:
    """([by,] _score, _c, _first): each distinct score, how many rows have it, and how many come before it (within by).

    Distinct scores are dealt by ranges; a count for each range (and each by in it) goes through the driver.
    """
    keys = [by] if by else []
    counts = df.groupBy(*keys, F.col(score).alias("_score")).agg(F.count(F.lit(1)).alias("_c"))
    order = F.col("_score").desc() if descending else F.col("_score").asc()
    ranged = snapshot(counts.repartitionByRange(*keys, order).withColumn("_part", F.spark_partition_id()), "score-ranges")
    sums = ranged.groupBy("_part", *keys).agg(F.sum("_c").alias("n")).collect()
    before, so_far = [], {}
    for r in sorted(sums, key=lambda r: r["_part"]):
        k = r[by] if by else None
        before.append((r["_part"], *([k] if by else []), so_far.get(k, 0)))
        so_far[k] = so_far.get(k, 0) + r["n"]
    kind = f"`{by}` {dict(df.dtypes)[by]}, " if by else ""
    offsets = df.sparkSession.createDataFrame(before, f"_part int, {kind}_before long")
    running = W.partitionBy("_part", *keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    first = F.col("_before") + F.coalesce(F.sum("_c").over(running), F.lit(0))
    on = F.lit(True)
    for k in ("_part", *keys):
        on = on & ranged[k].eqNullSafe(offsets[k])
    here = ranged.join(F.broadcast(offsets), on)
    return here.select(*[ranged[k] for k in keys], "_score", "_c", "_before", ranged["_part"]).withColumn("_first", first).select(*keys, "_score", "_c", "_first")


def with_rank(df: DataFrame, score: str, name: str, descending: bool = False, by: str | None = None) -> DataFrame:
    """df with the average rank of a score (ties share the mean of their places), within `by` if given."""
    places = placed(df, score, descending, by).withColumn(name, F.col("_first") + 1 + (F.col("_c") - 1) / 2.0).drop("_first", "_c")
    on = F.col(score).eqNullSafe(F.col("_score"))
    if by:
        places = places.withColumnRenamed(by, "_by")
        on = on & F.col(by).eqNullSafe(F.col("_by"))
    return df.join(places, on).drop("_score", "_by")


def quantiles(df: DataFrame, column: str, at: list[float]) -> list[float | None]:
    """Exact quantiles of a column, interpolated between neighbours as percentile does; nulls don't count."""
    places = snapshot(placed(df.where(F.col(column).isNotNull()), column), "places")
    n = places.agg(F.coalesce(F.sum("_c"), F.lit(0))).first()[0]
    if not n:
        return [None] * len(at)
    wanted = sorted({int(f(p * (n - 1))) for p in at for f in (math.floor, math.ceil)})
    holds = F.filter(F.array(*[F.lit(k).cast("long") for k in wanted]), lambda k: (k >= F.col("_first")) & (k < F.col("_first") + F.col("_c")))
    value = {k: float(r["_score"]) for r in places.select("_score", holds.alias("ks")).where("size(ks) > 0").collect() for k in r.ks}

    def between(p: float) -> float:
        low, high = math.floor(p * (n - 1)), math.ceil(p * (n - 1))
        return value[low] if low == high else (high - p * (n - 1)) * value[low] + (p * (n - 1) - low) * value[high]

    return [between(p) for p in at]


def correlation(a: str, b: str) -> Column:
    """Pearson's r of an aggregate; nan where a or b is constant (Spark's corr divides by zero there), null without rows."""
    varies = (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
    r = F.covar_pop(a, b) / (F.stddev_pop(a) * F.stddev_pop(b))
    return F.when(varies, r).when(F.count(F.lit(1)) > 0, F.lit(float("nan")))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: n, spearman (correlation of average ranks)."""
    ranked = with_rank(with_rank(df.select(a, b), a, "_ra"), b, "_rb")
    return ranked.agg(F.count(F.lit(1)).alias("n"), correlation("_ra", "_rb").alias("spearman"))


def bucket_spearman(df: DataFrame, a: str, b: str, buckets: list[tuple[int, int]]) -> DataFrame:
    """(lo, hi, n, spearman) over rows whose rank by b, best first, is in [lo, hi); ranks anew inside; n > 2."""
    ranked = with_rank(df.select(a, b), b, "_place", descending=True)
    place = F.floor("_place")
    bounds = F.array(*[F.struct(F.lit(lo).cast("long").alias("lo"), F.lit(hi).cast("long").alias("hi")) for lo, hi in buckets])
    rows = ranked.withColumn("x", F.explode(F.filter(bounds, lambda x: (place >= x.lo) & (place < x.hi)))).select(a, b, F.col("x.lo").alias("lo"), F.col("x.hi").alias("hi"))
    inner = with_rank(with_rank(rows, a, "_ra", by="lo"), b, "_rb", by="lo")
    return inner.groupBy("lo", "hi").agg(F.count(F.lit(1)).alias("n"), correlation("_ra", "_rb").alias("spearman")).where("n > 2")


def inversions(values) -> int:
    """Pairs i < j with values[i] > values[j], by merging blocks of doubling size in numpy."""
    import numpy as np

    v = np.unique(np.asarray(values), return_inverse=True)[1].astype(np.int64)
    n = 1 << max(0, int(len(v) - 1).bit_length())
    top = len(v) + 1
    v = np.concatenate([v, np.full(n - len(v), top - 1)])
    total, half = 0, 1
    while half < n:
        blocks = v.reshape(-1, 2 * half)
        shift = np.arange(len(blocks), dtype=np.int64)[:, None] * top
        left, right = (blocks[:, :half] + shift).ravel(), (blocks[:, half:] + shift).ravel()
        not_above = np.searchsorted(left, right, side="right") - np.repeat(np.arange(len(blocks)) * half, half)
        total += int((half - not_above).sum())
        v = np.sort(blocks, axis=1).ravel()
        half *= 2
    return total


def tau_b(x, y) -> float:
    """Kendall's tau-b of two numpy arrays in n log n; nan if one of them is constant."""
    import numpy as np

    x = np.unique(np.asarray(x), return_inverse=True)[1]
    y = np.unique(np.asarray(y), return_inverse=True)[1]

    def tied(*columns):
        _, c = np.unique(np.stack(columns), axis=1, return_counts=True)
        return int((c.astype(np.int64) * (c - 1) // 2).sum())

    n = len(x)
    pairs = n * (n - 1) // 2
    order = np.lexsort((y, x))
    discordant = inversions(y[order])
    tx, ty, txy = tied(x), tied(y), tied(x, y)
    concordant = pairs - tx - ty + txy - discordant
    bottom = ((pairs - tx) * (pairs - ty)) ** 0.5
    return (concordant - discordant) / bottom if bottom else float("nan")


def weighted_inversions(values, weights) -> int:
    """Sum of weight products over i < j with values[i] > values[j], by merging blocks of doubling size in numpy."""
    import numpy as np

    v = np.unique(np.asarray(values), return_inverse=True)[1].astype(np.int64)
    top, n = len(v) + 1, 1 << max(0, int(len(v) - 1).bit_length())
    v = np.concatenate([v, np.full(n - len(v), top - 1)])
    w = np.concatenate([np.asarray(weights, np.int64), np.zeros(n - len(weights), np.int64)])
    total, half = 0, 1
    while half < n:
        v, w = v.reshape(-1, 2 * half), w.reshape(-1, 2 * half)
        shift = np.arange(len(v), dtype=np.int64)[:, None] * top
        sums = np.concatenate([[0], np.cumsum(w[:, :half].ravel())])
        up_to = np.searchsorted((v[:, :half] + shift).ravel(), (v[:, half:] + shift).ravel(), side="right")
        ends = np.repeat((np.arange(len(v)) + 1) * half, half)
        total += int((w[:, half:].ravel() * (sums[ends] - sums[up_to])).sum())
        order = np.argsort(v, axis=1, kind="stable")
        v, w = np.take_along_axis(v, order, axis=1).ravel(), np.take_along_axis(w, order, axis=1).ravel()
        half *= 2
    return total


def kendall(df: DataFrame, a: str, b: str, block_rows: int = 1_000_000) -> float:
    """tau-b over all rows: in one piece up to block_rows rows, beyond it in blocks, with the same result. Rows with a null don't count."""
    import numpy as np

    rows = df.select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")).where("a is not null and b is not null")
    if rows.count() > block_rows:
        return kendall_in_blocks(rows, block_rows)
    got = rows.toArrow()
    return tau_b(np.asarray(got.column("a")), np.asarray(got.column("b")))


def kendall_in_blocks(rows: DataFrame, block_rows: int) -> float:
    """tau-b of (a, b). Rows are dealt into blocks of about block_rows neighbours by a, and as well by b.

    Discordant pairs are counted in three parts: in different blocks both by a and by b, from the
    numbers of rows in each pair of blocks; in one block by a; in one block by b but two by a. Equal
    pairs are one row with a count. A value that has more rows than a block is a block of its own,
    in which no pair can be discordant.
    """
    import numpy as np

    def block(first, count):
        return F.floor(first / block_rows) * 2 + F.when(count > block_rows, 1).otherwise(0)

    def halves(counts):
        return F.coalesce(F.sum(counts.cast("decimal(38,0)") * (counts - 1) / 2), F.lit(0)).cast("decimal(38,0)")

    sides = {}
    for c in ("a", "b"):
        sides[c] = snapshot(placed(rows, c), "places").select(F.col("_score").alias(f"_{c}"), block(F.col("_first"), F.col("_c")).alias(f"block_{c}"), F.col("_c").alias(f"n_{c}"))
    pairs = rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    for c in ("a", "b"):
        pairs = pairs.join(sides[c].drop(f"n_{c}"), F.col(c) == F.col(f"_{c}")).drop(f"_{c}")
    pairs = snapshot(pairs, "pairs")

    def inside(key: str, order: str, value: str) -> int:
        def count(table):
            t = table.sort_by([(order, "ascending"), (value, "ascending")])
            return pa.table({"d": pa.array([weighted_inversions(t.column(value).to_numpy(), t.column("n").to_numpy())], pa.int64())})

        counts = pairs.where(F.col(key) % 2 == 0).groupBy(key).applyInArrow(count, "d long")
        return int(counts.agg(F.coalesce(F.sum(F.col("d").cast("decimal(38,0)")), F.lit(0))).first()[0])

    grid = pairs.groupBy("block_a", "block_b").agg(F.sum("n").alias("n")).toArrow()
    x, y = (np.unique(grid.column(c).to_numpy(), return_inverse=True)[1] for c in ("block_a", "block_b"))
    cells = np.zeros((x.max() + 1, y.max() + 1), object)
    cells[x, y] = [int(n) for n in grid.column("n").to_pylist()]
    later = np.zeros((cells.shape[0] + 1, cells.shape[1] + 1), object)  # rows in later blocks by a and earlier ones by b
    later[:-1, 1:] = cells[::-1].cumsum(axis=0)[::-1].cumsum(axis=1)
    discordant = int((cells * later[1:, :-1]).sum()) + inside("block_a", "a", "b") + inside("block_b", "block_a", "b")
    n = int(sum(cells.ravel()))
    tied = {c: int(sides[c].agg(halves(F.col(f"n_{c}"))).first()[0]) for c in ("a", "b")}
    both = int(pairs.agg(halves(F.col("n"))).first()[0])
    total = n * (n - 1) // 2
    concordant = total - tied["a"] - tied["b"] + both - discordant
    bottom = math.sqrt(total - tied["a"]) * math.sqrt(total - tied["b"])
    return (concordant - discordant) / bottom if bottom else float("nan")


def top_jaccard(df: DataFrame, a: str, b: str, ks: list[int], key: str = "domain") -> DataFrame:
    """(k, jaccard) of the k best of both rankings, ties by key."""
    out = None
    for k in ks:
        left = df.orderBy(F.desc(a), key).limit(k).select(key)
        right = df.orderBy(F.desc(b), key).limit(k).select(key, F.lit(1).alias("_hit"))
        row = left.join(right, key, "left").agg(F.lit(k).cast("long").alias("k"), (F.count("_hit") / (2 * F.count(F.lit(1)) - F.count("_hit"))).alias("jaccard"))
        out = row if out is None else out.unionByName(row)
    return out


def rbo(df: DataFrame, a: str, b: str, p: float = 0.99, depth: int = 100_000, key: str = "domain") -> DataFrame:
    """One row: rbo, the truncated rank-biased overlap (1-p) * sum of overlap_i / i * p^(i-1), i up to depth.

    Only the depth best of each ranking are numbered, so the running sum is over at most depth rows.
    """
    left = numbered(df.orderBy(F.desc(a), key).limit(depth).select(key, a), F.desc(a), F.asc(key), name="_l").select(key, "_l")
    right = numbered(df.orderBy(F.desc(b), key).limit(depth).select(key, b), F.desc(b), F.asc(key), name="_r").select(key, "_r")
    met = left.join(right, key).groupBy(F.greatest("_l", "_r").alias("i")).agg(F.count(F.lit(1)).alias("c"))
    most = left.agg(F.max("_l").alias("most"))
    depths = most.select(F.explode(F.sequence(F.lit(1), "most")).alias("i"))
    run = F.sum(F.coalesce("c", F.lit(0))).over(W.orderBy("i").rowsBetween(W.unboundedPreceding, 0))
    terms = depths.join(met, "i", "left").select("i", run.alias("overlap"))
    return terms.agg((F.lit(1 - p) * F.sum(F.col("overlap") / F.col("i") * F.pow(F.lit(p), F.col("i") - 1))).alias("rbo"))


def displacement(df: DataFrame, a: str, b: str, hosts: str | None = None) -> DataFrame:
    """One row: median and p90 of |difference of ranks|, truncated average ranks, best first; with hosts, its Spearman with the difference."""
    ranked = with_rank(with_rank(df, a, "_ra", descending=True), b, "_rb", descending=True)
    rows = ranked.withColumn("_d", F.floor("_ra") - F.floor("_rb"))
    cuts = quantiles(rows.select(F.abs("_d").alias("d")), "d", [0.5, 0.9])
    out = df.sparkSession.createDataFrame([tuple(cuts)], "median_abs_delta double, p90_abs_delta double")
    return out if hosts is None else out.crossJoin(spearman(rows, "_d", hosts).select(F.col("spearman").alias("delta_vs_hosts")))


def auc(df: DataFrame, score: str, positive: str) -> DataFrame:
    """One row: n_pos, n_neg, auc = U / (n_pos * n_neg) from average ranks; null without both kinds."""
    ranked = with_rank(df.select(score, positive), score, "_r")
    pos = F.count_if(F.col(positive))
    neg = F.count_if(~F.col(positive))
    u = F.sum(F.when(F.col(positive), F.col("_r"))) - pos * (pos + 1) / 2
    return ranked.agg(pos.alias("n_pos"), neg.alias("n_neg"), F.try_divide(u, (pos * neg).cast("double")).alias("auc"))


def decile_rates(df: DataFrame, score: str, positive: str, min_rows: int = 10) -> DataFrame:
    """(decile, n, rate) with decile 1 the highest scores; cut at exact percentiles, equal cuts merged; no rows below min_rows."""
    if df.limit(min_rows).count() < min_rows:
        return df.select(F.lit(0).cast("long").alias("decile"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("rate")).limit(0)
    cuts = sorted({c for c in quantiles(df, score, [i / 10 for i in range(1, 10)]) if c is not None})
    above = sum([(F.col(score) > c).cast("int") for c in cuts], F.lit(0))
    n_cuts = len(cuts)
    return df.groupBy((F.lit(n_cuts + 1) - above).cast("long").alias("decile")).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(positive).cast("double")).alias("rate")).orderBy("decile")


def share_in_top(df: DataFrame, score: str, names: list[str], k: int, key: str = "domain") -> DataFrame:
    """One row: share of the k best that are in a list."""
    return df.orderBy(F.desc(score), key).limit(k).agg(F.avg(F.col(key).isin(names).cast("double")).alias("share"))


def rank_profile(df: DataFrame, a: str, b: str, ks: list[int] = (100, 1000, 10_000), p: float = 0.99, depth: int = 100_000, hosts: str | None = None) -> dict:
    """All agreement measures of two scores over one table of (domain, a, b)."""
    n = df.count()
    if n < 2:
        raise ValueError(f"a rank profile needs at least 2 rows, got {n}")
    out = {"n": n, "spearman": spearman(df, a, b).first().spearman, "kendall_tau_b": kendall(df, a, b), "rbo": rbo(df, a, b, p, depth).first().rbo}
    out["top_jaccard"] = {r.k: r.jaccard for r in top_jaccard(df, a, b, [k for k in ks if k <= n] or [n]).collect()}
    return out | displacement(df, a, b, hosts).first().asDict()


def trust_profile(df: DataFrame, score: str, trust: str, k: int = 1000, social: list[str] = ()) -> dict:
    """How a score agrees with a trust reference: AUC of trust > 0, tau-b, Spearman over positives, decile rates."""
    if df.count() < 2:
        raise ValueError("a trust profile needs at least 2 rows")
    marked = df.withColumn("_pos", F.col(trust) > 0)
    positives = df.where(F.col(trust) > 0)
    return {
        "auc": auc(marked, score, "_pos").first().auc,
        "kendall_tau_b": kendall(df, score, trust),
        "spearman_positive": spearman(positives, score, trust).first().spearman,
        "decile_rates": [r.rate for r in decile_rates(marked, score, "_pos").collect()],
        "social_share": share_in_top(df, score, list(social), k).first().share,
    }


def ladder_fit(points: DataFrame, x: str, y: str) -> DataFrame:
    """One row: n, slope, intercept, r2, stderr, slope_low and slope_high (1.96 standard errors)."""
    sums = points.agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"), F.regr_sxx(y, x).alias("_sxx"), F.regr_syy(y, x).alias("_syy")
    )
    residual = F.greatest(F.col("_syy") - F.col("slope") * F.col("slope") * F.col("_sxx"), F.lit(0.0))
    err = F.when(F.col("n") > 2, F.sqrt(F.try_divide(residual / (F.col("n") - 2), F.col("_sxx")))).otherwise(F.lit(0.0))
    out = sums.withColumn("stderr", err)
    return out.select("n", "slope", "intercept", "r2", "stderr", (F.col("slope") - 1.96 * F.col("stderr")).alias("slope_low"), (F.col("slope") + 1.96 * F.col("stderr")).alias("slope_high"))


def predict_ladder(points: DataFrame, x: str, y: str, at: float) -> tuple[dict, float, list[str]]:
    """Fit, prediction at a size, and warnings (fewer than 3 points, r2 under 0.95)."""
    if points.count() < 2:
        raise ValueError("a fit needs at least 2 points")
    fit = ladder_fit(points, x, y).first().asDict()
    warnings = [w for w, on in (("fewer than 3 points", fit["n"] < 3), ("r2 below 0.95", (fit["r2"] or 0) < 0.95)) if on]
    return fit, fit["slope"] * at + fit["intercept"], warnings
