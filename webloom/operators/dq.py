"""Data-quality tests: each is a plan that counts offending rows; all of a table's run in few passes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Test:
    name: str
    kind: str  # unique, not_null or between
    columns: tuple[str, ...]
    low: float | None = None
    high: float | None = None
    where: str | None = None


def unique(*columns: str) -> Test:
    return Test(f"unique({','.join(columns)})", "unique", columns)


def not_null(column: str) -> Test:
    return Test(f"not_null({column})", "not_null", (column,))


def between(column: str, low: float | None = None, high: float | None = None, where: str | None = None) -> Test:
    return Test(f"between({column},{low},{high})", "between", (column,), low, high, where)


def violations(df: DataFrame, test: Test) -> DataFrame:
    """Offending rows (row tests) or keys (unique)."""
    if test.kind == "unique":
        return df.groupBy(*test.columns).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
    return df.where(_bad(test))


def _bad(test: Test):
    c = F.col(test.columns[0])
    if test.kind == "not_null":
        return c.isNull()
    bad = F.lit(False)
    if test.low is not None:
        bad = bad | (c < test.low)
    if test.high is not None:
        bad = bad | (c > test.high)
    return F.coalesce(bad & F.expr(test.where), F.lit(False)) if test.where else F.coalesce(bad, F.lit(False))


def run_tests(df: DataFrame, tests: list[Test]) -> DataFrame:
    """(test, failures) of each test. Row tests share one aggregation; each key test is one more."""
    row_tests = [t for t in tests if t.kind != "unique"]
    parts = []
    if row_tests:
        counts = df.agg(*[F.count_if(_bad(t)).alias(f"t{i}") for i, t in enumerate(row_tests)])
        pairs = F.explode(F.array(*[F.struct(F.lit(t.name).alias("test"), F.col(f"t{i}").alias("failures")) for i, t in enumerate(row_tests)])).alias("x")
        parts.append(counts.select(pairs).select("x.*"))
    for t in tests:
        if t.kind == "unique":
            parts.append(violations(df, t).agg(F.lit(t.name).alias("test"), F.count(F.lit(1)).alias("failures")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("test", "failures")


def assert_none(df: DataFrame, tests: list[Test]) -> None:
    """AssertionError that names each failed test."""
    failed = [(r.test, r.failures) for r in run_tests(df, tests).where("failures > 0").collect()]
    if failed:
        raise AssertionError("; ".join(f"{t}: {n}" for t, n in failed))
