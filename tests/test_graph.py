"""PageRank, graph validation, degrees, seeds."""

from __future__ import annotations

import math

import pytest

from webloom.errors import DataSourceError
from webloom.operators import graph, seeds
from webloom.operators.pagerank import power_iteration


def nodes(spark, n):
    return spark.range(n)


def edges(spark, *pairs):
    return spark.createDataFrame(list(pairs), "from_id long, to_id long")


def ranks(df):
    return {r.id: r.rank for r in df.collect()}


def dense(pairs, n, d, steps, w=None):
    """Plain power iteration over lists."""
    w = w or [1 / n] * n
    out = [sum(a == i for a, _ in pairs) for i in range(n)]
    r = list(w)
    for _ in range(steps):
        flow = [0.0] * n
        for a, b in pairs:
            flow[b] += r[a] / out[a]
        lost = 1 - sum(flow)
        r = [((1 - d) + d * lost) * w[i] + d * flow[i] for i in range(n)]
    return r


def test_mass_and_order(spark):
    got = ranks(power_iteration(edges(spark, (1, 0), (2, 0), (2, 1)), nodes(spark, 3), max_iter=30, tol=1e-9))
    assert got[0] > got[1] > got[2] and sum(got.values()) == pytest.approx(1)


@pytest.mark.parametrize("every", [0, 1, 4, 50])
def test_equals_plain_iteration(spark, every):
    pairs = [(0, 1), (0, 1), (1, 2), (2, 0), (3, 3), (3, 0), (4, 2)]  # parallel edges, a self-loop, a dangling node 5
    got = ranks(power_iteration(edges(spark, *pairs), nodes(spark, 6), max_iter=9, tol=0, checkpoint_every=every))
    assert [got[i] for i in range(6)] == pytest.approx(dense(pairs, 6, 0.85, 9))


def test_heavy_sources_change_nothing(spark, monkeypatch):
    from webloom.operators import pagerank

    pairs = [(0, i) for i in range(1, 30)] + [(0, 1)] * 3 + [(i, 0) for i in range(1, 20)] + [(2, 3)]
    monkeypatch.setattr(pagerank, "LEAST_HEAVY", 5)
    monkeypatch.setattr(pagerank.shares, "__defaults__", (5,))
    light, heavy = pagerank.shares(edges(spark, *pairs), graph.out_degrees(edges(spark, *pairs)), 3)
    assert {r.from_id for r in heavy.collect()} == {0} and 0 not in {r.from_id for r in light.collect()}
    got = ranks(power_iteration(edges(spark, *pairs), nodes(spark, 30), max_iter=6, tol=0))
    assert [got[i] for i in range(30)] == pytest.approx(dense(pairs, 30, 0.85, 6))


def test_resume_needs_every_node(spark):
    e, some = edges(spark, (0, 1), (1, 2), (2, 0)), spark.createDataFrame([(0, 0.5), (1, 0.5)], "id long, rank double")
    with pytest.raises(ValueError, match="start lacks 1 nodes"):
        power_iteration(e, nodes(spark, 3), max_iter=2, tol=0, start=some)
    half = power_iteration(e, nodes(spark, 3), max_iter=3, tol=0)
    whole = ranks(power_iteration(e, nodes(spark, 3), max_iter=7, tol=0))
    assert ranks(power_iteration(e, nodes(spark, 3), max_iter=4, tol=0, start=half)) == pytest.approx(whole)


def test_personalised(spark):
    t = spark.createDataFrame([(0, 1.0)], "id long, w double")
    got = ranks(power_iteration(edges(spark, (0, 1)), nodes(spark, 4), max_iter=50, tol=1e-10, teleport=t))
    assert got[3] < 1e-6 and sum(got.values()) == pytest.approx(1)
    assert [got[i] for i in range(4)] == pytest.approx(dense([(0, 1)], 4, 0.85, 50, [1, 0, 0, 0]), abs=1e-6)


def test_dangling_mass_goes_to_the_seed(spark):
    t = spark.createDataFrame([(0, 1.0)], "id long, w double")
    got = ranks(power_iteration(edges(spark, (0, 1)), nodes(spark, 3), max_iter=3, tol=0, teleport=t))
    assert got[2] < 1e-9


def test_stops_at_tolerance_and_resumes(spark):
    e, n = edges(spark, (0, 1), (1, 2), (2, 0), (0, 2)), nodes(spark, 4)
    whole = power_iteration(e, n, max_iter=6, tol=0)
    half = power_iteration(e, n, max_iter=3, tol=0)
    assert ranks(power_iteration(e, n, max_iter=3, tol=0, start=half)) == pytest.approx(ranks(whole))
    assert ranks(power_iteration(e, n, max_iter=100, tol=2.0)) == pytest.approx(ranks(power_iteration(e, n, max_iter=1, tol=0)))


@pytest.mark.parametrize(("rows", "said"), [([(0, 0.6)], "normalized"), ([(0, None)], "null/NaN"), ([(0, float("nan"))], "null/NaN"), ([(0, -0.5), (1, 1.5)], "negative"), ([(0, 0.5), (0, 0.5)], "duplicate"), ([(9, 1.0)], "outside")])
def test_bad_teleports(spark, rows, said):
    t = spark.createDataFrame(rows, "id long, w double")
    with pytest.raises(ValueError, match=said):
        power_iteration(edges(spark, (0, 1)), nodes(spark, 3), max_iter=1, tol=0, teleport=t)


def test_guards(spark):
    e = edges(spark, (0, 1))
    for args, said in (({"damping": 1.0}, "damping"), ({"max_iter": 0}, "max_iter")):
        with pytest.raises(ValueError, match=said):
            power_iteration(e, nodes(spark, 2), **({"max_iter": 1, "tol": 0} | args))
    with pytest.raises(ValueError, match="no nodes"):
        power_iteration(e, nodes(spark, 0), max_iter=1, tol=0)


@pytest.mark.parametrize(
    ("rows", "said"),
    [([], "none"), ([(0, "a"), (0, "b")], "duplicate"), ([(0, "a"), (2, "b")], "dense"), ([(1, "a"), (2, "b")], "dense"), ([(0, "a"), (1, "a")], "domains are duplicate"), ([(0, "a"), (1, None)], "blank"), ([(0, "a"), (1, " ")], "blank"), ([(0, "a"), (None, "b")], "null or duplicate")],
)
def test_bad_vertices(spark, rows, said):
    with pytest.raises(DataSourceError, match=said):
        graph.validate_vertices(spark.createDataFrame(rows, "id long, domain string"))


def test_good_graph(spark):
    v = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "id long, domain string")
    assert graph.validate_vertices(v, 3) == 3
    assert graph.validate_edges(edges(spark, (0, 1), (1, 2)), 3) == 2
    with pytest.raises(DataSourceError, match="declared"):
        graph.validate_vertices(v, 4)
    for pair in ((0, 3), (-1, 0), (None, 1)):
        with pytest.raises(DataSourceError, match="edges"):
            graph.validate_edges(edges(spark, pair), 3)


def test_degrees(spark):
    got = {r.id: (r.in_degree, r.out_degree) for r in graph.degrees(nodes(spark, 4), edges(spark, (0, 1), (0, 2), (1, 2))).collect()}
    assert got == {0: (0, 2), 1: (1, 1), 2: (2, 0), 3: (0, 0)}


def test_collapse_has_dense_ordered_ids(spark):
    m = spark.createDataFrame([(0, "b.com"), (1, "b.com"), (2, "a.com"), (3, None), (4, "c.com")], "id long, domain string")
    v, e = graph.collapse(edges(spark, (0, 1), (0, 2), (1, 2), (2, 4), (3, 4)), m)
    assert sorted((r.id, r.domain) for r in v.collect()) == [(0, "a.com"), (1, "b.com"), (2, "c.com")]
    assert sorted(map(tuple, e.collect())) == [(0, 2), (1, 0)]


def seed(spark, *rows):
    return spark.createDataFrame(list(rows), "domain string, consensus double")


def test_seed_weights(spark):
    got = {r.domain: r.w for r in seeds.seed_weights(seed(spark, ("a.com", 0.9), ("b.org", 0.5), ("x.net", None))).collect()}
    assert got == pytest.approx({"a.com": 1.0, "b.org": 1 / math.log2(3)})
    got = [(r.domain, r.rank) for r in seeds.seed_weights(seed(spark, ("b", 0.5), ("a", 0.5), ("c", 0.9), ("c", 0.1)), size=2).orderBy("rank").collect()]
    assert got == [("c", 1), ("a", 2)]


@pytest.mark.parametrize("rows", [[("a", None)], [(None, 0.5)], [(" ", 0.5)], [("a", float("nan"))], [("a", -0.5)]])
def test_malformed_seeds(spark, rows):
    with pytest.raises(DataSourceError):
        seeds.seed_weights(seed(spark, *rows))


def test_score_weights_need_a_positive_score(spark):
    with pytest.raises(DataSourceError, match="positive"):
        seeds.seed_weights(seed(spark, ("a", 0.0)), "score")
    with pytest.raises(ValueError, match="unknown"):
        seeds.seed_weights(seed(spark, ("a", 1.0)), "other")


def test_teleport_vector(spark):
    v = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "id long, domain string")
    w = spark.createDataFrame([("a", 3.0), ("c", 1.0), ("z", 9.0)], "domain string, w double")
    assert {r.id: r.w for r in seeds.teleport_vector(w, v).collect()} == {0: 0.75, 2: 0.25}
    with pytest.raises(DataSourceError, match="none"):
        seeds.teleport_vector(w.where("domain = 'z'"), v)
    assert seeds.seed_coverage(w, v).first().asDict() == {"n_seed": 3, "n_on_graph": 2, "coverage": 2 / 3}
