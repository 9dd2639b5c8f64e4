"""SimHash near-dedup (6): full cells and which row of a group stays."""

from __future__ import annotations

import time

import numpy as np

from webloom.llm import simhash
from webloom.llm.components import components

from tests.llm.conftest import prose


def one_cell(n: int, seed: int = 1):
    """Distinct fingerprints of one own cell of the first part (a bit of each pair of its bits), some of them close."""
    rng = np.random.default_rng(seed)
    high = rng.integers(0, 1 << 18, n, np.uint64)
    first = np.zeros(n, np.uint64)
    for j in range(18):
        first |= np.uint64(1) << (np.uint64(28 + 2 * j) + (high >> np.uint64(j) & np.uint64(1)))
    fps = first | rng.integers(0, 1 << 28, n, np.uint64)
    fps[n // 2 :] = fps[: n - n // 2] ^ (np.uint64(1) << rng.integers(0, 28, n - n // 2, np.uint64))  # each other one bit from one of these
    return np.unique(fps).view(np.int64)


def groups_of(fps):
    """Smallest index of each one's group by comparing all with all."""
    values, parent = fps.view(np.uint64), list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= simhash.DISTANCE).tolist():
            a, b = find(i), find(i + 1 + j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_groups_of_bits_lose_no_link():
    rng = np.random.default_rng(3)
    for _ in range(300):
        a = int(rng.integers(0, 1 << 63))
        b = a
        for bit in rng.choice(64, 4, replace=False).tolist():
            b ^= 1 << bit
        assert any((a >> s) % (1 << n) == (b >> s) % (1 << n) for s, n in simhash.GROUPS)
    assert sum(n for _, n in simhash.GROUPS) == 64


def test_reached_cells_are_those_that_fingerprints_enter():
    fps = np.random.default_rng(4).integers(-(1 << 62), 1 << 62, 50)
    own = simhash.cells_of(fps, own_only=True)[1]
    assert len(own) == 100
    assert simhash.reached_cells(own).tolist() == np.unique(simhash.cells_of(fps)[1]).tolist()


def test_full_cells_are_split_without_loss(spark):
    fps = one_cell(4000)
    distinct = spark.createDataFrame([(int(x), i) for i, x in enumerate(fps.tolist())], "fp long, node long").repartition(3)
    assert simhash.full_cells(distinct, 100_000) is None
    want = groups_of(fps)
    for full in (200, 100_000):
        got = {r.node: r.component for r in components(simhash.links(distinct, full)).collect()}
        assert [got.get(i, i) for i in range(len(fps))] == want


def test_a_large_cell_takes_bounded_time():
    fps = one_cell(100_000)
    began = time.process_time()
    a, b = simhash._linked(fps, np.arange(len(fps)))
    assert time.process_time() - began < 60  # comparing all with all takes several times as long
    assert len(a) >= len(fps) // 3 and (np.bitwise_count((fps[a] ^ fps[b]).view(np.uint64)) <= 4).all()


def test_repeated_ids_keep_every_text(spark):
    one, two, three = (prose(80, i) for i in (71, 72, 73))
    rows = [(1, one, "a"), (1, two, "b"), (1, two, "b"), (2, one, "c"), (2, three, "d"), (None, three, "e"), (None, "only here", "f"), (None, "only here", "f"), (1, two, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string").repartition(4)
    kept = sorted(((r.doc_id, r.text, r.component) for r in simhash.first_of_groups(docs).collect()), key=repr)
    twos = {x for x in rows if x[1] == two}
    assert [x for x in kept if x[1] != two] == sorted([(1, one, "a"), (2, three, "d"), (None, "only here", "f")], key=repr)
    assert len(kept) == 4 and set(kept) & twos
    again = sorted(((r.doc_id, r.text, r.component) for r in simhash.first_of_groups(docs.repartition(2)).collect()), key=repr)
    assert again == kept
