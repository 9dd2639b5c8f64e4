"""The factors of substring dedup (9): documents come back from literals and factors."""

from __future__ import annotations

import random

from webloom.llm import substring_dedup
from webloom.llm.common import words_of


def pasted(seed: int, n_docs: int = 40):
    rng = random.Random(seed)
    sources = [[f"s{k}w{rng.randrange(60)}" for _ in range(200)] for k in range(4)] + [["a", "b"] * 60, ["z"] * 90]
    docs = []
    for i in range(n_docs):
        w = []
        for _ in range(rng.randint(1, 5)):
            s = rng.choice(sources)
            a = rng.randrange(len(s))
            w += s[a : a + rng.randint(1, 90)]
            if rng.random() < 0.5:
                w.append(f"own{i}x{len(w)}")
        docs.append((i, " ".join(w)))
    return docs


def test_parse_is_greedy():
    # runs of windows (lo, hi, place) with a window of 5 words
    assert substring_dedup.parse([], 5) == []
    assert substring_dedup.parse([(4, 6, 100), (0, 3, 96)], 5) == [(0, 11, 96)]  # goes on in the reference
    assert substring_dedup.parse([(0, 3, 96), (4, 6, 300)], 5) == [(0, 8, 96), (8, 3, 304)]  # another reference: what is parsed stays
    assert substring_dedup.parse([(0, 3, 96), (5, 6, 101)], 5) == [(0, 8, 96), (8, 3, 104)]  # a window between them isn't shared
    assert substring_dedup.parse([(0, 0, 7), (20, 22, 7)], 5) == [(0, 5, 7), (20, 7, 7)]


def test_factors_and_literals_give_documents_back(spark):
    for seed in range(2):
        docs = pasted(seed)
        words = {i: words_of(t) for i, t in docs}
        rows = substring_dedup.remove_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), window=12, gram=5).collect()
        assert len(rows) == len(docs) and sum(r.n_removed for r in rows) > 0
        for r in rows:
            factors = r.factors or []
            literals = words_of(r.kept_text) if r.kept_text is not None else [] if r.n_removed else words[r.doc_id]
            out, used = [], 0
            for start, n, ref_id, ref_start in factors:
                assert ref_id < r.doc_id and n > 0
                gap = start - len(out)
                out += literals[used : used + gap]
                used += gap
                out += words[ref_id][ref_start : ref_start + n]
            assert out + literals[used:] == words[r.doc_id]
            assert sum(f.n for f in factors) == r.n_removed


def test_a_long_copy_is_one_factor(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(900)]
    docs = [(1, " ".join(base)), (2, " ".join(["x"] + base[100:700] + ["y"])), (3, " ".join(base))]
    got = {r.doc_id: [tuple(f) for f in r.factors or []] for r in substring_dedup.remove_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: [], 2: [(1, 600, 1, 100)], 3: [(0, 900, 1, 0)]}


def test_odd_ids_and_repeated_ids(spark):
    rng = random.Random(6)
    base = " ".join(f"w{rng.randrange(5000)}" for _ in range(80))
    other = " ".join(f"v{rng.randrange(5000)}" for _ in range(80))
    docs = [(-5, base), (-5, other), (7, base + " " + other), (None, other), ((1 << 63) - 2, base)]
    rows = substring_dedup.remove_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in rows), key=repr)
    assert got == sorted([(-5, 80, 0), (-5, 80, 0), (7, 160, 160), (None, 80, 80), ((1 << 63) - 2, 80, 80)], key=repr)
    seven = next(r for r in rows if r.doc_id == 7)
    assert [(f.start, f.n, f.ref_id, f.ref_start) for f in seven.factors] == [(0, 80, -5, 0), (80, 80, -5, 0)]
