"""SimHash (6), substring dedup (9), decontamination (4) and components."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from webloom.llm import decontaminate, simhash, substring_dedup
from webloom.llm.components import components


def brute_fp(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(values):
    """Smallest index of each index's group, linking at 4 or fewer differing bits."""
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_fingerprints(odd):
    for r in odd.where("doc_id <> 6").collect():
        assert simhash.fingerprint(r.text) == brute_fp(r.text)


def test_grid_misses_nothing():
    """Any two fingerprints within 4 bits share a cell, whatever bits differ."""
    rng = random.Random(2)
    for n in range(400):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 1 + n % 4):
            b ^= 1 << bit
        rows, keys = simhash.cells_of(np.array([a, b], np.uint64).view(np.int64))
        assert set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist())


def test_popcount_distance_is_a_lower_bound():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(2**63), 2**63 - 1, 500), rng.integers(-(2**63), 2**63 - 1, 500)
    manhattan = np.abs(simhash.popcounts(a).astype(int) - simhash.popcounts(b).astype(int)).sum(axis=1)
    assert (manhattan <= np.bitwise_count((a ^ b).view(np.uint64))).all()


def test_links_connect_like_brute_force(spark):
    rng = random.Random(7)
    seeds = [rng.getrandbits(64) for _ in range(15)]
    values = set(seeds)
    for s in seeds:  # chains and clouds
        x = s
        for _ in range(25):
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << bit
            values.add(x)
            if rng.random() < 0.4:
                x = s
    values = sorted(values)
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    distinct = spark.createDataFrame(list(zip(signed, range(len(values)), strict=True)), "fp long, node long").repartition(3)
    got = {r.node: r.component for r in components(simhash.links(distinct)).collect()}
    assert [got.get(i, i) for i in range(len(values))] == brute_groups(values)


def test_near_duplicates_of_odd_rows(odd, clashing, nothing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    values = [brute_fp(t) for _, t in docs]
    group = brute_groups(values)
    least = {}
    for (i, _), g in zip(docs, group, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    want = sorted(((i, v, least.get(g)) for (i, _), v, g in zip(docs, values, group, strict=True)), key=repr)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in rows), key=repr) == want
    kept = simhash.first_of_groups(clashing)
    assert kept.columns == clashing.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=repr) == sorted([least.get(g) for g in set(group)], key=repr)
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.first_of_groups(nothing).count() == 0


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_components(spark, kind):
    rng = random.Random(3)
    edges = {"chain": [(i, i + 1) for i in range(300)], "star": [(0, i) for i in range(1, 300)], "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]}[kind]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges + edges[:5], "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


# ---- substrings ---------------------------------------------------------------------------------


def brute_substrings(docs, window):
    first, words = {}, []
    order = lambda i: (i is None, i or 0)
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        words.append(w)
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            if g not in first or order(i) < order(first[g]):
                first[g] = i
    out = []
    for (i, _), w in zip(docs, words, strict=True):
        gone = {k + j for k in range(len(w) - window + 1) if order(first[tuple(w[k : k + window])]) < order(i) for j in range(window)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got_substrings(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr)


def test_substrings_of_odd_rows(odd, clashing, nothing):
    want = brute_substrings([(r.doc_id, r.text) for r in odd.collect()], 50)
    assert got_substrings(substring_dedup.remove_duplicates(odd)) == want
    assert sum(r[2] for r in want) > 0
    assert got_substrings(substring_dedup.remove_duplicates(clashing)) == want
    assert substring_dedup.remove_duplicates(nothing).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_substrings_of_pasted_texts(spark, seed):
    """Pieces of a few sources pasted together in any order: many partial, nested and adjoining copies."""
    rng = random.Random(seed)
    sources = [[f"s{k}w{rng.randrange(60)}" for _ in range(200)] for k in range(4)] + [["a", "b"] * 60, ["z"] * 90]
    docs = []
    for i in range(40):
        w = []
        for _ in range(rng.randint(1, 5)):
            s = rng.choice(sources)
            a = rng.randrange(len(s))
            w += s[a : a + rng.randint(1, 90)]
            if rng.random() < 0.5:
                w.append(f"own{i}x{len(w)}")
        docs.append((i, " ".join(w)))
    got = got_substrings(substring_dedup.remove_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), window=12, gram=5))
    assert got == brute_substrings(docs, 12)


# ---- benchmark ----------------------------------------------------------------------------------


def test_lcs_length():
    rng = random.Random(4)
    for _ in range(300):
        a, b = [rng.choice("abcd") for _ in range(rng.randint(1, 12))], [rng.choice("abcde") for _ in range(rng.randint(0, 12))]
        row = [0] * (len(a) + 1)
        for y in b:
            new = [0]
            for i, x in enumerate(a):
                new.append(row[i] + 1 if x == y else max(new[i], row[i + 1]))
            row = new
        assert decontaminate.lcs_length(decontaminate._masks(a), b, len(a)) == row[-1]


def _prose(rng, n):
    return " ".join(f"c{rng.randrange(20)}" if rng.random() < 0.3 else f"w{rng.randrange(3000)}" for _ in range(n))


def _planted(spark, seed=9):
    rng = random.Random(seed)
    items = [(i, _prose(rng, rng.randint(15, 60)) + ". " + _prose(rng, 8) + ".") for i in range(40)]
    docs, leaks = [], set()
    for i in range(200):
        w = _prose(rng, rng.randint(30, 600)).split()
        if i % 4 == 0:
            item = items[(i // 4) % 40]
            copy = item[1].split()
            if i % 8 == 4:  # a paraphrase: some words changed, the answer kept
                for k in rng.sample(range(len(copy) - 9), len(copy) // 8):
                    copy[k] = f"other{k}"
            at = rng.randrange(len(w))
            w[at:at] = copy
            leaks.add((i, item[0]))
        docs.append((i, " ".join(w)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), docs, items, leaks


def test_word_tables_hold_normal_words(odd):
    texts = [r.text for r in odd.collect()] + ["'a' -- (b) ...", "--", " x", "ÀÉ.Σ ΑΣ, \u00a0y\x1cz \u2028 İ", "q" * 50 + "!", None, "a\n\nb\x0bc"]
    got = []
    for base, table in decontaminate.word_tables(texts):
        assert base == len(got)
        firsts = table.first.tolist()
        features = table.features().tolist()
        for low, high in zip(firsts, firsts[1:], strict=False):
            words = table.words(low, high)
            got.append(words)
            assert features[low:high] == [int(decontaminate.WordTable([w.encode()]).features()[0]) for w in words[:500]] + features[low + 500 : high]
    assert got == [decontaminate.normal_words(t) for t in texts]


def test_items_in_blocks(spark, monkeypatch):
    """Several blocks of items, several passes and tables of a text each find what one of each finds."""
    docs, benchmark, *_, leaks = _planted(spark)
    monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", 3)
    monkeypatch.setattr(decontaminate, "ITEMS_A_PASS", 17)
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, benchmark).collect()} == leaks


def test_planted_leaks_are_found_and_nothing_else(spark):
    docs, benchmark, _, _, leaks = _planted(spark)
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert got == leaks
    kept = {r.doc_id for r in decontaminate.remove_contaminated(docs, benchmark).collect()}
    assert kept == set(range(200)) - {i for i, _ in leaks}


def test_search_finds_what_brute_force_finds(spark, sf):
    """Recall of the latent search against verifying every window with every item."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, benchmark).collect()}
    items = [decontaminate.Item(r.item_id, r.text) for r in benchmark.collect()]
    want = set()
    for doc_id, text in docs.collect():
        w = decontaminate.normal_words(text)
        for item in items:
            n, size = len(item.words), decontaminate.window_length(len(item.words))
            for at in range(0, max(1, len(w) - size + decontaminate.BLOCK), decontaminate.BLOCK):
                part = w[at : at + size]
                lcs = decontaminate.lcs_length(item.masks, part, n) / n
                if lcs >= 0.8 or (lcs >= 0.6 and decontaminate.lcs_length(item.answer_masks, part, len(item.answer)) >= 0.8 * len(item.answer)):
                    want.add((doc_id, item.item_id))
                    break
    assert got == want


def test_copies_in_foreign_text_are_found_like_by_brute_force(spark):
    """Short items and items of common words, whose windows' cosines are low beside rare words."""
    rng = random.Random(3)
    common = [f"c{i}" for i in range(20)]
    items = [(n * 10 + j, " ".join(rng.choice(common) if j else f"s{n}x{i}" for i in range(n))) for n in (1, 2, 3, 4, 5, 6, 7) for j in range(3)]
    items += [(100 + i, " ".join(rng.choice(common) for _ in range(rng.randint(8, 50)))) for i in range(12)] + [(200, _prose(rng, 300))]
    docs = [(i, _prose(rng, 300)) for i in range(40)]
    for i in range(4 * len(items)):
        w = [f"rare{i}x{j}" for j in range(rng.choice([0, 5, 40, 300]))]
        at = rng.randint(0, len(w))
        docs.append((100 + i, " ".join(w[:at] + items[i % len(items)][1].split() + w[at:])))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.lcs for r in decontaminate.contaminated(*frames).collect()}
    copies = {(d, i) for d, text in docs for i, item in items if f" {item} " in f" {text} "}
    assert copies - got.keys() == set()
    assert {(d, i) for d, i in got if i < 100} == {(d, i) for d, i in copies if i < 100}
    assert all(got[x] == 1 for x in copies)


@pytest.mark.parametrize("fit", [100, 20])
def test_recall_of_a_sampled_index(spark, monkeypatch, fit):
    """Copies and paraphrases are found with an index fitted on few documents; document frequencies are of all."""
    docs, benchmark, rows, _, leaks = _planted(spark)
    given, fitted = [], decontaminate.latent_space
    monkeypatch.setattr(decontaminate, "FIT_DOCUMENTS", fit)
    monkeypatch.setattr(decontaminate, "latent_space", lambda texts, idf: given.append((texts.count(), idf)) or fitted(texts, idf))
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs.repartition(5), benchmark).collect()}
    assert got == leaks
    n, counts = 0, np.zeros(decontaminate.FEATURES)
    for _, text in rows:
        w = decontaminate.normal_words(text)
        for at in range(0, len(w), decontaminate.PASSAGE):
            n += 1
            counts[list({int(decontaminate.WordTable([x.encode()]).features()[0]) for x in w[at : at + decontaminate.PASSAGE]})] += 1
    assert 0 < given[0][0] < 200 and np.allclose(given[0][1], np.log((1 + n) / (1 + counts)))


def test_benchmark_odd_rows(spark, odd, clashing, nothing):
    base = odd.where("doc_id = 0").first().text
    benchmark = spark.createDataFrame([(1, " ".join(base.split()[20:60]), "x"), (2, None, "x"), (3, "", "x"), (4, "of", "x"), (1, " ".join(base.split()[20:60]), "y")], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(odd, benchmark).collect()}
    assert {(0, 1), (4, 1), (5, 1), (13, 1)} <= got
    assert {i for _, i in got} <= {1, 4}
    left = decontaminate.remove_contaminated(clashing, benchmark)
    assert left.columns == clashing.columns
    assert decontaminate.contaminated(nothing, benchmark).count() == 0
    assert decontaminate.contaminated(odd, benchmark.limit(0)).count() == 0
