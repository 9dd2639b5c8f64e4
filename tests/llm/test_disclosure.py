"""The information-theoretic part of personal data (3) against a brute-force version."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHES, DOCS
from webloom.llm import pii

REACH, THRESHOLD, CHANCE = 8, 0.95, 0.01


def brute(texts):
    """(entity value, term) pairs that disclose, from all texts (repeats included), by plain loops."""
    near, seen_in, around, total, count = Counter(), defaultdict(set), Counter(), 0, Counter()
    for text in texts:
        terms = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\x20\x09-\x0D.,;:!?\"()]+", text or "")]
        total += len(terms)
        count.update(t for *_, t in terms)
        spans = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text or "")]
        free = [x for x in terms if not any(s < x[1] and x[0] < e for s, e, _ in spans)]
        for s, e, value in spans:
            picked = [t for a, b, t in free if b <= s][-REACH:] + [t for a, b, t in free if a >= e][:REACH]
            for t in picked:
                near[value.lower(), t] += 1
                seen_in[value.lower(), t].add(text)
                around[value.lower()] += 1
    out = set()
    for (e, t), n in near.items():
        information = math.log2(total / around[e])
        mutual = information + math.log2(min(1, n / count[t]))
        k, m = len(seen_in[e, t]), count[t] * around[e] / total
        if k > m and information > 0 and mutual >= THRESHOLD * information and math.exp(k - m) * (m / k) ** k * total * len(around) < CHANCE:
            out.add((e, t))
    return out


def planted(seed: int):
    """Texts of a common vocabulary; some addresses have a secret word beside them, all have rare words beside them once."""
    rng = random.Random(seed)
    common = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    texts, secrets = [], set()
    for e in range(30):
        secret = f"secret{e}" if e % 3 else None
        for k in range(rng.randint(4, 9)):
            w = [rng.choice(common) for _ in range(rng.randint(30, 90))]
            at = rng.randrange(len(w))
            w[at:at] = [f"Person{e}@mail.org", *([secret.title()] if secret else []), f"rare{e}x{k}"]
            texts.append(" ".join(w))
        if secret:
            secrets.add(secret)
    texts += [" ".join(rng.choice(common) for _ in range(400)) for _ in range(150)]
    texts += [f"here is secret{e} again without an address" for e in (1, 2, 4)] + [texts[0]] * 20  # copies
    rng.shuffle(texts)
    return texts, secrets


@pytest.mark.parametrize("seed", [1, 2])
def test_disclosing_pairs_are_those_of_brute_force(spark, seed):
    texts, secrets = planted(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = {t for _, t in brute(texts)}
    rows = pii.find_personal_data(docs).collect()
    got, spanned = set(), Counter()
    for r in rows:
        for k, s, e in (x.split(":") for x in r.spans.split(",") if x):
            if k == "term":
                got.add(texts[r.doc_id][int(s) : int(e)].lower())
                spanned[texts[r.doc_id][int(s) : int(e)].lower()] += 1
    assert got == want
    occurrences = Counter(m[0].lower() for t in texts for m in re.finditer(r"[^\x20\x09-\x0D.,;:!?\"()]+", t))
    assert all(spanned[t] == occurrences[t] for t in got)  # every occurrence, beside the address or not
    assert len(got & secrets) >= 0.95 * len(secrets)  # recall of the planted terms
    assert len(got & secrets) >= 0.95 * len(got)  # precision: rare and common words stay


@pytest.mark.parametrize("broadcast_up_to", [50_000, 0])
def test_counts_of_terms(spark, broadcast_up_to):
    docs = spark.createDataFrame([("A b, a É",), (None,), ("é a-b\n(a)",), ("",)], "text string").repartition(3)
    terms = spark.createDataFrame([("a",), ("é",), ("none",)], "term string")
    got = {r.term: r.n for r in pii.term_counts(docs, terms, broadcast_up_to).collect()}
    assert got == {None: 7, "a": 3, "é": 2}


def test_odd_rows_with_spans(spark):
    secret = "Zorblax same@y.org 10.0.0.1"
    rows = [(i, f"{secret} n{i}", "en", "a", 1) for i in range(40)]
    rows += [(None, f"{secret} x", None, None, None)] * 3 + [(7, f"zorblax again", "en", "a", 1)] * 2 + [(None, None, None, None, None), (8, "", "en", "a", 0)]
    rows += [(1000 + i, "filler text of the corpus " * 400, "en", "a", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3).select("*", *[F.lit(f"clash {c}").alias(c) for c in CLASHES])
    out = pii.find_personal_data(docs).collect()
    assert len(out) == len(rows)
    base = "email:8:18,ip:19:27"
    assert sorted(r.spans for r in out if r.doc_id is None) == ["", *[f"{base},term:0:7"] * 3]
    assert sorted(r.spans for r in out if r.doc_id == 7) == sorted([f"{base},term:0:7", "term:0:7", "term:0:7"])
    clean = pii.sanitize(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert {(r.text, r.spans, r.crc) for r in clean.where("doc_id = 7 and n_chars = 1").collect()} == {("[...] again", "clash spans", "clash crc"), ("[...] [EMAIL] [IP] n7", "clash spans", "clash crc")}
