"""corpus_pipeline.py against a version of plain loops, stage by stage and as a whole."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.test_duplicates import brute_fp, brute_groups
from tests.llm.test_text_operators import brute_lines, brute_measures
from webloom.llm import decontaminate, quality, tokens
from webloom.llm.common import materialize

pytest.importorskip("public_tokenizers")


def good(text) -> bool:
    """The base rules and the threshold table, written out."""
    n_words, chars, n_symbols, n_dup_lines, n_repeat = brute_measures(text)
    if n_words < 20 or 100 * n_repeat > 30 * n_words:
        return False
    plain = re.split(r"[ .,;:!?\"()\t\n\x0b\x0c\r]", text.lower())
    solid = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    shares = {
        "mean_word_chars": chars / n_words,
        "symbols_per_word": n_symbols / n_words,
        "shouts_per_word": text.count("!") / n_words,
        "stop_word_share": sum(w in set(quality.STOP_WORDS) for w in plain) / n_words,
        "dup_line_share": n_dup_lines / len(solid),
    }
    return all((r.low is None or shares[r.metric] >= r.low) and (r.high is None or shares[r.metric] <= r.high) for r in quality.RULES)


def leaks(text, items) -> bool:
    """Whether any window of any item's length is a copy or a paraphrase of it."""
    w = decontaminate.normal_words(text)
    for item in items:
        n, size = len(item.words), decontaminate.window_length(len(item.words))
        for at in range(0, max(1, len(w) - size + decontaminate.BLOCK), decontaminate.BLOCK):
            part = w[at : at + size]
            lcs = decontaminate.lcs_length(item.masks, part, n) / n
            if lcs >= 0.8 or (lcs >= 0.6 and decontaminate.lcs_length(item.answer_masks, part, len(item.answer)) >= 0.8 * len(item.answer)):
                return True
    return False


def brute_stages(docs, items):
    """Rows (doc_id, text) after each stage but the last."""
    docs = [d for d in docs if good(d[1] or "")]
    yield docs
    docs = [(i, text) for i, _, _, text in brute_lines(docs)]
    yield docs
    groups = brute_groups([brute_fp(t) for _, t in sorted(docs)])
    docs = [d for k, (d, g) in enumerate(zip(sorted(docs), groups, strict=True)) if k == g]
    yield docs
    yield [d for d in docs if not leaks(d[1], items)]


def test_pipeline_against_brute_force(spark, sf):
    import corpus_pipeline

    frame = spark.read.parquet(f"{sf}/documents.parquet")
    items = [decontaminate.Item(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    names = frame.columns
    rest = {r.doc_id: (r.lang, r.source) for r in frame.collect()}
    want = brute_stages([(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()], items)
    sizes = [frame.count()]
    for (name, stage), rows in zip(corpus_pipeline.STAGES[:-1], want, strict=True):
        frame = materialize(stage(spark, frame, sf), "stage")
        got = frame.collect()
        assert frame.columns == names, name
        assert sorted((r.doc_id, r.text) for r in got) == sorted(rows), name
        assert all((r.lang, r.source) == rest[r.doc_id] for r in got)
        sizes.append(len(got))
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] > sizes[4] > 0

    packed = corpus_pipeline.run(spark, sf).collect()
    tokenizer = tokens.encoder(tokens.default_vocabulary()).tokenizer
    pieces, total = Counter(), 0
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            pieces[i, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == pieces
    sequences: dict = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(sequences) <= math.ceil(total / 4096) + 2


@pytest.mark.parametrize("kind", ["odd", "clashing", "nothing"])
def test_pipeline_on_odd_rows(spark, sf, kind, request):
    """Other columns come through all stages as they are, and rows of one doc_id with different texts stay."""
    import corpus_pipeline

    docs = request.getfixturevalue(kind)
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    rows = {repr(tuple(r)) for r in docs.select(*others).collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, docs, sf), "stage")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert {repr(tuple(r)) for r in out.select(*others).collect()} <= rows
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.columns[:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_different_texts_of_one_id_all_come_through(spark, sf):
    import corpus_pipeline

    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(3)]
    docs = spark.createDataFrame([(1, texts[0], "en", "a", 1), (1, texts[1], "en", "b", 1), (None, texts[2], "en", "c", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf), "stage")
    assert sorted((r.doc_id or 0, r.text) for r in docs.collect()) == sorted([(1, texts[0]), (1, texts[1]), (0, texts[2])])
