"""Packing (1), token files (2) and the tokenising both share."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from webloom.llm import arrow_files, packing, tokens
from webloom.llm.common import new_dir

pytest.importorskip("public_tokenizers")
VOCABULARY = tokens.default_vocabulary()


def direct(text):
    return np.asarray(tokens.encoder(VOCABULARY).tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4")


@pytest.mark.parametrize("text", ["", "It's a b\tc  d\n\ne", "they'RE ''s 'S a'b'll'd 12+34=46!!!", "ÀÉ×÷ß ŸİΣΑΣ é ́x １２ ½ x\x1cy  z", "a<|endoftext|>b", "…–— “q” 中文 🙂 ªº µ ſ K", "x" * 5000])
def test_parts_encode_like_the_whole_text(text):
    assert tokens.encoder(VOCABULARY).encode(text) == direct(text).tobytes()


def test_encoding_of_real_documents(spark, sf):
    for (text,) in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(60).collect():
        assert tokens.encoder(VOCABULARY).encode(text) == direct(text).tobytes()


def test_table_of_parts_stays_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PARTS", 10)
    monkeypatch.setattr(tokens, "KEPT_PIECES", 10)
    e = tokens.TextEncoder(VOCABULARY)
    for i in range(200):
        e.encode(f"word{i} again")
    assert len(e.parts) <= 11 and len(e.parts.old) <= 11 and len(e.parts.pieces) <= 11


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(rule):
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 101, 600)
    bins, offsets = packing.best_fit(lengths, 100, 5, 4000, weights=(1.0, 0.3, 0.3), rule=rule)
    for b in set(bins.tolist()):
        mine = lengths[bins == b]
        assert mine.sum() <= 100 and len(mine) <= 5
        assert (mine**2).sum() <= 4000 or len(mine) == 1
        order = np.argsort(offsets[bins == b])
        assert (np.cumsum(mine[order]) - mine[order] == offsets[bins == b][order]).all()


def test_best_fit_is_near_the_bound():
    lengths = np.random.default_rng(4).integers(1, 2000, 3000)
    bins, _ = packing.best_fit(lengths, 4096, 4096, 4096 * 4096)
    assert bins.max() + 1 <= 1.01 * np.ceil(lengths.sum() / 4096)


def test_fullest_fitting_sequence_is_chosen():
    # 60 and 70 stay open; 30 leaves nothing beside 70 and 10 beside 60
    bins, _ = packing.best_fit(np.array([70, 60, 30]), 100, 9, 10**9)
    assert bins[2] == bins[0]


def check_packing(rows, docs, capacity):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    assert set(by_doc) == {d for d, _ in docs}
    for doc_id, text in docs:
        ids = np.append(direct(text), 1).astype("<u4")
        pieces = sorted((r for r in by_doc[doc_id]), key=lambda r: (r.piece, r.ids_crc32))
        want = [(p, at, len(ids[at : at + capacity]), zlib.crc32(ids[at : at + capacity].tobytes())) for p, at in enumerate(range(0, len(ids), capacity))]
        assert {(r.piece, r.start, r.length, r.ids_crc32) for r in pieces} >= set(want)


def test_shards_follow_pieces_and_repeated_rows_are_spread(spark):
    text = "word " * 3000
    docs = spark.createDataFrame([(1, text)] * 40 + [(None, None)] * 30, "doc_id long, text string").repartition(2)
    rows = packing.pack_documents(docs, VOCABULARY, capacity=64, shard_pieces=200).collect()
    shards = {}
    for r in rows:
        shards[r.sequence_id >> 32] = shards.get(r.sequence_id >> 32, 0) + 1
    assert len(rows) == 40 * 47 + 30 and len(shards) >= 10 and max(shards.values()) < 400


def test_capacities_bind_without_more_sequences():
    """All three capacities hold, and an even spread of pieces costs next to no sequence."""
    rng = np.random.default_rng(9)
    for lengths in (rng.integers(1, 2000, 4000), np.minimum(rng.geometric(1 / 600, 4000), 4096), np.ones(5000, np.int64), rng.integers(1, 30, 6000)):
        limits = packing.capacities(lengths, 4096, None, None, 8.0)
        bins, _ = packing.best_fit(lengths, *limits)
        count = np.bincount(bins)
        cost = np.bincount(bins, weights=lengths.astype(float) ** 2)
        assert np.bincount(bins, weights=lengths).max() <= 4096 and count.max() <= limits[1] and cost.max() <= limits[2]
        assert bins.max() + 1 <= 1.01 * np.ceil(lengths.sum() / 4096) + 1
    assert packing.capacities(np.full(100, 41), 4096, None, None, 1.0)[1] == 64 + 50
    bins, _ = packing.best_fit(np.array([50, 50, 1, 1, 1, 1]), 100, 2, 10_000)  # documents bind
    assert np.bincount(bins).tolist() == [2, 2, 2]
    bins, _ = packing.best_fit(np.array([60, 30, 10]), 100, 9, 4000)  # attention binds
    assert bins.tolist() == [0, 1, 0]


def test_another_vocabulary_encodes_whole_texts(tmp_path):
    import json

    import public_tokenizers

    config = json.loads(open(public_tokenizers.path("word_bpe_49k.json")).read())
    config["normalizer"]["normalizers"].pop()  # keeps case
    (tmp_path / "v.json").write_text(json.dumps(config))
    e = tokens.TextEncoder(str(tmp_path / "v.json"))
    assert not e.words and tokens.encoder(VOCABULARY).words
    text = "Some Text's  words"
    assert e.encode(text) == np.asarray(e.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_packing_of_odd_rows(odd, clashing, nothing):
    rows = packing.pack_documents(odd, VOCABULARY, capacity=512, shard_pieces=20).collect()
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    check_packing(rows, docs, 512)
    assert sum(r.length for r in rows) == sum(len(direct(t)) + 1 for _, t in docs)
    assert packing.pack_documents(clashing, VOCABULARY, capacity=512).count() == len(rows)
    assert packing.pack_documents(nothing, VOCABULARY).count() == 0


@pytest.mark.parametrize("file_tokens", [1 << 26, 500])
def test_files_round_trip(odd, clashing, nothing, monkeypatch, file_tokens):
    import xxhash

    monkeypatch.setattr(arrow_files, "FILE_TOKENS", file_tokens)

    def hashed(text):
        h = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
        return h - (1 << 64) if h >> 63 else h

    rows = arrow_files.round_trip(odd, VOCABULARY, seq_len=64).collect()
    docs = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda d: (d[0] is not None, d[0] or 0, hashed(d[1])))
    start, want = 0, []
    for doc_id, text in docs:
        ids = np.append(direct(text), 2).astype("<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want
    assert arrow_files.round_trip(clashing, VOCABULARY).count() == len(want)
    assert arrow_files.round_trip(nothing, VOCABULARY).count() == 0


def test_random_access(spark, odd):
    path = new_dir(spark, "files")
    manifest = arrow_files.write_token_files(odd.where("doc_id = 6"), path, VOCABULARY, seq_len=16, files=1).collect()
    file = arrow_files.TokenFile(path, next(r.file for r in manifest if r.n_tokens))
    ids = np.append(direct(odd.where("doc_id = 6").first().text), 2)
    assert len(file) == -(-len(ids) // 16) and len(file) > arrow_files.BATCH
    for s in (0, 1, 255, 256, len(file) - 1):
        want = ids[s * 16 : (s + 1) * 16]
        assert (file.sequence(s)[: len(want)] == want).all()
        assert file.mask(s).to_pylist() == [True] * len(want) + [False] * (16 - len(want))
    base = file.batches[0].column("ids").values.buffers()[1]
    assert base.address <= file.sequence(3).__array_interface__["data"][0] < base.address + base.size  # a view, no copy
