"""Substring dedup by relative Lempel-Ziv parsing against content-defined reference blocks.

A window is `window` consecutive words. Each window has an anchor: among its k-grams of words the one
of least hash. Windows of one document that share an anchor lie side by side; the words they cover
are a block. So blocks cut the windows of a document into runs, by content alone, and a stretch that
two documents share falls into the same blocks in both, except at its ends.

Every block of every document is indexed under the place of its first occurrence: the smallest doc_id
that has it, and the first window there. A document is parsed from left to right, greedily: a block
that a smaller doc_id has starts a factor, and each next block, and then each next window, prolongs it
as long as its own reference goes on where the factor's ends. At a factor's boundaries, where the
shared stretch may reach into blocks that differ as a whole, those blocks are compared window by
window; that is needed only for blocks whose anchor another document has too. A factor is at least a
window long. Words of factors are duplicate spans; the other words are literals, and factors and
literals give the document back.

Why this finds every duplicate window: if a window also starts in other documents, let m be the
smallest. All of them have its anchor. In m its block can't be in a smaller document, so m's windows
there are compared one by one, and so are those of each document whose block isn't already a factor.

What travels is one short row for each block (about one for 18 words) and one for each window that is
compared; texts travel only to their own document's marks. All groups are folded to a minimum and a
maximum with partial sums before the shuffle; no group is gathered, and joins on hashes that very
many rows share are split by AQE. Stored steps go as soon as the next one is stored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import discard, free_shuffles, materialize, part_of, tune, words_of

WINDOW = 50
#: Words of a k-gram that can be an anchor.
GRAM = 16
#: Stands for a null doc_id: larger than any other.
LAST = (1 << 63) - 1

_BASE = 0x9E3779B97F4A7C15
_BASE2 = 0xC2B2AE3D27D4EB4F
_MASK = (1 << 64) - 1
#: Words a worker keeps the hash of.
KEPT_WORDS = 400_000

BLOCKS = "anchor long, block long, id long, sig long, lo int, hi int, n int, sha string"
#: Where a run of words starts: doc_id, then 31 bits of the text's hash, then its first word. A number of 126 bits.
PLACE = "cast(id as decimal(19,0)) * 9223372036854775808 + cast((sig & 2147483647L) * 4294967296L + lo as decimal(19,0))"
#: The place before all places of a doc_id.
BEFORE = "cast(id as decimal(19,0)) * 9223372036854775808"


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= KEPT_WORDS:
            self.clear()
        value = xxhash.xxh64_intdigest(word.encode())
        if len(word) <= 48:
            self[word] = value
        return value


_HASHES = _WordHashes()
_POWERS: dict = {}


def _powers(base: int, n: int):
    """base^0 ... base^n and the inverses, modulo 2^64."""
    import numpy as np

    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        size = max(4096, 2 * n)
        inverse = pow(base, -1, 1 << 64)
        have = _POWERS[base] = tuple(np.concatenate([[np.uint64(1)], np.full(size, b, np.uint64)]).cumprod(dtype=np.uint64) for b in (base, inverse))
    return have


def _mix(x):
    """A finaliser of 64-bit integers, in place of weak low bits."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Rolling:
    """Hashes of runs of words: equal runs have equal hashes wherever they stand."""

    def __init__(self, words: list[str], base: int = _BASE):
        import numpy as np

        n = len(words)
        hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
        up, self.down = _powers(base, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * up[:n], dtype=np.uint64, out=self.sums[1:])

    def run(self, lo, hi):
        """Hashes of words lo to hi, exclusive; arrays."""
        return _mix((self.sums[hi] - self.sums[lo]) * self.down[lo])


def blocks_of(words: list[str], window: int = WINDOW, gram: int = GRAM):
    """Anchor hash, block hash, first and last window of each block; None for a text of less than a window."""
    import numpy as np

    n = len(words)
    if n < window:
        return None
    rolling = _Rolling(words)
    at = np.arange(n - gram + 1)
    grams = rolling.run(at, at + gram)
    span = window - gram + 1
    anchors = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1) + np.arange(n - window + 1)
    cuts = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
    lo = np.concatenate([[0], cuts])
    hi = np.concatenate([cuts - 1, [n - window]])
    block = rolling.run(lo, hi + window) ^ _mix((hi - lo).astype(np.uint64))
    return grams[anchors[lo]].view(np.int64), block.view(np.int64), lo, hi


def signature(text: str | None) -> int:
    """Spark's xxhash64 of a text."""
    import xxhash

    h = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def _ids(batch) -> list[int]:
    return [LAST if i is None else i for i in batch.column(0).to_pylist()]


def index_blocks(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """A row for each block, and for each row of docs one of lo = -1 with its word count and hash."""

    def run(batches):
        import numpy as np

        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            shas: list[str | None] = []
            for doc_id, text in zip(_ids(batch), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                sig = signature(text)
                found = blocks_of(words, window, gram)
                count = 0 if found is None else len(found[0])
                head = [np.zeros(1, np.int64)] * 2 + [np.full(1, -1)] * 2
                for column, first, rest in zip((0, 1, 4, 5), head, found or [np.empty(0, np.int64)] * 4, strict=True):
                    columns[column] += [first, rest]
                for column, value in ((2, doc_id), (3, sig), (6, len(words))):
                    columns[column].append(np.full(count + 1, value, np.int64))
                shas += [hashlib.sha256(" ".join(words).encode()).hexdigest()] + [None] * count
            types = [pa.int64()] * 4 + [pa.int32()] * 3
            arrays = [pa.array(np.concatenate(c) if c else [], t) if c else pa.array([], t) for c, t in zip(columns, types, strict=True)]
            arrays = [a if a.type == t else a.cast(t) for a, t in zip(arrays, types, strict=True)]
            yield pa.record_batch([*arrays, pa.array(shas, pa.string())], names=["anchor", "block", "id", "sig", "lo", "hi", "n", "sha"])

    return docs.mapInArrow(run, BLOCKS)


def _first(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that two doc_ids or more have, and the place where each starts first."""
    least = rows.groupBy(*keys).agg(F.min(F.expr(PLACE)).alias("ref"), F.max(F.expr(BEFORE)).alias("most"))
    return least.where("ref < most").drop("most")


def factor_marks(blocks: DataFrame) -> DataFrame:
    """Blocks whose anchor is in two doc_ids or more: id, sig, lo, hi, n and ref, the block's place in a smaller doc_id or null."""
    shared = blocks.groupBy("anchor").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("anchor")
    shared = materialize(shared, "shared-anchors")  # stored, so that the join's sides are plain exchanges, which AQE can split
    near = materialize(blocks.join(shared, "anchor", "left_semi"), "shared-blocks")
    discard(shared, blocks)
    free_shuffles(blocks.sparkSession)
    first = materialize(_first(near, "anchor", "block"), "first-blocks")
    ref = F.when(F.col("ref") < F.expr(BEFORE), F.col("ref"))
    marks = materialize(near.join(first, ["anchor", "block"], "left").select("id", "sig", "lo", "hi", "n", ref.alias("ref")), "block-marks")
    discard(near, first)
    return marks


def compared_windows(marked: DataFrame, window: int) -> DataFrame:
    """A row for each window to compare: h, h2, id, sig, lo. marked: id, sig, text, marks."""

    def run(batches):
        import numpy as np

        for batch in batches:
            for doc_id, sig, text, marks in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                open_runs = [m for m in marks if m["ref"] is None]
                if not open_runs:
                    continue
                words = words_of(text)
                at = np.concatenate([np.arange(m["lo"], m["hi"] + 1) for m in open_runs])
                h = _Rolling(words).run(at, at + window).view(np.int64)
                h2 = (_Rolling(words, _BASE2).run(at, at + window) >> np.uint64(33)).astype(np.int32)
                yield pa.record_batch(
                    [pa.array(h), pa.array(h2), pa.array(np.full(len(at), doc_id, np.int64)), pa.array(np.full(len(at), sig, np.int64)), pa.array(at.astype(np.int32))],
                    names=["h", "h2", "id", "sig", "lo"],
                )

    return marked.select("id", "sig", "text", "marks").mapInArrow(run, "h long, h2 int, id long, sig long, lo int")


def parse(pieces: list[tuple[int, int, int]], window: int) -> list[tuple[int, int, int]]:
    """Greedy factors (first word, words, place of the reference) from matched runs of windows (lo, hi, place).

    Runs are disjoint. A factor goes on while the next run follows it both here and in the reference.
    Words that the factor before has already stay with that one.
    """
    factors: list[tuple[int, int, int]] = []
    end = 0  # words parsed so far
    low = high = place = None

    def close():
        nonlocal end
        if low is not None:
            start, stop = max(low, end), high + window
            factors.append((start, stop - start, place + start - low))
            end = stop

    for lo, hi, ref in sorted(pieces):
        if low is not None and lo == high + 1 and ref == place + lo - low:
            high = hi
        else:
            close()
            low, high, place = lo, hi, ref
    close()
    return factors


def matched_runs(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(rows, runs): rows has id, sig, n, sha for each row of docs; runs has id, sig, text and pieces.

    pieces: array of (lo, hi, ref), runs of windows that also start, at place ref, in a smaller doc_id.
    text is null where the pieces cover every word.
    """
    spark = docs.sparkSession
    tune(spark)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), F.col("text").cast("string").alias("text"))
    indexed = index_blocks(texts, window, gram).withColumn("head", F.col("lo") < 0)
    stored = materialize(indexed, "blocks", "head")
    rows = part_of(stored, "head=true", "id long, sig long, n int, sha string")
    marks = factor_marks(part_of(stored, "head=false", "anchor long, block long, id long, sig long, lo int, hi int, n int"))
    run = F.struct("lo", "hi", "ref")
    by_doc = marks.groupBy("id", "sig", "n").agg(F.array_sort(F.array_distinct(F.collect_list(run))).alias("marks"))
    covered = F.aggregate(F.filter("marks", lambda m: m.ref.isNotNull()), F.lit(0), lambda s, m: s + m.hi - m.lo + 1)
    by_doc = materialize(by_doc.withColumn("whole", covered == F.col("n") - (window - 1)), "marks")
    discard(marks)
    parts = by_doc.where("not whole").select("id", "sig", "marks")
    marked = materialize(texts.join(parts, (texts.id == parts.id) & (F.xxhash64("text") == parts.sig)).select(parts.id, parts.sig, "text", "marks").dropDuplicates(["id", "sig"]), "marked-texts")
    free_shuffles(spark)
    windows = materialize(compared_windows(marked, window), "windows")
    first = materialize(_first(windows, "h", "h2"), "first-windows")
    free_shuffles(spark)
    hits = windows.join(first, ["h", "h2"]).where(F.col("ref") < F.expr(BEFORE)).groupBy("id", "sig").agg(F.collect_set(F.struct("lo", F.col("lo").alias("hi"), "ref")).alias("hits"))
    hits = materialize(hits, "window-hits")
    discard(windows, first)
    factors = F.filter("marks", lambda m: m.ref.isNotNull())
    partly = marked.join(hits, ["id", "sig"], "left").select("id", "sig", "text", F.when(F.col("hits").isNull(), factors).otherwise(F.concat(factors, "hits")).alias("pieces"))
    wholly = by_doc.where("whole").select("id", "sig", F.lit(None).cast("string").alias("text"), F.col("marks").alias("pieces"))
    return rows, partly.where(F.size("pieces") > 0).unionByName(wholly)


FACTOR = "array<struct<start: int, n: int, ref_id: long, ref_start: int>>"


def remove_duplicates(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (null where nothing or everything was removed), kept_sha256, factors for each row.

    factors: (start, n, ref_id, ref_start), the words that are also words ref_start on of document
    ref_id; null where there are none. Null and blank texts have no words. A null doc_id counts as
    larger than all others; rows of one doc_id never remove each other's words. Repeated rows come out
    once each; of rows of one doc_id, a 64-bit hash tells texts apart. No rows: no rows.
    """
    rows, runs = matched_runs(docs, window, gram)

    def cut(batches):
        factor = pa.struct([("start", pa.int32()), ("n", pa.int32()), ("ref_id", pa.int64()), ("ref_start", pa.int32())])
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(factor))
        for batch in batches:
            out: list[list] = [[] for _ in types]
            for doc_id, sig, text, pieces in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                factors = parse([(p["lo"], p["hi"], int(p["ref"])) for p in pieces], window)
                if text is None:
                    kept = ""
                else:
                    words, literals, at = words_of(text), [], 0
                    for start, n, _ in factors:
                        literals += words[at:start]
                        at = start + n
                    kept = " ".join(literals + words[at:])
                listed = [{"start": a, "n": n, "ref_id": place >> 63, "ref_start": place & 0xFFFFFFFF} for a, n, place in factors]
                for column, value in zip(out, (doc_id, sig, sum(n for _, n, _ in factors), kept, hashlib.sha256(kept.encode()).hexdigest(), listed), strict=True):
                    column.append(value)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["id", "sig", "n_removed", "kept", "kept_sha", "factors"])

    removed = runs.mapInArrow(cut, f"id long, sig long, n_removed long, kept string, kept_sha string, factors {FACTOR}")
    return rows.join(removed, ["id", "sig"], "left").select(
        F.when(F.col("id") < LAST, F.col("id")).alias("doc_id"),
        F.col("n").cast("long").alias("n_words"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.col("kept").alias("kept_text"),
        F.coalesce("kept_sha", "sha").alias("kept_sha256"),
        "factors",
    )


#: The same for DuckDB: every window as text.
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ')) AS k
  FROM d, unnest(range(1, len(w) - {WINDOW - 2})) AS u(i)
), f AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS m FROM g) WHERE m < doc_id
), p AS (
  SELECT DISTINCT doc_id, i + j AS pos FROM f, unnest(range(0, {WINDOW})) AS u(j)
), x AS (
  SELECT d.doc_id, i AS pos, list_extract(w, i) AS word FROM d, unnest(range(1, len(w) + 1)) AS u(i)
), y AS (
  SELECT x.doc_id, count(p.pos) AS n_removed, string_agg(word, ' ' ORDER BY x.pos) FILTER (WHERE p.pos IS NULL) AS kept
  FROM x LEFT JOIN p ON x.doc_id = p.doc_id AND x.pos = p.pos GROUP BY x.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN y ON d.doc_id = y.doc_id
"""
