"""Line dedup by sorted hash ranges, in DataFrame functions only.

Every line of at least `min_chars` code points gives a short row: the 128-bit hash of its key, its
document and its position; texts don't travel. Rows are dealt by ranges of the hash and sorted by
document, largest first, then position. Streaming through a key, the first document is the one that
keeps its lines.

A key that a third of all rows hold would fill one range. So the first pass deals by (hash, salt of
the document): rows past the third document of a salted group are surely dropped, and only the three
largest documents of each group, some dozens for the hottest key, go on to the second pass, which
deals by the hash alone and decides about them.

Short rows are stored once, and so are their ranks, so lines are cut and hashed in one scan. Marks go
back to texts by a join, but only texts that a bitmap of marked documents lets through are shuffled
for it. The bitmap has FILTER_BITS bits, whatever the data's size; it may let more documents through,
never fewer, and the join decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from webloom.llm.common import SPACE_CHARS, discard, materialize, part_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SALTS = 32
#: Bits of the filter of marked documents: 8 MB, the most that is ever broadcast.
FILTER_BITS = 1 << 26


def lines_of(text: Column) -> Column:
    """Lines of a text; null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without ASCII white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE_CHARS)), UPPER, LOWER)


def _runs(positions: str) -> str:
    """SQL: ascending positions as runs (at, len), a run-length form of the bitmap of dropped lines."""
    starts = "filter(sequence(0, size(p) - 1), i -> i = 0 or get(p, i) <> get(p, i - 1) + 1)"
    runs = "transform(s, (i, k) -> named_struct('at', get(p, i), 'len', coalesce(get(s, k + 1), size(p)) - i))"
    return f"transform(array({positions}), p -> transform(array({starts}), s -> {runs})[0])[0]"


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Documents that lose lines: doc_id, text_hash, dropped (runs of line positions).

    min_docs is 2 or more. Rows with one doc_id count as one document; text_hash tells their texts
    apart. A null doc_id counts as a document smaller than all others.
    """
    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.posexplode(F.transform(lines_of(F.col("text")), line_key)).alias("pos", "key"))
    rows = keys.where(F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "text_hash", "pos", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt")
    )
    newest = [F.col("doc_id").desc_nulls_last()]
    salted = W.partitionBy("h1", "h2", "salt").orderBy(*newest)
    stored = materialize(rows, "line-rows")
    ranked = stored.repartitionByRange("h1", "h2", "salt").sortWithinPartitions("h1", "h2", "salt", *newest, "pos").withColumn("rank", F.dense_rank().over(salted))
    parted = materialize(ranked.select("h1", "h2", "doc_id", "text_hash", "pos", (F.col("rank") > min_docs).alias("sure")), "line-ranks", "sure")
    discard(stored)
    names = "h1 long, h2 long, doc_id long, text_hash long, pos int"
    sure, open_rows = part_of(parted, "sure=true", names), part_of(parted, "sure=false", names)
    whole = W.partitionBy("h1", "h2")
    merged = (
        open_rows.repartitionByRange("h1", "h2")
        .sortWithinPartitions("h1", "h2", *newest, "pos")
        .withColumn("rank", F.dense_rank().over(whole.orderBy(*newest)))
        .withColumn("n_docs", F.max("rank").over(whole))
    )
    decided = merged.where((F.col("rank") > 1) & (F.col("n_docs") >= min_docs))
    dropped = sure.select("doc_id", "text_hash", "pos").union(decided.select("doc_id", "text_hash", "pos"))
    gathered = dropped.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("positions"))
    marks = materialize(gathered.select("doc_id", "text_hash", F.expr(_runs("positions")).alias("dropped")), "line-marks")
    discard(parted)
    return marks


def _slot(doc_id: Column, text_hash: Column) -> Column:
    """A document's bit of the filter, from 1."""
    return F.pmod(F.xxhash64(doc_id, text_hash), F.lit(FILTER_BITS)) + 1


def _sifted(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """rows (id, hash, ...) with maybe: false only where marks has no such document."""
    slot = _slot(F.col("doc_id"), F.col("text_hash"))
    bits = marks.groupBy(F.bitmap_bucket_number(slot).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits"))
    place = F.bitmap_bit_position("_slot").cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    maybe = F.coalesce(F.expr("1") == F.call_function("shiftright", byte, F.pmod(place, F.lit(8))).bitwiseAND(F.lit(1)), F.lit(False))
    sought = rows.withColumn("_slot", _slot(F.col("id"), F.col("hash"))).withColumn("_bucket", F.bitmap_bucket_number("_slot"))
    return sought.join(F.broadcast(bits), "_bucket", "left").withColumn("maybe", maybe).drop("_slot", "_bucket", "_bits")


def _cut(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """row (all columns of docs), text (kept), n_lines, n_dropped."""
    marks = keep_bitmaps(docs, min_chars, min_docs)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"), F.col("text").alias("text"))
    sifted = _sifted(rows, marks)
    sought = sifted.where("maybe")
    joined = sought.join(marks, sought["id"].eqNullSafe(marks["doc_id"]) & (sought["hash"] == marks["text_hash"]), "left").select("row", "text", "dropped")
    clear = sifted.where("not maybe").select("row", "text", F.lit(None).cast(marks.schema["dropped"].dataType).alias("dropped"))
    lines = "split(text, '\n', -1)"
    gone = "flatten(transform(dropped, r -> sequence(r.at, r.at + r.len - 1)))"
    kept = f"transform(array({lines}), l -> array_join(transform(array_except(sequence(0, size(l) - 1), {gone}), i -> get(l, i)), '\n'))[0]"
    text = F.expr(f"case when dropped is null then text else {kept} end")
    n_dropped = F.expr("coalesce(aggregate(dropped, 0L, (n, r) -> n + r.len), 0L)")
    n_lines = F.size(lines_of(F.col("text"))).cast("long")
    return joined.unionByName(clear).select("row", text.alias("text"), n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))


def _columns(names: list[str]) -> list[Column]:
    return [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in names]


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All columns of docs with the kept text, and n_lines and n_dropped of the input text.

    Keys in at least min_docs documents stay only in the largest doc_id that holds them. Null text
    stays null and counts as one empty line. Repeated rows: each keeps what its document keeps. An
    empty table gives no rows. Columns named like those added here are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return _cut(docs, min_chars, min_docs).select(*_columns(names), "n_lines", "n_dropped")


def drop_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """docs with the kept text and its other columns as they are, whatever their names."""
    return _cut(docs, min_chars, min_docs).select(*_columns(docs.columns))


#: The same for DuckDB, in terms of the contract.
ORACLE = r"""
WITH lines AS (
  SELECT doc_id, i AS pos, list_extract(parts, i) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) d,
       unnest(range(1, len(parts) + 1)) AS u(i)
), keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), hot AS (
  SELECT key, max(doc_id) AS last_id FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.pos, k.line, h.key IS NOT NULL AND k.doc_id <> h.last_id AS gone
  FROM keyed k LEFT JOIN hot h ON k.key = h.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
