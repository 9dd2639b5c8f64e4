"""Best-fit packing of tokenised documents into sequences with several capacities.

A sequence has three residual capacities: tokens, number of documents, attention cost (the sum of
squared piece lengths). Pieces go in by descending length. Among the open sequences that can take a
piece under every capacity, the one with the smallest weighted norm of what would be left is chosen,
or, by the other rule, the one with the largest weighted dot product of piece and residual.

Pieces are dealt by hash into shards and each shard is packed alone, so the number of sequences
exceeds that of one global packing by about one for each shard. There are as many shards as it takes
for a shard to get about SHARD_PIECES pieces at most, whatever the texts' lengths: no text has more
pieces than one and its bytes divided by the capacity.

Capacities that are not given follow from the shard's own pieces: a sequence takes up to `spread`
times the documents and the attention cost that an even spread would give it, so that short pieces
don't crowd into a few sequences, and never less than one largest piece needs.
"""

from __future__ import annotations

import math
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import tune
from webloom.llm.tokens import encoder

#: Pieces of a shard, about, at most.
SHARD_PIECES = 16384
#: Documents that a sequence takes whatever the spread.
LEAST_DOCUMENTS = 64

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, shard long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, shards: int) -> DataFrame:
    """Tokenise every text, append end_id, cut only what is longer than capacity; a row for each piece."""

    def run(batches):
        encode = encoder(vocabulary).encode
        end = end_id.to_bytes(4, "little")
        task, row = TaskContext.get().partitionId(), 0  # so that repeated rows fall into many shards
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text) + end
                row += 1
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    crc = zlib.crc32(part)
                    shard = zlib.crc32(b"%d:%d:%d:%d" % (crc, piece, task, row)) % shards
                    for column, value in zip(out, (doc_id, piece, at // 4, len(part) // 4, crc, shard), strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "shard"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


def best_fit(lengths, capacity: int, max_documents: int, max_attention: int, weights=(1.0, 0.1, 0.1), rule: str = "norm"):
    """Sequence number and offset of each length. lengths: numpy integers of 1 to capacity.

    A length whose square exceeds max_attention gets a sequence of its own, as it fits nowhere.
    """
    import numpy as np

    n = len(lengths)
    lengths = np.asarray(lengths, np.int64)
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(n, np.int64)
    offsets = np.zeros(n, np.int64)
    total = np.array([capacity, max_documents, max_attention], float)
    scale = np.sqrt(np.asarray(weights, float)) / total
    room = np.empty((max(n, 1), 3))  # residuals of open sequences
    number = np.empty(max(n, 1), np.int64)  # their sequence numbers
    is_open = made = 0
    smallest = int(lengths.min()) if n else 0
    for i in order.tolist():
        size = int(lengths[i])
        need = np.array([size, 1, size * size], float)
        at = -1
        if is_open and size < capacity:
            left = room[:is_open] - need
            fits = np.flatnonzero((left >= 0).all(axis=1))
            if len(fits):
                if rule == "norm":
                    score = ((left[fits] * scale) ** 2).sum(axis=1)
                else:
                    score = -(room[fits] * (need * scale * scale)).sum(axis=1)
                at = int(fits[score.argmin()])
        if at < 0:
            at = is_open
            room[at], number[at] = total, made
            is_open, made = is_open + 1, made + 1
        bins[i], offsets[i] = number[at], capacity - room[at, 0]
        room[at] -= need
        if room[at, 0] < smallest or room[at, 1] < 1 or room[at, 2] < smallest * smallest:
            is_open -= 1
            room[at], number[at] = room[is_open], number[is_open]
    return bins, offsets


def capacities(lengths, capacity: int, max_documents: int | None, max_attention: int | None, spread: float) -> tuple[int, int, int]:
    """Tokens, documents and attention cost of a sequence; those not given from an even spread of the pieces."""
    import numpy as np

    lengths = np.asarray(lengths, np.int64)
    sequences = max(1, -(-int(lengths.sum()) // capacity))
    squares = lengths * lengths
    documents = max_documents or min(capacity, LEAST_DOCUMENTS + math.ceil(spread * len(lengths) / sequences))
    attention = max_attention or min(capacity * capacity, max(int(squares.max(initial=1)), math.ceil(spread * int(squares.sum()) / sequences)))
    return capacity, documents, attention


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 4096,
    end_id: int = 1,
    max_documents: int | None = None,
    max_attention: int | None = None,
    weights=(1.0, 0.1, 0.1),
    rule: str = "norm",
    spread: float = 8.0,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Pack documents (doc_id, text) into sequences of at most `capacity` tokens.

    weights are of tokens, documents and attention cost. Null or empty text: one piece, the end id
    alone. Null doc_id and repeated rows: packed like any other row. An empty table gives no rows.
    Further columns are ignored, whatever their names.
    """
    tune(docs.sparkSession)
    most = docs.agg(F.count(F.lit(1)) + F.floor(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0)) / capacity)).first()[0]
    shards = max(1, math.ceil(most / shard_pieces))
    pieces = cut_pieces(docs, vocabulary, capacity, end_id, shards)

    def pack(table: pa.Table) -> pa.Table:
        import numpy as np

        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = table.column("length").to_numpy()
        bins, offsets = best_fit(lengths, *capacities(lengths, capacity, max_documents, max_attention, spread), weights=weights, rule=rule)
        shard = table.column("shard")[0].as_py()
        columns = [table.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        columns += [pa.array((np.int64(shard) << 32) + bins), pa.array(offsets)]
        return pa.table(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return pieces.groupBy("shard").applyInArrow(pack, PACKED)
