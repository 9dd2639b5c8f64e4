"""Token ids as Arrow stream files of fixed-size lists, written and read back.

A file holds record batches of equally long sequences: `ids`, a fixed-size list of unsigned 16- or
32-bit ids, and `mask`, a fixed-size list of booleans that is false where the last sequence is
padded. Every batch but the last has the same number of sequences, so sequence s of a file lies in
batch s // BATCH at row s % BATCH, and a memory map reads it without copying. Beside each file an
index stream has doc_id, first token and token count. A file ends at the first document beyond
FILE_TOKENS, so its size doesn't grow with a task's share. File names of committed tasks stand in a
manifest; files of failed or repeated attempts are in no manifest and are never read.
"""

from __future__ import annotations

import posixpath
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from webloom.llm.common import materialize, new_dir, tune
from webloom.llm.tokens import encoder

#: Sequences of a record batch.
BATCH = 256
#: Tokens after which a task begins another file.
FILE_TOKENS = 1 << 26
MANIFEST = "part int, number int, file string, n_documents long, n_tokens long, seq_len int"
READ_BACK = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _store(uri: str):
    """File system and path of a URI, for workers: local folders, or whatever pyarrow can reach."""
    from pyarrow import fs

    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), parsed.path
    return fs.FileSystem.from_uri(uri)


def _schema(bits: int, seq_len: int) -> pa.Schema:
    ids = pa.uint16() if bits == 16 else pa.uint32()
    return pa.schema([("ids", pa.list_(ids, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])


class _Sequences:
    """Cuts a stream of ids into full record batches; the tail is padded at the end."""

    def __init__(self, sink, bits: int, seq_len: int):
        self.schema, self.seq_len = _schema(bits, seq_len), seq_len
        self.writer = pa.ipc.new_stream(sink, self.schema)
        self.kind = "<u2" if bits == 16 else "<u4"
        self.waiting: list = []
        self.n_waiting = 0

    def add(self, ids) -> None:
        self.waiting.append(ids.astype(self.kind))
        self.n_waiting += len(ids)
        if self.n_waiting >= BATCH * self.seq_len:
            self._write(BATCH * self.seq_len)

    def _write(self, step: int, last: bool = False) -> None:
        import numpy as np

        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, self.kind)
        done = 0
        while len(ids) - done >= step or (last and done < len(ids)):
            part = ids[done : done + step]
            done += len(part)
            rows = -(-len(part) // self.seq_len)
            flat = np.zeros(rows * self.seq_len, self.kind)
            flat[: len(part)] = part
            mask = np.arange(len(flat)) < len(part)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len) for x in (flat, mask)]
            self.writer.write_batch(pa.record_batch(lists, schema=self.schema))
        self.waiting = [ids[done:]]
        self.n_waiting = len(ids) - done

    def close(self) -> None:
        self._write(BATCH * self.seq_len, last=True)
        self.writer.close()


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, seq_len: int = 2048, files: int | None = None
) -> DataFrame:
    """Write the ids of every text in ascending doc_id order; returns the manifest, itself stored beside the files.

    Rows are dealt by ranges of doc_id, so file numbers and rows within a file ascend. Rows of one
    doc_id stand in the order of a hash of their texts, and many of them are dealt to many files. Null
    doc_id comes first; null text has the end id only.
    """
    spark = docs.sparkSession
    tune(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    by_range = [rows.doc_id.asc_nulls_first(), rows.hash, rows.row]
    dealt = rows.repartitionByRange(files, *by_range) if files else rows.repartitionByRange(*by_range)

    def run(batches):
        store, folder = _store(path)
        part = TaskContext.get().partitionId()
        store.create_dir(folder, recursive=True)
        file, done = None, []
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                file = file or _FileWriter(store, folder, part, len(done), vocabulary, end_id, seq_len)
                at += file.add(batch.slice(at))
                if file.n_tokens >= FILE_TOKENS:
                    done.append(file.close())
                    file = None
        if file:
            done.append(file.close())
        if done:
            types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32())
            names = ["part", "number", "file", "n_documents", "n_tokens", "seq_len"]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names)

    return materialize(dealt.sortWithinPartitions(*by_range).select("doc_id", "text").mapInArrow(run, MANIFEST), "token-manifest")


class _FileWriter:
    """One file of sequences and its index."""

    def __init__(self, store, folder: str, part: int, number: int, vocabulary: str, end_id: int, seq_len: int):
        self.encode = encoder(vocabulary)
        self.end = end_id.to_bytes(4, "little")
        bits = 16 if self.encode.tokenizer.get_vocab_size() <= 65536 and end_id < 65536 else 32
        self.part, self.number, self.seq_len = part, number, seq_len
        self.name = f"part-{part:06d}-{number:04d}-{uuid.uuid4().hex}"
        self.sinks = [store.open_output_stream(posixpath.join(folder, f"{self.name}.{x}")) for x in ("arrows", "index")]
        self.sequences = _Sequences(self.sinks[0], bits, seq_len)
        self.schema = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])
        self.index = pa.ipc.new_stream(self.sinks[1], self.schema)
        self.n_tokens = self.n_documents = 0

    def add(self, batch) -> int:
        """Documents (doc_id, text) of a batch up to the end of the file; how many were taken."""
        import numpy as np

        firsts, counts = [], []
        for text in batch.column(1).to_pylist():
            ids = np.frombuffer(self.encode.encode(text) + self.end, "<u4")
            self.sequences.add(ids)
            firsts.append(self.n_tokens)
            counts.append(len(ids))
            self.n_tokens += len(ids)
            if self.n_tokens >= FILE_TOKENS:
                break
        self.n_documents += len(firsts)
        ids = batch.column(0).slice(0, len(firsts))
        self.index.write_batch(pa.record_batch([ids, pa.array(firsts, pa.int64()), pa.array(counts, pa.int64())], schema=self.schema))
        return len(firsts)

    def close(self) -> tuple:
        """The manifest's row."""
        self.sequences.close()
        self.index.close()
        for sink in self.sinks:
            sink.close()
        return self.part, self.number, self.name, self.n_documents, self.n_tokens, self.seq_len


class TokenFile:
    """A file of equal-length sequences with random access: mapped if it is local, else read into memory."""

    def __init__(self, path: str, name: str):
        store, folder = _store(path)
        at = posixpath.join(folder, name)
        local = store.type_name == "local"
        opened = [pa.memory_map(f"{at}.{x}") if local else store.open_input_file(f"{at}.{x}") for x in ("arrows", "index")]
        self.batches = list(pa.ipc.open_stream(opened[0]))
        self.index = list(pa.ipc.open_stream(opened[1]))
        self.seq_len = self.batches[0].schema.field("ids").type.list_size if self.batches else 0

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def sequence(self, s: int):
        """Ids of sequence s, a view of the file."""
        column = self.batches[s // BATCH].column("ids")
        at = s % BATCH
        return column.values.to_numpy()[at * self.seq_len : (at + 1) * self.seq_len]

    def mask(self, s: int) -> pa.Array:
        """Mask of sequence s, a view of the file."""
        return self.batches[s // BATCH].column("mask")[s % BATCH].values

    def tokens(self, first: int, count: int):
        """Ids first to first + count of the file; a view where they lie in one record batch."""
        import numpy as np

        step, out = BATCH * self.seq_len, []
        while count:
            flat = self.batches[first // step].column("ids").values.to_numpy()
            part = flat[first % step : first % step + count]
            out.append(part)
            first, count = first + len(part), count - len(part)
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.empty(0, "<u4")


def documents_of(path: str, name: str) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """(doc_id, first, n_tokens) and crc32 of the documents of a file, from front to back.

    Holds one record batch of sequences at a time, wherever the file lies.
    """
    store, folder = _store(path)
    with store.open_input_stream(posixpath.join(folder, f"{name}.arrows")) as ids_source, store.open_input_stream(posixpath.join(folder, f"{name}.index")) as index_source:
        sequences = iter(pa.ipc.open_stream(ids_source))
        data, at = memoryview(b""), 0
        for rows in pa.ipc.open_stream(index_source):
            crcs = []
            for n in rows.column(2).to_pylist():
                left, crc = 4 * n, 0
                while left:
                    if at == len(data):
                        data, at = memoryview(next(sequences).column("ids").values.to_numpy().astype("<u4").tobytes()), 0
                    part = data[at : at + left]
                    crc = zlib.crc32(part, crc)
                    left, at = left - len(part), at + len(part)
                crcs.append(crc)
            yield rows, crcs


def read_token_files(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """A row for each document, all of it from the files: doc_id, start over all files, n_tokens, ids_crc32.

    The manifest has one short row for each file; only that is summed in one task.
    """
    import pyarrow.compute as pc

    before = W.orderBy("part", "number").rowsBetween(W.unboundedPreceding, -1)
    placed = manifest.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))

    def run(batches):
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for rows, crcs in documents_of(path, name):
                    yield pa.record_batch([rows.column(0), pc.add(rows.column(1), start), rows.column(2), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.repartition(tasks).mapInArrow(run, READ_BACK)


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 2, seq_len: int = 2048) -> DataFrame:
    """Write to the shared folder and return what the files say.

    Null or empty text: one token, the end id. Repeated rows: once each. An empty table: no rows.
    """
    spark = docs.sparkSession
    path = new_dir(spark, "token-files")
    return read_token_files(spark, path, write_token_files(docs, path, vocabulary, end_id, seq_len))
