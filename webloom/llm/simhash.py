"""SimHash near-dedup with a grid over segment popcounts.

A fingerprint's 64 bits fall into segments of two bits; the vector of segment popcounts is a point
of {0,1,2}^32. Popcounts of two fingerprints differ in a segment by no more than their bits do, so
the Manhattan distance of the points is a lower bound of the Hamming distance.

The first 36 bits give 18 coordinates, the other 28 bits 14. If two fingerprints differ in at most 4
bits, their points are within 2 on the first part or within 1 on the second (were it 3 or more and 2
or more, the sum would exceed 4). Within 2: some point lies within 1 of both, so each fingerprint
enters its own cell and the neighbouring cells, and the two meet. Within 1: one of the two points is
the other or one step below it, so each enters its own cell and the cells one step below. Cells are
the keys of an ordinary equi-join by sorting; what meets is verified on all 64 bits.

Exact copies and equal fingerprints are one row before that. In a cell only a spanning forest of the
true links is emitted, so a group of copies gives as many links as members, not as many as pairs.

A cell that very many fingerprints enter is split before it is dealt out: of five groups of a
fingerprint's bits, two within 4 bits have one in common, so its fingerprints meet by (cell, group,
bits of the group). Which cells are split follows from how many fingerprints have a cell as their own:
a cell that no such full cell reaches is entered by at most ENTERED * FULL of them.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import discard, materialize, tune, words_of
from webloom.llm.components import components

SHINGLE = 4
SEED = 42
DISTANCE = 4
#: Bits of the first part of a fingerprint, from the top; even.
FIRST_BITS = 36
#: Fingerprints that have a cell as their own, beyond which the cells that they enter are split.
FULL = 2000
#: Cells of a part that a fingerprint enters at most.
ENTERED = 1 + FIRST_BITS
#: Five groups of bits, as (shift, width): more than DISTANCE, so that one stays equal.
GROUPS = tuple((s, 13 if s < 52 else 12) for s in range(0, 64, 13))
#: Entries of a cell beyond which a task compares its groups one by one.
MANY = 4096

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str | None, size: int = SHINGLE, seed: int = SEED):
    """XXH64 of every shingle of a text, repeats included, as numpy unsigned 64-bit integers."""
    import numpy as np
    import xxhash

    words = words_of(text.translate(_LOWER) if text else text)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        hashes = [digest(" ".join(words).encode(), seed)] if words else []
        return np.array(hashes, np.uint64)
    data = " ".join(words).encode()
    lengths = np.array([len(w) for w in words]) if len(data) == sum(map(len, words)) + len(words) - 1 else np.array([len(w.encode()) for w in words])
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    spans = zip(starts[: 1 - size].tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.array([digest(data[a:b], seed) for a, b in spans], np.uint64)


def fingerprint(text: str | None) -> int:
    """64-bit SimHash: a bit is 1 if set in over half of the hashes; no words: zero."""
    import numpy as np

    hashes = shingle_hashes(text)
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, sig: Column) -> DataFrame:
    """(doc_id, fp, sig) for each row; fp is the fingerprint as a signed long, sig what the caller tells rows apart by."""

    def run(batches):
        import numpy as np

        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(fps, pa.int64()), batch.column(2)], names=["doc_id", "fp", "sig"])

    tune(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), sig.alias("sig")).mapInArrow(run, "doc_id long, fp long, sig long")


def popcounts(fps):
    """Popcounts of the 32 two-bit segments, top segment first: an n x 32 array."""
    import numpy as np

    bits = np.unpackbits(np.asarray(fps, np.int64).astype(">i8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits[:, 0::2] + bits[:, 1::2]


def cells_of(fps, own_only: bool = False):
    """Grid cells that each fingerprint enters, or its own two: (row numbers, cell keys).

    A key is a base-3 number of the part's coordinates; the second part's keys are set apart by sign.
    """
    import numpy as np

    points = popcounts(fps).astype(np.int64)
    cut = FIRST_BITS // 2
    rows, keys = [], []
    everyone = np.arange(len(points))
    for part, (coordinates, both_ways) in enumerate(((points[:, :cut], True), (points[:, cut:], False))):
        weight = 3 ** np.arange(coordinates.shape[1], dtype=np.int64)
        own = coordinates @ weight
        found = [(everyone, own)]
        for j, w in enumerate(() if own_only else weight.tolist()):
            down = coordinates[:, j] > 0
            found.append((everyone[down], own[down] - w))
            if both_ways:
                up = coordinates[:, j] < 2
                found.append((everyone[up], own[up] + w))
        for r, k in found:
            rows.append(r)
            keys.append(-1 - k if part else k)
    return np.concatenate(rows), np.concatenate(keys)


def reached_cells(own):
    """Keys of all cells that fingerprints with these own cells may enter."""
    import numpy as np

    out = [own]
    for part, n, both_ways in ((0, FIRST_BITS // 2, True), (1, 32 - FIRST_BITS // 2, False)):
        keys = own[own >= 0] if part == 0 else -1 - own[own < 0]
        for j in range(n):
            digit = keys // 3**j % 3
            near = [keys[digit > 0] - 3**j, *([keys[digit < 2] + 3**j] if both_ways else [])]
            out += [-1 - k if part else k for k in near]
    return np.unique(np.concatenate(out))


def _popcount64(x):
    import numpy as np

    return np.bitwise_count(x)


def forest(fps):
    """Spanning forest of the links among distinct fingerprints: index pairs (from, to).

    Breadth first: a point taken from the frontier is compared with what no tree has reached yet, so a
    tight group of copies costs a few passes over it. Working memory is some bytes for each point.
    """
    import numpy as np

    left = np.arange(len(fps))
    values = np.asarray(fps, np.int64).view(np.uint64)
    out_a, out_b = [], []
    while len(left) > 1:
        frontier, left = [int(left[0])], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = _popcount64(values[left] ^ values[at]) <= DISTANCE
            reached = left[near]
            if len(reached):
                out_a += [at] * len(reached)
                out_b += reached.tolist()
                frontier += reached.tolist()
                left = left[~near]
    return out_a, out_b


def links(distinct: DataFrame, full: int = FULL) -> DataFrame:
    """Links (a, b) by node id that connect all fingerprints within DISTANCE; distinct: (fp, node)."""

    def enter(batches):
        for batch in batches:
            fps, nodes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at in range(0, len(fps), 4096):
                rows, keys = cells_of(fps[at : at + 4096])
                yield pa.record_batch([pa.array(keys), pa.array(fps[at : at + 4096][rows]), pa.array(nodes[at : at + 4096][rows])], names=["cell", "fp", "node"])

    def meet(batches):
        import numpy as np

        kept: list = []  # rows of the cell that runs on past the batch
        for batch in batches:
            cell, sub, fps, nodes = (batch.column(i).to_numpy() for i in range(4))
            if kept and len(cell):
                cell, sub, fps, nodes = (np.concatenate([k, x]) for k, x in zip(kept, (cell, sub, fps, nodes), strict=True))
            if not len(cell):
                continue
            edge = np.flatnonzero((cell[1:] != cell[:-1]) | (sub[1:] != sub[:-1])) + 1
            starts = np.concatenate([[0], edge])
            last = int(starts[-1])
            kept = [cell[last:], sub[last:], fps[last:], nodes[last:]]
            yield from _found(starts, fps, nodes)
        if kept:
            yield from _found(np.array([0, len(kept[0])]), kept[2], kept[3])

    cells = distinct.select("fp", "node").mapInArrow(enter, "cell long, fp long, node long").withColumn("sub", F.lit(0))
    hot = full_cells(distinct, full)
    if hot is not None:
        groups = F.array(*[(F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << n) - 1)) + F.lit(g << 13)).cast("int") for g, (at, n) in enumerate(GROUPS, 1)])
        marked = cells.join(hot, "cell", "left")
        cells = marked.withColumn("sub", F.explode(F.when(F.col("hot"), groups).otherwise(F.array(F.lit(0)))))
    return cells.select("cell", "sub", "fp", "node").repartition("cell", "sub").sortWithinPartitions("cell", "sub").mapInArrow(meet, "a long, b long")


def full_cells(distinct: DataFrame, full: int) -> DataFrame | None:
    """(cell, hot = true) of all cells that fingerprints of a full cell enter; None where no cell is full."""

    def own(batches):
        for batch in batches:
            keys = cells_of(batch.column(0).to_numpy(), own_only=True)[1]
            yield pa.record_batch([pa.array(keys)], names=["cell"])

    def reach(batches):
        for batch in batches:
            yield pa.record_batch([pa.array(reached_cells(batch.column(0).to_numpy()))], names=["cell"])

    crowded = materialize(distinct.select("fp").mapInArrow(own, "cell long").groupBy("cell").count().where(F.col("count") > full).select("cell"), "full-cells")
    if crowded.isEmpty():
        return None
    return materialize(crowded.mapInArrow(reach, "cell long").distinct().withColumn("hot", F.lit(True)), "hot-cells")


def _linked(fps, nodes):
    """Links of one cell as node pairs; a large one by groups of equal bits, one group of bits after another."""
    import numpy as np

    if len(fps) <= MANY:
        a, b = forest(fps)
        return nodes[a], nodes[b]
    out_a, out_b = [], []
    for at, width in GROUPS:
        bits = fps.view(np.uint64) >> np.uint64(at) & np.uint64((1 << width) - 1)
        order = np.argsort(bits, kind="stable")
        edges = np.flatnonzero(np.diff(bits[order])) + 1
        for members in np.split(order, edges):
            if len(members) > 1:
                a, b = forest(fps[members])
                out_a.append(nodes[members[a]])
                out_b.append(nodes[members[b]])
    return (np.concatenate(x) if x else nodes[:0] for x in (out_a, out_b))


def _found(starts, fps, nodes):
    """Links of the closed runs between starts."""
    import numpy as np

    sizes = np.diff(starts)
    out_a, out_b = [], []
    pairs = starts[:-1][sizes == 2]
    if len(pairs):
        near = _popcount64((fps[pairs] ^ fps[pairs + 1]).view(np.uint64)) <= DISTANCE
        out_a.append(nodes[pairs[near]])
        out_b.append(nodes[pairs[near] + 1])
    for at, size in zip(starts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        a, b = _linked(fps[at : at + size], nodes[at : at + size])
        out_a.append(a)
        out_b.append(b)
    if out_a and sum(map(len, out_a)):
        yield pa.record_batch([pa.array(np.concatenate(out_a).astype(np.int64)), pa.array(np.concatenate(out_b).astype(np.int64))], names=["a", "b"])


def _grouped(docs: DataFrame, sig: Column) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp, sig) of each row, and (fp, component, component_id); component is a fingerprint."""
    prints = materialize(fingerprints(docs, sig), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    # a node is its fingerprint; component ids come from the documents' ids below
    found = components(links(distinct.select("fp", F.col("fp").alias("node"))))
    named = distinct.join(found, distinct.fp == found.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    named = materialize(named, "named-fingerprints")
    discard(distinct)
    ids = materialize(named.groupBy("component").agg(F.min("least").alias("component_id")), "component-ids")
    return prints, named.join(ids, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for each row of docs (doc_id, text).

    component_id is the smallest doc_id reachable over links of at most DISTANCE differing bits, the
    row's own included. Texts without words have fingerprint zero and link like others. Null doc_id
    counts as smaller than none: a component of only such rows has a null component_id. Repeated rows
    come out once each. An empty table gives no rows.
    """
    prints, resolved = _grouped(docs, F.lit(0).cast("long"))
    return prints.join(resolved, "fp").select("doc_id", "fp", "component_id")


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns that have one (maps and variants have none)."""
    plain = [f.name for f in docs.schema if not re.search(r"\b(map|variant)\b", f.dataType.simpleString())]
    return F.xxhash64(*[F.col(f"`{n}`") for n in plain])


def first_of_groups(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, with the columns of docs as they are.

    It is the row of the smallest doc_id, a null one being the largest; of several such rows the one
    whose hash over all columns is smallest. So rows of one doc_id with different texts stay, each
    for its own group, and of rows alike in every column one stays. An empty table gives no rows.
    """
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))  # sig tells a null from 0, and plain keys are dealt once for both steps
    keyed = docs.select(F.struct("*").alias("row"), number.alias("id"), row_hash(docs).alias("sig"))
    prints, resolved = _grouped(docs, row_hash(docs))
    least = prints.join(resolved, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = least.groupBy("component").agg(F.min("doc_id").alias("id"), F.min("sig").alias("sig"))
    kept = materialize(kept.select(F.coalesce("id", F.lit(0).cast("long")).alias("id"), "sig"), "kept-rows")
    return keyed.join(kept, ["id", "sig"], "left_semi").dropDuplicates(["id", "sig"]).select("row.*")
