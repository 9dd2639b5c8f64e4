"""Line dedup (8): other columns, and the filter of marked documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from webloom.llm import line_dedup


def test_dropped_lines_keep_other_columns(clashing, nothing):
    got = line_dedup.drop_lines(clashing.withColumn("n_lines", F.lit(777)))
    assert got.columns == clashing.columns + ["n_lines"]
    assert {(r.n_lines, r.dropped, r.pos) for r in got.collect()} == {(777, "clash dropped", "clash pos")}
    want = sorted(repr((r.doc_id, r.text)) for r in line_dedup.dedup_lines(clashing).collect())
    assert sorted(repr((r.doc_id, r.text)) for r in got.collect()) == want
    assert line_dedup.drop_lines(nothing).count() == 0


def test_the_filter_lets_every_marked_document_through(spark, monkeypatch):
    rows = spark.range(3000).select(F.col("id"), (F.col("id") * 7).alias("hash"))
    marks = rows.where("id % 3 = 0").select(F.col("id").alias("doc_id"), F.col("hash").alias("text_hash"))
    marks = marks.union(spark.createDataFrame([(None, 5)], "doc_id long, text_hash long"))
    rows = rows.union(spark.createDataFrame([(None, 5)], "id long, hash long"))
    for bits in (1 << 26, 1 << 16, 64):
        monkeypatch.setattr(line_dedup, "FILTER_BITS", bits)
        got = {r.id: r.maybe for r in line_dedup._sifted(rows, marks).collect()}
        assert len(got) == 3001 and got[None] and all(got[i] for i in range(0, 3000, 3))
        assert sum(got.values()) <= {1 << 26: 1010, 1 << 16: 1150, 64: 3001}[bits]
