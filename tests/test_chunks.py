"""Chunks and counts in one pass against the column expressions that define them, row by row."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from deskflow.functions.text import chunks
from deskflow.functions.vectors import term_counts
from deskflow.operators import chunks as one_pass

ODD = [
    None, "", "   \n\t ", "a", "ab cd", " lead and trail ", "x" * 50, "x" * 9 + " " + "y" * 40, "a b c d e f g h i j k",
    "ab cd ef\u0085gh\x1cij", "Straße ÄÖÜ İstanbul ΟΔΟΣ ΟΔΟΣ Σ", "😀😀 😀" * 9, "tie tie tie tie tie tie", "zero​width ﻿mark",
]


def sides(spark, texts, size, overlap, buckets=64):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    plain = docs.select("doc_id", F.posexplode(chunks(F.col("text"), size, overlap)).alias("chunk_idx", "content"))
    plain = plain.withColumn("embedding", term_counts(F.col("content"), buckets))
    found = one_pass.chunk_rows(docs, size, overlap, buckets)
    return [sorted(map(tuple, df.select("doc_id", "chunk_idx", "content", "embedding").collect())) for df in (plain, found)]


@pytest.mark.parametrize("size,overlap", [(700, 120), (7, 3), (10, 0), (2, 1), (1, 0), (5, 4)])
def test_same_as_the_expressions(spark, size, overlap):
    plain, found = sides(spark, ODD, size, overlap)
    assert found == plain and found


def test_runs_of_texts_do_not_show(spark, monkeypatch):
    texts = [f"text {i} " * (i % 9) + "word" * (i % 4) for i in range(60)] + ["long " * 500]
    plain, found = sides(spark, texts, 30, 8)
    assert found == plain

    def small(frames):
        one_pass.PIECE_CHARS, one_pass.KNOWN_WORDS = 40, 5
        yield from frames

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).mapInArrow(small, "doc_id long, text string")
    again = one_pass.chunk_rows(docs, 30, 8, 64).select("doc_id", "chunk_idx", "content", "embedding").collect()
    assert sorted(map(tuple, again)) == plain


def test_columns_and_faults(spark):
    docs = spark.createDataFrame([(1, "a b", None, [1, 2])], "doc_id long, text string, lang string, more array<int>")
    row = one_pass.chunk_rows(docs).first()
    assert row.asDict() == {"doc_id": 1, "lang": None, "more": [1, 2], "chunk_idx": 0, "content": "a b"}
    assert one_pass.chunk_rows(docs.limit(0), buckets=8).collect() == []
    with pytest.raises(ValueError):
        one_pass.chunk_rows(docs, 10, 10)
    with pytest.raises(ValueError):
        one_pass.chunk_rows(docs.withColumn("content", F.lit(1)))
