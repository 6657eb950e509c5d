"""Removes passages that an earlier document holds, by relative Lempel-Ziv parsing.

The reference is every document, read in the order of doc_id. Its 13-word seeds are indexed in blocks
that are cut by hash, so that a block is one task's work however often a passage occurs. Each document
is factored against every block: a factor is the longest run of words whose every seed stands in an
earlier document. Seeds that cross from one factor into the next are looked up like all others, so
nothing is lost at factor boundaries; factors of 13 words and more are the duplicate spans.

Seeds travel packed: one row holds all seeds that a batch of documents sends to one block, as 64-bit
hashes and steps between their places. Two different seeds share a hash with a chance of 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import PACKED, matched, pack
from .common import gram_hashes, join_few, pieces, shuffle_partitions, stored, text_bytes, word_hashes

RUN_BYTES = 1 << 22  # of text whose seeds are packed together


def seed_rows(docs: DataFrame, size: int, blocks: int) -> DataFrame:
    def seeds(data, at):
        hashes, counts = [], np.zeros(len(at) - 1, np.int32)
        for i, j in pieces(at):
            words, first = word_hashes(data[at[i] : at[j]], at[i : j + 1] - at[i])
            hashes.append(gram_hashes(words, first, size)[0])
            counts[i:j] = np.maximum(np.diff(first) - size + 1, 0)
        return np.concatenate(hashes), counts

    def rows(batches):
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j in pieces(at, RUN_BYTES):
                h, counts = seeds(data[at[i] : at[j]], at[i : j + 1] - at[i])
                yield from pack(ids[i:j], counts, h, blocks)

    return docs.mapInArrow(rows, PACKED)


def after_first(doc: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Places whose hash also stands in a text with a smaller id."""
    return doc > np.repeat(np.minimum.reduceat(doc, begin), np.diff(begin, append=len(doc)))


def remove_earlier_passages(docs: DataFrame, size: int = 13) -> DataFrame:
    """The rows of `docs` (doc_id, text) as doc_id, n_words, n_removed, kept_text and factors (start, end in words).

    Words are runs of other bytes than blanks; a null text has none. A row without doc_id is no reference and keeps
    all its words. Rows that repeat a doc_id count as one document: none is earlier than the other, and what is found
    in one is applied at the same words of the other. No rows give no rows; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    blocks = shuffle_partitions(docs.sparkSession)
    packed = seed_rows(docs.where("doc_id is not null and text is not null"), size, blocks)
    hits = stored(matched(packed, blocks, after_first).toDF("doc_id", "starts"), "factors")

    def cut(batches):
        for batch in batches:
            n_words, n_removed, kept, spans = [], [], [], []
            for text, starts in zip(batch.column("text"), batch.column("starts")):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                n_words.append(len(words))
                found = []
                if starts.is_valid:
                    s = np.unique(starts.values.to_numpy())
                    s = s[s + size <= len(words)]
                    covered = np.zeros(len(words) + 1, np.int32)
                    np.add.at(covered, s, 1)
                    np.add.at(covered, s + size, -1)
                    covered = np.cumsum(covered[:-1]) > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
                    found = [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]
                    words = [w for w, gone in zip(words, covered.tolist()) if not gone]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
                spans.append(found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ],
                ["doc_id", "n_words", "n_removed", "kept_text", "factors"],
            )

    return join_few(docs, hits, "doc_id").select("doc_id", "text", "starts").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept_text string, factors array<struct<start:int,end:int>>"
    )
