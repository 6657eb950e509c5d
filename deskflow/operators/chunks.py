"""From documents to overlapping chunks and their word counts in one pass over Arrow batches."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

PIECE_CHARS = 1 << 21  # of text that are cut together; a longer text is cut by itself
KNOWN_WORDS = 1 << 20  # that a task keeps with their buckets


class Buckets(dict):
    """Bucket of each word, hashed when it is first asked for; the empty word has none (-1)."""

    def __init__(self, buckets: int):
        super().__init__({"": -1})
        self.buckets = buckets

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
            self[""] = -1
        self[word] = int.from_bytes(hashlib.md5(word.lower().encode()).digest()[:3]) % self.buckets
        return self[word]


def collapsed(text: str | None) -> str:
    """White space runs as one blank, none at the ends; the characters are those of `functions.text.WHITESPACE`."""
    return "" if text is None else " ".join(text.split())


def cut(lengths: np.ndarray, size: int, overlap: int):
    """Text, first and end of each chunk, places being counted over all texts with one sign between two."""
    step = size - overlap
    start = np.cumsum(lengths + 1) - lengths - 1
    n = -(-lengths // step)
    text = np.repeat(np.arange(len(lengths)), n)
    first = start[text] + (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * step
    return text, first, np.minimum(first + size, start[text] + lengths[text])


def counts(joined: str, first: np.ndarray, end: np.ndarray, known: Buckets) -> np.ndarray:
    """Words of each chunk by bucket. Whole words are taken from one list; a word cut by an edge counts as what is left of it."""
    words = joined.split(" ")
    size = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(size + 1) - size - 1
    stop = begin + size
    bucket = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    a, b = np.searchsorted(begin, first), np.searchsorted(stop, end, side="right")
    n = np.maximum(b - a, 0)
    chunk = np.repeat(np.arange(len(first)), n)
    word = np.repeat(a - np.cumsum(n) + n, n) + np.arange(len(chunk))
    left = np.flatnonzero((a > 0) & (stop[a - 1] > first))
    right = np.flatnonzero((b < len(words)) & (b >= a))
    right = right[begin[b[right]] < end[right]]
    i = np.concatenate([first[left], begin[b[right]]])
    j = np.concatenate([np.minimum(stop[a[left] - 1], end[left]), end[right]])
    part = np.fromiter((known[joined[p:q]] for p, q in zip(i.tolist(), j.tolist())), np.int64, len(i))
    chunk, bucket = np.concatenate([chunk, left, right]), np.concatenate([bucket[word], part])
    at = chunk[bucket >= 0] * known.buckets + bucket[bucket >= 0]
    return np.bincount(at, minlength=len(first) * known.buckets).astype(np.float64)


def chunk_rows(
    docs: DataFrame, size: int = 700, overlap: int = 120, buckets: int | None = None, column: str = "text"
) -> DataFrame:
    """The other columns of `docs` with chunk_idx and content of each chunk, and its word counts where `buckets` is given.

    Chunks are those of `functions.text.chunks` and counts (`embedding`) those of `functions.vectors.term_counts`:
    texts have their white space collapsed, and a chunk of `size` characters begins every `size - overlap`. Null and
    blank texts have none. Texts are cut in runs of about two million characters, so batches stay small for long
    texts too; a row is one text, which a task holds whole.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    others = [f for f in docs.schema.fields if f.name != column]
    fields = [StructField("chunk_idx", IntegerType()), StructField("content", StringType())]
    if buckets:
        fields.append(StructField("embedding", ArrayType(DoubleType())))
    taken = {f.name for f in others} & {f.name for f in fields}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are already there")

    def pieces(batch):
        texts, held, n = [], 0, 0
        column_of = batch.column(column)
        for at in range(len(column_of)):
            texts.append(collapsed(column_of[at].as_py()))
            n += len(texts[-1])
            if n >= PIECE_CHARS:
                yield held, texts
                texts, held, n = [], at + 1, 0
        if texts:
            yield held, texts

    def run(batches):
        known = Buckets(buckets) if buckets else None
        for batch in batches:
            for held, texts in pieces(batch):
                joined = " ".join(texts)
                lengths = np.fromiter(map(len, texts), np.int64, len(texts))
                text, first, end = cut(lengths, size, overlap)
                content = [joined[i:j] for i, j in zip(first.tolist(), end.tolist())]
                kept = np.fromiter((c.strip(" ") != "" for c in content), bool, len(content))
                if not kept.any():
                    continue
                if not kept.all():
                    text, first, end = text[kept], first[kept], end[kept]
                    content = [c for c, k in zip(content, kept) if k]
                new = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
                index = np.arange(len(text)) - np.repeat(new, np.diff(new, append=len(text)))
                rows = pa.array(text + held)
                out = [batch.column(f.name).take(rows) for f in others]
                out += [pa.array(index.astype(np.int32)), pa.array(content, pa.string())]
                if buckets:
                    places = np.arange(0, (len(text) + 1) * buckets, buckets, dtype=np.int32)
                    out.append(pa.ListArray.from_arrays(places, counts(joined, first, end, known)))
                yield pa.RecordBatch.from_arrays(out, [f.name for f in others + fields])

    return docs.mapInArrow(run, StructType(others + fields))

