"""Removes byte strings that occur more than once, by bucket-pointer refinement over anchored suffixes.

A string of `length` bytes is anchored at the q-gram in it (half its length) with the smallest hash, the first one
if several are equal. Equal strings have their anchors at equal places, so only suffixes at anchors need sorting,
about two in a hundred bytes, and all strings with one anchor form a run of starts.

Buckets start as equal q-grams; a bucket of one anchor holds nothing that repeats and is dropped. Each other bucket
is refined by the identifier of the whole run's text, from its first string to its last, which points beyond the
q-gram at both sides. Runs that share this bucket repeat with all their strings at once, which settles the inside of
repeated passages. Only where such a bucket is left with one run, at the ends of passages, are its strings refined
one by one against the strings of the other runs of its q-gram, again by bucket identifiers.

Identifiers are 64-bit hashes, so that sorting into buckets is grouping by number, in any partition; two different
strings of one q-gram share a bucket with a chance of 2**-64.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import PACKED, matched, pack
from .common import join_few, moved, pieces, rolling, row_key, shuffle_partitions, stored, text_bytes

LENGTH = 400


def anchors(data: np.ndarray, at: np.ndarray, length: int):
    """Runs of starts with one anchor: first and last start, q-gram, and identifier of the run's text."""
    q = max(1, length // 2)
    width = length - q + 1
    roll = rolling(2)
    sums = roll.of_bytes(data)
    n = len(data) - q + 1
    sizes = np.diff(at) - length + 1
    starts = np.arange(int(np.maximum(sizes, 0).sum()))
    if n < width or not len(starts):
        return [np.empty(0, np.int64)] * 2 + [np.empty(0, np.uint64)] * 2
    grams = roll.runs(sums, np.arange(n), np.arange(q, q + n))
    bits = np.uint64(max(20, int(n).bit_length()))
    order = (grams >> bits << bits) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = order
    padded = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(padded, axis=1).ravel()
    each = np.maximum(sizes, 0)
    starts += np.repeat(at[:-1] - (np.cumsum(each) - each), each)
    anchor = (np.minimum(ahead[starts], behind[starts + width - 1]) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    low, high = starts[new], starts[np.append(new[1:], len(starts)) - 1]
    return low, high, grams[anchor[new]], roll.runs(sums, low, high + length)


def anchored_runs(docs: DataFrame, length: int) -> DataFrame:
    """key, low, high (starts within the text), gram and whole for each run of the texts."""

    def rows(batches):
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            key = batch.column("key").to_numpy()
            for i, j in pieces(at):
                low, high, gram, whole = anchors(data[at[i] : at[j]], at[i : j + 1] - at[i], length)
                text = np.searchsorted(at[i : j + 1] - at[i], low, side="right") - 1
                begin = at[i + text] - at[i]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key[i + text]), pa.array((low - begin).astype(np.int32)), pa.array((high - begin).astype(np.int32)),
                        pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64)),
                    ],
                    ["key", "low", "high", "gram", "whole"],
                )

    return docs.mapInArrow(rows, "key long, low int, high int, gram long, whole long")


def string_rows(docs: DataFrame, length: int, blocks: int) -> DataFrame:
    """Packed identifiers of the strings of each text's runs (array of low and high); ids are the keys."""

    def rows(batches):
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            key = batch.column("key").to_numpy()
            runs = batch.column("runs")
            count = np.diff(runs.offsets.to_numpy())
            low, high = (runs.flatten().field(k).to_numpy().astype(np.int64) for k in (0, 1))
            first = np.concatenate([[0], np.cumsum(count)])
            roll = rolling(3)
            for i, j in pieces(at, 1 << 22):
                hashes, counts = [], np.zeros(j - i, np.int64)
                for a, b in pieces(at[i : j + 1] - at[i]):
                    a, b = a + i, b + i
                    mine = slice(first[a], first[b])
                    lo, size = low[mine], high[mine] - low[mine] + 1
                    text = np.repeat(np.arange(a, b), count[a:b])
                    start = np.arange(int(size.sum())) + np.repeat(lo + at[text] - at[a] - (np.cumsum(size) - size), size)
                    hashes.append(roll.runs(roll.of_bytes(data[at[a] : at[b]]), start, start + length))
                    counts[a - i : b - i] = np.bincount(text - a, size, b - a).astype(np.int64)
                yield from pack(key[i:j], counts, np.concatenate(hashes), blocks)

    return docs.mapInArrow(rows, PACKED)


def more_than_one(text: np.ndarray, begin: np.ndarray) -> np.ndarray:
    size = np.diff(begin, append=len(text))
    return np.repeat(size > 1, size)


def remove_repeated_strings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of `docs` (doc_id, text) as doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (start, end in bytes).

    A byte goes when a string of `length` bytes that covers it starts anywhere else too, in this or another row;
    strings lie within one text and are judged on the input. kept_sha256 is of the bytes that stay, which may split
    a character. Null texts are empty. Equal rows are copies of one another, so they lose all their bytes if they
    are long enough. No rows give no rows; other columns are ignored.
    """
    docs = docs.select("doc_id", "text", row_key().alias("key"))
    blocks = shuffle_partitions(docs.sparkSession)
    long = docs.where(F.octet_length("text") >= length)
    runs = stored(anchored_runs(long.select("key", "text"), length), "runs")
    shared = stored(runs.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "grams")
    runs = stored(join_few(runs, shared, "gram").where("n is not null").drop("n"), "shared-runs")

    wholes = stored(
        runs.groupBy("gram", "whole").agg(F.count("*").alias("n"), F.min(F.struct("key", "low", "high")).alias("one")), "wholes"
    )
    settled = runs.join(moved(wholes.where("n > 1").select("gram", "whole")), ["gram", "whole"]).select("key", "low", "high")
    open_grams = wholes.groupBy("gram").agg(F.count("*").alias("classes"), F.min("n").alias("fewest")).where("classes > 1 and fewest = 1")
    rest = wholes.join(moved(open_grams.select("gram")), "gram").select("one.*")
    rest = stored(rest.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("low", "high"))).alias("runs")), "open-runs")
    texts = join_few(long.select("key", "text"), rest, "key").where("runs is not null").dropDuplicates(["key"])
    found = matched(string_rows(texts.select("key", "text", "runs"), length, blocks), blocks, more_than_one)

    settled = settled.groupBy("key").agg(F.collect_set(F.struct("low", "high")).alias("whole_runs"))
    hits = stored(settled.join(found.withColumnRenamed("id", "key"), "key", "full").join(rest, "key", "left"), "repeats")

    def cut(batches):
        for batch in batches:
            cols = [[], [], [], [], []]
            for text, whole, places, mine in zip(*(batch.column(c) for c in ("text", "whole_runs", "places", "runs"))):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                found = []
                kept = data
                if whole.is_valid or places.is_valid:
                    step = np.zeros(len(data) + 1, np.int32)
                    if whole.is_valid:
                        np.add.at(step, whole.values.field(0).to_numpy(), 1)
                        np.add.at(step, whole.values.field(1).to_numpy() + length, -1)
                    if places.is_valid:
                        low, high = (mine.values.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                        size = high - low + 1
                        start = np.arange(int(size.sum())) + np.repeat(low - (np.cumsum(size) - size), size)
                        start = start[places.values.to_numpy()]
                        np.add.at(step, start, 1)
                        np.add.at(step, start + length, -1)
                    gone = np.cumsum(step[:-1]) > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    found = [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                for col, v in zip(cols, (len(data), len(data) - len(kept), len(found), hashlib.sha256(kept).hexdigest(), found)):
                    col.append(v)
            kinds = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    return join_few(docs, hits, "key").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>"
    )
