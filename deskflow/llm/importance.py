"""Importance resampling: draws the documents whose word features are most like those of a target set.

Features are hashed into buckets; how much more often the target has a bucket than all documents have is the bucket's
gain, and a document's weight is read from the array of gains, a whole run of texts at a time. Noise from a hash of
the doc_id turns the highest scores into a draw without replacement.

The k-th best of all composite keys (score, doc_id, and what tells equal ones apart) is found by quickselect over the
stored scores: each round draws random pivot keys from the stretch that is still open, counts exactly what lies
before, at and after each of them in one aggregate, and narrows the stretch. Only the winners are sorted then, by
ranges, and numbered; all other rows are never ordered or moved.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import number_rows
from ..session import work_dir
from .common import _LOWER, pieces, stored, text_bytes, word_bounds

PIVOTS = 16  # keys that a round of the quickselect compares with
STEPS = 64  # bytes of a word that are hashed side by side with other words

# fixed values: [0-9a-z] and all above ASCII make words
_BETWEEN = np.ones(256, bool)
_BETWEEN[0x30:0x3A] = _BETWEEN[0x61:0x7B] = _BETWEEN[0x80:] = False


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_TABLE = _crc_table()


def crc_after(before: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray, order: np.ndarray) -> np.ndarray:
    """CRC-32 of what each of `before` stands for, followed by data[start:end]; `order` has the longest first."""
    crc, at, n = ~before[order], start[order], (end - start)[order]
    for step in range(min(int(n[0]), STEPS) if len(n) else 0):
        m = int(np.searchsorted(-n, -step, side="left"))  # those with more than `step` bytes
        crc[:m] = _TABLE[(crc[:m] ^ data[at[:m] + step]) & 255] ^ (crc[:m] >> 8)
    crc = ~crc
    for i in np.flatnonzero(n > STEPS):
        crc[i] = zlib.crc32(data[at[i] + STEPS : at[i] + n[i]].tobytes(), int(crc[i]))
    out = np.empty_like(crc)
    out[order] = crc
    return out


def feature_hashes(data: np.ndarray, at: np.ndarray, longest: int = 3):
    """The words of each text, counted, and for each run length the CRC-32 of the run that ends at each word and its place."""
    data = _LOWER[data]
    start, end, first = word_bounds(data, at, _BETWEEN)
    order = np.argsort(start - end, kind="stable")
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    nth = np.arange(len(start)) - first[text]
    found, crc = [], np.zeros(len(start), np.uint32)
    for size in range(1, longest + 1):
        crc = crc_after(crc, data, start, end, order)
        ok = nth >= size - 1
        found.append((crc[ok], text[ok]))
        state = ~np.concatenate([crc[:0], np.zeros(min(1, len(crc)), np.uint32), crc[:-1]])
        crc = ~(_TABLE[(state ^ np.uint32(32)) & 255] ^ (state >> 8))  # one space after the run that ends at the word before
    return np.diff(first), found


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """How many features all texts have in each bucket."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            for i, j in pieces(at):
                for crc, _ in feature_hashes(data[at[i] : at[j]], at[i : j + 1] - at[i])[1]:
                    total += np.bincount(crc % buckets, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["bucket", "n"])

    rows = texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of how much more likely each bucket is in the target, each bucket counted once more than seen."""
    n = len(source)
    ratio = (target + 1.0) * float(source.sum() + n) / ((source + 1.0) * float(target.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_features, weight, n_words and a hash of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(gains)

    def weigh(batches):
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            for i, j in pieces(at):
                words, found = feature_hashes(data[at[i] : at[j]], at[i : j + 1] - at[i])
                weight, n = np.zeros(j - i, np.int64), np.zeros(j - i, np.int64)
                for crc, text in found:
                    total = np.concatenate([[0], np.cumsum(sent.value[crc % len(sent.value)])])
                    ends = np.searchsorted(text, np.arange(j - i + 1))
                    weight += np.diff(total[ends])
                    n += np.diff(ends)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[i:j], batch.column("tie")[i:j], pa.array(n), pa.array(weight), pa.array(words.astype(np.int64))],
                    ["doc_id", "tie", "n_features", "weight", "n_words"],
                )

    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    return rows.mapInArrow(weigh, "doc_id long, tie long, n_features long, weight long, n_words long")


def kth_key(rows: DataFrame, keys: list[str], k: int) -> tuple:
    """The k-th smallest (from 1) of the composite keys of `rows` (stored; keys are unique and not null)."""
    key = F.struct(*keys)
    low = high = None
    turn = 0
    while True:
        inside = rows
        if low is not None:
            inside = inside.where((F.col(keys[0]) >= low[0]) & (key > literal(rows, keys, low)))
        if high is not None:
            inside = inside.where((F.col(keys[0]) <= high[0]) & (key < literal(rows, keys, high)))
        drawn = inside.select(*keys).orderBy(F.xxhash64(*keys, F.lit(turn))).limit(PIVOTS).collect()
        pivots = sorted(tuple(r) for r in drawn)
        counts = inside.agg(
            *[F.count_if(key < literal(rows, keys, p)).alias(f"before{i}") for i, p in enumerate(pivots)],
            *[F.count_if(key == literal(rows, keys, p)).alias(f"at{i}") for i, p in enumerate(pivots)],
        ).first()
        passed = 0
        for i, pivot in enumerate(pivots):
            before, to = counts[f"before{i}"], counts[f"before{i}"] + counts[f"at{i}"]
            if before < k <= to:
                return pivot
            if k <= before:
                high = pivot
                break
            low, passed = pivot, to
        k -= passed
        turn += 1


def literal(rows: DataFrame, keys: list[str], values: tuple) -> Column:
    return F.struct(*[F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in zip(keys, values)])


def importance_sample(
    docs: DataFrame, target: DataFrame, share: int = 5, of: int = 100, least_words: int = 20, buckets: int = 10_000, seed: int = 42
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of each row of `docs` (doc_id, text), drawn to be like `target` (text).

    Words are runs of letters, digits and signs beyond ASCII, A-Z in lower case; features are runs of one to three of
    them. Of the rows with `least_words` or more, the share with the highest scores (rounded down) gets ranks from 1,
    equal scores to the smaller doc_id, null last, then by a hash of the text; all others have a null rank. Texts that
    are null or without words have no features and weight 0. Rows that repeat a doc_id are rows of their own and have one
    hash, so equal rows stand next to each other; a null doc_id counts as empty in the hash. No rows give no rows, and an
    empty target is one that has no features; other columns are ignored. A text is worked on whole.
    """
    spark = docs.sparkSession
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    rows = weighed(docs, gains).withColumn("score", F.col("weight") + noise)
    rows = rows.withColumns({
        "better": -F.col("score"), "unnamed": F.col("doc_id").isNull(), "id": F.coalesce("doc_id", F.lit(0)), "row": F.monotonically_increasing_id(),
    })
    rows = stored(rows, "scores")
    able = F.col("n_words") >= least_words
    k = share * rows.where(able).count() // of
    plain = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if not k:
        return rows.select(*plain, none)
    keys = ["better", "unnamed", "id", "tie", "row"]
    last = literal(rows, keys, kth_key(rows.where(able), keys, k))
    won = able & (F.struct(*keys) <= last)
    ranked = number_rows(rows.where(won), keys, "rank", work_dir(spark, "winners"))
    return ranked.select(*plain, F.col("rank").cast("long")).unionByName(rows.where(~won).select(*plain, none))
