"""Language by nearest centroid over TF-IDF vectors of letter n-grams.

A text's letters are counted as hashed byte 2-grams and 3-grams, weighted by how rare they are over all labelled
texts, and normalised. Each language has several centroids, clustered from a bounded sample of its texts; a text
takes the language of the centroid with the greatest cosine. Every centroid has a distance beyond which it rejects:
such a text is like none of the languages learned, which is said beside the nearest one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import top_rows
from .common import pieces, stored, text_bytes

TWO, THREE = 1 << 10, 1 << 12  # slots for 2-grams and 3-grams
DIMS = TWO + THREE
SAMPLE = 3000  # texts that the centroids are clustered from, all languages together; at least one of each
CENTROIDS = 4  # for each language
REJECT = 0.02  # share of the sample that its own centroids reject
ROWS = 512  # texts whose counts a task holds at once

_LETTERS = np.full(256, 0x20, np.uint8)  # other characters are gaps; A-Z in lower case
_LETTERS[0x80:] = np.arange(0x80, 256)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)


def gram_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts of hashed n-grams, one row for each text."""
    n = len(at) - 1
    spaced = np.full(len(data) + 2 * n + 1, 0x20, np.uint8)  # a gap before and after each text
    text = np.repeat(np.arange(n), np.diff(at))
    spaced[np.arange(len(data)) + 2 * text + 1] = _LETTERS[data]
    owner = np.repeat(np.arange(n), np.diff(at) + 2)
    x = spaced.astype(np.uint32)
    two = x[:-1] | x[1:] << 8
    three = two[:-1] | x[2:] << 16
    slot2 = (two * np.uint32(2654435761) >> np.uint32(22)).astype(np.int64)[: len(owner) - 1]
    slot3 = (three * np.uint32(2246822519) >> np.uint32(20)).astype(np.int64)[: max(0, len(owner) - 2)]
    keep2 = (owner[:-1] == owner[1:]) & (two[: len(owner) - 1] != 0x2020)
    keep3 = (owner[:-2] == owner[2:]) & (three[: max(0, len(owner) - 2)] & 0xFFFF != 0x2020) & (three[: max(0, len(owner) - 2)] >> 8 != 0x2020)
    out = np.empty((n, DIMS), np.float32)
    out[:, :TWO] = np.bincount(owner[: len(slot2)][keep2] * TWO + slot2[keep2], minlength=n * TWO).reshape(n, TWO)
    out[:, TWO:] = np.bincount(owner[: len(slot3)][keep3] * THREE + slot3[keep3], minlength=n * THREE).reshape(n, THREE)
    return out


def runs(column: pa.Array):
    """(first, end, counts) over a column of texts, a bounded number at a time."""
    data, at = text_bytes(column)
    for i, j in pieces(at):
        for a in range(i, j, ROWS):
            b = min(a + ROWS, j)
            yield a, b, gram_counts(data[at[a] : at[b]], at[a : b + 1] - at[a])


def unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def cluster(x: np.ndarray, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centroids and each row's cosine to the nearest."""
    rng = np.random.default_rng(seed)
    centers = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(12):
        near = (x @ centers.T).argmax(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        norm = np.sqrt((sums * sums).sum(1, keepdims=True))
        centers = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centers)
    return centers, (x @ centers.T).max(1)


def fit(labelled: DataFrame) -> dict:
    """Learns from `labelled` (text, lang); rows with a null in either are left out.

    Document frequencies are counted over all rows. The centroids come from at most SAMPLE different texts, the same
    number of each language where there are as many, chosen by a hash of the text; with more languages than SAMPLE
    there is one of each. Copies of a text count once here, so no language is lost to the copies of another text.
    """
    rows = labelled.select("text", F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")

    def count(batches):
        n, total = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for _, _, counts in runs(batch.column("text")):
                n += (counts > 0).sum(0)
                total += len(counts)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(n[used], total))], ["slot", "n"])

    found = rows.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros(DIMS)
    known = found[found["slot"] >= 0]
    seen[known["slot"].to_numpy()] = known["n"].to_numpy()
    total = int(found.loc[found["slot"] < 0, "n"].sum())
    idf = np.log((1 + total) / (1 + seen)).astype(np.float32) + 0.05

    keys = rows.select("lang", F.xxhash64("text", F.lit(3)).alias("h")).distinct()
    languages = rows.select("lang").distinct().count()
    drawn = stored(top_rows(keys, ["lang"], [F.col("h")], max(1, SAMPLE // max(1, languages))), "drawn-texts")
    chosen = rows.withColumn("h", F.xxhash64("text", F.lit(3))).join(drawn, ["lang", "h"], "left_semi")
    chosen = chosen.groupBy("lang", "h").agg(F.min("text").alias("text"))

    def vectors(batches):
        for batch in batches:
            lang = batch.column("lang")
            for a, b, counts in runs(batch.column("text")):
                yield pa.RecordBatch.from_arrays([lang[a:b], pa.array([x.tobytes() for x in np.minimum(counts, 65535).astype(np.uint16)], pa.binary())], ["lang", "counts"])

    sample = chosen.select("lang", "text").mapInArrow(vectors, "lang string, counts binary").toPandas()
    sample = sample.sort_values(["lang", "counts"], ignore_index=True)
    names, centers, limits = [], [], []
    for i, (lang, part) in enumerate(sample.groupby("lang", sort=True)):
        x = unit(np.stack([np.frombuffer(c, np.uint16) for c in part["counts"]]).astype(np.float32), idf)
        own, cosine = cluster(x, CENTROIDS, i)
        names += [lang] * len(own)
        centers.append(own)
        limits += [float(np.quantile(cosine, REJECT))] * len(own)
    return {"idf": idf, "names": names, "limits": np.array(limits), "centers": np.concatenate(centers) if centers else np.empty((0, DIMS), np.float32)}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score (cosine of the nearest centroid) and rejected for each row of `docs` (doc_id, text).

    A text that is null or has no letter is `und` with score 0 and rejected; so is every text if no language was
    learned. No rows give no rows; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))

    def nearest(batches):
        model = sent.value
        names = np.array([*model["names"], "und"], dtype=object)
        for batch in batches:
            ok = batch.column("lettered").to_numpy(zero_copy_only=False) & (len(model["names"]) > 0)
            best, score = np.full(batch.num_rows, len(names) - 1), np.zeros(batch.num_rows)
            if ok.any():
                for a, b, counts in runs(batch.column("text")):
                    cosine = unit(counts, model["idf"]) @ model["centers"].T
                    best[a:b], score[a:b] = cosine.argmax(1), cosine.max(1)
            best[~ok], score[~ok] = len(names) - 1, 0
            limit = np.append(model["limits"], 2.0)[best]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names[best], pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(score < limit)],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    rows = docs.select("doc_id", "text", lettered.alias("lettered"))
    return rows.mapInArrow(nearest, "doc_id long, lang_pred string, score double, rejected boolean")


def fold(doc_id: Column, of: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo `of`."""
    return F.crc32(doc_id.cast("string")) % of
