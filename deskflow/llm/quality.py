"""Quality by a byte-level convolutional network, in numpy.

Learned filters of eight bytes slide over a text in steps of four. A text is covered from end to end by chunks of
512 bytes, each overlapping half of the next; each filter's greatest response in a chunk is kept, and the mean and
the maximum over all chunks go into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, stored, text_bytes

WIDTH, STEP, HALF, FILTERS = 8, 4, 256, 16
SAMPLE_ROWS, SAMPLE_BYTES = 1500, 6 << 20  # of each label, about, that the network is trained on
STEPS, BATCH, RATE = 1000, 16, 0.01


def laid_out(data: np.ndarray, at: np.ndarray):
    """Texts in whole half-chunks, each ending with at least STEP zero bytes; and the first half-chunk of each."""
    size = np.diff(at)
    halves = np.where(size > 0, -(-(size + STEP) // HALF), 0)
    first = np.concatenate([[0], np.cumsum(halves)])
    out = np.zeros(int(first[-1]) * HALF + WIDTH, np.uint8)
    out[np.arange(len(data)) + np.repeat(first[:-1] * HALF - at[:-1], size)] = data
    return out, first


def responses(weights: np.ndarray, laid: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(half-chunks, places, filters): what each filter says at each place."""
    n = int(first[-1]) * HALF // STEP
    out = np.zeros((n, FILTERS), np.float32)
    for k in range(WIDTH):
        out += weights[k].take(laid[k : k + n * STEP : STEP], axis=0)
    out = out.reshape(-1, HALF // STEP, FILTERS)
    out[first[1:][np.diff(first) > 0] - 1, -1] = -np.inf  # nothing but the zeros at the end of a text
    return out


def chunks(first: np.ndarray):
    """For each chunk its two halves (one, in a text of one half) and for each text its first chunk."""
    halves = np.diff(first)
    count = np.where(halves > 0, np.maximum(halves - 1, 1), 0)
    begin = np.concatenate([[0], np.cumsum(count)])
    left = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], count)
    return left, left + np.repeat((halves > 1).astype(np.int64), count), begin


def pooled(peaks: np.ndarray, first: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Mean and maximum over the chunks of each text, zero for an empty one."""
    left, right, begin = chunks(first)
    out = np.zeros((len(first) - 1, 2 * FILTERS), np.float32)
    has = np.diff(begin) > 0
    if has.any():
        best = np.maximum(np.maximum(peaks[left], peaks[right]) + bias, 0)
        starts = begin[:-1][has]
        out[has, :FILTERS] = np.add.reduceat(best, starts, axis=0) / np.diff(begin)[has][:, None]
        out[has, FILTERS:] = np.maximum.reduceat(best, starts, axis=0)
    return out


def probability(model: dict, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    laid, first = laid_out(data, at)
    x = pooled(responses(model["filters"], laid, first).max(1), first, model["bias"])
    return 1 / (1 + np.exp(-np.clip(x @ model["out"] + model["base"], -30, 30).astype(np.float64)))


def train(texts: list[bytes], labels: np.ndarray, seed: int = 7) -> dict:
    """Gradient steps (Adam) over whole texts; each filter learns at the places where its response was greatest."""
    rng = np.random.default_rng(seed)
    p = {
        "filters": rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "out": rng.normal(0, 0.3, 2 * FILTERS).astype(np.float32),
        "base": np.zeros(1, np.float32),
    }
    one, two = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    steps = 0
    while steps < STEPS:
        order = rng.permutation(len(texts))
        for b in range(0, len(order), BATCH):
            mine = order[b : b + BATCH]
            at = np.concatenate([[0], np.cumsum([len(texts[i]) for i in mine])])
            laid, first = laid_out(np.frombuffer(b"".join(texts[i] for i in mine), np.uint8), at)
            r = responses(p["filters"], laid, first)
            spot = r.argmax(1)
            peaks = np.take_along_axis(r, spot[:, None], 1)[:, 0]
            x = pooled(peaks, first, p["bias"])
            guess = 1 / (1 + np.exp(-np.clip(x @ p["out"] + p["base"], -30, 30)))
            slope = ((guess - labels[mine]) / len(mine)).astype(np.float32)
            g = {k: np.zeros_like(v) for k, v in p.items()}
            g["out"], g["base"][0] = x.T @ slope, slope.sum()
            left, right, begin = chunks(first)
            if len(left):
                later = peaks[right] > peaks[left]
                half = np.where(later, right[:, None], left[:, None])
                best = np.take_along_axis(peaks, half, 0) + p["bias"]
                flow = np.zeros_like(best)
                for t in range(len(mine)):
                    a, z = begin[t], begin[t + 1]
                    if z > a:
                        flow[a:z] += slope[t] * p["out"][:FILTERS] / (z - a)
                        flow[a + best[a:z].argmax(0), np.arange(FILTERS)] += slope[t] * p["out"][FILTERS:]
                flow[best <= 0] = 0
                g["bias"] = flow.sum(0)
                place = half * (HALF // STEP) + np.take_along_axis(spot, half, 0)
                f = np.broadcast_to(np.arange(FILTERS), place.shape)
                for k in range(WIDTH):
                    g["filters"][k] = np.bincount(
                        (laid[place * STEP + k].astype(np.int64) * FILTERS + f).ravel(), flow.ravel(), 256 * FILTERS
                    ).reshape(256, FILTERS)
            steps += 1
            for k in p:
                one[k] = 0.9 * one[k] + 0.1 * g[k]
                two[k] = 0.999 * two[k] + 0.001 * g[k] * g[k]
                p[k] = (p[k] - RATE * (one[k] / (1 - 0.9**steps)) / (np.sqrt(two[k] / (1 - 0.999**steps)) + 1e-6)).astype(np.float32)
    return p


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Learns from the texts of `docs` (doc_id, text) that `labels` (doc_id, quality 0 or 1) say something of.

    Labels with another quality or no doc_id are left out; null texts are empty. Labels and texts that are repeated
    count once. About SAMPLE_ROWS labels of each kind are drawn by a hash of doc_id before texts are read, and their
    texts, which stay whole, are thinned text by text if they have more than SAMPLE_BYTES. Without texts of both labels every text is as likely one as the other.
    """

    def thinned(rows: DataFrame, shares: dict, *drawn_by) -> DataFrame:
        chance = F.shiftrightunsigned(F.xxhash64(*drawn_by), 11) / float(1 << 53)
        share = F.lit(0.0)
        for q, part in shares.items():
            share = F.when(F.col("quality") == q, F.lit(min(1.0, part))).otherwise(share)
        return rows.where(chance < share)

    labels = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("quality in (0, 1) and doc_id is not null").distinct()
    counts = labels.groupBy("quality").agg(F.count("*").alias("n")).collect()
    drawn = stored(thinned(labels, {q: SAMPLE_ROWS / n for q, n in counts}, "doc_id", F.lit(5)), "labels")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(drawn, "doc_id")
    texts = stored(texts.groupBy("doc_id", "quality", F.xxhash64("text").alias("h")).agg(F.min("text").alias("text")), "labelled-texts")
    sizes = texts.groupBy("quality").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    sample = thinned(texts, {q: SAMPLE_BYTES / max(n, 1) for q, n in sizes}, "doc_id", "h", F.lit(6)).toPandas()
    sample = sample.sort_values(["quality", "doc_id", "text"], ignore_index=True)
    truth = sample["quality"].to_numpy(np.float32)
    if len(set(truth.tolist())) < 2:
        shapes = {"filters": (WIDTH, 256, FILTERS), "bias": FILTERS, "out": 2 * FILTERS, "base": 1}
        return {k: np.zeros(v, np.float32) for k, v in shapes.items()}
    return train([t.encode() for t in sample["text"]], truth)


def scored(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score at least 0.5) for each row of `docs` (doc_id, text).

    Null and empty texts get the score of a text without chunks. No rows give no rows; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            out = np.zeros(batch.num_rows)
            for i, j in pieces(at, 1 << 19):
                out[i:j] = probability(sent.value, data[at[i] : at[j]], at[i : j + 1] - at[i])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out), pa.array((out >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double, predicted int")


def score_of(spark: SparkSession, model: dict):
    """The score as a function of a text column, for filters that keep a row's other columns."""
    sent = spark.sparkContext.broadcast(model)

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in texts:
            data, at = text_bytes(text)
            out = np.zeros(len(text))
            for i, j in pieces(at, 1 << 19):
                out[i:j] = probability(sent.value, data[at[i] : at[j]], at[i : j + 1] - at[i])
            yield pa.array(out)

    return F.arrow_udf(score, "double")
