"""What the operators of this folder share: stored tables, text as bytes, words, hashes and components."""

from __future__ import annotations

import ctypes

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir

PIECE_BYTES = 1 << 18  # texts are worked on in runs of about so many bytes
HELD_EDGES = 1 << 19  # that a task joins at once

# fixed values: the bytes that end a word, [\x20\x09-\x0D]
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again, which cuts their lineage.

    The folder goes when the session's file system is closed.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key() -> Column:
    """What tells rows of documents apart where doc_id may be null or repeated: only equal rows share it."""
    return F.xxhash64("doc_id", "text")


def moved(df: DataFrame) -> DataFrame:
    """Takes a side off its key's partitions, so that a join on that key shuffles both sides anew
    and adaptive execution may split a frequent key."""
    return df.repartition(F.xxhash64(*df.columns, F.lit(1)))


def trimmed(work):
    """`work` over Arrow batches, after which the worker's unused memory goes back to the machine.

    A Python worker serves one stage after the other, and would keep the most that any of them took.
    """

    def run(batches):
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return run


# ---- texts as bytes ----


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and where each begins; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def pieces(at: np.ndarray, limit: int = PIECE_BYTES):
    """Runs (first, end) of texts with about `limit` bytes in each; a longer text is a run of its own."""
    first, n = 0, len(at) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield first, end
        first = end


# ---- hashes: polynomials modulo 2**64 over random values, mixed at the end ----


def mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _seeded(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15))


class Rolling:
    """Hashes of any run of a sequence in constant time, from one running sum."""

    def __init__(self, seed: int = 0):
        self.values = _seeded(256, 2 * seed + 1)
        self.base = int(_seeded(1, 2 * seed + 2)[0]) | 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * PIECE_BYTES)
            powers = []
            for x in (self.base, self.inverse):
                steps = np.full(n, x, np.uint64)
                steps[0] = 1
                powers.append(np.multiply.accumulate(steps))
            self.up, self.down = powers

    def sums(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def of_bytes(self, data: np.ndarray) -> np.ndarray:
        return self.sums(self.values[data])

    def runs(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each run [start, end); its length counts."""
        return mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_ROLLING: dict[int, Rolling] = {}


def rolling(seed: int = 0) -> Rolling:
    if seed not in _ROLLING:
        _ROLLING[seed] = Rolling(seed)
    return _ROLLING[seed]


def word_bounds(data: np.ndarray, at: np.ndarray, between: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in the bytes, and for each text the number of its first word; `between` marks bytes of no word."""
    n = len(data)
    solid = ~between[data]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    closes = np.zeros(n + 1, bool)
    closes[1:n] = solid[:-1] & ~solid[1:]
    if n:
        closes[n] = solid[-1]
    inner = at[(at > 0) & (at < n)]  # a word ends with its text
    opens[inner] = solid[inner]
    closes[inner] |= solid[inner - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes)
    return start, end, np.searchsorted(start, at)


def word_hashes(data: np.ndarray, at: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word in order, and for each text the number of its first word."""
    if lower:
        data = _LOWER[data]
    start, end, first = word_bounds(data, at)
    roll = rolling(0)
    return roll.runs(roll.of_bytes(data), start, end), first


def gram_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each run of `size` words that lies in one text, in order."""
    roll = rolling(1)
    counts = np.diff(first)
    each = np.maximum(counts - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), each)
    begin = np.cumsum(each) - each
    place = np.arange(int(each.sum())) - np.repeat(begin, each) + np.repeat(first[:-1], each)
    return roll.runs(roll.sums(words), place, place + size), text


def lists(values: np.ndarray, counts: np.ndarray, kind=None) -> pa.Array:
    """One list for each count, from the values in order."""
    at = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values, kind))


# ---- components ----


def spanned(edges: DataFrame) -> DataFrame:
    """Edges (a, b), a > b, that lead to the same as `edges`: of some of a task's edges at a time, each id and the smallest that they lead to."""
    most = HELD_EDGES

    def stars(a, b):
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        a, b, low = at[: len(a)], at[len(a) :], np.arange(len(ids))
        while True:
            a, b = low[a], low[b]
            apart = a != b
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
            while (low[low] != low).any():
                low = low[low]
        linked = np.flatnonzero(low != np.arange(len(ids)))
        return ids[linked], ids[low[linked]]

    def span(batches):
        held, n = [], 0
        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in ("a", "b")])
            n += batch.num_rows
            if n > most:
                held = [stars(*map(np.concatenate, zip(*held)))]
                n = len(held[0][0])
                if n > most // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["a", "b"])
                    held, n = [], 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in stars(*map(np.concatenate, zip(*held)))], ["a", "b"])

    return edges.mapInArrow(trimmed(span), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in `edges` (a, b): the smallest id that links lead to.

    Tasks first reduce their own edges, twice, the second time with all that is left of an id in one task; an id is
    then a row a task at most, however many edges it has. Where that does not point every id to its smallest, large
    stars and small stars follow in turn, each as joins and minima, and the number of rounds grows with the logarithm
    of the longest chain.
    """

    def fewer(links):
        return stored(spanned(spanned(links).repartition("a")), "edges")

    now = fewer(edges.where("a <> b").select("a", "b"))
    while True:
        named = now.select(F.col("a").alias("id"), "b").unionByName(now.select(F.col("b").alias("id"), "b"))
        named = named.groupBy("id").agg(F.min("b").alias("component"), F.max("b").alias("other"))
        if not named.where("component <> other").limit(1).count():
            return named.select("id", "component")
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(moved(lowest), "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(moved(low), "a").select(F.explode(F.array(F.struct("a", "low"), F.struct(F.col("b").alias("a"), "low"))).alias("e"))
        now = fewer(small.select(F.col("e.a").alias("a"), F.col("e.low").alias("b")).where("a <> b"))


# ---- a join that moves few of the left rows ----


def bit_map(rows: DataFrame, slot: str, bits: int) -> np.ndarray:
    """A map of `bits` bits, those set that occur in the column `slot` (0 to bits - 1).

    It comes to the driver as Arrow columns, a dozen bytes for each word of the map; as rows it would be Python objects.
    """
    words = (
        rows.groupBy((F.col(slot) / 64).cast("int").alias("w"))
        .agg(F.expr(f"bit_or(shiftleft(1L, cast({slot} % 64 as int)))").alias("m"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    out[words["w"].to_numpy()] = words["m"].to_numpy()
    return out


def join_few(left: DataFrame, right: DataFrame, key: str, bits: int = 1 << 24) -> DataFrame:
    """Left outer join with a side (stored, one row for each key) that lacks most of the left side's keys.

    A bit map of fixed size says which left rows may have a partner; only those are shuffled, the others go
    straight through. Once the map is full, at very many keys, every row is shuffled: slower, never wrong.
    """
    spark = left.sparkSession
    slot = F.pmod(F.xxhash64(key), F.lit(bits))
    sent = spark.sparkContext.broadcast(bit_map(right.select(slot.alias("s")), "s", bits))

    @F.pandas_udf("boolean")
    def may(s: pd.Series) -> pd.Series:
        s = s.to_numpy()
        return pd.Series((sent.value[s // 64] >> (s % 64)) & 1 == 1)

    flag = "__may"
    while flag in left.columns:
        flag += "_"
    marked = left.withColumn(flag, may(slot))
    names = [c for c in right.columns if c != key]
    kinds = dict(right.dtypes)
    quiet = marked.where(~F.col(flag)).drop(flag).withColumns({c: F.lit(None).cast(kinds[c]) for c in names})
    busy = marked.where(F.col(flag)).drop(flag).join(right, key, "left")
    return quiet.unionByName(busy)
