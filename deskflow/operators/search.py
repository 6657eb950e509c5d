"""Embedding of text and nearest neighbours by cosine."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..functions.vectors import round6, unit
from ..session import work_dir

QUERY_BLOCK = 2048  # queries that go to the tasks together
PART_ROWS = 1 << 14  # stored rows that a task holds while more queries than a block pass them
QUERY_RUN = 256  # of these that are compared at once
SCORE_DECIMALS = 12  # beyond these, scores differ by the order of sums only
CELL_ROWS = 1 << 12  # stored rows of a cell of the approximate search, on average
MOST_CELLS = 1 << 10
FIT_ROWS = 1 << 14  # rows that the centres of the cells are fitted on
TRIED = 256  # queries that are answered exactly to choose how many cells are asked
RECALL = 0.95  # share of their hits that these cells must hold


def embed_with(
    df: DataFrame, column: str, model: Callable[[list[str]], np.ndarray], batch: int = 16
) -> DataFrame:
    """Adds `embedding` from a model that takes a list of texts, `batch` texts per call."""
    schema = StructType([*df.schema.fields, StructField("embedding", ArrayType(DoubleType()))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame[column].tolist()
            vectors = [
                vector
                for at in range(0, len(texts), batch)
                for vector in np.asarray(model(texts[at : at + batch]), dtype=float).tolist()
            ]
            yield frame.assign(embedding=vectors)

    return df.mapInPandas(run, schema)


def _best(ids: pd.DataFrame, vectors: np.ndarray, query_ids, queries: np.ndarray, k: int) -> pd.DataFrame:
    """The k best rows of one block for each query; of equal scores the first by the row's key columns."""
    order = ids.reset_index(drop=True).sort_values(list(ids.columns)).index.to_numpy()
    ids, vectors = ids.iloc[order], vectors[order]
    lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    query_lengths = np.sqrt(np.einsum("ij,ij->i", queries, queries))
    with np.errstate(divide="ignore", invalid="ignore"):
        scores = (queries @ vectors.T) / (query_lengths[:, None] * lengths[None, :])
    scores[np.isnan(scores)] = -np.inf
    # only scores that may be among the k best once they are rounded are looked at again
    at = max(0, scores.shape[1] - k)
    edges = np.partition(scores, at, axis=1)[:, at] - 10.0**-SCORE_DECIMALS * 2
    of, row = np.nonzero((scores >= edges[:, None]) & (scores > -np.inf))
    score = np.round(scores[of, row], SCORE_DECIMALS)
    order = np.lexsort((row, -score, of))
    of, row, score = of[order], row[order], score[order]
    kept = np.arange(len(of)) - np.searchsorted(of, of) < k
    return ids.iloc[row[kept]].assign(query_id=np.asarray(query_ids)[of[kept]], score=score[kept])


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def _final(candidates: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of all blocks by their whole score, which is rounded to six decimals only then."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), *keys)
    ranked = candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.withColumn("score", round6(F.col("score")))


def nearest(
    stored: DataFrame, queries: DataFrame, keys: list[str], k: int = 4, block: int = QUERY_BLOCK, part: int = PART_ROWS
) -> DataFrame:
    """The k stored rows nearest to each query, exact: (query_id, keys, score, rank).

    `stored` has key columns, which tell its rows apart, and `embedding`; `queries` has `query_id` and `embedding`.
    Up to `block` queries go to the tasks that read the stored rows. More are dealt to parts of about `part` stored
    rows: a task holds one part, and the queries stream past it. Either way k rows per query and task are kept.
    For query sets of the size of the table there is `nearest_approx`.
    """
    stored = stored.select(*keys, "embedding")
    fields = [stored.schema[c] for c in keys]
    schema = StructType([*fields, queries.schema["query_id"], StructField("score", DoubleType())])
    queries = queries.select("query_id", "embedding").where("embedding is not null")
    few = queries.limit(block + 1).collect()
    if not few:
        found = stored.sparkSession.createDataFrame([], schema)
    elif len(few) <= block:
        found = _scored(stored, keys, few, k, schema)
    else:
        found = _dealt(stored, queries, keys, k, schema, part)
    return _final(found, keys, k)


def _dealt(
    stored: DataFrame, queries: DataFrame, keys: list[str], k: int, schema: StructType, size: int
) -> DataFrame:
    """The k best rows of each part for each query."""
    parts = max(1, -(-stored.count() // size))
    held = stored.withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))
    sent = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return _met(held, sent, keys, k, schema)


def _met(held: DataFrame, sent: DataFrame, keys: list[str], k: int, schema: StructType) -> DataFrame:
    """The k best rows for each query of the rows with its `part`; both sides meet in a shuffle by part, the rows first."""
    vector = F.transform("embedding", lambda x: x.cast("double")).alias("embedding")
    held = held.select(
        *keys, F.lit(None).cast(schema["query_id"].dataType).alias("query_id"), vector, "part", F.lit(False).alias("asked")
    )
    sent = sent.select(
        *[F.lit(None).cast(schema[c].dataType).alias(c) for c in keys], "query_id", vector, "part", F.lit(True).alias("asked")
    )

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, ids, vectors = None, [], []
        for frame in frames:
            for (part, asked), run in frame.groupby(["part", "asked"]):
                if part != current:
                    current, ids, vectors = part, [], []
                if not asked:
                    ids.append(run[keys])
                    vectors.append(_matrix(run["embedding"]))
                elif ids:
                    ids, vectors = [pd.concat(ids)], [np.concatenate(vectors)]
                    for at in range(0, len(run), QUERY_RUN):
                        some = run.iloc[at : at + QUERY_RUN]
                        yield _best(ids[0], vectors[0], some["query_id"], _matrix(some["embedding"]), k)

    rows = held.where("embedding is not null").unionByName(sent).repartition("part")
    return rows.sortWithinPartitions("part", "asked").mapInPandas(score, schema)


def _scored(stored: DataFrame, keys: list[str], rows: list, k: int, schema: StructType) -> DataFrame:
    query_ids = [row["query_id"] for row in rows]
    shared = stored.sparkSession.sparkContext.broadcast(np.array([row["embedding"] for row in rows], dtype=float))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield _best(frame[keys], _matrix(frame["embedding"]), query_ids, shared.value, k)

    return stored.mapInPandas(score, schema)


def _centres(rows: DataFrame, keys: list[str], cells: int, seed: int) -> np.ndarray:
    """Centres of cells, by k-means over FIT_ROWS different rows; one cell needs no fit."""
    some = rows.dropDuplicates(["embedding"]).orderBy(F.xxhash64(*keys)).limit(FIT_ROWS).select(array_to_vector("embedding").alias("v"))
    if cells == 1:
        return np.zeros((1, 1))
    model = KMeans(k=cells, featuresCol="v", initMode="random", maxIter=5, seed=seed).fit(some)
    centres = np.array([c for c in model.clusterCenters()])
    return centres / np.maximum(np.sqrt((centres**2).sum(axis=1)), 1e-12)[:, None]


def _order(centres: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """For each vector the cells, that with the nearest centre first."""
    if len(centres) == 1:
        return np.zeros((len(vectors), 1), int)
    return np.argsort(-(vectors @ centres.T), axis=1, kind="stable")


def nearest_approx(
    stored: DataFrame, queries: DataFrame, keys: list[str], k: int = 4,
    cell_rows: int = CELL_ROWS, part: int = PART_ROWS, seed: int = 11,
) -> DataFrame:
    """About the k nearest rows of each query: those in the cells whose centres are nearest to it.

    Every row is in the cell of its nearest centre, with `cell_rows` rows in a cell on average; the centres are fitted
    on a bounded sample. How many cells a query asks follows from TRIED of the queries, which are answered exactly in one pass
    over all rows: as many as hold RECALL of their hits. Queries stream past the rows of a cell, and a cell of more than
    `part` rows is several parts, so a task holds no more than one part. Vectors without length are in no cell.
    """

    def hashed(df: DataFrame, columns: list[str]) -> DataFrame:
        long = df.where(F.exists("embedding", lambda x: x != 0))
        return long.select(*columns, unit(F.transform("embedding", lambda x: x.cast("double"))).alias("embedding"))

    rows, asked = hashed(stored, keys), hashed(queries, ["query_id"])
    schema = StructType([*[rows.schema[c] for c in keys], asked.schema["query_id"], StructField("score", DoubleType())])
    cells = max(1, min(MOST_CELLS, rows.count() // cell_rows))
    centres = _centres(rows, keys, cells, seed)
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    @F.pandas_udf("int")
    def cell_of(vectors: pd.Series) -> pd.Series:
        if len(shared.value) == 1 or not len(vectors):
            return pd.Series(np.zeros(len(vectors), int))
        return pd.Series((_matrix(vectors) @ shared.value.T).argmax(axis=1))

    # the index: every row with its cell, written once
    index = work_dir(rows.sparkSession, "cells")
    rows = rows.withColumn("cell", cell_of("embedding"))
    rows.write.parquet(index)
    rows = rows.sparkSession.read.schema(rows.schema).parquet(index)
    # a row for each cell; its parts are numbered from the last of the cells before it
    sizes = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()}
    n_parts = np.array([-(-sizes.get(c, 0) // part) for c in range(len(centres))])
    first = np.cumsum(n_parts) - n_parts
    probes = _probes(rows, asked, keys, k, centres)

    @F.pandas_udf("int")
    def part_of(cell: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series(first[cell] + key % n_parts[cell])

    @F.pandas_udf("array<int>")
    def parts_asked(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        near = _order(shared.value, _matrix(vectors))[:, :probes]
        return pd.Series([[p for c in some for p in range(first[c], first[c] + n_parts[c])] for some in near.tolist()])

    held = rows.withColumn("part", part_of("cell", F.xxhash64(*keys)))
    sent = asked.withColumn("part", F.explode(parts_asked("embedding")))
    return _final(_met(held, sent, keys, k, schema), keys, k)


def _probes(rows: DataFrame, asked: DataFrame, keys: list[str], k: int, centres: np.ndarray) -> int:
    """How many cells hold RECALL of the hits of TRIED queries."""
    if len(centres) == 1:
        return 1
    tried = asked.orderBy(F.xxhash64("query_id")).limit(TRIED).collect()
    hits = nearest(rows, rows.sparkSession.createDataFrame(tried, asked.schema), [*keys, "cell"], k).select("query_id", "cell").collect() if tried else []
    if not hits:
        return len(centres)
    rank = np.argsort(_order(centres, np.array([r["embedding"] for r in tried])), axis=1)
    at = {r["query_id"]: i for i, r in enumerate(tried)}
    needed = np.sort([rank[at[h["query_id"]], h["cell"]] for h in hits])
    return int(needed[int(np.ceil(RECALL * len(needed))) - 1]) + 1


def recall(exact: DataFrame, approx: DataFrame, keys: list[str]) -> DataFrame:
    """One row: hits of the exact answer, and how many of them the approximate one has."""
    found = approx.select("query_id", *keys, F.lit(1).alias("found"))
    met = exact.select("query_id", *keys).join(found, ["query_id", *keys], "left")
    return met.agg(F.count("*").alias("n_exact"), F.count("found").alias("n_found"))
