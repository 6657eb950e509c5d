"""Near copies of vectors by a subspace pigeonhole join.

Unit vectors are turned by a fixed rotation and cut into blocks of a few dimensions. The squared distance of two
vectors is the sum of their blocks' squared distances, so two vectors within the allowed distance are, in at least
one block, within that block's proportional share of it. Each block is therefore range-joined on its own: a grid
over the block's first dimensions, one cell wide as the share's radius, puts partners into the same or touching
cells, and the block's distance decides. The union of what the blocks find is checked by cosine.

Equal vectors are one representative, so copies are never compared with one another. Vectors are sent through the
grid without their other blocks and meet again only as candidates.

Cells are counted before anything is sent. A cell of many rows is cut into parts by a hash of the representative, and
a task compares one part with one part, so no cell has to fit into a task, however many vectors lie close together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, moved, shuffle_partitions, stored, trimmed

BLOCK_DIMS, GRID_DIMS = 8, 3
CELL_ROWS = 1024  # rows that a task compares at once; further ones are taken in turn
PART_ROWS = 4096  # about so many rows of a cell are a part
SLACK = 1e-9  # for rounding of unit vectors and rotation
FLOAT_SLACK = 1e-6  # for squared distances of blocks, which are sent in single precision
CELL = ["label", "dims", "block", "g0", "g1", "g2"]


def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def block_radius(reach: float, width: int, dims: int) -> float:
    """The share of the allowed squared distance that a block of `width` dimensions has, as a distance."""
    return float(np.sqrt(reach * width / dims) + SLACK)


def cells(reps: DataFrame, reach: float, coords: bool = True) -> DataFrame:
    """Each representative's blocks, in its own cell (home) and in those around it that come later in order.

    coords are the block's numbers in single precision; the cells are found in double precision. Without them
    there are the columns of the cell alone, to count by.
    """

    def place(batches):
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            for d in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == d))
                if d not in turns:
                    turns[d] = rotation(d)
                x = part.column("unit").flatten().to_numpy().reshape(-1, d) @ turns[d]
                for k, first in enumerate(range(0, d, BLOCK_DIMS)):
                    block = x[:, first : first + BLOCK_DIMS]
                    radius = block_radius(reach, block.shape[1], d)
                    g = min(GRID_DIMS, block.shape[1])
                    grid = np.zeros((len(block), GRID_DIMS), np.int64)
                    grid[:, :g] = np.floor(block[:, :g] / radius)
                    wide = np.zeros((len(block), BLOCK_DIMS), np.float32)
                    wide[:, : block.shape[1]] = block
                    packed = pa.Array.from_buffers(pa.binary(4 * BLOCK_DIMS), len(block), [None, pa.py_buffer(wide)]).cast(pa.binary())
                    near = np.array(np.meshgrid(*[[-1, 0, 1] if i < g else [0] for i in range(GRID_DIMS)], indexing="ij")).reshape(GRID_DIMS, -1).T
                    for move in near:
                        if tuple(move) < (0,) * GRID_DIMS:
                            continue
                        at = grid + move
                        where = [part.column("label"), part.column("dims"), pa.array(np.full(len(block), k, np.int32)), *[pa.array(at[:, i]) for i in range(GRID_DIMS)]]
                        more = [part.column("rep"), pa.array(np.full(len(block), not move.any())), packed] if coords else []
                        yield pa.RecordBatch.from_arrays(where + more, CELL + ["rep", "home", "coords"][: len(more)])

    kinds = "label int, dims int, block int, g0 long, g1 long, g2 long"
    return reps.mapInArrow(place, kinds + ", rep long, home boolean, coords binary" if coords else kinds)


def in_parts(rows: DataFrame, crowded: DataFrame) -> DataFrame:
    """The rows with the two parts (i, j) of their cell that a task compares, and their own (mine).

    `crowded` has the cells of several parts and how many they are. There a row goes to the tasks where its part is
    the second one, and, at home, to those where it is the first; a pair of rows meets once in each order.
    """
    mine = F.pmod(F.xxhash64("rep"), "parts").cast("int")
    rows = rows.join(crowded, CELL, "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("mine", mine)
    steps = F.sequence(F.lit(0), F.col("parts") - 1)
    second = F.transform(steps, lambda p: F.struct(p.alias("i"), F.col("mine").alias("j")))
    first = F.transform(steps, lambda p: F.struct(F.col("mine").alias("i"), p.alias("j")))
    both = F.when(F.col("home"), F.array_distinct(F.concat(second, first))).otherwise(second)
    return rows.withColumn("at", F.explode(both)).select(*CELL, "at.i", "at.j", "mine", "rep", "home", "coords")


def numbers(coords: pa.ChunkedArray) -> np.ndarray:
    """The blocks' numbers, a row each, in double precision."""
    flat = coords.combine_chunks().cast(pa.large_binary())
    at = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    return np.frombuffer(flat.buffers()[2], np.uint8)[at[0] : at[-1]].view(np.float32).reshape(-1, BLOCK_DIMS).astype(np.float64)


def block_pairs(rows: DataFrame, reach: float, partitions: int) -> DataFrame:
    """Candidate pairs (a, b): block distance within the radius, from the same or touching cells."""
    key = [*CELL, "i", "j"]

    def compare(table):
        rep, home, mine = (table.column(c).to_numpy() for c in ("rep", "home", "mine"))
        x = numbers(table.column("coords"))
        dims, block = table.column("dims")[0].as_py(), table.column("block")[0].as_py()
        limit = block_radius(reach, min(BLOCK_DIMS, dims - block * BLOCK_DIMS), dims) ** 2 + FLOAT_SLACK
        norms = (x * x).sum(1)
        own = np.flatnonzero(home & (mine == table.column("i")[0].as_py()))
        others = np.flatnonzero(mine == table.column("j")[0].as_py())
        for first in range(0, len(own), CELL_ROWS):
            a = own[first : first + CELL_ROWS]
            for begin in range(0, len(others), CELL_ROWS):
                b = others[begin : begin + CELL_ROWS]
                apart = norms[a][:, None] + norms[b][None, :] - 2 * (x[a] @ x[b].T)
                ok = (apart <= limit) & (~home[b][None, :] | (rep[a][:, None] < rep[b][None, :]))
                i, j = np.nonzero(ok)
                if len(i):
                    p, q = rep[a[i]], rep[b[j]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], ["a", "b"])

    def by_cell(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            keys = [held.column(c).to_numpy() for c in key]  # at most two parts of a cell are held from batch to batch
            begin = np.flatnonzero(np.logical_or.reduce([np.concatenate([[True], k[1:] != k[:-1]]) for k in keys]))
            for i, j in zip(begin[:-1].tolist(), begin[1:].tolist()):
                yield from compare(held.slice(i, j - i))
            held = held.slice(int(begin[-1])) if len(begin) else None
        if held is not None and held.num_rows:
            yield from compare(held)

    return rows.repartition(partitions, *key).sortWithinPartitions(*key).mapInArrow(trimmed(by_cell), "a long, b long").distinct()


def near_vectors(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of `vectors` (vec_id, embedding, label).

    Two rows are linked when their labels are equal and not null, their dimensions are equal and their cosine, in
    double precision, is at least `cosine` (above 0). A vector that is null, empty, zero or has null or non-finite
    components is linked with nothing. component_id is the smallest vec_id that links lead to; kept says that it is
    the row's own. Rows that repeat a vec_id are rows of their own. No rows give no rows; other columns are ignored.
    """
    partitions = shuffle_partitions(vectors.sparkSession)
    rows = vectors.select("vec_id", F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    # scaled by the largest component first, so that squares neither overflow nor vanish
    largest = F.aggregate("x", F.lit(0.0), lambda s, v: F.greatest(s, F.abs(v)))
    rows = rows.withColumn("ok", F.col("label").isNotNull() & F.coalesce(F.size("x") > 0, F.lit(False)) & F.coalesce(finite, F.lit(False)))
    rows = rows.withColumn("ok", F.col("ok") & F.coalesce(F.when(F.col("ok"), largest) > 0, F.lit(False)))
    rows = rows.withColumn("same", F.when(F.col("ok"), F.xxhash64("label", F.size("x"), "x", F.sha2(F.to_json("x"), 256))))
    rows = stored(rows, "vectors")
    reps = rows.where("ok").groupBy("same").agg(
        F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.any_value("label").alias("label"), F.any_value("x").alias("x")
    )
    scaled = F.transform("x", lambda v: v / F.array_max(F.transform("x", F.abs)))
    reps = reps.withColumn("y", scaled)
    reps = reps.withColumn("norm", F.sqrt(F.aggregate("y", F.lit(0.0), lambda s, v: s + v * v)))
    reps = reps.select(F.col("same").alias("rep"), "low", "copies", "label", F.size("x").alias("dims"), "y", "norm", F.expr("transform(y, v -> v / norm)").alias("unit"))
    reps = stored(reps, "vector-classes")

    reach, units = 2 - 2 * cosine, reps.select("rep", "label", "dims", "unit")
    crowded = cells(units, reach, coords=False).groupBy(CELL).count().where(F.col("count") > PART_ROWS)
    crowded = stored(crowded.select(*CELL, F.ceil(F.col("count") / PART_ROWS).cast("int").alias("parts")), "crowded-cells")
    pairs = block_pairs(in_parts(cells(units, reach), crowded), reach, partitions)
    side = reps.select("rep", "y", "norm", "copies")
    both = pairs.join(side.toDF("a", "ya", "na", "ca"), "a").join(side.toDF("b", "yb", "nb", "cb"), "b")
    product = F.aggregate(F.zip_with("ya", "yb", lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    links = stored(both.where(product / (F.col("na") * F.col("nb")) >= cosine).select("a", "b", "ca", "cb"), "vector-links")

    degree = links.select(F.explode(F.array(F.struct(F.col("a").alias("rep"), F.col("cb").alias("n")), F.struct(F.col("b").alias("rep"), F.col("ca").alias("n")))).alias("e"))
    degree = degree.groupBy("e.rep").agg(F.sum("e.n").alias("n"))
    named = components(links.select("a", "b")).toDF("rep", "component")
    joined = reps.select("rep", "low", "copies").join(moved(named), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    lowest = joined.groupBy("component").agg(F.min("low").alias("component_id"))
    classes = joined.join(moved(lowest), "component").join(moved(degree), "rep", "left")
    classes = classes.select(F.col("rep").alias("same"), "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.select("vec_id", "same").join(moved(classes), "same", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
