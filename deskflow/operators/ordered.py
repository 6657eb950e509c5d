"""Ordered operations that stay parallel inside one key.

A window over a key puts all rows of that key into one task. Here the key is cut into
ranges of its order column, the window runs per range, and one row per range carries
the totals or the neighbour across the cut. The result is the same for any range width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

RANGE_WIDTH = 1 << 20


def next_in_key(
    df: DataFrame, keys: list[str], order: str, name: str, width: int = RANGE_WIDTH
) -> DataFrame:
    """Adds the next larger value of a whole-number `order` column within the key, or NULL."""
    cut = df.withColumn("__range", F.floor(F.col(order) / F.lit(width)))
    starts = cut.groupBy(*keys, "__range").agg(F.min(order).alias("__start"))
    starts = starts.select(
        *keys,
        "__range",
        F.lead("__start").over(Window.partitionBy(*keys).orderBy("__range")).alias("__next_start"),
    )
    inner = F.lead(order).over(Window.partitionBy(*keys, "__range").orderBy(order))
    return (
        cut.withColumn("__next", inner)
        .join(starts, [*keys, "__range"])
        .withColumn(name, F.coalesce("__next", "__next_start"))
        .drop("__range", "__next", "__next_start")
    )


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    cut: Column,
    totals: dict[str, str],
) -> DataFrame:
    """Adds running sums (`totals`: output name -> column) in `order` within the key.

    `cut` must not decrease along `order`; rows with one value of it form a range.
    """
    ranged = df.withColumn("__range", cut)
    per_range = ranged.groupBy(*keys, "__range").agg(
        *[F.sum(src).alias(f"__sum_{out}") for out, src in totals.items()]
    )
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *keys,
        "__range",
        *[F.sum(f"__sum_{out}").over(before).alias(f"__before_{out}") for out in totals],
    )
    inner = (
        Window.partitionBy(*keys, "__range")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = ranged.withColumns(
        {f"__inner_{out}": F.sum(src).over(inner) for out, src in totals.items()}
    )
    helpers = [f"__{part}_{out}" for part in ("inner", "before") for out in totals]
    return (
        summed.join(offsets, [*keys, "__range"])
        .withColumns(
            {
                out: F.col(f"__inner_{out}") + F.coalesce(F.col(f"__before_{out}"), F.lit(0))
                for out in totals
            }
        )
        .drop("__range", *helpers)
    )


def place_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """Adds __part and __place: rows in order along range partitions, to be written once, which fixes the partitions."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.withColumns({"__part": F.spark_partition_id(), "__place": place})


PLACED = [StructField("__part", IntegerType()), StructField("__place", LongType())]


def part_sizes(placed: DataFrame) -> list[tuple[int, int]]:
    """Each partition that was written and its number of rows, in order."""
    sizes = placed.groupBy("__part").agg((F.max("__place") + 1).alias("n")).collect()  # one row for each partition
    return sorted((r["__part"], r["n"]) for r in sizes)


def number_rows(df: DataFrame, order: list[str], name: str, staging: str, start: int = 1) -> DataFrame:
    """Adds gap-free numbers from `start` along a total order, without one global window.

    Rows are range-partitioned, sorted in their partition and written once with the partition's
    number and their place in it; what the partitions before it hold is added to the place. The
    rows are shuffled once: the partitions' offsets are a constant, where a join would move the rows
    again. The written table fixes the partitions, so a lost task is redone against the same cut.
    """
    spark = df.sparkSession
    place_rows(df, order).write.mode("overwrite").parquet(staging)
    staged = spark.read.schema(StructType([*df.schema.fields, *PLACED])).parquet(staging)
    offsets, before = {}, 0
    for part, n in part_sizes(staged):
        offsets[part], before = before, before + n
    # a partition without rows has no place
    known = F.array(*[F.lit(offsets.get(p, 0)).cast("long") for p in range(max(offsets, default=0) + 1)])
    return (
        staged.withColumn(name, known[F.col("__part")] + F.col("__place") + F.lit(start))
        .drop("__part", "__place")
    )


def splittable(side: DataFrame, key: str) -> DataFrame:
    """The small side of a join whose other side may hold one key very often.

    A side that an earlier step left partitioned by the join key is joined in place, and
    then Spark cannot split a frequent key of the other side at run time. Moving its rows
    to another partitioning makes the join shuffle both sides, which Spark can split.
    """
    return side.repartition(F.xxhash64(key))


def top_rows(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first `n` rows per key; Spark keeps at most `n` rows per key before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")
