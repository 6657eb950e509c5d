"""Distinct counts from stored sketches, for any choice of their cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12
ERROR = 1.04 / (1 << LG_K // 2)  # relative standard deviation of a sketch of 2**LG_K cells


def sketch_cells(rows: DataFrame, cells: list[str], counted: str, lg_k: int = LG_K) -> DataFrame:
    """One row for each cell: its rows and a sketch, of bounded size, of the values it has seen; sketches begin before the shuffle."""
    return rows.groupBy(*cells).agg(F.count("*").alias("n_rows"), F.hll_sketch_agg(counted, F.lit(lg_k)).alias("sketch"))


def merged(sketches: DataFrame, by: list[str], condition: Column | None = None) -> DataFrame:
    """n_rows and n_distinct (estimated) of the cells that meet the condition, for each `by`; the rows themselves are not read."""
    chosen = sketches if condition is None else sketches.where(condition)
    return chosen.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct")
    )


def near(estimate: Column, exact: Column, error: float = ERROR) -> Column:
    """Within three standard deviations."""
    return F.abs(estimate - exact) <= F.ceil(3 * error * exact)
