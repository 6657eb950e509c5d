"""Table constraints as queries that return the rows that break them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child keys that no parent row has, with how many child rows carry them.

    The child is reduced to its distinct keys first, so a frequent key is one row in the join.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    return keys.join(parent.select(F.col(key).alias(column)), column, "left_anti")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column with its number of NULLs, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "n_null")


def outside_domain(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    return df.where(~F.col(column).isin(allowed))


def rows_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: all rows, distinct keys, and whether they agree.

    Counting per key first lets a frequent key collapse before the shuffle.
    """
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    rows, distinct = F.coalesce(F.sum("n"), F.lit(0)), F.count("*")
    return per_key.agg(
        rows.alias("n_rows"), distinct.alias("n_keys"), (rows == distinct).alias("one_row_per_key")
    )


def require_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key has no NULL."""
    return df.dropna(subset=keys)
