"""Change capture between snapshots, and current or versioned tables from changes."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import RANGE_WIDTH, next_in_key


def capture_changes(old: DataFrame | None, new: DataFrame, keys: list[str], version: int) -> DataFrame:
    """Rows that differ between two snapshots, as change rows.

    An insert and a delete are one row each; an update is the old row and the new row.
    `sort_by` is twice the version, plus one for the new row of an update, so it grows
    along the changes of a key.
    """
    if old is None:
        return new.withColumn("change_type", F.lit("insert")).withColumn(
            "sort_by", F.lit(2 * version).cast("long")
        )
    sides, here, there = _side_by_side(old, new, keys)

    def change(prefix: str, kind: str, step: int) -> Column:
        return F.struct(
            *[F.col(prefix + c).alias(c) for c in new.columns],
            F.lit(kind).alias("change_type"),
            F.lit(2 * version + step).cast("long").alias("sort_by"),
        )

    events = (
        F.when(~here, F.array(change("n_", "insert", 0)))
        .when(~there, F.array(change("o_", "delete", 0)))
        .otherwise(
            F.array(change("o_", "update_preimage", 0), change("n_", "update_postimage", 1))
        )
    )
    changed = ~here | ~there | ~_same_row(new.columns)
    return sides.where(changed).select(F.inline(events))


def _side_by_side(old: DataFrame, new: DataFrame, keys: list[str]) -> tuple[DataFrame, Column, Column]:
    """Both tables joined on their key with prefixed columns, and which side each row is on.

    Plain renamed columns keep a partitioning by the key that the tables already have.
    """
    left = old.select(*[F.col(c).alias(f"o_{c}") for c in new.columns], F.lit(True).alias("__old"))
    right = new.select(*[F.col(c).alias(f"n_{c}") for c in new.columns], F.lit(True).alias("__new"))
    same_key = reduce(and_, [F.col(f"o_{k}") == F.col(f"n_{k}") for k in keys])
    return (
        left.join(right, same_key, "full"), F.col("__old").isNotNull(), F.col("__new").isNotNull(),
    )


def _same_row(columns: list[str]) -> Column:
    return reduce(and_, [F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}")) for c in columns])


def effective(changes: DataFrame) -> DataFrame:
    """Changes that carry a new state: no pre-images, no rows without a change type."""
    return changes.where(F.col("change_type") != "update_preimage")


def latest_change(changes: DataFrame, keys: list[str], sequence: str = "sort_by") -> DataFrame:
    """The change with the highest sequence per key, deletes included.

    An aggregate, so each task keeps one row per key before the shuffle.
    """
    rest = [c for c in changes.columns if c not in keys]
    return (
        changes.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.col(sequence)).alias("__row"))
        .select(*keys, "__row.*")
        .select(*changes.columns)
    )


def scd1(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Current state: the latest change per key unless it is a delete."""
    return drop_deleted(latest_change(effective(changes), keys))


def drop_deleted(latest: DataFrame) -> DataFrame:
    return latest.where(F.col("change_type") != "delete").drop("change_type", "sort_by")


def scd2(changes: DataFrame, keys: list[str], width: int = RANGE_WIDTH) -> DataFrame:
    """Every version of a key with the sequence it starts at and the one it ends at."""
    bounded = next_in_key(effective(changes), keys, "sort_by", "valid_to", width)
    return (
        bounded.where(F.col("change_type") != "delete")
        .withColumnRenamed("sort_by", "valid_from")
        .withColumn("is_current", F.col("valid_to").isNull())
        .drop("change_type")
    )


def as_of(changes: DataFrame, keys: list[str], sequence: Column) -> DataFrame:
    """Current state as it was at a point of the sequence."""
    return scd1(changes.where(F.col("sort_by") <= sequence), keys)


def update_where(df: DataFrame, condition: Column, assignments: dict[str, Column]) -> DataFrame:
    """New contents of a table after an update of the rows that meet the condition."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns(
        {c: F.when(hit, new).otherwise(F.col(c)) for c, new in assignments.items()}
    )


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Insert the incoming rows, replacing those with the same key."""
    columns = current.columns
    ranked = current.select(F.lit(0).alias("__new"), *columns).unionByName(
        incoming.select(F.lit(1).alias("__new"), *columns)
    )
    rest = [c for c in columns if c not in keys]
    return (
        ranked.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.col("__new")).alias("__row"))
        .select(*keys, "__row.*")
        .select(*columns)
    )


def reconcile(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """One row: sizes of both sides and how their keys and rows differ."""
    sides, in_target, in_source = _side_by_side(target, source, keys)
    both = in_source & in_target
    same = _same_row(source.columns)
    return sides.agg(
        F.count_if(in_source).alias("source_rows"),
        F.count_if(in_target).alias("target_rows"),
        F.count_if(in_source & ~in_target).alias("missing_in_target"),
        F.count_if(~in_source & in_target).alias("extra_in_target"),
        F.count_if(both & ~same).alias("different"),
        F.count_if(both & same).alias("equal"),
    )
