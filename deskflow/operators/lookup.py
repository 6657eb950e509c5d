"""Lookup of features by key or by free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import splittable


def feature_lookup(requests: DataFrame, features: DataFrame, key: str = "client_id") -> DataFrame:
    """Each request with the features of its key, NULLs for an unknown key."""
    return requests.join(splittable(features, key), key, "left")


def resolve_entities(mentions: DataFrame, aliases: DataFrame, column: str = "mention") -> DataFrame:
    """Adds `entity_id`: an id as given, else the id of a known alias, else the mention itself.

    `aliases` has one row per lower-case `alias` with its `alias_id`.
    """
    text = F.trim(column)
    is_id = F.startswith(F.upper(text), F.lit("CL-"))
    return (
        mentions.withColumn("alias", F.lower(text))
        .join(aliases, "alias", "left")
        .withColumn(
            "entity_id", F.when(is_id, F.upper(text)).otherwise(F.coalesce("alias_id", F.upper(text)))
        )
        .drop("alias", "alias_id")
    )


def first_result(body: Column, row_schema: str) -> Column:
    """First row of `outputs`, else of `predictions`, else the object itself."""
    parsed = F.from_json(
        body, f"outputs array<struct<{row_schema}>>, predictions array<struct<{row_schema}>>"
    )
    return F.coalesce(
        F.get(parsed["outputs"], 0), F.get(parsed["predictions"], 0), F.from_json(body, row_schema)
    )


def compare_largest(features: DataFrame, by: str, metrics: list[str]) -> DataFrame:
    """One row per metric with the values of the two clients that are largest by `by`."""
    pair = features.orderBy(F.desc(by), "client_id").limit(2)

    row = pair.agg(
        F.array(
            *[
                F.struct(
                    F.lit(m).alias("metric"),
                    F.max_by(F.col(m).cast("double"), by).alias("left_value"),
                    F.min_by(F.col(m).cast("double"), by).alias("right_value"),
                )
                for m in metrics
            ]
        ).alias("m")
    )
    return row.select(F.inline("m")).withColumn(
        "difference", F.col("left_value") - F.col("right_value")
    )
