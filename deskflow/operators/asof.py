"""Rows answered as of their own time: many requests, each with the version of its key that was valid then."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_as_of(
    requests: DataFrame,
    versions: DataFrame,
    keys: list[str],
    at: str,
    since: str,
    cut: Column,
    ties: list[str] = (),
    most: Column | None = None,
) -> DataFrame:
    """Each request with the columns of the last version of its keys whose `since` is not after its `at`.

    Both sides become one table in the order of time and the last version is carried along it. `cut` is an expression
    over a column `t` (the time of either side) that must not decrease with it; a key's rows with one value of it form
    a range, and one row for each range carries its last version into the ranges behind it. So a key with most of the
    requests, or of the versions, is spread over as many tasks as it has ranges, and no request is joined with the
    versions before the one it gets.

    Of versions of one time the one with the greatest `ties` counts. A version that is older than `most` (a difference
    of times) is none. A null key or time has no version; requests without one get nulls, and all requests are kept.
    """
    taken = [c for c in versions.columns if c not in keys]
    clash = set(taken) & set(requests.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    known = versions.where(" and ".join(f"{c} is not null" for c in [*keys, since]))
    version, request = F.struct(*taken), F.struct(*[c for c in requests.columns if c not in keys])
    order = F.struct(F.col(since).alias("t"), *[F.col(c) for c in ties])
    empty = {kind: F.lit(None).cast(df.select(col).schema[0].dataType) for kind, df, col in (
        ("version", known, version), ("request", requests, request), ("order", known, order))}
    told = known.select(*keys, F.col(since).alias("t"), F.lit(0).alias("__ask"), order.alias("__order"), version.alias("__version"), empty["request"].alias("__request"))
    told = told.withColumn("__range", cut)
    asked = requests.select(*keys, F.col(at).alias("t"), F.lit(1).alias("__ask"), empty["order"].alias("__order"), empty["version"].alias("__version"), request.alias("__request"))
    asked = asked.withColumn("__range", cut)
    both = told.unionByName(asked)

    # moved before they are sorted and reduced, so that no task holds the sort beside what it made the versions with
    lasts = told.repartition(*keys, "__range").groupBy(*keys, "__range").agg(F.max_by("__version", "__order").alias("__last"))
    # one row for each range with versions and one, before it, for each with requests; only the latter get what is carried
    ranges = lasts.select(*keys, "__range", F.lit(1).alias("__told"), "__last").unionByName(
        asked.select(*keys, "__range").distinct().select(*keys, "__range", F.lit(0).alias("__told"), empty["version"].alias("__last"))
    )
    before = Window.partitionBy(*keys).orderBy("__range", "__told").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.withColumn("__carried", F.last("__last", ignorenulls=True).over(before)).where("__told = 0").drop("__told", "__last")

    inside = Window.partitionBy(*keys, "__range").orderBy("t", "__ask", "__order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("__inside", F.last("__version", ignorenulls=True).over(inside)).where("__ask = 1")
    found = found.join(carried, [*keys, "__range"], "left").withColumn("__found", F.coalesce("__inside", "__carried"))
    if most is not None:
        found = found.withColumn("__found", F.when(F.col("t") - F.col("__found")[since] <= most, F.col("__found")))
    out = found.select(*keys, "__request.*", "__found.*")
    return out.select(*requests.columns, *taken)
