"""Returns, their distribution and movers, from one price per instrument and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import top_rows


def daily_returns(marks: DataFrame) -> DataFrame:
    """Change of each price against the one before, in percent; a window holds one price per day."""
    previous = F.lag("spot_price").over(Window.partitionBy("instrument_id").orderBy("price_date"))
    return marks.select(
        "instrument_id", "price_date", "spot_price",
        ((F.col("spot_price") / previous - 1) * 100).alias("daily_return"),
    )


def returns_histogram(returns: DataFrame, bins: int = 25) -> DataFrame:
    """Equal bins between the lowest and the highest return of each instrument."""
    whole = Window.partitionBy("instrument_id")
    x, low, high = F.col("daily_return"), F.col("low"), F.col("high")
    ranged = returns.where(x.isNotNull()).withColumns({"low": F.min(x).over(whole), "high": F.max(x).over(whole)})
    place = F.when(high > low, F.floor((x - low) / (high - low) * bins)).otherwise(F.lit(0))
    bin_no = F.greatest(F.lit(0), F.least(F.lit(bins - 1), place)).cast("int")
    return ranged.groupBy("instrument_id", bin_no.alias("bin")).agg(F.count("*").alias("n"))


def largest_movers(marks: DataFrame, n: int = 20) -> DataFrame:
    """The last two prices per instrument decide, found by an aggregate over the marks."""
    last_two = top_rows(marks, ["instrument_id"], [F.desc("price_date")], 2)
    newest = F.max_by("spot_price", "price_date")
    oldest = F.min_by("spot_price", "price_date")
    moves = last_two.groupBy("instrument_id").agg(
        F.max("price_date").alias("price_date"),
        F.when(F.count("*") == 2, (newest / oldest - 1) * 100).alias("daily_return"),
    )
    return (
        moves.where(F.col("daily_return").isNotNull())
        .orderBy(F.desc(F.abs("daily_return")), "instrument_id")
        .limit(n)
    )
