"""Money arithmetic whose totals do not depend on how rows are partitioned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICRO = 1e6
LOW_BITS = 20
SMALL = float(1 << 45)  # millionths; parts of smaller amounts can be summed over 2**38 rows as longs


def exact_sum(amount: Column) -> Column:
    """Sum in whole millionths: associative, so any partial-sum order gives the same double.

    High and low parts of ordinary amounts are summed as longs, which is cheaper per row than
    wide decimals. Amounts above some 35 million, such as totals that are summed again, are
    summed as decimals; where even those do not suffice, the sum is an error and never a clamp.
    """
    scaled = amount * F.lit(MICRO) + F.lit(0.5)
    small = F.abs(scaled) < SMALL
    units = F.floor(F.when(small, scaled))
    high = F.sum(F.shiftright(units, LOW_BITS))
    low = F.sum(units.bitwiseAND(F.lit((1 << LOW_BITS) - 1)))
    large = F.sum(F.floor(F.when(~small, scaled).cast("decimal(38,4)")).cast("decimal(38,0)"))
    ordinary = high.cast("decimal(20,0)") * F.lit(1 << LOW_BITS).cast("decimal(8,0)") + low.cast("decimal(20,0)")
    whole = (F.coalesce(ordinary, F.lit(0)) + F.coalesce(large, F.lit(0))).cast("double")
    quick = (high * F.lit(1 << LOW_BITS) + low).cast("double")
    total = F.when(large.isNull() & (F.abs(high) < 1 << 42), quick).when(F.count(amount) > 0, whole)
    return total / F.lit(MICRO)


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL when the denominator is zero or missing."""
    return F.try_divide(numerator, denominator)


# fixed values: the desk's exchange rates to CAD
FX_TO_CAD = {"USD": 1.36, "CAD": 1.0, "EUR": 1.47}


def fx_rate(currency: Column) -> Column:
    """Rate to CAD; an unknown currency counts as CAD."""
    return (
        F.when(currency == "USD", F.lit(FX_TO_CAD["USD"]))
        .when(currency == "EUR", F.lit(FX_TO_CAD["EUR"]))
        .otherwise(F.lit(1.0))
    )


def format_money(amount: Column) -> Column:
    """`$1.2B`, `$3.4M`, `$5.6K` or `$789.0`, one decimal, sign in front."""
    size = F.abs(amount)

    def scaled(unit: float, suffix: str) -> Column:
        tenths = F.floor(size / F.lit(unit / 10) + F.lit(0.5))
        return F.concat(
            F.when(amount < 0, F.lit("-")).otherwise(F.lit("")),
            F.lit("$"),
            F.floor(tenths / 10).cast("string"),
            F.lit("."),
            (tenths % 10).cast("string"),
            F.lit(suffix),
        )

    return (
        F.when(size >= 1e9, scaled(1e9, "B"))
        .when(size >= 1e6, scaled(1e6, "M"))
        .when(size >= 1e3, scaled(1e3, "K"))
        .otherwise(scaled(1.0, ""))
    )
