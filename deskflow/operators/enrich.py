"""Enriched trades and positions behind the dashboard, and its filter bar."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import exact_sum, ratio
from .ordered import splittable, top_rows


def latest_marks(marks: DataFrame) -> DataFrame:
    """The last price of every instrument."""
    return top_rows(marks, ["instrument_id"], [F.desc("price_date")])


def with_calendar(trades: DataFrame) -> DataFrame:
    return trades.withColumn("trade_week", F.to_date(F.date_trunc("week", "trade_ts"))).withColumn(
        "trade_hour", F.hour("trade_ts")
    )


def value_positions(positions: DataFrame, instruments: DataFrame, marks: DataFrame) -> DataFrame:
    """Positions at the latest price; those without instrument or price disappear."""
    latest = latest_marks(marks).select(
        "instrument_id", F.col("spot_price").alias("latest_price"), "price_date"
    )
    priced = instruments.drop("spot_price", "volatility").join(latest, "instrument_id")
    return (
        positions.join(splittable(priced, "instrument_id"), "instrument_id")
        .withColumn("market_value", F.col("net_qty") * F.col("latest_price") * F.col("contract_size"))
        .withColumn("gross_exposure", F.abs("market_value"))
        .withColumn(
            "pnl_cad",
            F.col("net_qty")
            * (F.col("latest_price") - F.col("avg_entry_price"))
            * F.col("contract_size"),
        )
    )


def enrich_positions(
    valued: DataFrame, clients: DataFrame, limits: DataFrame, limit_type: str = "GROSS_NOTIONAL"
) -> DataFrame:
    """Valued positions with their client and its one limit of the given type."""
    one_limit = limits.where(F.col("limit_type") == limit_type).select("client_id", "limit_cad")
    # clients and limits meet first, so that positions are in one join only
    client_side = clients.join(one_limit, "client_id", "left")
    return valued.join(splittable(client_side, "client_id"), "client_id")


@dataclass(frozen=True)
class Selections:
    """A filter bar: chosen values per column, and a range of days, both ends included.

    A column without chosen values, and a missing end, keep everything.
    """

    chosen: dict[str, list] = field(default_factory=dict)
    first_day: str | Column | None = None
    last_day: str | Column | None = None

    def apply(self, df: DataFrame, date_column: str | None = None) -> DataFrame:
        """Keeps the rows that meet every selection on a column that the table has."""
        for column, values in self.chosen.items():
            if values and column in df.columns:
                df = df.where(F.col(column).isin(values))
        if date_column:
            for end, keeps in ((self.first_day, "ge"), (self.last_day, "le")):
                if end is not None:
                    bound = F.lit(end).cast("date") if isinstance(end, str) else end
                    day = F.col(date_column)
                    df = df.where(day >= bound if keeps == "ge" else day <= bound)
        return df


def totals_by(
    deals: DataFrame, clients: DataFrame, client_columns: list[str], other_keys: list[str],
    selections: Selections | None = None,
) -> DataFrame:
    """`notional` and `n_trades` of the deals of known clients, by client columns and deal columns.

    Selections on deals apply before the reduction to one row per client, those on clients to
    the clients; only then do both meet.
    """
    selections = selections or Selections()
    kept = selections.apply(deals, "trade_date")
    per_client = kept.groupBy("client_id", *other_keys).agg(
        exact_sum(F.col("notional_cad")).alias("notional"), F.count("*").alias("n_trades")
    )
    keys = selections.apply(clients).select(*dict.fromkeys(["client_id", *client_columns]))
    return (
        per_client.join(keys, "client_id")
        .groupBy(*client_columns, *other_keys)
        .agg(exact_sum(F.col("notional")).alias("notional"), F.sum("n_trades").alias("n_trades"))
    )


def kpis(deals: DataFrame, valued: DataFrame, clients: DataFrame, selections: Selections | None = None) -> DataFrame:
    """One row: notional, trades, active clients, buy and sell flow, and gross exposure of the open positions.

    Clients are counted from one row per client and side, not from all trades. Positions have no
    trade date, so the range of days does not apply to them.
    """
    selections = selections or Selections()
    sides = totals_by(deals, clients, ["client_id"], ["side"], selections)
    keys = selections.apply(clients).select("client_id")
    gross = selections.apply(valued).groupBy("client_id").agg(exact_sum(F.col("gross_exposure")).alias("gross"))
    gross = gross.join(keys, "client_id", "left_semi").agg(exact_sum(F.col("gross")).alias("gross_exposure"))
    per_client = sides.groupBy("client_id").agg(
        F.sum("n_trades").alias("n"), exact_sum(F.col("notional")).alias("total"),
        exact_sum(F.when(F.col("side") == "BUY", F.col("notional"))).alias("buy"),
        exact_sum(F.when(F.col("side") == "SELL", F.col("notional"))).alias("sell"),
    )
    return per_client.agg(
        exact_sum(F.col("total")).alias("total_notional"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_trades"),
        F.count("*").alias("active_clients"), exact_sum(F.col("buy")).alias("buy_flow"),
        exact_sum(F.col("sell")).alias("sell_flow"),
    ).withColumn("gross_exposure", gross.scalar())


def exposure_by(
    valued: DataFrame, clients: DataFrame, client_columns: list[str], other_keys: list[str],
    selections: Selections | None = None,
) -> DataFrame:
    """`gross`, `pnl` and `n_positions` of the positions of known clients, by client and position columns."""
    selections = selections or Selections()
    per_client = selections.apply(valued).groupBy("client_id", *other_keys).agg(
        exact_sum(F.col("gross_exposure")).alias("gross"), exact_sum(F.col("pnl_cad")).alias("pnl"),
        F.count("*").alias("n_positions"),
    )
    keys = selections.apply(clients).select(*dict.fromkeys(["client_id", *client_columns]))
    return per_client.join(keys, "client_id").groupBy(*client_columns, *other_keys).agg(
        exact_sum(F.col("gross")).alias("gross"), exact_sum(F.col("pnl")).alias("pnl"),
        F.sum("n_positions").alias("n_positions"),
    )


def with_share(df: DataFrame, column: str) -> DataFrame:
    """Adds each row's part of the column's total; for one row per category."""
    total = df.agg(exact_sum(F.col(column))).scalar()
    return df.withColumn("share", ratio(F.col(column), total))


def asset_pivot(deals: DataFrame, clients: DataFrame, classes: list[str], selections: Selections | None = None) -> DataFrame:
    """One row per known client and one column per asset class; a class that is not listed counts as OTHER."""
    totals = totals_by(deals, clients, ["client_id"], ["asset_class"], selections)
    known = F.when(F.col("asset_class").isin(classes), F.col("asset_class")).otherwise("OTHER")
    return (
        totals.withColumn("class", known).groupBy("client_id").pivot("class", [*classes, "OTHER"])
        .agg(exact_sum(F.col("notional")))
    )


def by_hour(deals: DataFrame, clients: DataFrame, selections: Selections | None = None) -> DataFrame:
    """Trades in each of the 24 hours, also those without."""
    counts = totals_by(deals, clients, [], ["trade_hour"], selections).select("trade_hour", F.col("n_trades").alias("n"))
    hours = deals.sparkSession.range(24).select(F.col("id").cast("int").alias("trade_hour"))
    return hours.join(counts, "trade_hour", "left").select("trade_hour", F.coalesce("n", F.lit(0)).alias("n_trades"))


def trade_points(deals: Callable[[DataFrame], DataFrame], clients: DataFrame, columns: list[str], selections: Selections | None = None) -> DataFrame:
    """Every selected trade of a known client, for a scatter chart; `deals` gives the trades of the clients it is called with."""
    selections = selections or Selections()
    return selections.apply(deals(selections.apply(clients)), "trade_date").select(*columns)
