"""Pieces that several queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import fx_rate
from ..operators import enrich
from ..operators.cdc import update_where
from ..operators.features import TierRules, client_risk_features_from_fills
from ..sources.views import Desk

# thresholds that split the clients of the input tables
RULES = TierRules(high_gross=8e6, high_vol=0.34, medium_gross=5e6, medium_vol=0.30)


def with_fx(instruments: DataFrame) -> DataFrame:
    return instruments.withColumn("fx_to_cad", fx_rate(F.col("currency")))


def features(d: Desk) -> DataFrame:
    return client_risk_features_from_fills(
        d.clients, d.fills, with_fx(d.all_instruments), d.trade_date_max.scalar(), RULES
    )


def aged_trades(d: Desk) -> DataFrame:
    return d.trades.withColumn("days_ago", F.datediff(d.trade_date_max.scalar(), "trade_date"))


def valued(d: Desk) -> DataFrame:
    return enrich.value_positions(d.positions, d.instruments, d.marks)


def book(d: Desk) -> DataFrame:
    return enrich.enrich_positions(valued(d), d.clients, d.limits)


def deals(d: Desk, clients: DataFrame | None = None) -> DataFrame:
    """Trades in listed instruments with the instrument's columns and notional in CAD.

    Their clients may be unknown unless they are given; what sums them by client joins the clients after that.
    """
    fills = d.fills if clients is None else d.fills_of(clients)
    return enrich.with_calendar(fills.join(with_fx(d.instruments), "instrument_id")).withColumn(
        "notional_cad", F.col("notional") * F.col("fx_to_cad")
    )


def flow(d: Desk) -> DataFrame:
    """Deals with their client's columns."""
    return deals(d).join(d.clients, "client_id")


def flow_totals(
    d: Desk, client_columns: list[str], other_keys: list[str], selections: enrich.Selections | None = None
) -> DataFrame:
    """Notional and number of trades per client attribute and other key, under a filter bar.

    Trades are reduced to one row per client and key before clients are joined, so a client
    with many trades is a few rows in that join, and trades of unknown clients go.
    """
    return enrich.totals_by(deals(d), d.clients, client_columns, other_keys, selections)


def last_year(d: Desk) -> Column:
    """The first day of the year of the last trade."""
    return F.trunc(d.trade_date_max.scalar(), "year")


def book_at(d: Desk, before: Column | None = None) -> DataFrame:
    """Open quantity per client and instrument, from the fills before a day."""
    fills = d.fills if before is None else d.fills.where(F.col("trade_date") < before)
    signed = F.when(F.col("side") == "BUY", F.col("quantity")).otherwise(-F.col("quantity"))
    return (
        fills.groupBy("client_id", "instrument_id")
        .agg(F.sum(signed).cast("long").alias("net_qty"))
        .where("net_qty <> 0")
    )


def reference(d: Desk) -> DataFrame:
    """The client reference table that is kept in step with its copies."""
    return d.clients.select(
        "client_id", "legal_name", "sector", "credit_rating", "coverage_officer",
        (F.lit(1000000.0) + F.col("balance") * 100).alias("risk_limit_cad"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
    )


def updated_reference(d: Desk) -> DataFrame:
    """The same table after the limits of one sector were doubled."""
    return update_where(
        reference(d),
        F.col("sector") == "BUILDING",
        {
            "risk_limit_cad": F.col("risk_limit_cad") * 2,
            "updated_at": F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"),
        },
    )
