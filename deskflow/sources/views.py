"""The desk's tables, derived from the input tables.

No join here names a broadcast: Spark broadcasts a side only where its size is known
to be under the session's threshold, and shuffles otherwise.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import exact_sum, fx_rate
from ..operators.chunks import chunk_rows
from ..operators.ordered import number_rows
from ..session import work_dir
from .tables import read_table

# fixed values: agency ratings in order of quality, and one that is not rated
RATINGS = ["AAA", "AA", "A", "A-", "BBB+", "BBB", "BBB-", "BB", "B", "CCC", "NR"]
# fixed values: the asset classes of the part table
ASSET_CLASSES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


class Desk:
    """Lazily built views over one folder of input tables."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.base, name)

    @cached_property
    def clients(self) -> DataFrame:
        places = (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", "n_name", "r_regionkey")
        )
        return (
            self.table("customer")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("client_id"),
                F.concat(F.lit("T"), F.col("c_custkey")).alias("ticker"),
                F.col("c_name").alias("legal_name"),
                F.col("c_mktsegment").alias("sector"),
                F.col("n_name").alias("country"),
                F.element_at(
                    F.array(*map(F.lit, RATINGS)),
                    (F.col("c_custkey") % len(RATINGS) + 1).cast("int"),
                ).alias("credit_rating"),
                # one officer covers at most 250 clients, so a list per officer stays short
                F.concat(
                    F.lit("OFFICER_"),
                    F.col("r_regionkey"),
                    F.lit("_"),
                    F.floor(F.col("c_custkey") / 250),
                ).alias("coverage_officer"),
                F.when(F.col("c_acctbal") >= 6000, "Platinum")
                .when(F.col("c_acctbal") >= 2000, "Gold")
                .otherwise("Silver")
                .alias("relationship_tier"),
                F.col("c_acctbal").alias("balance"),
            )
        )

    @cached_property
    def all_instruments(self) -> DataFrame:
        even = F.col("p_size") % 2 == 0
        return self.table("part").select(
            F.col("p_partkey").alias("instrument_id"),
            F.col("p_type").alias("asset_class"),
            F.col("p_name").alias("description"),
            F.col("p_brand").alias("book"),
            F.element_at(
                F.array(*map(F.lit, ["USD", "CAD", "EUR"])), F.col("p_size") % 3 + 1
            ).alias("currency"),
            F.when(even, F.lit(1.0)).otherwise(F.lit(10.0)).alias("contract_size"),
            F.col("p_retailprice").alias("spot_price"),
            ((F.col("p_partkey") % 50 + 5) / F.lit(100.0)).alias("volatility"),
            (F.col("p_size") > 1).alias("listed"),
        )

    @cached_property
    def instruments(self) -> DataFrame:
        """Listed instruments; a trade may be in an unlisted one."""
        return self.all_instruments.where("listed").drop("listed")

    @cached_property
    def fills(self) -> DataFrame:
        """One row per trade, before anything about the instrument is known."""
        return self._fills(self.table("orders"))

    def fills_of(self, clients: DataFrame) -> DataFrame:
        """The fills of given clients; orders, which are fewer and narrower than fills, meet the clients."""
        keys = clients.select("client_id")
        orders = self.table("orders")
        return self._fills(orders.join(keys, orders["o_custkey"] == keys["client_id"], "left_semi"))

    def _fills(self, orders: DataFrame) -> DataFrame:
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
        )
        orders = orders.select("o_orderkey", "o_custkey", "o_orderdate")
        hours = F.make_dt_interval(hours=(F.col("l_orderkey") % 24).cast("int"))
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("o_custkey").alias("client_id"),
            F.col("l_partkey").alias("instrument_id"),
            F.when(F.col("l_returnflag") == "R", "SELL").otherwise("BUY").alias("side"),
            F.col("l_quantity").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
            F.col("l_extendedprice").alias("amount"),
            (F.col("o_orderdate") + hours).alias("trade_ts"),
            F.to_date("o_orderdate").alias("trade_date"),
            F.col("l_suppkey").alias("trader"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("notional"),
            (F.col("l_extendedprice") * (F.col("l_tax") - F.col("l_discount"))).alias(
                "realized_pnl_cad"
            ),
        )

    @cached_property
    def trades(self) -> DataFrame:
        rates = self.all_instruments.select("instrument_id", fx_rate(F.col("currency")).alias("fx"))
        return (
            self.fills.join(rates, "instrument_id")
            .withColumn("notional_cad", F.col("notional") * F.col("fx"))
            .drop("notional", "fx")
        )

    @cached_property
    def numbered_instruments(self) -> DataFrame:
        """All instruments with `instrument_no` from 0, without gaps however the keys run."""
        return self._numbered(self.all_instruments, "instrument_id", "instrument_no")

    @cached_property
    def numbered_clients(self) -> DataFrame:
        """The keys of the client table with `client_no` from 0, without gaps."""
        keys = self.table("customer").select(F.col("c_custkey").alias("client_id"))
        return self._numbered(keys, "client_id", "client_no")

    def _numbered(self, df: DataFrame, key: str, name: str) -> DataFrame:
        return number_rows(df, [key], name, work_dir(self.spark, name), 0)

    @cached_property
    def trade_date_max(self) -> DataFrame:
        """The valuation date: the last order date in the data, never the clock."""
        return self.table("orders").agg(F.max(F.to_date("o_orderdate")).alias("as_of"))

    @cached_property
    def marks(self) -> DataFrame:
        lines = self.table("lineitem").select("l_partkey", "l_shipdate", "l_extendedprice", "l_quantity")
        return marks_of(lines)

    @cached_property
    def positions(self) -> DataFrame:
        signed = F.when(F.col("side") == "BUY", F.col("quantity")).otherwise(-F.col("quantity"))
        return self.fills.groupBy("client_id", "instrument_id").agg(
            F.sum(signed).alias("net_qty"),
            (exact_sum(F.col("amount")) / F.sum("quantity")).alias("avg_entry_price"),
        )

    @cached_property
    def limits(self) -> DataFrame:
        """Two limits per client."""
        gross = F.lit(5000000.0) + F.col("c_acctbal") * 400
        return (
            self.table("customer")
            .select(
                F.col("c_custkey").alias("client_id"),
                F.explode(
                    F.array(
                        F.struct(
                            (F.col("c_custkey") * 2).alias("limit_id"),
                            F.lit("GROSS_NOTIONAL").alias("limit_type"),
                            gross.alias("limit_cad"),
                        ),
                        F.struct(
                            (F.col("c_custkey") * 2 + 1).alias("limit_id"),
                            F.lit("NET").alias("limit_type"),
                            (gross / 2).alias("limit_cad"),
                        ),
                    )
                ).alias("l"),
            )
            .select("client_id", "l.*")
        )

    @cached_property
    def changes(self) -> DataFrame:
        return as_changes(self.table("events"))

    @cached_property
    def turns(self) -> DataFrame:
        return self.table("conversations").select(
            F.col("conv_id").alias("thread_id"), F.col("turn").alias("version"), "role", "text"
        )

    def chunks(self, where: str | None = None, buckets: int | None = None) -> DataFrame:
        """Chunks of the documents that meet a condition, with their word counts (`embedding`) where buckets are given."""
        docs = self.table("documents")
        return chunk_rows((docs.where(where) if where else docs).select("doc_id", "source", "lang", "text"), buckets=buckets)


def marks_of(lines: DataFrame) -> DataFrame:
    """One price per instrument and day, from order lines."""
    day = F.to_date("l_shipdate")
    return (
        lines.groupBy(F.col("l_partkey").alias("instrument_id"), day.alias("price_date"))
        .agg((exact_sum(F.col("l_extendedprice")) / F.sum("l_quantity")).alias("spot_price"))
        .withColumn(
            "volatility",
            ((F.col("instrument_id") + F.dayofyear("price_date")) % 50 + 5) / F.lit(100.0),
        )
    )


def as_changes(events: DataFrame) -> DataFrame:
    """Events read as a change table; works on a batch and on a stream."""
    kind = (
        F.when(F.col("event_type") == "signup", "insert")
        .when(F.col("event_type").isin("click", "purchase"), "update_postimage")
        .when(F.col("event_type") == "view", "update_preimage")
        .when(F.col("event_type") == "error", "delete")
    )
    return events.select(
        F.col("user_id").alias("key"),
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        kind.alias("change_type"),
        F.col("event_id").alias("sort_by"),
        F.col("ts").alias("changed_at"),
    )
