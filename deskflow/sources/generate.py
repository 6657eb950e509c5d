"""Seeded generators whose rows Spark makes in parallel.

Every draw is a hash of the seed and the row's own key, so a row does not depend on how
the work is split or on how often a task is redone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import fx_rate
from ..functions.text import let

SEED = 1867
BLOCK = 1024  # generated rows of one client that are made together

# fixed values: the picks of the order generator
ORDER_CLIENTS = ["AC", "SU", "BCE", "MFC", "ABX"]
ORDER_INSTRUMENTS = ["WTI", "HO", "NG", "GOLD", "USDCAD"]
# fixed values: books and traders of the desk
BOOKS = ["ENERGY", "RATES", "CREDIT", "EQUITY", "FX"]
TRADERS = ["T. Okafor", "L. Zhang", "M. Dubois", "R. Patel", "K. Nguyen"]


def draw(*parts: Column, low: int, high: int) -> Column:
    """A whole number from low to high, both included, fixed by the parts."""
    digest = F.md5(F.concat_ws(":", F.lit(SEED), *parts))
    number = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
    return F.lit(low) + number % (high - low + 1)


def uniform(*parts: Column) -> Column:
    """A double in [0, 1) in steps of one millionth."""
    return draw(*parts, low=0, high=999_999) / F.lit(1e6)


def gauss(*parts: Column) -> Column:
    """About standard normal: twelve uniform bytes of one hash, summed and centred."""

    def total(digest: Column) -> Column:
        out = F.lit(0)
        for i in range(12):
            out = out + F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10).cast("int")
        return out

    digest = F.md5(F.concat_ws(":", F.lit(SEED), *parts))
    return (let(digest, total) + F.lit(6)) / F.lit(256.0) - F.lit(6.0)


def _walks(ids: pd.Series, start: pd.Series, volatility: pd.Series, steps: int) -> np.ndarray:
    """(ids, steps): the path of each; a move is what `gauss` draws for the id and the step."""
    digests = []
    for key in ids:
        name = f"{SEED}:price:" if key is None else f"{SEED}:price:{key}:"
        digests += [hashlib.md5(f"{name}{i}".encode()).digest()[:12] for i in range(1, steps + 1)]
    total = np.frombuffer(b"".join(digests), np.uint8).reshape(len(ids), steps, 12).sum(axis=2, dtype=np.int64)
    moves = 1 + ((total + 6) / 256.0 - 6.0) * (volatility.to_numpy(float) / np.sqrt(252.0))[:, None]
    path, price = np.empty(moves.shape), start.to_numpy(float)
    for i in range(steps):
        path[:, i] = price = np.maximum(0.01, price * moves[:, i])
    return path


def pick(values: list[str], *parts: Column) -> Column:
    index = draw(*parts, low=1, high=len(values)).cast("int")
    return F.element_at(F.array(*map(F.lit, values)), index)


def gen_orders(spark: SparkSession, n: int) -> DataFrame:
    """A series of orders 1 to n with values picked by number."""
    g = F.col("id")
    at = (F.pmod(g, F.lit(5)) + 1).cast("int")
    return spark.range(1, n + 1).select(
        g.alias("order_id"),
        F.concat(F.lit("CL-"), F.element_at(F.array(*map(F.lit, ORDER_CLIENTS)), at)).alias("client_id"),
        F.element_at(F.array(*map(F.lit, ORDER_INSTRUMENTS)), at).alias("instrument"),
        draw(F.lit("qty"), g, low=0, high=500).alias("qty"),
        (draw(F.lit("px"), g, low=2000, high=12000) / F.lit(100.0)).alias("px"),
    )


def price_walk(instruments: DataFrame, last_day: Column, steps: int = 30) -> DataFrame:
    """A daily price per instrument: each step moves by its volatility, never below 0.01."""

    @F.pandas_udf("array<double>")
    def walk(ids: pd.Series, start: pd.Series, volatility: pd.Series) -> pd.Series:
        return pd.Series(list(_walks(ids, start, volatility, steps)), dtype=object)

    # a small table is few splits, but each of its rows is `steps` hashes: it is dealt to all tasks
    tasks = int(instruments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = instruments.select("instrument_id", "volatility", "spot_price").repartition(tasks, "instrument_id")
    # a null price starts at the least one, and a null volatility stays there
    moved = walk(F.col("instrument_id").cast("string"), F.coalesce("spot_price", F.lit(0.0)), F.coalesce("volatility", F.lit(0.0)))
    path = F.when(F.col("volatility").isNull(), F.array_repeat(F.lit(0.01), steps)).otherwise(moved)
    walked = dealt.select("instrument_id", "volatility", F.posexplode(path).alias("i", "p"))
    return walked.select(
        "instrument_id",
        F.date_sub(last_day, F.lit(steps - 1) - F.col("i")).alias("price_date"),
        (F.floor(F.col("p") * 10000 + F.lit(0.5)) / F.lit(10000.0)).alias("spot_price"),
        "volatility",
    )


def gen_positions(
    clients: DataFrame, instruments: DataFrame, n_instruments: int, hero: str, hero_legs: DataFrame
) -> DataFrame:
    """A book per client: six to eleven random legs, and its own stock where that is listed.

    Instruments carry `instrument_no` from 0 to n - 1. The hero client gets its given legs instead.
    """
    others = clients.where(F.col("client_id") != hero)
    cid = F.col("client_id")
    legs = others.select(
        cid,
        F.explode(F.sequence(F.lit(1), draw(F.lit("legs"), cid, low=6, high=11))).alias("leg"),
    ).select(
        cid,
        (draw(F.lit("instr"), cid, F.col("leg"), low=0, high=n_instruments - 1)).alias("instrument_no"),
        pick(BOOKS, F.lit("book"), cid, F.col("leg")).alias("book"),
        (
            (2 * draw(F.lit("sign"), cid, F.col("leg"), low=0, high=1) - 1)
            * draw(F.lit("qty"), cid, F.col("leg"), low=5, high=400)
        ).alias("net_qty"),
        F.col("leg").cast("long").alias("leg"),
    )
    random_legs = legs.join(instruments.select("instrument_no", "instrument_id", "spot_price"), "instrument_no")
    own = others.join(instruments.select("instrument_id", "spot_price"), F.col("ticker") == F.col("instrument_id"))
    own_legs = own.select(
        cid, "instrument_id", F.lit("EQUITY").alias("book"),
        draw(F.lit("own"), cid, low=2000, high=25000).alias("net_qty"),
        F.lit(0).cast("long").alias("leg"), "spot_price",
    )
    fixed_legs = hero_legs.join(instruments.select("instrument_id", "spot_price"), "instrument_id").select(
        F.lit(hero).alias("client_id"), "instrument_id", "book", "net_qty",
        F.lit(-1).cast("long").alias("leg"), "spot_price",
    )
    book = random_legs.drop("instrument_no").unionByName(own_legs).unionByName(fixed_legs)
    entry = F.col("spot_price") * (1 + (uniform(F.lit("entry"), cid, F.col("instrument_id"), F.col("leg")) * 0.16 - 0.08))
    return book.withColumn(
        "avg_entry_price", F.floor(entry * 10000 + F.lit(0.5)) / F.lit(10000.0)
    ).drop("spot_price")


def gen_trades(
    spark: SparkSession, n: int, clients: DataFrame, instruments: DataFrame,
    n_clients: int, n_instruments: int, today: Column,
) -> DataFrame:
    """n trades over the last 90 days at up to 12 percent from the spot price.

    Clients carry `client_no` and instruments `instrument_no`, both from 0.
    """
    g = F.col("id")
    ago = F.make_dt_interval(
        draw(F.lit("days"), g, low=0, high=89).cast("int"),
        draw(F.lit("hours"), g, low=0, high=8).cast("int"),
        draw(F.lit("minutes"), g, low=0, high=59).cast("int"),
    )
    drawn = spark.range(1, n + 1).select(
        g.alias("trade_id"),
        draw(F.lit("client"), g, low=0, high=n_clients - 1).alias("client_no"),
        draw(F.lit("instrument"), g, low=0, high=n_instruments - 1).alias("instrument_no"),
        pick(["BUY", "SELL"], F.lit("side"), g).alias("side"),
        draw(F.lit("quantity"), g, low=1, high=500).alias("quantity"),
        (uniform(F.lit("price"), g) * 0.24 - 0.12).alias("off"),
        (today.cast("timestamp_ntz") - ago).alias("trade_ts"),
        pick(TRADERS, F.lit("trader"), g).alias("trader"),
    )
    price = F.floor(F.col("spot_price") * (1 + F.col("off")) * 10000 + F.lit(0.5)) / F.lit(10000.0)
    return (
        drawn.join(clients.select("client_no", "client_id"), "client_no")
        .join(
            instruments.select("instrument_no", "instrument_id", "spot_price", "contract_size", "currency"),
            "instrument_no",
        )
        .withColumn("price", price)
        .withColumn(
            "notional_cad",
            F.floor(
                F.col("quantity") * F.col("price") * F.col("contract_size") * fx_rate(F.col("currency")) * 100
                + F.lit(0.5)
            )
            / F.lit(100.0),
        )
        .select(
            "trade_id", "client_id", "instrument_id", "side", "quantity", "price", "trade_ts",
            "trader", "notional_cad",
        )
    )


def gen_trades_by_profile(profile: DataFrame) -> DataFrame:
    """Trades per client from its profile: how many, and around which notional."""
    cid, i = F.col("client_id"), F.col("i")
    notional = F.col("base_notional") * (uniform(F.lit("pn"), cid, i) * 1.2 + 0.4)
    # blocks of numbers first, dealt to all tasks, so a client with most of the trades is many blocks
    blocks = profile.where(F.col("n_trades") > 0).select(
        cid, "base_notional", "n_trades",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_trades") - 1) / BLOCK))).alias("block"),
    ).repartition("client_id", "block")
    first = F.col("block") * BLOCK + 1
    numbers = F.sequence(first, F.least(first + BLOCK - 1, F.col("n_trades")))
    rows = blocks.select(cid, "base_notional", F.explode(numbers).alias("i"))
    return (
        rows.withColumn("notional_cad", F.floor(notional * 100 + F.lit(0.5)) / F.lit(100.0))
        .withColumn("days_ago", draw(F.lit("pd"), cid, i, low=0, high=90))
        .withColumn(
            "realized_pnl_cad",
            F.floor(F.col("notional_cad") * (uniform(F.lit("pp"), cid, i) * 0.07 - 0.03) * 100 + F.lit(0.5))
            / F.lit(100.0),
        )
        .select("client_id", F.col("i").alias("trade_no"), "notional_cad", "days_ago", "realized_pnl_cad")
    )
