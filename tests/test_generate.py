from pyspark.sql import functions as F

from deskflow.plans import QUERIES
from deskflow.sources import generate


def test_order_picks(spark):
    rows = generate.gen_orders(spark, 20).orderBy("order_id").collect()
    assert [r["client_id"] for r in rows[:5]] == ["CL-SU", "CL-BCE", "CL-MFC", "CL-ABX", "CL-AC"]
    assert [r["instrument"] for r in rows[:5]] == ["HO", "NG", "GOLD", "USDCAD", "WTI"]
    assert all(0 <= r["qty"] <= 500 and 20 <= r["px"] <= 120 for r in rows)


def test_noise_is_about_normal(spark):
    noise = spark.range(20_000).select(generate.gauss(F.lit("t"), F.col("id")).alias("z"))
    mean, deviation = noise.agg(F.avg("z"), F.stddev("z")).first()
    assert abs(mean) < 0.03 and abs(deviation - 1) < 0.03


def test_rows_do_not_depend_on_partitions(spark):
    profile = spark.range(50).select(
        F.concat(F.lit("C"), "id").alias("client_id"), (F.col("id") % 7).alias("n_trades"),
        F.lit(1000.0).alias("base_notional"),
    )
    a = generate.gen_trades_by_profile(profile.repartition(1)).collect()
    b = generate.gen_trades_by_profile(profile.repartition(7)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert len(a) == sum(i % 7 for i in range(50))
    assert all(400 <= r["notional_cad"] <= 1600 and 0 <= r["days_ago"] <= 90 for r in a)


def test_a_client_of_many_blocks(spark, monkeypatch):
    profile = spark.createDataFrame([("A", 25, 10.0), ("B", 0, 10.0), ("C", 10, 10.0)], "client_id string, n_trades long, base_notional double")
    whole = sorted(map(tuple, generate.gen_trades_by_profile(profile).collect()))
    monkeypatch.setattr(generate, "BLOCK", 10)
    assert sorted(map(tuple, generate.gen_trades_by_profile(profile).collect())) == whole
    assert sorted(r[:2] for r in whole) == [("A", i) for i in range(1, 26)] + [("C", i) for i in range(1, 11)]


def test_price_walk(spark):
    instruments = spark.createDataFrame(
        [("A", 100.0, 0.3), ("B", 0.01, 5.0)], "instrument_id string, spot_price double, volatility double"
    )
    rows = generate.price_walk(instruments, F.lit("2026-09-11").cast("date")).collect()
    assert len(rows) == 60 and min(r["spot_price"] for r in rows) >= 0.01
    assert str(max(r["price_date"] for r in rows)) == "2026-09-11"
    assert str(min(r["price_date"] for r in rows)) == "2026-08-13"


def test_books(spark, base):
    rows = QUERIES["gen_positions"](spark, base)
    legs = {r["client_id"]: r["n"] for r in rows.where("leg > 0").groupBy("client_id").agg(F.count("*").alias("n")).collect()}
    assert "CL-0" not in legs and set(legs.values()) <= set(range(6, 12))
    assert rows.where("client_id = 'CL-0'").count() == 4
    assert rows.where("leg = 0 and (net_qty < 2000 or net_qty > 25000)").count() == 0


def test_trades(spark, base):
    from deskflow.sources.tables import read_table

    rows = QUERIES["gen_trades"](spark, base)
    assert rows.count() == read_table(spark, base, "lineitem").count()
    assert rows.where("quantity < 1 or quantity > 500 or side not in ('BUY', 'SELL')").count() == 0


def test_price_walk_is_dealt_to_all_tasks_and_knows_nulls(spark):
    rows = [(None, 10.0, 0.2), (1, None, 0.2), (2, 10.0, None), (3, 10.0, 0.2)]
    instruments = spark.createDataFrame(rows, "instrument_id long, spot_price double, volatility double").coalesce(1)
    found = generate.price_walk(instruments, F.lit("2026-09-11").cast("date"), 5)
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = {}
    for r in found.orderBy("price_date").collect():
        paths.setdefault(r["instrument_id"], []).append(r["spot_price"])
    assert {k: len(v) for k, v in paths.items()} == {None: 5, 1: 5, 2: 5, 3: 5}
    assert paths[2] == [0.01] * 5 and paths[1][0] == 0.01 and paths[3][0] != paths[None][0]
