import datetime

import pytest
from pyspark.sql import functions as F

from deskflow.functions.money import exact_sum, format_money
from deskflow.operators.enrich import Selections
from deskflow.operators.features import TierRules, client_risk_features_from_fills
from deskflow.operators.lookup import first_result, resolve_entities
from deskflow.operators import enrich
from deskflow.plans import QUERIES
from deskflow.plans.common import deals, valued
from deskflow.sources.views import Desk

from . import golden as g


TODAY = "2026-09-11"


def build(spark, clients=(), positions=(), trades=(), rules=TierRules()):
    """Features from fills: a position is one old fill, a trade a fill in an instrument that is not listed."""
    day = datetime.date.fromisoformat(TODAY)
    old = day - datetime.timedelta(days=900)
    fills = [
        (c, i, "BUY" if q >= 0 else "SELL", float(abs(q)), old, 0.0, 0.0) for c, i, q in [*g.POSITIONS, *positions]
    ] + [(c, "CASH", "BUY", 0.0, day - datetime.timedelta(days=ago), amount, pnl) for c, amount, ago, pnl in trades]
    instruments = [(*row, True) for row in g.INSTRUMENTS] + [("CASH", "cash", "CAD", 1.0, 1.0, 0.0, 1.0, False)]
    rows = client_risk_features_from_fills(
        spark.createDataFrame([*g.CLIENTS, *clients], g.CLIENT_COLUMNS),
        spark.createDataFrame(
            fills, "client_id string, instrument_id string, side string, quantity double, trade_date date, "
            "notional double, realized_pnl_cad double",
        ),
        spark.createDataFrame(instruments, g.INSTRUMENT_COLUMNS + ", listed boolean"),
        F.lit(TODAY).cast("date"),
        rules,
    ).collect()
    return {r["client_id"]: r for r in rows}


def test_nine_clients(spark):
    rows = build(spark)
    assert set(rows) == set(g.FEATURES)
    for client, (gross, net, n, largest, vol, score, tier) in g.FEATURES.items():
        r = rows[client]
        assert r["gross_notional_cad"] == pytest.approx(gross, abs=1e-6)
        assert r["net_exposure_cad"] == pytest.approx(net, abs=1e-6)
        assert r["num_open_positions"] == n
        assert r["largest_position_pct"] == pytest.approx(largest, abs=1e-6)
        assert r["portfolio_volatility"] == pytest.approx(vol, abs=1e-6)
        assert (r["credit_rating_score"], r["risk_tier"]) == (score, tier)


def test_edges(spark):
    rows = build(
        spark,
        clients=[("NEW", "NR"), ("ODD", "AAA"), ("EDGE", "AA"), ("FLAT", "A")],
        positions=[("ODD", "NOWHERE", 5), ("EDGE", "USDCAD", 2500), ("FLAT", "WTI", 0)],
        trades=[("ODD", 100.0, 30, 1.0), ("ODD", 200.0, 31, 2.0), ("EDGE", 10.5, 45, 0.5)],
    )
    new = rows["NEW"]
    assert new["credit_rating_score"] is None
    assert (new["num_open_positions"], new["days_since_last_trade"], new["risk_tier"]) == (0, 999, "LOW")
    assert new["gross_notional_cad"] == new["avg_trade_notional_cad"] == new["portfolio_volatility"] == 0.0
    odd = rows["ODD"]
    assert (odd["num_open_positions"], odd["num_trades_30d"], odd["avg_trade_notional_cad"]) == (0, 1, 100.0)
    assert odd["days_since_last_trade"] == 30 and odd["credit_rating_score"] == 10
    assert (rows["EDGE"]["num_trades_30d"], rows["EDGE"]["days_since_last_trade"]) == (0, 45)
    # a position of quantity zero is open, has no gross value and no volatility
    flat = rows["FLAT"]
    assert (flat["num_open_positions"], flat["largest_position_pct"], flat["portfolio_volatility"]) == (1, 0.0, 0.0)


def test_thresholds_are_strict(spark):
    at = TierRules(high_gross=505698400.0, high_vol=0.9, medium_gross=4080000.0, medium_vol=0.9)
    rows = build(spark, rules=at)
    assert rows["CL-AC"]["risk_tier"] == "MEDIUM"
    assert rows["CL-CNR"]["risk_tier"] == "LOW"


def test_totals_do_not_depend_on_partitions(spark):
    df = spark.range(10_000).select((F.col("id") * 0.1 - 37).alias("x"))
    totals = {df.repartition(n, "x").agg(exact_sum(F.col("x"))).first()[0] for n in (1, 3, 17)}
    assert totals == {sum(round(i * 1e5 - 37e6) for i in range(10_000)) / 1e6}


def test_totals_beyond_a_long(spark):
    df = spark.range(40).select((F.lit(9e12) - F.col("id") * 1e6).alias("x"), (F.lit(-9e12) + F.col("id")).alias("y"))
    x, y, none = df.agg(exact_sum(F.col("x")), exact_sum(F.col("y")), exact_sum(F.lit(None).cast("double"))).first()
    assert x == float(sum(9 * 10**12 - i * 10**6 for i in range(40)))
    assert y == float(sum(-9 * 10**12 + i for i in range(40)))
    assert none is None


@pytest.mark.parametrize("amounts", [[2e13] * 3, [9.3e12, 1.0], [3e7, 4e7, -5e13], [1e20, 1.0], [-2e13, 0.25]])
def test_totals_are_not_clamped(spark, amounts):
    df = spark.createDataFrame([(x,) for x in amounts], "x double")
    once = df.agg(exact_sum(F.col("x")).alias("x"))
    assert once.first()[0] == sum(amounts)
    again = once.crossJoin(spark.range(3)).agg(exact_sum(F.col("x")))
    assert again.first()[0] == float(3 * sum(amounts))


def test_too_large_totals_are_errors(spark):
    with pytest.raises(Exception, match="(?i)overflow|out of range|cannot be represented|NUMERIC_VALUE"):
        spark.createDataFrame([(1e33,)], "x double").agg(exact_sum(F.col("x"))).collect()


def test_format_money(spark):
    values = [1.25e9, 3.44e6, -5600.0, 789.0, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(format_money(F.col("v"))).collect()] == [
        "$1.3B", "$3.4M", "-$5.6K", "$789.0", "$0.0",
    ]


def test_resolve_entities(spark):
    aliases = spark.createDataFrame(
        [("air canada", "CL-AC"), ("ac.to", "CL-AC"), ("bce", "CL-BCE")], "alias string, alias_id string"
    )
    asked = spark.createDataFrame(
        [("Air Canada",), (" ac.to ",), ("cl-ac",), ("bce",), ("unknown co",)], "mention string"
    )
    found = {r["mention"]: r["entity_id"] for r in resolve_entities(asked, aliases).collect()}
    assert found == {
        "Air Canada": "CL-AC", " ac.to ": "CL-AC", "cl-ac": "CL-AC", "bce": "CL-BCE", "unknown co": "UNKNOWN CO",
    }


def test_first_result(spark):
    bodies = ['{"outputs":[{"k":1}]}', '{"outputs":[],"predictions":[{"k":2}]}', '{"k":3}', "{}"]
    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    assert [r[0] for r in df.select(first_result(F.col("b"), "k int")["k"]).collect()] == [1, 2, 3, None]


def test_empty_selection_keeps_all(spark):
    df = spark.range(5).withColumn("kind", F.col("id") % 2).withColumn("day", F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int")))
    assert Selections({"kind": [], "other": [1]}).apply(df, "day").count() == 5
    assert Selections({"kind": [1], "id": [1, 2]}).apply(df).count() == 1
    assert Selections({}, "2026-01-02").apply(df, "day").count() == 4
    assert Selections({}, None, "2026-01-02").apply(df, "day").count() == 2
    assert Selections({}, "2026-01-02", "2026-01-03").apply(df, "day").count() == 2


def test_empty_bar_equals_no_bar(spark, base):
    d = Desk(spark, base)
    empty = Selections({"client_id": [], "sector": [], "book": []})
    assert enrich.kpis(deals(d), valued(d), d.clients, empty).collect() == QUERIES["kpi_cards"](spark, base).collect()
    for columns, keys in ((["sector"], ["asset_class"]), ([], ["trade_date", "side"])):
        a = enrich.totals_by(deals(d), d.clients, columns, keys, empty)
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, enrich.totals_by(deals(d), d.clients, columns, keys).collect()), key=str)


def test_latest_price_equals_lateral_sql(spark, base):
    d = Desk(spark, base)
    d.positions.createOrReplaceTempView("p")
    d.marks.createOrReplaceTempView("m")
    lateral = spark.sql(
        """SELECT p.instrument_id, p.client_id, mp.spot_price AS latest_price, p.net_qty * mp.spot_price AS value
           FROM p JOIN LATERAL (SELECT spot_price FROM m WHERE m.instrument_id = p.instrument_id
                                ORDER BY price_date DESC LIMIT 1) mp ON true"""
    )
    window = QUERIES["join_lateral_latest_price"](spark, base)
    assert sorted(map(tuple, lateral.collect())) == sorted(map(tuple, window.collect()))
