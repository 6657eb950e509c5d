"""Queries over tables with orphans and gaps in their keys, each against its SQL answer."""

import pytest
from pyspark.sql import functions as F

from deskflow.plans import ORACLES, QUERIES
from deskflow.sources.tables import SCHEMAS, read_table

from .compare import compare

NAMES = [
    "kpi_cards", "daily_flow", "notional_by_asset_class", "top_traders", "sector_treemap", "client_asset_heatmap",
    "trades_by_hour", "trade_scatter", "cumulative_flow", "top_clients", "notional_by_rating", "sector_concentration",
    "gen_positions", "gen_trades", "days_since_last_trade", "client_risk_features", "enrich_trades", "enrich_positions",
    "kpi_cards_filtered", "daily_flow_filtered", "limit_utilisation", "exposure_sunburst", "agg_trades_30d",
    "pnl_by_desk", "pnl_by_desk_filtered", "long_short", "pnl_by_client", "distinct_clients_by_range", "trade_marks_as_of",
]


@pytest.fixture(scope="module")
def dirty(spark, base, tmp_path_factory):
    """A tenth of the orders from unknown clients, a tenth of the lines in unknown instruments, keys times three."""
    folder = str(tmp_path_factory.mktemp("dirty"))
    change = {
        "customer": {"c_custkey": F.col("c_custkey") * 3},
        "part": {"p_partkey": F.col("p_partkey") * 3},
        "orders": {"o_custkey": F.when(F.col("o_orderkey") % 10 == 0, 3_000_001).otherwise(F.col("o_custkey") * 3)},
        "lineitem": {"l_partkey": F.when(F.col("l_linenumber") % 10 == 3, 4_000_001).otherwise(F.col("l_partkey") * 3)},
    }
    for name in SCHEMAS:
        df = read_table(spark, base, name).withColumns(change.get(name, {}))
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in read_table(spark, base, name).schema])
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def con(dirty):
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in SCHEMAS:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{dirty}/{name}.parquet/*.parquet')")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, dirty, con, name):
    assert compare(con, QUERIES[name](spark, dirty), ORACLES[name]) == []


def test_generators_lose_no_rows(spark, dirty):
    assert QUERIES["gen_trades"](spark, dirty).count() == read_table(spark, dirty, "lineitem").count()


def test_no_selection_is_an_empty_selection(spark, dirty):
    """What a bar without selections shows is what the plain report shows, unknown clients or not."""
    from deskflow.operators import enrich
    from deskflow.plans.common import valued
    from deskflow.sources.views import Desk

    d = Desk(spark, dirty)
    assert valued(d).where("client_id = 3000001").count() > 0
    plain = QUERIES["pnl_by_desk"](spark, dirty).select("book", "pnl")
    empty = enrich.exposure_by(valued(d), d.clients, [], ["book"], enrich.Selections()).select("book", "pnl")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, empty.collect()))
