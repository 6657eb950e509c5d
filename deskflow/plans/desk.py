"""Risk features, exposure, flow, profit and loss, and prices of the desk."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.money import exact_sum, format_money, fx_rate, ratio
from ..operators import enrich, lookup, prices, sketches
from ..operators import features as feat
from ..operators.ordered import number_rows, running_totals, splittable, top_rows
from ..session import work_dir
from ..sources.views import ASSET_CLASSES, RATINGS, Desk, marks_of
from .common import aged_trades, book, deals, features, flow, flow_totals, reference, valued, with_fx
from .oracle_views import FX, RATING, money
from .registry import query

# --- projections and predicates -------------------------------------------


def economics(d: Desk):
    return feat.position_economics(d.positions, with_fx(d.instruments))


@query("position_economics", "SELECT client_id, instrument_id, net_qty, gross_cad, net_cad FROM v_economics")
def position_economics(d: Desk):
    return economics(d).select("client_id", "instrument_id", "net_qty", "gross_cad", "net_cad")


@query("project_columns", "SELECT client_id, legal_name, sector, credit_rating FROM v_clients")
def project_columns(d: Desk):
    return d.clients.select("client_id", "legal_name", "sector", "credit_rating")


@query("drop_columns", "SELECT * EXCLUDE (k, changed_at) FROM v_changes")
def drop_columns(d: Desk):
    return d.changes.drop("k", "changed_at")


@query("fx_convert", f"SELECT instrument_id, currency, spot_price * ({FX}) AS spot_cad FROM v_instruments")
def fx_convert(d: Desk):
    return d.instruments.select(
        "instrument_id", "currency", (F.col("spot_price") * fx_rate(F.col("currency"))).alias("spot_cad")
    )


@query("rating_score", f"SELECT client_id, credit_rating, {RATING} AS credit_rating_score FROM v_clients")
def rating_score(d: Desk):
    return d.clients.select(
        "client_id", "credit_rating", feat.rating_score(F.col("credit_rating")).alias("credit_rating_score")
    )


@query(
    "risk_tier",
    "SELECT risk_tier, count(*) AS n_clients, max(gross_notional_cad) AS max_gross FROM v_features GROUP BY risk_tier",
)
def risk_tier(d: Desk):
    return features(d).groupBy("risk_tier").agg(
        F.count("*").alias("n_clients"), F.max("gross_notional_cad").alias("max_gross")
    )


@query(
    "concentration",
    """SELECT client_id, CASE WHEN gross_notional_cad > 0 THEN largest_position_cad / gross_notional_cad ELSE 0 END
              AS largest_position_pct FROM v_postotals""",
)
def concentration(d: Desk):
    totals = feat.position_totals(economics(d))
    return totals.select(
        "client_id",
        feat.concentration(F.col("largest_position_cad"), F.col("gross_notional_cad")).alias(
            "largest_position_pct"
        ),
    )


@query(
    "null_fill",
    """SELECT client_id, coalesce(num_trades_30d, 0) AS num_trades_30d,
              coalesce(avg_trade_notional_cad, 0) AS avg_trade_notional_cad
       FROM v_clients LEFT JOIN v_recent USING (client_id)""",
)
def null_fill(d: Desk):
    joined = d.clients.select("client_id").join(feat.recent_trade_totals(aged_trades(d)), "client_id", "left")
    return joined.na.fill({"num_trades_30d": 0, "avg_trade_notional_cad": 0.0}).select(
        "client_id", "num_trades_30d", "avg_trade_notional_cad"
    )


@query(
    "trades_30d",
    "SELECT order_id, line_no, instrument_id, client_id, notional_cad, days_ago FROM v_aged WHERE days_ago <= 30",
)
def trades_30d(d: Desk):
    return aged_trades(d).where("days_ago <= 30").select(
        "order_id", "line_no", "instrument_id", "client_id", "notional_cad", "days_ago"
    )


@query(
    "filter_client",
    """SELECT client_id, sector, relationship_tier, credit_rating FROM v_clients
       WHERE sector = 'BUILDING' AND credit_rating <> 'NR'""",
)
def filter_client(d: Desk):
    return d.clients.where("sector = 'BUILDING' and credit_rating <> 'NR'").select(
        "client_id", "sector", "relationship_tier", "credit_rating"
    )


@query("filter_like", "SELECT key, sort_by, change_type FROM v_changes WHERE change_type LIKE 'update%'")
def filter_like(d: Desk):
    return d.changes.where(F.col("change_type").like("update%")).select("key", "sort_by", "change_type")


@query(
    "filter_not_in",
    """SELECT client_id, credit_rating, ticker FROM v_clients
       WHERE credit_rating NOT IN ('AAA', 'AA', 'A') AND ticker IS NOT NULL""",
)
def filter_not_in(d: Desk):
    return d.clients.where(
        ~F.col("credit_rating").isin("AAA", "AA", "A") & F.col("ticker").isNotNull()
    ).select("client_id", "credit_rating", "ticker")


# the filter bar of the dashboard: no client and no book is chosen, so all of them are kept
BAR = enrich.Selections(
    {
        "client_id": [], "book": [], "sector": ["BUILDING", "MACHINERY"], "asset_class": ["PROMO", "SMALL"],
        "relationship_tier": ["Gold", "Platinum"],
    },
    "1996-01-01", "1998-12-31",
)
_BAR_CLIENT = "sector IN ('BUILDING', 'MACHINERY') AND relationship_tier IN ('Gold', 'Platinum')"
_BAR_FLOW = f"""(SELECT * FROM v_flow WHERE {_BAR_CLIENT} AND asset_class IN ('PROMO', 'SMALL')
         AND trade_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31')"""
_BAR_BOOK = f"(SELECT * FROM v_book WHERE {_BAR_CLIENT} AND asset_class IN ('PROMO', 'SMALL'))"


@query(
    "dashboard_filter",
    f"""SELECT order_id, line_no, client_id, sector, asset_class, relationship_tier, book, trade_date, notional_cad
       FROM {_BAR_FLOW}""",
)
def dashboard_filter(d: Desk):
    return BAR.apply(flow(d), "trade_date").select(
        "order_id", "line_no", "client_id", "sector", "asset_class", "relationship_tier", "book",
        "trade_date", "notional_cad",
    )


@query(
    "coerce_numeric",
    """SELECT p_partkey, try_cast(replace(p_brand, 'Brand#', '') AS DOUBLE) AS brand_no,
              try_cast(p_name AS DOUBLE) AS name_no FROM part""",
)
def coerce_numeric(d: Desk):
    return d.table("part").select(
        "p_partkey",
        F.expr("try_cast(replace(p_brand, 'Brand#', '') as double)").alias("brand_no"),
        F.expr("try_cast(p_name as double)").alias("name_no"),
    )


@query(
    "math_scalars",
    """SELECT c_custkey, abs(c_acctbal) AS absolute, round(c_acctbal) AS whole, greatest(0.01, c_acctbal) AS floored,
              floor(sqrt(252.0::DOUBLE) * abs(c_acctbal)) AS yearly, c_custkey % 7 AS pick
       FROM customer""",
)
def math_scalars(d: Desk):
    bal = F.col("c_acctbal")
    return d.table("customer").select(
        "c_custkey",
        F.abs(bal).alias("absolute"),
        F.round(bal).alias("whole"),
        F.greatest(F.lit(0.01), bal).alias("floored"),
        F.floor(F.sqrt(F.lit(252.0)) * F.abs(bal)).cast("double").alias("yearly"),
        F.pmod("c_custkey", F.lit(7)).alias("pick"),
    )


@query(
    "fmt_money",
    """SELECT client_id, CASE WHEN b < 0 THEN '-' ELSE '' END || '$' || CASE
         WHEN s >= 1e9 THEN (CAST(floor(s / 1e8 + 0.5) AS BIGINT) // 10) || '.' || (CAST(floor(s / 1e8 + 0.5) AS BIGINT) % 10) || 'B'
         WHEN s >= 1e6 THEN (CAST(floor(s / 1e5 + 0.5) AS BIGINT) // 10) || '.' || (CAST(floor(s / 1e5 + 0.5) AS BIGINT) % 10) || 'M'
         WHEN s >= 1e3 THEN (CAST(floor(s / 1e2 + 0.5) AS BIGINT) // 10) || '.' || (CAST(floor(s / 1e2 + 0.5) AS BIGINT) % 10) || 'K'
         ELSE (CAST(floor(s / 0.1::DOUBLE + 0.5) AS BIGINT) // 10) || '.' || (CAST(floor(s / 0.1::DOUBLE + 0.5) AS BIGINT) % 10) END AS balance_text
       FROM (SELECT client_id, b, abs(b) AS s FROM (
         SELECT c_custkey AS client_id, c_acctbal AS b FROM customer
         UNION ALL SELECT client_id, gross_notional_cad FROM v_postotals
         UNION ALL SELECT -1, sum(gross_notional_cad::HUGEINT)::DOUBLE FROM v_postotals))""",
)
def fmt_money(d: Desk):
    """Balances, gross exposures and their whole-dollar total as short text."""
    gross = feat.position_totals(economics(d)).select("client_id", F.col("gross_notional_cad").alias("b"))
    whole = gross.agg(F.sum(F.round("b").cast("decimal(19,0)")).cast("double").alias("b")).select(
        F.lit(-1).cast("long").alias("client_id"), "b"
    )
    amounts = d.table("customer").select(F.col("c_custkey").alias("client_id"), F.col("c_acctbal").alias("b"))
    amounts = amounts.unionByName(gross).unionByName(whole)
    return amounts.select("client_id", format_money(F.col("b")).alias("balance_text"))


@query(
    "trade_calendar",
    """SELECT trade_date, CAST(date_trunc('week', trade_ts) AS DATE) AS trade_week,
              CAST(hour(trade_ts) AS INTEGER) AS trade_hour, count(*) AS n_trades
       FROM v_fills GROUP BY ALL""",
)
def trade_calendar(d: Desk):
    return d.fills.groupBy(
        "trade_date",
        F.to_date(F.date_trunc("week", "trade_ts")).alias("trade_week"),
        F.hour("trade_ts").alias("trade_hour"),
    ).agg(F.count("*").alias("n_trades"))


# --- joins ----------------------------------------------------------------


@query(
    "join_inner",
    "SELECT client_id, instrument_id, asset_class, net_qty FROM v_positions JOIN v_instruments USING (instrument_id)",
)
def join_inner(d: Desk):
    return d.positions.join(d.instruments, "instrument_id").select(
        "client_id", "instrument_id", "asset_class", "net_qty"
    )


@query(
    "join_left_chain",
    """SELECT client_id, gross_notional_cad, num_trades_30d, days_since_last_trade
       FROM v_clients LEFT JOIN v_postotals USING (client_id) LEFT JOIN v_recent USING (client_id)
            LEFT JOIN v_recency USING (client_id)""",
)
def join_left_chain(d: Desk):
    trades = aged_trades(d)
    return (
        d.clients.select("client_id")
        .join(feat.position_totals(economics(d)), "client_id", "left")
        .join(feat.recent_trade_totals(trades), "client_id", "left")
        .join(feat.recency(trades), "client_id", "left")
        .select("client_id", "gross_notional_cad", "num_trades_30d", "days_since_last_trade")
    )


@query(
    "positions_with_officer",
    """SELECT client_id, legal_name, coverage_officer, instrument_id, net_qty
       FROM v_positions JOIN v_clients USING (client_id) ORDER BY net_qty DESC, client_id, instrument_id LIMIT 25""",
)
def positions_with_officer(d: Desk):
    """The 25 largest positions with their client's officer."""
    return (
        d.positions.join(d.clients, "client_id")
        .orderBy(F.desc("net_qty"), "client_id", "instrument_id")
        .limit(25)
        .select("client_id", "legal_name", "coverage_officer", "instrument_id", "net_qty")
    )


@query(
    "join_lateral_latest_price",
    """SELECT p.instrument_id, p.client_id, mp.spot_price AS latest_price, p.net_qty * mp.spot_price AS value
       FROM v_positions p
       JOIN (SELECT instrument_id, latest_price AS spot_price FROM v_latest) mp USING (instrument_id)""",
)
def join_lateral_latest_price(d: Desk):
    latest = enrich.latest_marks(d.marks).select("instrument_id", F.col("spot_price").alias("latest_price"))
    return d.positions.join(splittable(latest, "instrument_id"), "instrument_id").select(
        "instrument_id", "client_id", "latest_price", (F.col("net_qty") * F.col("latest_price")).alias("value")
    )


@query(
    "join_modulo_key",
    """SELECT p_brand, count(*) AS n_rows, count(p_partkey) AS n_matched
       FROM orders LEFT JOIN part ON p_partkey = o_orderkey % (SELECT count(*) FROM part) + 1 GROUP BY p_brand""",
)
def join_modulo_key(d: Desk):
    n = d.table("part").agg(F.count("*")).scalar()
    keyed = d.table("orders").select((F.col("o_orderkey") % n + 1).alias("p_partkey"))
    # one row per computed key before the join
    counted = keyed.groupBy("p_partkey").agg(F.count("*").alias("n"))
    parts = d.table("part").select("p_partkey", "p_brand", F.lit(1).alias("hit"))
    return (
        counted.join(parts, "p_partkey", "left")
        .groupBy("p_brand")
        .agg(
            F.sum("n").alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("hit") == 1, F.col("n"))), F.lit(0)).alias("n_matched"),
        )
    )


_FLOW_COLUMNS = [
    "order_id", "line_no", "client_id", "instrument_id", "trader", "side", "quantity", "price", "sector",
    "asset_class", "credit_rating", "trade_date", "trade_week", "trade_hour", "notional_cad",
]


@query("enrich_trades", f"SELECT {', '.join(_FLOW_COLUMNS)} FROM v_flow")
def enrich_trades(d: Desk):
    return flow(d).select(*_FLOW_COLUMNS)


_BOOK_COLUMNS = [
    "client_id", "instrument_id", "book", "asset_class", "sector", "net_qty", "avg_entry_price", "latest_price",
    "market_value", "gross_exposure", "pnl_cad", "limit_cad",
]


@query("enrich_positions", f"SELECT {', '.join(_BOOK_COLUMNS)} FROM v_book")
def enrich_positions(d: Desk):
    return book(d).select(*_BOOK_COLUMNS)


@query(
    "feature_lookup",
    """SELECT event_id, user_id * 20 AS client_id, gross_notional_cad, portfolio_volatility, risk_tier
       FROM events LEFT JOIN v_features ON client_id = user_id * 20""",
)
def feature_lookup(d: Desk):
    """Every event asks for the features of one client; some ask for clients that do not exist."""
    requests = d.table("events").select("event_id", (F.col("user_id") * 20).alias("client_id"))
    found = features(d).select("client_id", "gross_notional_cad", "portfolio_volatility", "risk_tier")
    return lookup.feature_lookup(requests, found)


_MENTIONS_SQL = """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '  ' || upper(c_name) || ' ' WHEN 1 THEN 't' || c_custkey
       WHEN 2 THEN ' cl-' || c_custkey ELSE 'unknown ' || c_custkey END AS mention, c_custkey,
       CASE WHEN o_orderkey % 4 = 3 THEN 'UNKNOWN ' || c_custkey ELSE 'CL-' || c_custkey END AS entity_id
FROM orders JOIN customer ON o_custkey = c_custkey"""


def mentions(d: Desk):
    """One free-text mention of a client per order: a name, a ticker, an id or nobody known."""
    kind = F.col("o_orderkey") % 4
    key = F.col("o_custkey").cast("string")
    named = d.table("orders").join(
        d.table("customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey")
    )
    return named.select(
        "o_orderkey",
        F.when(kind == 0, F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")))
        .when(kind == 1, F.concat(F.lit("t"), key))
        .when(kind == 2, F.concat(F.lit(" cl-"), key))
        .otherwise(F.concat(F.lit("unknown "), key))
        .alias("mention"),
    )


def aliases(d: Desk):
    """Names and tickers of all clients, in lower case, with the id they stand for."""
    cid = F.concat(F.lit("CL-"), F.col("client_id"))
    return d.clients.select(
        F.explode(F.array(F.lower("legal_name"), F.lower("ticker"))).alias("alias"), cid.alias("alias_id")
    )


@query("entity_resolve", f"SELECT o_orderkey, mention, entity_id FROM ({_MENTIONS_SQL})")
def entity_resolve(d: Desk):
    return lookup.resolve_entities(mentions(d), aliases(d))


@query(
    "risk_lookup_json",
    f"""SELECT o_orderkey, entity_id, gross_notional_cad, net_exposure_cad, num_open_positions, num_trades_30d,
               avg_trade_notional_cad, largest_position_pct, realized_pnl_30d_cad, portfolio_volatility,
               days_since_last_trade, credit_rating_score, risk_tier
        FROM ({_MENTIONS_SQL}) m LEFT JOIN v_features f ON 'CL-' || f.client_id = m.entity_id""",
)
def risk_lookup_json(d: Desk):
    """Free text to client to all of its features as one JSON object per request, read back from the text.

    How a double is written differs between engines, so the answer is compared by what the object holds.
    """
    found = features(d).withColumn("entity_id", F.concat(F.lit("CL-"), F.col("client_id"))).drop("client_id")
    asked = lookup.resolve_entities(mentions(d), aliases(d))
    joined = lookup.feature_lookup(asked, found, "entity_id")
    names = ["entity_id", *feat.FEATURE_COLUMNS[1:]]
    body = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    held = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.select(*names).schema)
    return joined.select("o_orderkey", F.from_json(body, held).alias("b")).select("o_orderkey", "b.*")


_METRICS = ["gross_notional_cad", "net_exposure_cad", "num_open_positions", "portfolio_volatility", "credit_rating_score"]


@query(
    "compare_clients",
    " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, l.{m}::DOUBLE AS left_value, r.{m}::DOUBLE AS right_value,
            l.{m}::DOUBLE - r.{m}::DOUBLE AS difference
            FROM (SELECT * FROM v_features ORDER BY gross_notional_cad DESC LIMIT 1) l,
                 (SELECT * FROM v_features ORDER BY gross_notional_cad DESC LIMIT 1 OFFSET 1) r"""
        for m in _METRICS
    ),
)
def compare_clients(d: Desk):
    """The two clients with the largest gross exposure side by side."""
    return lookup.compare_largest(features(d), "gross_notional_cad", _METRICS)


@query(
    "limit_breaches",
    f"""SELECT client_id, exposure, limit_cad, exposure - limit_cad AS excess
        FROM (SELECT client_id, {money('gross_exposure')} AS exposure FROM v_valued GROUP BY client_id)
        JOIN v_limits USING (client_id) WHERE limit_type = 'GROSS_NOTIONAL' AND exposure > limit_cad""",
)
def limit_breaches(d: Desk):
    exposure = valued(d).groupBy("client_id").agg(exact_sum(F.col("gross_exposure")).alias("exposure"))
    gross = d.limits.where("limit_type = 'GROSS_NOTIONAL'").select("client_id", "limit_cad")
    return (
        exposure.join(gross, "client_id")
        .where("exposure > limit_cad")
        .withColumn("excess", F.col("exposure") - F.col("limit_cad"))
    )


# --- aggregates -----------------------------------------------------------


@query("agg_positions", "SELECT * EXCLUDE (portfolio_volatility) FROM v_postotals")
def agg_positions(d: Desk):
    return feat.position_totals(economics(d)).drop("portfolio_volatility")


@query("portfolio_volatility", "SELECT client_id, portfolio_volatility FROM v_postotals")
def portfolio_volatility(d: Desk):
    return feat.position_totals(economics(d)).select("client_id", "portfolio_volatility")


@query("agg_trades_30d", "SELECT * FROM v_recent")
def agg_trades_30d(d: Desk):
    return feat.recent_trade_totals(aged_trades(d))


@query("days_since_last_trade", "SELECT * FROM v_recency")
def days_since_last_trade(d: Desk):
    """Trades in unknown instruments do not count, as in the features."""
    return feat.recency(aged_trades(d))


@query("client_risk_features", "SELECT * FROM v_features")
def client_risk_features(d: Desk):
    return features(d)


@query(
    "clients_by_officer",
    """SELECT coverage_officer, count(*) AS clients, string_agg(ticker, ', ' ORDER BY ticker) AS book
       FROM v_clients GROUP BY coverage_officer""",
)
def clients_by_officer(d: Desk):
    """Each officer's clients; an officer has at most 250."""
    tickers = F.array_join(F.array_sort(F.collect_list("ticker")), ", ")
    return d.clients.groupBy("coverage_officer").agg(F.count("*").alias("clients"), tickers.alias("book"))


@query("distinct_keys", "SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT props) AS n_props FROM events")
def distinct_keys(d: Desk):
    return d.table("events").agg(
        F.countDistinct("user_id").alias("n_users"), F.countDistinct("props").alias("n_props")
    )


SKETCH_ERROR = 0.02  # relative standard deviation of the sketch


@query(
    "distinct_keys_sketch",
    "SELECT true AS users_near, true AS props_near, count(DISTINCT user_id) > 0 AS any_user FROM events",
)
def distinct_keys_sketch(d: Desk):
    """The counts by a sketch of fixed size, against the exact ones: within three standard deviations."""
    # a column's different values first: a sketch of them is that of all rows, and no sketch is kept for each value
    counts = [
        d.table("events").select(c).distinct().agg(F.count(c).alias(f"{c}_n"), F.approx_count_distinct(c, SKETCH_ERROR).alias(f"{c}_sketch"))
        for c in ("user_id", "props")
    ]

    def near(c: str):
        return F.abs(F.col(f"{c}_sketch") - F.col(f"{c}_n")) <= F.ceil(3 * SKETCH_ERROR * F.col(f"{c}_n"))

    props = counts[1].select(near("props")).scalar()
    return counts[0].select(near("user_id").alias("users_near"), props.alias("props_near"), (F.col("user_id_sketch") > 0).alias("any_user"))


@query(
    "distinct_clients_by_range",
    """SELECT CAST(year(trade_date) AS INTEGER) AS trade_year, book, count(*) AS n_trades, true AS clients_near
       FROM v_fills JOIN v_instruments USING (instrument_id) GROUP BY ALL""",
)
def distinct_clients_by_range(d: Desk):
    """Active clients per year and book from one stored sketch per day and book, against exact counts."""
    path = work_dir(d.spark, "sketches")
    done = d.fills.join(d.instruments.select("instrument_id", "book"), "instrument_id").select("trade_date", "book", "client_id")
    sketches.sketch_cells(done, ["trade_date", "book"], "client_id").write.parquet(path)
    cells = d.spark.read.schema("trade_date date, book string, n_rows long, sketch binary").parquet(path)
    by = [F.year("trade_date").alias("trade_year"), "book"]
    exact = done.groupBy(*by).agg(F.countDistinct("client_id").alias("exact"))
    met = sketches.merged(cells, by).join(exact, ["trade_year", "book"])
    return met.select("trade_year", "book", F.col("n_rows").alias("n_trades"), sketches.near(F.col("n_distinct"), F.col("exact")).alias("clients_near"))


_KPI_SQL = """SELECT {total} AS total_notional, count(*) AS n_trades,
               count(DISTINCT client_id) AS active_clients, {buy} AS buy_flow, {sell} AS sell_flow,
               (SELECT {gross} FROM {book}) AS gross_exposure
        FROM {flow}"""


def _kpi_sql(flow_source: str, book_source: str) -> str:
    return _KPI_SQL.format(
        total=money("notional_cad"), buy=money("CASE WHEN side = 'BUY' THEN notional_cad END"),
        sell=money("CASE WHEN side = 'SELL' THEN notional_cad END"), gross=money("gross_exposure"),
        flow=flow_source, book=book_source,
    )


@query("kpi_cards", _kpi_sql("v_flow", "v_book"))
def kpi_cards(d: Desk):
    return enrich.kpis(deals(d), valued(d), d.clients)


@query("kpi_cards_filtered", _kpi_sql(_BAR_FLOW, _BAR_BOOK))
def kpi_cards_filtered(d: Desk):
    """The same cards under the filter bar."""
    return enrich.kpis(deals(d), valued(d), d.clients, BAR)


@query(
    "daily_flow",
    f"SELECT trade_date, side, {money('notional_cad')} AS notional FROM v_flow GROUP BY trade_date, side",
)
def daily_flow(d: Desk):
    return flow_totals(d, [], ["trade_date", "side"]).drop("n_trades")


@query(
    "daily_flow_filtered",
    f"SELECT trade_date, side, {money('notional_cad')} AS notional FROM {_BAR_FLOW} GROUP BY trade_date, side",
)
def daily_flow_filtered(d: Desk):
    return flow_totals(d, [], ["trade_date", "side"], BAR).drop("n_trades")


def _share_sql(key: str, source: str = "v_flow", value: str = "notional_cad", name: str = "notional") -> str:
    return f"""
WITH g AS (SELECT {key}, {money(value)} AS {name} FROM {source} GROUP BY {key})
SELECT *, {name} / (SELECT {money(name)} FROM g) AS share FROM g"""


@query("notional_by_asset_class", _share_sql("asset_class"))
def notional_by_asset_class(d: Desk):
    return enrich.with_share(flow_totals(d, [], ["asset_class"]).drop("n_trades"), "notional")


@query(
    "top_traders",
    f"""SELECT trader, {money('notional_cad')} AS notional, count(*) AS n_trades FROM v_flow GROUP BY trader
        ORDER BY notional DESC, trader LIMIT 10""",
)
def top_traders(d: Desk):
    return flow_totals(d, [], ["trader"]).orderBy(F.desc("notional"), "trader").limit(10)


@query(
    "sector_treemap",
    f"""SELECT sector, asset_class, CAST(grouping_id(sector, asset_class) AS BIGINT) AS level, {money('notional_cad')} AS notional
        FROM v_flow GROUP BY ROLLUP (sector, asset_class)""",
)
def sector_treemap(d: Desk):
    """Totals per leaf first, so the rollup expands categories and not trades."""
    leaves = flow_totals(d, ["sector"], ["asset_class"])
    return leaves.rollup("sector", "asset_class").agg(
        F.grouping_id().cast("long").alias("level"), exact_sum(F.col("notional")).alias("notional")
    )


_PIVOT = ", ".join(
    f"""{money(f"CASE WHEN asset_class = '{c}' THEN notional_cad END")} AS "{c}" """ for c in ASSET_CLASSES
)
_KNOWN = ", ".join(f"'{c}'" for c in ASSET_CLASSES)


@query(
    "client_asset_heatmap",
    f"""SELECT client_id, {_PIVOT},
               {money(f"CASE WHEN asset_class NOT IN ({_KNOWN}) THEN notional_cad END")} AS "OTHER"
        FROM v_flow GROUP BY client_id""",
)
def client_asset_heatmap(d: Desk):
    return enrich.asset_pivot(deals(d), d.clients, ASSET_CLASSES)


@query(
    "client_asset_heatmap_filtered",
    f"""SELECT client_id, {_PIVOT},
               {money(f"CASE WHEN asset_class NOT IN ({_KNOWN}) THEN notional_cad END")} AS "OTHER"
        FROM {_BAR_FLOW} GROUP BY client_id""",
)
def client_asset_heatmap_filtered(d: Desk):
    return enrich.asset_pivot(deals(d), d.clients, ASSET_CLASSES, BAR)


@query(
    "trades_by_hour",
    """SELECT CAST(h AS INTEGER) AS trade_hour, count(trade_hour) AS n_trades
       FROM (SELECT unnest(range(0, 24)) AS h) LEFT JOIN v_flow ON trade_hour = h GROUP BY h""",
)
def trades_by_hour(d: Desk):
    return enrich.by_hour(deals(d), d.clients)


@query(
    "gross_by_client",
    f"""SELECT client_id, legal_name, {money('gross_exposure')} AS gross FROM v_book GROUP BY client_id, legal_name
        ORDER BY gross DESC, client_id LIMIT 12""",
)
def gross_by_client(d: Desk):
    totals = valued(d).groupBy("client_id").agg(exact_sum(F.col("gross_exposure")).alias("gross"))
    top = totals.join(d.clients.select("client_id", "legal_name"), "client_id")
    return top.orderBy(F.desc("gross"), "client_id").limit(12).select("client_id", "legal_name", "gross")


def _sign(column: str):
    return F.when(F.col(column) >= 0, "gain").otherwise("loss").alias("sign")


@query(
    "pnl_by_desk",
    f"""SELECT book, pnl, CASE WHEN pnl >= 0 THEN 'gain' ELSE 'loss' END AS sign
        FROM (SELECT book, {money('pnl_cad')} AS pnl FROM v_book GROUP BY book)""",
)
def pnl_by_desk(d: Desk):
    """Positions of unknown clients count nowhere, with selections or without."""
    return enrich.exposure_by(valued(d), d.clients, [], ["book"]).select("book", "pnl", _sign("pnl"))


@query(
    "pnl_by_desk_filtered",
    f"""SELECT book, pnl, CASE WHEN pnl >= 0 THEN 'gain' ELSE 'loss' END AS sign
        FROM (SELECT book, {money('pnl_cad')} AS pnl FROM {_BAR_BOOK} GROUP BY book)""",
)
def pnl_by_desk_filtered(d: Desk):
    return enrich.exposure_by(valued(d), d.clients, [], ["book"], BAR).select("book", "pnl", _sign("pnl"))


@query(
    "exposure_sunburst",
    f"""SELECT book, legal_name, instrument_id, CAST(grouping_id(book, legal_name, instrument_id) AS BIGINT) AS level,
               {money('gross_exposure')} AS gross
        FROM v_book GROUP BY ROLLUP (book, legal_name, instrument_id)""",
)
def exposure_sunburst(d: Desk):
    leaves = book(d).groupBy("book", "legal_name", "instrument_id").agg(
        exact_sum(F.col("gross_exposure")).alias("gross")
    )
    # the leaves are a level as they are, so only the others are summed and shuffled again
    above = leaves.rollup("book", "legal_name").agg(
        (F.grouping_id() * 2 + 1).cast("long").alias("level"), exact_sum(F.col("gross")).alias("gross")
    )
    level = leaves.select("book", "legal_name", "instrument_id", F.lit(0).cast("long").alias("level"), "gross")
    return level.unionByName(above.withColumn("instrument_id", F.lit(None).cast(leaves.schema["instrument_id"].dataType)))


@query(
    "long_short",
    f"""SELECT book, CASE WHEN net_qty >= 0 THEN 'Long' ELSE 'Short' END AS direction, count(*) AS n_positions,
               {money('gross_exposure')} AS gross FROM v_book GROUP BY ALL""",
)
def long_short(d: Desk):
    facing = valued(d).withColumn("direction", F.when(F.col("net_qty") >= 0, "Long").otherwise("Short"))
    return enrich.exposure_by(facing, d.clients, [], ["book", "direction"]).drop("pnl")


_RETURNS_SQL = """
SELECT instrument_id, price_date, spot_price,
       (spot_price / lag(spot_price) OVER (PARTITION BY instrument_id ORDER BY price_date) - 1) * 100 AS daily_return
FROM v_marks"""


@query("daily_returns", _RETURNS_SQL)
def daily_returns(d: Desk):
    return prices.daily_returns(d.marks)


@query(
    "returns_histogram",
    f"""WITH r AS (SELECT instrument_id, daily_return AS x FROM ({_RETURNS_SQL}) WHERE daily_return IS NOT NULL),
             b AS (SELECT instrument_id, min(x) AS lo, max(x) AS hi FROM r GROUP BY instrument_id)
        SELECT instrument_id, CAST(greatest(0, least(24, CASE WHEN hi > lo THEN floor((x - lo) / (hi - lo) * 25) ELSE 0 END)) AS INTEGER) AS bin,
               count(*) AS n FROM r JOIN b USING (instrument_id) GROUP BY ALL""",
)
def returns_histogram(d: Desk):
    return prices.returns_histogram(prices.daily_returns(d.marks))


@query(
    "vol_comparison",
    """SELECT instrument_id, description, m.volatility FROM v_marks m JOIN v_instruments i USING (instrument_id)
       QUALIFY row_number() OVER (PARTITION BY instrument_id ORDER BY price_date DESC) = 1
       ORDER BY m.volatility DESC, instrument_id LIMIT 15""",
)
def vol_comparison(d: Desk):
    latest = enrich.latest_marks(d.marks).select("instrument_id", "volatility")
    return (
        latest.join(d.instruments.select("instrument_id", "description"), "instrument_id")
        .orderBy(F.desc("volatility"), "instrument_id")
        .limit(15)
    )


@query(
    "top_clients",
    f"""SELECT client_id, legal_name, {money('notional_cad')} AS notional FROM v_flow GROUP BY client_id, legal_name
        ORDER BY notional DESC, client_id LIMIT 15""",
)
def top_clients(d: Desk):
    return (
        flow_totals(d, ["client_id", "legal_name"], []).drop("n_trades")
        .orderBy(F.desc("notional"), "client_id")
        .limit(15)
    )


@query(
    "notional_by_rating",
    f"""SELECT credit_rating, list_position(['AAA','AA','A','A-','BBB+','BBB','BBB-','BB','B','CCC','NR'], credit_rating)::INTEGER
               AS rating_order, {money('notional_cad')} AS notional FROM v_flow GROUP BY credit_rating""",
)
def notional_by_rating(d: Desk):
    """In order of quality, not of the alphabet."""
    position = F.array_position(F.array(*map(F.lit, RATINGS)), F.col("credit_rating")).cast("int")
    return (
        flow_totals(d, ["credit_rating"], []).drop("n_trades")
        .withColumn("rating_order", position)
        .orderBy("rating_order")
    )


@query(
    "tier_mix",
    """SELECT relationship_tier, count(*) AS n_clients, count(*)::DOUBLE / (SELECT count(*) FROM v_clients) AS share
       FROM v_clients GROUP BY relationship_tier""",
)
def tier_mix(d: Desk):
    counts = d.clients.groupBy("relationship_tier").agg(F.count("*").alias("n_clients"))
    total = counts.agg(F.sum("n_clients")).scalar()
    return counts.withColumn("share", F.col("n_clients") / total)


@query(
    "pnl_by_client",
    f"""SELECT client_id, pnl, CASE WHEN pnl >= 0 THEN 'gain' ELSE 'loss' END AS sign
        FROM (SELECT client_id, {money('pnl_cad')} AS pnl FROM v_book GROUP BY client_id)""",
)
def pnl_by_client(d: Desk):
    return enrich.exposure_by(valued(d), d.clients, ["client_id"], []).select("client_id", "pnl", _sign("pnl"))


@query(
    "limit_utilisation",
    f"""SELECT client_id, limit_cad, coalesce(exposure, 0) AS exposure, coalesce(exposure, 0) / nullif(limit_cad, 0) AS utilisation
        FROM (SELECT client_id, limit_cad FROM v_limits WHERE limit_type = 'GROSS_NOTIONAL')
        LEFT JOIN (SELECT client_id, {money('gross_exposure')} AS exposure FROM v_valued GROUP BY client_id)
             USING (client_id)""",
)
def limit_utilisation(d: Desk):
    exposure = valued(d).groupBy("client_id").agg(exact_sum(F.col("gross_exposure")).alias("exposure"))
    gross = d.limits.where("limit_type = 'GROSS_NOTIONAL'").select("client_id", "limit_cad")
    return (
        gross.join(exposure, "client_id", "left").na.fill({"exposure": 0.0})
        .withColumn("utilisation", ratio(F.col("exposure"), F.col("limit_cad")))
    )


@query("sector_concentration", _share_sql("sector", "v_book", "gross_exposure", "gross"))
def sector_concentration(d: Desk):
    return enrich.with_share(enrich.exposure_by(valued(d), d.clients, ["sector"], []).select("sector", "gross"), "gross")


@query("sector_concentration_filtered", _share_sql("sector", _BAR_BOOK, "gross_exposure", "gross"))
def sector_concentration_filtered(d: Desk):
    kept = enrich.exposure_by(valued(d), d.clients, ["sector"], [], BAR)
    return enrich.with_share(kept.select("sector", "gross"), "gross")


@query(
    "hero_exposure",
    f"""SELECT client_id, instrument_id, CAST(grouping_id(client_id, instrument_id) AS BIGINT) AS level,
               {money(f'floor(abs(net_qty * latest_price * contract_size * ({FX})) + 0.5)')} AS gross_cad
        FROM v_valued GROUP BY ROLLUP (client_id, instrument_id) HAVING grouping_id(client_id, instrument_id) < 3""",
)
def hero_exposure(d: Desk):
    """Exposure in whole CAD of every client's instruments, with a total row per client."""
    whole = F.floor(
        F.abs(F.col("net_qty") * F.col("latest_price") * F.col("contract_size") * fx_rate(F.col("currency")))
        + F.lit(0.5)
    ).cast("double")
    legs = valued(d).select("client_id", "instrument_id", whole.alias("gross"))
    return (
        legs.groupingSets([["client_id", "instrument_id"], ["client_id"]], "client_id", "instrument_id")
        .agg(F.grouping_id().cast("long").alias("level"), exact_sum(F.col("gross")).alias("gross_cad"))
    )


_POINT = ["order_id", "line_no", "quantity", "price", "asset_class", "notional_cad", "instrument_id", "trader", "side"]


@query("trade_scatter", f"SELECT {', '.join(_POINT)} FROM v_flow")
def trade_scatter(d: Desk):
    """A point for every trade."""
    return enrich.trade_points(lambda clients: deals(d, clients), d.clients, _POINT)


@query("trade_scatter_filtered", f"SELECT {', '.join(_POINT)} FROM {_BAR_FLOW}")
def trade_scatter_filtered(d: Desk):
    return enrich.trade_points(lambda clients: deals(d, clients), d.clients, _POINT, BAR)


# --- windows, sorts -------------------------------------------------------


@query(
    "latest_mark",
    """SELECT instrument_id, price_date, spot_price FROM v_marks
       QUALIFY row_number() OVER (PARTITION BY instrument_id ORDER BY price_date DESC) = 1""",
)
def latest_mark(d: Desk):
    return enrich.latest_marks(d.marks).select("instrument_id", "price_date", "spot_price")


@query(
    "cumulative_flow",
    f"""WITH g AS (SELECT side, trade_ts, {money('notional_cad')} AS notional FROM v_flow GROUP BY side, trade_ts)
        SELECT side, trade_ts, notional,
               CAST(sum(CAST(floor(notional * 1e6 + 0.5) AS HUGEINT)) OVER (PARTITION BY side ORDER BY trade_ts) AS DOUBLE) / 1e6
               AS cumulative FROM g""",
)
def cumulative_flow(d: Desk):
    """Running total per side: one row per time first, then totals by day carried into the day."""
    per_time = flow_totals(d, [], ["side", "trade_ts"]).drop("n_trades")
    units = F.floor((F.col("notional") * F.lit(1e6) + F.lit(0.5)).cast("decimal(38,4)")).cast("decimal(28,0)")
    whole = per_time.withColumn("units", units)
    totals = running_totals(whole, ["side"], ["trade_ts"], F.to_date("trade_ts"), {"cumulative": "units"})
    return totals.select(
        "side", "trade_ts", "notional", (F.col("cumulative").cast("double") / F.lit(1e6)).alias("cumulative")
    )


@query(
    "price_line",
    """SELECT asset_class, instrument_id, price_date, spot_price, volatility FROM v_marks
       JOIN (SELECT asset_class, min(instrument_id) AS instrument_id FROM v_instruments GROUP BY asset_class)
            USING (instrument_id)""",
)
def price_line(d: Desk):
    """Price and volatility by day of the instrument each asset class's chart starts with.

    The few instruments are known before order lines are read, so only theirs are aggregated.
    """
    chosen = first_instrument(d).select("asset_class", "instrument_id")
    lines = d.table("lineitem").join(chosen, F.col("l_partkey") == F.col("instrument_id"), "left_semi")
    return marks_of(lines).join(chosen, "instrument_id").select(
        "asset_class", "instrument_id", "price_date", "spot_price", "volatility"
    ).orderBy("asset_class", "price_date")


@query(
    "largest_movers",
    f"""WITH r AS ({_RETURNS_SQL})
        SELECT * FROM (SELECT instrument_id, price_date, daily_return FROM r
          QUALIFY row_number() OVER (PARTITION BY instrument_id ORDER BY price_date DESC) = 1)
        WHERE daily_return IS NOT NULL ORDER BY abs(daily_return) DESC, instrument_id LIMIT 20""",
)
def largest_movers(d: Desk):
    return prices.largest_movers(d.marks)


@query(
    "timeseries_dedupe",
    """SELECT user_id, event_id, ts, event_type FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def timeseries_dedupe(d: Desk):
    latest = top_rows(d.table("events"), ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return latest.select("user_id", "event_id", "ts", "event_type")


@query(
    "first_instrument",
    "SELECT asset_class, min(instrument_id) AS instrument_id, count(*) AS in_scope FROM v_instruments GROUP BY asset_class",
)
def first_instrument(d: Desk):
    """The instrument a chart starts with, per asset class."""
    return d.instruments.groupBy("asset_class").agg(
        F.min("instrument_id").alias("instrument_id"), F.count("*").alias("in_scope")
    )


@query("sort_features", "SELECT * FROM v_features ORDER BY gross_notional_cad DESC, client_id")
def sort_features(d: Desk):
    return features(d).orderBy(F.desc("gross_notional_cad"), "client_id")


@query("sort_limit", "SELECT * FROM v_reference ORDER BY client_id LIMIT 5")
def sort_limit(d: Desk):
    return reference(d).orderBy("client_id").limit(5)


@query(
    "hash_sort_join_count",
    """WITH h AS (SELECT md5(l_orderkey || ':' || l_linenumber) AS h, o_orderpriority AS priority
                  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey % (SELECT max(o_orderkey) FROM orders) + 1)
       SELECT priority, count(*) AS n, min(h) AS first_hash, max(h) AS last_hash,
              max(CASE WHEN place % 1000 = 0 THEN place END) AS last_mark
       FROM (SELECT *, row_number() OVER (ORDER BY h, priority) AS place FROM h) GROUP BY priority""",
)
def hash_sort_join_count(d: Desk):
    """The load statement over rows of the tables: hash, left join, sort; the places in the order are used."""
    last = d.table("orders").agg(F.max("o_orderkey")).scalar()
    lines = d.table("lineitem").select(
        F.md5(F.concat_ws(":", "l_orderkey", "l_linenumber")).alias("h"),
        (F.col("l_orderkey") % last + 1).alias("o_orderkey"),
    )
    orders = d.table("orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"))
    met = lines.join(orders, "o_orderkey", "left").select("h", "priority")
    ranked = number_rows(met, ["h", "priority"], "place", work_dir(d.spark, "hash-sorted"))
    return ranked.groupBy("priority").agg(
        F.count("*").alias("n"), F.min("h").alias("first_hash"), F.max("h").alias("last_hash"),
        F.max(F.when(F.col("place") % 1000 == 0, F.col("place"))).alias("last_mark"),
    )
