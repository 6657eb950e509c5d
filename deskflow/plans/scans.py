"""Scans, sources, generators, table upkeep and constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cdc, quality
from ..operators.keys import NumberedTable
from ..operators.ordered import number_rows
from ..functions.money import exact_sum
from ..functions.text import visible_text
from ..functions.vectors import vector_literal
from ..session import work_dir
from ..sources import generate
from ..sources.tables import count_rows, read_document_files, slices, write_document_files
from ..sources.views import Desk
from .common import book_at, features, last_year, reference, updated_reference
from .oracle_views import SPACE, fx, money
from .registry import query

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@query("scan_inferred", "SELECT p_partkey, p_name, p_retailprice FROM part")
def scan_inferred(d: Desk):
    """Types as the files declare them."""
    return d.spark.read.parquet(f"{d.base}/part.parquet").select("p_partkey", "p_name", "p_retailprice")


@query(
    "scan_typed",
    """SELECT CAST(client_id AS VARCHAR) AS client_id, legal_name, sector, credit_rating, risk_limit_cad,
              coverage_officer, updated_at FROM v_reference""",
)
def scan_typed(d: Desk):
    return reference(d).select(
        F.col("client_id").cast("string").alias("client_id"), "legal_name", "sector",
        "credit_rating", "risk_limit_cad", "coverage_officer", "updated_at",
    )


@query("scan_table", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_table(d: Desk):
    """A whole table by name; the name is the statement's own and no other session or base sees it."""
    return d.spark.sql("SELECT o_orderkey, o_custkey, o_totalprice FROM {orders}", orders=d.table("orders"))


def _jdbc_slices_sql() -> str:
    return f"""
WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi,
                  greatest(1, (max(o_orderkey) - min(o_orderkey) + 1) // 8) AS w FROM orders)
SELECT CAST(least(7, (o_orderkey - lo) // w) AS INTEGER) AS slice, count(*) AS n_rows,
       {money("o_totalprice")} AS total
FROM orders, b GROUP BY 1"""


@query("jdbc_read_partitioned", _jdbc_slices_sql())
def jdbc_read_partitioned(d: Desk):
    """The slices a partitioned row-store read is cut into, each with its rows and total."""
    orders = d.table("orders")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    number = F.lit(None).cast("int")
    for i, predicate in reversed(list(enumerate(slices("o_orderkey", low, high, 8)))):
        number = F.when(F.expr(predicate), F.lit(i)).otherwise(number)
    return orders.groupBy(number.alias("slice")).agg(
        F.count("*").alias("n_rows"), exact_sum(F.col("o_totalprice")).alias("total")
    )


@query(
    "rest_style_select_json",
    """SELECT CAST(to_json({'client_id': client_id, 'ticker': ticker, 'sector': sector}) AS VARCHAR) AS body
       FROM v_clients ORDER BY client_id LIMIT 5""",
)
def rest_style_select_json(d: Desk):
    """A page of five rows as JSON objects."""
    page = d.clients.select("client_id", "ticker", "sector").orderBy("client_id").limit(5)
    return page.select(
        F.to_json(F.struct("client_id", "ticker", "sector"), {"ignoreNullFields": "false"}).alias("body")
    )


@query(
    "document_scan",
    """SELECT source, lang, count(*) AS n_docs, CAST(sum(length("text")) AS BIGINT) AS n_chars FROM documents
       GROUP BY source, lang""",
)
def document_scan(d: Desk):
    return d.table("documents").groupBy("source", "lang").agg(
        F.count("*").alias("n_docs"), F.sum(F.length("text")).alias("n_chars")
    )


@query(
    "document_files",
    """SELECT doc_id, source, lang, length("text") AS n_chars, sha256("text") AS digest FROM documents WHERE lang = 'de'""",
)
def document_files(d: Desk):
    """Documents read from files, those of one language only: folders of other languages are not opened."""
    path = work_dir(d.spark, "files")
    write_document_files(d.table("documents").select("doc_id", "text", "lang", "source"), path, ["lang"])
    found = read_document_files(d.spark, path, "doc_id long, text string, source string", "lang string").where("lang = 'de'")
    return found.select("doc_id", "source", "lang", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("digest"))


@query(
    "page_text_extract",
    f"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html,
          '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'),
          '(?s)<[^>]*>', ' ', 'g'), '{SPACE}', ' ', 'g'), ' ') AS content FROM pages""",
)
def page_text_extract(d: Desk):
    return d.table("pages").select("page_id", visible_text(F.col("html")).alias("content"))


@query("gen_orders", "SELECT * FROM v_orders")
def gen_orders(d: Desk):
    """As many generated orders as the orders table has rows."""
    return generate.gen_orders(d.spark, d.table("orders").count())


_NOISE = " + ".join(f"CAST('0x' || substr(h, {2 * i + 1}, 2) AS BIGINT)" for i in range(12))


@query(
    "gen_price_walk",
    f"""
WITH RECURSIVE moves AS (
  SELECT instrument_id, volatility, i, (0 + {_NOISE} + 6)::DOUBLE / 256.0::DOUBLE - 6.0::DOUBLE AS z
  FROM (SELECT instrument_id, volatility, i, md5('1867:price:' || instrument_id || ':' || i) AS h
        FROM v_instruments, (SELECT unnest(range(1, 31)) AS i))),
walk AS (
  SELECT instrument_id, CAST(0 AS BIGINT) AS i, spot_price AS p FROM v_instruments
  UNION ALL
  SELECT w.instrument_id, m.i, greatest(0.01::DOUBLE, w.p * (1 + m.z * (m.volatility / sqrt(252.0::DOUBLE))))
  FROM walk w JOIN moves m ON m.instrument_id = w.instrument_id AND m.i = w.i + 1)
SELECT w.instrument_id, (SELECT as_of FROM v_asof) - CAST(30 - w.i AS INTEGER) AS price_date,
       CAST(floor(w.p * 10000 + 0.5) AS BIGINT)::DOUBLE / 10000.0::DOUBLE AS spot_price, v.volatility
FROM walk w JOIN v_instruments v USING (instrument_id) WHERE w.i > 0""",
)
def gen_price_walk(d: Desk):
    """Thirty prices for every instrument up to the valuation date."""
    return generate.price_walk(d.instruments, d.trade_date_max.scalar())


def _draw(parts: str, low: int, high: int | str) -> str:
    return f"({low} + CAST('0x' || substr(md5('1867:' || {parts}), 1, 12) AS BIGINT) % ({high} - {low} + 1))"


def _uniform(parts: str) -> str:
    return f"({_draw(parts, 0, 999_999)} / 1e6::DOUBLE)"


def _pick(values: list[str], parts: str) -> str:
    return f"({values!r})[{_draw(parts, 1, len(values))}]"


_LEG = "client_id || ':' || leg"


@query(
    "gen_positions",
    f"""WITH c AS (SELECT 'CL-' || client_id AS client_id, ticker FROM v_clients WHERE client_id <> 0),
             i AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS no, 'T' || p_partkey AS instrument_id,
                          p_retailprice AS spot FROM part),
             l AS (SELECT client_id, unnest(range(1, {_draw("'legs:' || client_id", 6, 11)} + 1)) AS leg FROM c),
             r AS (SELECT client_id, leg, {_draw("'instr:' || " + _LEG, 0, "(SELECT count(*) FROM part) - 1")} AS no,
                          {_pick(generate.BOOKS, "'book:' || " + _LEG)} AS book,
                          (2 * {_draw("'sign:' || " + _LEG, 0, 1)} - 1) * {_draw("'qty:' || " + _LEG, 5, 400)} AS net_qty FROM l),
             b AS (SELECT client_id, instrument_id, book, net_qty, leg, spot FROM r JOIN i USING (no)
                   UNION ALL
                   SELECT client_id, instrument_id, 'EQUITY', {_draw("'own:' || client_id", 2000, 25000)}, 0, spot
                   FROM c JOIN i ON ticker = instrument_id
                   UNION ALL
                   SELECT 'CL-0', instrument_id, 'ENERGY', no * 100 + 250, -1, spot FROM (SELECT * FROM i ORDER BY no LIMIT 4))
        SELECT client_id, instrument_id, book, net_qty, leg,
               CAST(floor(spot * (1 + ({_uniform("'entry:' || client_id || ':' || instrument_id || ':' || leg")} * 0.16::DOUBLE - 0.08::DOUBLE))
                    * 10000 + 0.5) AS BIGINT)::DOUBLE / 10000.0::DOUBLE AS avg_entry_price FROM b""",
)
def gen_positions(d: Desk):
    """A generated book for every client over the whole instrument table."""
    instruments = d.numbered_instruments.select(
        "instrument_no", F.concat(F.lit("T"), F.col("instrument_id")).alias("instrument_id"), "spot_price"
    )
    clients = d.clients.select(F.concat(F.lit("CL-"), F.col("client_id")).alias("client_id"), "ticker")
    hero = instruments.where("instrument_no < 4").select(
        "instrument_id", F.lit("ENERGY").alias("book"), (F.col("instrument_no") * 100 + 250).alias("net_qty")
    )
    return generate.gen_positions(clients, instruments, d.table("part").count(), "CL-0", hero)


@query(
    "gen_trades",
    f"""WITH t AS (
          SELECT g AS trade_id, {_draw("'client:' || g", 0, "(SELECT count(*) FROM customer) - 1")} AS client_no,
                 {_draw("'instrument:' || g", 0, "(SELECT count(*) FROM part) - 1")} AS instrument_no,
                 {_pick(["BUY", "SELL"], "'side:' || g")} AS side, {_draw("'quantity:' || g", 1, 500)} AS quantity,
                 {_uniform("'price:' || g")} * 0.24::DOUBLE - 0.12::DOUBLE AS off,
                 CAST((SELECT as_of FROM v_asof) AS TIMESTAMP) - to_days(CAST({_draw("'days:' || g", 0, 89)} AS INTEGER))
                   - to_hours({_draw("'hours:' || g", 0, 8)}) - to_minutes({_draw("'minutes:' || g", 0, 59)}) AS trade_ts,
                 {_pick(generate.TRADERS, "'trader:' || g")} AS trader
          FROM (SELECT unnest(range(1, (SELECT count(*) + 1 FROM lineitem))) AS g))
        SELECT trade_id, client_id, instrument_id, side, quantity, price, trade_ts, trader,
               floor(quantity * price * contract_size * ({fx('currency')}) * 100 + 0.5) / 100.0::DOUBLE AS notional_cad
        FROM (SELECT t.*, client_id, instrument_id, contract_size, currency,
                     floor(spot_price * (1 + off) * 10000 + 0.5) / 10000.0::DOUBLE AS price
              FROM t JOIN (SELECT *, row_number() OVER (ORDER BY instrument_id) - 1 AS instrument_no FROM v_parts) USING (instrument_no)
                     JOIN (SELECT c_custkey AS client_id, row_number() OVER (ORDER BY c_custkey) - 1 AS client_no FROM customer)
                          USING (client_no))""",
)
def gen_trades(d: Desk):
    """As many generated trades as there are order lines."""
    instruments, clients = d.numbered_instruments, d.numbered_clients
    return generate.gen_trades(
        d.spark, d.table("lineitem").count(), clients, instruments, clients.count(),
        instruments.count(), d.trade_date_max.scalar(),
    )


@query(
    "gen_trades_profile",
    f"""WITH p AS (SELECT o_custkey AS client_id, count(*) AS n, ({money('o_totalprice')}) / count(*) AS base
                   FROM orders GROUP BY o_custkey),
             r AS (SELECT client_id, base, unnest(range(1, n + 1)) AS trade_no FROM p),
             v AS (SELECT *, floor(base * ({_uniform("'pn:' || client_id || ':' || trade_no")} * 1.2::DOUBLE + 0.4::DOUBLE) * 100 + 0.5)
                             / 100.0::DOUBLE AS notional_cad FROM r)
        SELECT client_id, trade_no, notional_cad, {_draw("'pd:' || client_id || ':' || trade_no", 0, 90)} AS days_ago,
               floor(notional_cad * ({_uniform("'pp:' || client_id || ':' || trade_no")} * 0.07::DOUBLE - 0.03::DOUBLE) * 100 + 0.5)
                 / 100.0::DOUBLE AS realized_pnl_cad FROM v""",
)
def gen_trades_profile(d: Desk):
    """Generated trades per client: as many as its orders, around its mean order value."""
    profile = d.table("orders").groupBy(F.col("o_custkey").alias("client_id")).agg(
        F.count("*").alias("n_trades"),
        (exact_sum(F.col("o_totalprice")) / F.count("*")).alias("base_notional"),
    )
    return generate.gen_trades_by_profile(profile)


@query(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES),
)
def table_counts(d: Desk):
    return count_rows({t: d.table(t) for t in TABLES})


# --- table upkeep ---------------------------------------------------------


@query("write_overwrite_roundtrip", "SELECT * FROM v_updated")
def write_overwrite_roundtrip(d: Desk):
    """A table written, then overwritten with another schema, then read."""
    path = work_dir(d.spark, "overwrite")
    reference(d).select("client_id", "sector").write.mode("overwrite").parquet(path)
    new = updated_reference(d)
    new.write.mode("overwrite").parquet(path)
    return d.spark.read.schema(new.schema).parquet(path)


@query("feature_table_build", "SELECT * FROM v_features")
def feature_table_build(d: Desk):
    """The feature table, refused when its key is missing or repeated."""
    path = work_dir(d.spark, "features")
    rows = quality.require_key(features(d), ["client_id"])
    rows.write.mode("overwrite").parquet(path)
    table = d.spark.read.schema(rows.schema).parquet(path)
    if not quality.duplicate_keys(table, ["client_id"]).isEmpty():
        raise ValueError("client_id is not a key of the feature table")
    return table


FILL_ORDER = ["trade_ts", "client_id", "order_id", "line_no", "instrument_id", "trader", "quantity", "price", "side"]


@query(
    "append_in_batches",
    """SELECT row_number() OVER (ORDER BY order_id % 3, trade_ts, client_id, order_id, line_no, instrument_id, trader, quantity, price, side)
              AS trade_id, trade_ts, client_id, order_id, line_no, instrument_id, trader, quantity, price, side
       FROM v_fills""",
)
def append_in_batches(d: Desk):
    """Fills appended in three batches whose keys go on; the second batch comes again after the third and keeps its keys."""
    fills = d.fills.select(*FILL_ORDER)
    table = NumberedTable(d.spark, work_dir(d.spark, "appended"), fills.schema, FILL_ORDER, "trade_id")
    for batch in (0, 1, 2, 1):
        table.append(fills.where(F.col("order_id") % 3 == batch), batch)
    return table.rows()


@query(
    "append_surrogate_key",
    """SELECT row_number() OVER (ORDER BY trade_ts, client_id, order_id, line_no, instrument_id, trader, quantity, price, side)
              AS trade_id, trade_ts, client_id, order_id, line_no, instrument_id, trader, quantity, price, side
       FROM v_fills""",
)
def append_surrogate_key(d: Desk):
    order = [
        "trade_ts", "client_id", "order_id", "line_no", "instrument_id", "trader", "quantity", "price", "side",
    ]
    return number_rows(d.fills.select(*order), order, "trade_id", work_dir(d.spark, "numbered"))


@query(
    "update_where",
    """SELECT client_id, sector, risk_limit_cad, updated_at FROM v_updated""",
)
def update_where(d: Desk):
    return updated_reference(d).select("client_id", "sector", "risk_limit_cad", "updated_at")


@query(
    "upsert_on_conflict",
    """SELECT limit_id, client_id, limit_type,
              CASE WHEN limit_type = 'NET' THEN limit_cad - 1000 ELSE limit_cad END AS limit_cad FROM v_limits
       UNION ALL
       SELECT 2 * c.n + s_suppkey, s_suppkey, 'DESK', s_acctbal
       FROM supplier, (SELECT count(*) AS n FROM customer) c""",
)
def upsert_on_conflict(d: Desk):
    """Net limits lowered, and one new limit per supplier added."""
    n = d.table("customer").agg(F.count("*")).scalar()
    lowered = d.limits.where("limit_type = 'NET'").withColumn("limit_cad", F.col("limit_cad") - 1000)
    added = d.table("supplier").select(
        F.col("s_suppkey").alias("client_id"),
        (F.col("s_suppkey") + n * 2).alias("limit_id"),
        F.lit("DESK").alias("limit_type"),
        F.col("s_acctbal").alias("limit_cad"),
    )
    return cdc.upsert(d.limits, lowered.unionByName(added), ["limit_id"])


@query("seed_if_empty", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def seed_if_empty(d: Desk):
    """Two seedings of one table; the second finds rows and adds none."""
    path = work_dir(d.spark, "seed")
    rows = d.table("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    rows.limit(0).write.mode("overwrite").parquet(path)
    for _ in range(2):
        if d.spark.read.schema(rows.schema).parquet(path).isEmpty():
            rows.write.mode("append").parquet(path)
    return d.spark.read.schema(rows.schema).parquet(path)


@query(
    "reconcile",
    """SELECT count(s.client_id) AS source_rows, count(t.client_id) AS target_rows,
              count(*) FILTER (t.client_id IS NULL) AS missing_in_target,
              count(*) FILTER (s.client_id IS NULL) AS extra_in_target,
              count(*) FILTER (s.net_qty <> t.net_qty) AS different,
              count(*) FILTER (s.net_qty = t.net_qty) AS "equal"
       FROM v_booknew s FULL JOIN v_bookold t
            ON s.client_id = t.client_id AND s.instrument_id = t.instrument_id""",
)
def reconcile(d: Desk):
    """The book now against the book of the start of the last year."""
    return cdc.reconcile(book_at(d), book_at(d, last_year(d)), ["client_id", "instrument_id"])


_E6 = (
    "list_aggregate(list_transform(embedding, lambda x: "
    "CAST(CAST(floor(x::DOUBLE * 1e6 + 0.5) AS BIGINT) AS VARCHAR)), 'string_agg', ',')"
)


@query("vector_store", f"SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dim, {_E6} AS vec FROM embeddings")
def vector_store(d: Desk):
    """Vectors stored as arrays that a search can read; every vector must have the size of the widest.

    The answer is compared by the components in whole millionths, read back from the table.
    """
    path = work_dir(d.spark, "vectors")
    rows = d.table("embeddings").select("vec_id", "label", F.size("embedding").alias("dim"), "embedding")
    rows.write.mode("overwrite").parquet(path)
    table = d.spark.read.schema(rows.schema).parquet(path)
    low, high = table.agg(F.min("dim"), F.max("dim")).first()
    if low != high:
        raise ValueError(f"vectors of {low} and of {high} components in one table")
    return table.select("vec_id", "label", "dim", vector_literal(F.col("embedding")).alias("vec"))


# --- constraints ----------------------------------------------------------


@query("check_pk", "SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def check_pk(d: Desk):
    """Clients that a one-order-per-client key would refuse."""
    return quality.duplicate_keys(d.table("orders"), ["o_custkey"])


@query(
    "check_pk_composite",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber
       HAVING count(*) > 1""",
)
def check_pk_composite(d: Desk):
    return quality.duplicate_keys(d.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "check_fk",
    """SELECT instrument_id, count(*) AS n_rows FROM v_marks
       WHERE instrument_id NOT IN (SELECT instrument_id FROM v_instruments) GROUP BY instrument_id""",
)
def check_fk(d: Desk):
    """Prices of instruments that are not listed."""
    return quality.orphans(d.marks, "instrument_id", d.instruments, "instrument_id")


@query(
    "check_not_null",
    """UNPIVOT (SELECT count(*) FILTER (num_trades_30d IS NULL) AS num_trades_30d,
                       count(*) FILTER (portfolio_volatility IS NULL) AS portfolio_volatility,
                       count(*) FILTER (credit_rating_score IS NULL) AS credit_rating_score FROM v_features)
       ON COLUMNS(*) INTO NAME column_name VALUE n_null""".replace(
        "UNPIVOT (", "SELECT column_name, n_null FROM (UNPIVOT ("
    )
    + ")",
)
def check_not_null(d: Desk):
    return quality.null_counts(
        features(d), ["num_trades_30d", "portfolio_volatility", "credit_rating_score"]
    )


@query("check_domain", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('signup', 'click', 'purchase', 'view')")
def check_domain(d: Desk):
    return quality.outside_domain(
        d.table("events"), "event_type", ["signup", "click", "purchase", "view"]
    ).select("event_id", "event_type")


@query(
    "check_one_row_per_key",
    """SELECT count(*) AS n_rows, count(DISTINCT key) AS n_keys, count(*) = count(DISTINCT key) AS one_row_per_key
       FROM v_current""",
)
def check_one_row_per_key(d: Desk):
    return quality.rows_per_key(cdc.scd1(d.changes, ["key"]), ["key"])


@query(
    "sync_exclude_null_pk",
    """SELECT try_cast(replace(legal_name, 'Customer#', '') AS BIGINT) AS pk, credit_rating, country FROM v_clients
       WHERE credit_rating <> 'NR'""",
)
def sync_exclude_null_pk(d: Desk):
    """Rows without a key are not synced; unrated clients are given none here."""
    rows = d.clients.select(
        F.when(
            F.col("credit_rating") != "NR", F.expr("try_cast(replace(legal_name, 'Customer#', '') as bigint)")
        ).alias("pk"),
        "credit_rating",
        "country",
    )
    return quality.require_key(rows, ["pk"])
