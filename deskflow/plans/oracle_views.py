"""The desk's tables as SQL, for the answers the queries are compared with."""


def money(expr: str) -> str:
    """Sum in whole millionths."""
    return f"CAST(sum(CAST(floor(({expr}) * 1e6 + 0.5) AS HUGEINT)) AS DOUBLE) / 1e6"


def fx(column: str) -> str:
    return f"CASE {column} WHEN 'USD' THEN 1.36::DOUBLE WHEN 'EUR' THEN 1.47::DOUBLE ELSE 1.0::DOUBLE END"


SPACE = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def squash(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{SPACE}', ' ', 'g'), ' ')"


def terms(expr: str) -> str:
    """Word counts over 64 hash buckets."""
    hashed = (
        f"list_transform(list_filter(string_split(lower({expr}), ' '), lambda w: w <> ''), "
        "lambda w: CAST('0x' || substr(md5(w), 1, 6) AS BIGINT) % 64)"
    )
    return (
        f"list_transform(range(0, 64), lambda b: "
        f"CAST(len(list_filter({hashed}, lambda h: h = b)) AS DOUBLE))"
    )


RATING = (
    "CASE credit_rating WHEN 'AAA' THEN 10 WHEN 'AA' THEN 9 WHEN 'A' THEN 8 WHEN 'A-' THEN 7 "
    "WHEN 'BBB+' THEN 6 WHEN 'BBB' THEN 5 WHEN 'BBB-' THEN 4 WHEN 'BB' THEN 3 WHEN 'B' THEN 2 "
    "WHEN 'CCC' THEN 1 END::DOUBLE"
)

FX = fx("currency")

VIEWS = {
    "v_clients": """
SELECT c_custkey AS client_id, 'T' || c_custkey AS ticker, c_name AS legal_name, c_mktsegment AS sector,
       n_name AS country,
       (['AAA','AA','A','A-','BBB+','BBB','BBB-','BB','B','CCC','NR'])[c_custkey % 11 + 1] AS credit_rating,
       'OFFICER_' || r_regionkey || '_' || (c_custkey // 250) AS coverage_officer,
       CASE WHEN c_acctbal >= 6000 THEN 'Platinum' WHEN c_acctbal >= 2000 THEN 'Gold' ELSE 'Silver' END
           AS relationship_tier,
       c_acctbal AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "v_parts": """
SELECT p_partkey AS instrument_id, p_type AS asset_class, p_name AS description, p_brand AS book,
       (['USD','CAD','EUR'])[p_size % 3 + 1] AS currency,
       CASE WHEN p_size % 2 = 0 THEN 1.0::DOUBLE ELSE 10.0::DOUBLE END AS contract_size,
       p_retailprice AS spot_price, (p_partkey % 50 + 5)::DOUBLE / 100.0::DOUBLE AS volatility, p_size
FROM part""",
    "v_instruments": "SELECT * EXCLUDE (p_size) FROM v_parts WHERE p_size > 1",
    "v_fills": """
SELECT l_orderkey AS order_id, l_linenumber AS line_no, o_custkey AS client_id, l_partkey AS instrument_id,
       CASE WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS side, l_quantity AS quantity,
       l_extendedprice / l_quantity AS price, l_extendedprice AS amount,
       o_orderdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS trade_ts,
       CAST(o_orderdate AS DATE) AS trade_date, l_suppkey AS trader,
       l_extendedprice * (1 - l_discount) AS notional,
       l_extendedprice * (l_tax - l_discount) AS realized_pnl_cad
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_trades": f"""
SELECT f.* EXCLUDE (notional), notional * ({FX}) AS notional_cad
FROM v_fills f JOIN (SELECT instrument_id, currency FROM v_parts) p USING (instrument_id)""",
    "v_asof": "SELECT max(CAST(o_orderdate AS DATE)) AS as_of FROM orders",
    "v_aged": """
SELECT *, CAST(date_diff('day', trade_date, (SELECT as_of FROM v_asof)) AS INTEGER) AS days_ago FROM v_trades""",
    "v_marks": f"""
SELECT l_partkey AS instrument_id, CAST(l_shipdate AS DATE) AS price_date,
       {money("l_extendedprice")} / sum(l_quantity) AS spot_price,
       ((l_partkey + dayofyear(CAST(l_shipdate AS DATE))) % 50 + 5)::DOUBLE / 100.0::DOUBLE AS volatility
FROM lineitem GROUP BY l_partkey, CAST(l_shipdate AS DATE)""",
    "v_latest": """
SELECT instrument_id, spot_price AS latest_price, price_date FROM v_marks
QUALIFY row_number() OVER (PARTITION BY instrument_id ORDER BY price_date DESC) = 1""",
    "v_positions": f"""
SELECT client_id, instrument_id, sum(CASE WHEN side = 'BUY' THEN quantity ELSE -quantity END) AS net_qty,
       {money("amount")} / sum(quantity) AS avg_entry_price
FROM v_fills GROUP BY client_id, instrument_id""",
    "v_limits": """
SELECT c_custkey * 2 AS limit_id, c_custkey AS client_id, 'GROSS_NOTIONAL' AS limit_type,
       5000000.0::DOUBLE + c_acctbal * 400 AS limit_cad FROM customer
UNION ALL
SELECT c_custkey * 2 + 1, c_custkey, 'NET', (5000000.0::DOUBLE + c_acctbal * 400) / 2 FROM customer""",
    "v_economics": f"""
SELECT p.*, i.* EXCLUDE (instrument_id), {FX} AS fx_to_cad,
       abs(net_qty * (spot_price * contract_size * ({FX}))) AS gross_cad,
       net_qty * (spot_price * contract_size * ({FX})) AS net_cad
FROM v_positions p JOIN v_instruments i USING (instrument_id)""",
    "v_postotals": f"""
SELECT client_id, {money("gross_cad")} AS gross_notional_cad, {money("net_cad")} AS net_exposure_cad,
       count(*) AS num_open_positions, max(gross_cad) AS largest_position_cad,
       ({money("gross_cad * volatility")}) / nullif({money("gross_cad")}, 0) AS portfolio_volatility
FROM v_economics GROUP BY client_id""",
    "v_recent": f"""
SELECT client_id, count(*) AS num_trades_30d, ({money("notional_cad")}) / count(*) AS avg_trade_notional_cad,
       {money("realized_pnl_cad")} AS realized_pnl_30d_cad
FROM v_aged WHERE days_ago <= 30 GROUP BY client_id""",
    "v_recency": """
SELECT client_id, CAST(min(days_ago) AS BIGINT) AS days_since_last_trade FROM v_aged GROUP BY client_id""",
    "v_features": f"""
SELECT *, CASE WHEN gross_notional_cad > 8e6 OR portfolio_volatility > 0.34 THEN 'HIGH'
               WHEN gross_notional_cad > 5e6 OR portfolio_volatility > 0.30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
FROM (
  SELECT client_id, coalesce(gross_notional_cad, 0) AS gross_notional_cad,
         coalesce(net_exposure_cad, 0) AS net_exposure_cad, coalesce(num_open_positions, 0) AS num_open_positions,
         coalesce(num_trades_30d, 0) AS num_trades_30d, coalesce(avg_trade_notional_cad, 0) AS avg_trade_notional_cad,
         CASE WHEN gross_notional_cad > 0 THEN largest_position_cad / gross_notional_cad ELSE 0 END
             AS largest_position_pct,
         coalesce(realized_pnl_30d_cad, 0) AS realized_pnl_30d_cad,
         coalesce(portfolio_volatility, 0) AS portfolio_volatility,
         coalesce(days_since_last_trade, 999) AS days_since_last_trade, {RATING} AS credit_rating_score
  FROM v_clients LEFT JOIN v_postotals USING (client_id) LEFT JOIN v_recent USING (client_id)
       LEFT JOIN v_recency USING (client_id))""",
    "v_valued": """
SELECT *, abs(market_value) AS gross_exposure FROM (
  SELECT p.*, i.* EXCLUDE (instrument_id, spot_price, volatility), latest_price, price_date,
         net_qty * latest_price * contract_size AS market_value,
         net_qty * (latest_price - avg_entry_price) * contract_size AS pnl_cad
  FROM v_positions p JOIN v_instruments i USING (instrument_id) JOIN v_latest USING (instrument_id))""",
    "v_book": """
SELECT v.*, c.* EXCLUDE (client_id), limit_cad
FROM v_valued v JOIN v_clients c USING (client_id)
     LEFT JOIN (SELECT client_id, limit_cad FROM v_limits WHERE limit_type = 'GROSS_NOTIONAL') l USING (client_id)""",
    "v_flow": """
SELECT t.*, i.* EXCLUDE (instrument_id), c.* EXCLUDE (client_id),
       CAST(date_trunc('week', trade_ts) AS DATE) AS trade_week, CAST(hour(trade_ts) AS INTEGER) AS trade_hour
FROM v_trades t JOIN v_instruments i USING (instrument_id) JOIN v_clients c USING (client_id)""",
    "v_changes": """
SELECT user_id AS key, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CASE event_type WHEN 'signup' THEN 'insert' WHEN 'click' THEN 'update_postimage'
            WHEN 'purchase' THEN 'update_postimage' WHEN 'view' THEN 'update_preimage'
            WHEN 'error' THEN 'delete' END AS change_type,
       event_id AS sort_by, ts AS changed_at
FROM events""",
    "v_effective": "SELECT * FROM v_changes WHERE change_type <> 'update_preimage'",
    "v_current": """
SELECT * EXCLUDE (change_type, sort_by) FROM (
  SELECT * FROM v_effective QUALIFY row_number() OVER (PARTITION BY key ORDER BY sort_by DESC) = 1)
WHERE change_type <> 'delete'""",
    "v_versions": """
SELECT key, value, k, sort_by AS valid_from, changed_at, valid_to, valid_to IS NULL AS is_current FROM (
  SELECT *, lead(sort_by) OVER (PARTITION BY key ORDER BY sort_by) AS valid_to FROM v_effective)
WHERE change_type <> 'delete'""",
    "v_bookold": """
SELECT client_id, instrument_id, CAST(sum(CASE WHEN side = 'BUY' THEN quantity ELSE -quantity END) AS BIGINT) AS net_qty
FROM v_fills WHERE trade_date < (SELECT date_trunc('year', as_of) FROM v_asof) GROUP BY client_id, instrument_id HAVING net_qty <> 0""",
    "v_booknew": """
SELECT client_id, instrument_id, CAST(sum(CASE WHEN side = 'BUY' THEN quantity ELSE -quantity END) AS BIGINT) AS net_qty
FROM v_fills GROUP BY client_id, instrument_id HAVING net_qty <> 0""",
    "v_reference": """
SELECT client_id, legal_name, sector, credit_rating, coverage_officer, 1000000.0::DOUBLE + balance * 100 AS risk_limit_cad,
       TIMESTAMP '2024-01-01 00:00:00' AS updated_at
FROM v_clients""",
    "v_updated": """
SELECT * REPLACE (
  CASE WHEN sector = 'BUILDING' THEN risk_limit_cad * 2 ELSE risk_limit_cad END AS risk_limit_cad,
  CASE WHEN sector = 'BUILDING' THEN TIMESTAMP '2024-02-01 00:00:00' ELSE updated_at END AS updated_at)
FROM v_reference""",
    "v_turns": 'SELECT conv_id AS thread_id, turn AS version, "role", "text" FROM conversations',
    "v_flat": f"SELECT doc_id, source, {squash('text')} AS flat FROM documents",
    "v_chunks": """
SELECT doc_id, source, CAST(i AS INTEGER) AS chunk_idx, substr(flat, CAST(i * 580 + 1 AS BIGINT), 700) AS content
FROM (SELECT *, unnest(range(0, CAST(ceil(length(flat) / 580.0) AS BIGINT))) AS i FROM v_flat)""",
    "v_cited": """
SELECT c.doc_id, c.chunk_idx, c.content, d.source, d.lang FROM v_chunks c JOIN documents d ON c.doc_id = d.doc_id""",
    "v_chunkterms": f"SELECT doc_id, source, chunk_idx, content, {terms('content')} AS embedding FROM v_chunks",
    "v_orders": """
SELECT g AS order_id, 'CL-' || (['AC','SU','BCE','MFC','ABX'])[1 + g % 5] AS client_id,
       (['WTI','HO','NG','GOLD','USDCAD'])[1 + g % 5] AS instrument,
       CAST('0x' || substr(md5('1867:qty:' || g), 1, 12) AS BIGINT) % 501 AS qty,
       (2000 + CAST('0x' || substr(md5('1867:px:' || g), 1, 12) AS BIGINT) % 10001)::DOUBLE / 100.0::DOUBLE AS px
FROM (SELECT unnest(range(1, (SELECT count(*) + 1 FROM orders))) AS g)""",
}
