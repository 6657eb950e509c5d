"""Small tables with known answers."""

# fixed values: instruments with asset class, currency, contract size, spot price, volatility and rate to CAD
INSTRUMENTS = [
    ("WTI", "commodity", "USD", 1000.0, 78.50, 0.42, 1.36),
    ("HO", "commodity", "USD", 42000.0, 2.55, 0.39, 1.36),
    ("NG", "commodity", "USD", 10000.0, 2.10, 0.55, 1.36),
    ("GOLD", "commodity", "USD", 100.0, 2380.0, 0.16, 1.36),
    ("USDCAD", "fx", "CAD", 100000.0, 1.36, 0.07, 1.00),
    ("CAD10Y", "rates", "CAD", 100000.0, 98.20, 0.08, 1.00),
    ("CDX-IG", "credit", "USD", 100000.0, 0.55, 0.12, 1.36),
    ("AC.TO", "equity", "CAD", 100.0, 18.40, 0.35, 1.00),
    ("SU.TO", "equity", "CAD", 100.0, 52.10, 0.28, 1.00),
    ("BCE.TO", "equity", "CAD", 100.0, 44.90, 0.19, 1.00),
]
INSTRUMENT_COLUMNS = (
    "instrument_id string, asset_class string, currency string, contract_size double, "
    "spot_price double, volatility double, fx_to_cad double"
)

# fixed values: client, instrument and net quantity of every position
POSITIONS = [
    ("CL-AC", "WTI", 1800),
    ("CL-AC", "HO", -900),
    ("CL-AC", "NG", 2500),
    ("CL-AC", "USDCAD", 140),
    ("CL-AC", "AC.TO", 50000),
    ("CL-SU", "WTI", 400),
    ("CL-SU", "SU.TO", 20000),
    ("CL-CVE", "WTI", 300),
    ("CL-CVE", "NG", 800),
    ("CL-BCE", "BCE.TO", 30000),
    ("CL-BCE", "CAD10Y", 50),
    ("CL-MFC", "CDX-IG", 40),
    ("CL-MFC", "CAD10Y", 80),
    ("CL-ABX", "GOLD", 600),
    ("CL-CNR", "USDCAD", 30),
    ("CL-MG", "USDCAD", 25),
    ("CL-BAM", "CAD10Y", 40),
]
POSITION_COLUMNS = "client_id string, instrument_id string, net_qty long"

# fixed values: client and credit rating
CLIENTS = [
    ("CL-AC", "BB"),
    ("CL-SU", "BBB+"),
    ("CL-CVE", "BBB"),
    ("CL-BCE", "A-"),
    ("CL-MFC", "A"),
    ("CL-ABX", "BBB+"),
    ("CL-CNR", "A"),
    ("CL-MG", "A-"),
    ("CL-BAM", "A-"),
]
CLIENT_COLUMNS = "client_id string, credit_rating string"

# fixed values: gross, net, positions, largest share, volatility, score and tier per client
FEATURES = {
    "CL-AC": (505698400.00, 243517600.00, 5, 0.380005, 0.404665, 3.0, "HIGH"),
    "CL-SU": (146904000.00, 146904000.00, 2, 0.709307, 0.320697, 6.0, "MEDIUM"),
    "CL-CVE": (54876000.00, 54876000.00, 2, 0.583643, 0.474126, 5.0, "HIGH"),
    "CL-BCE": (625700000.00, 625700000.00, 2, 0.784721, 0.103681, 7.0, "HIGH"),
    "CL-MFC": (788592000.00, 788592000.00, 2, 0.996206, 0.080152, 8.0, "HIGH"),
    "CL-ABX": (194208000.00, 194208000.00, 1, 1.0, 0.16, 6.0, "MEDIUM"),
    "CL-CNR": (4080000.00, 4080000.00, 1, 1.0, 0.07, 8.0, "LOW"),
    "CL-MG": (3400000.00, 3400000.00, 1, 1.0, 0.07, 7.0, "LOW"),
    "CL-BAM": (392800000.00, 392800000.00, 1, 1.0, 0.08, 7.0, "HIGH"),
}
TRADE_COLUMNS = "client_id string, notional_cad double, days_ago int, realized_pnl_cad double"
