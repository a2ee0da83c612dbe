"""Stored-table and landed-response schemas, as Spark DDL."""

from barsmith import fixed

DAILY = (
    "scrip STRING, exchange STRING, security_id BIGINT, open DOUBLE, high DOUBLE, low DOUBLE, "
    "close DOUBLE, volume DOUBLE, row_id STRING, trade_date DATE"
)
# A bar that can take more candles; `batch` names the last micro-batch merged into it.
BAR_STATE = (
    "scrip STRING, exchange STRING, security_id BIGINT, open_at DECIMAL(38, 0), open DOUBLE, high DOUBLE, low DOUBLE, "
    "close_at DECIMAL(38, 0), close DOUBLE, volume DOUBLE, row_id STRING, batch STRING, trade_date DATE"
)
FLAGS = (
    "run_ts TIMESTAMP, scrip STRING, security_id STRING, check_date DATE, reason STRING, "
    "field STRING, fetched_value DOUBLE, stored_value DOUBLE"
)
INTRADAY = (
    "scrip STRING, exchange STRING, security_id STRING, timestamp BIGINT, interval_m INT, "
    "open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE, trade_date DATE"
)
OPTIONS = (
    "expiry_date DATE, expiry_flag STRING, expiry_code INT, security_ticker STRING, "
    "security_id STRING, interval INT, timestamp BIGINT, strike_price DECIMAL(38,9), "
    "option_type STRING, strike_offset STRING, spot DOUBLE, open DOUBLE, high DOUBLE, "
    "low DOUBLE, close DOUBLE, volume BIGINT, iv DOUBLE, oi BIGINT, trade_date DATE"
)
PRICE_NUMBERS = [c for c in fixed.PRICE_COLUMNS.values() if c not in ("symbol", "series", "date")]
PRICE_FILE = (
    "symbol STRING, series STRING, " + ", ".join(f"{c} DOUBLE" for c in PRICE_NUMBERS) + ", date DATE"
)
MCAP_NUMBERS = ["face_value", "issue_size", "close_price", "market_cap"]
MCAP = (
    "symbol STRING, series STRING, security_name STRING, category STRING, last_trade_date DATE, "
    + ", ".join(f"{c} DOUBLE" for c in MCAP_NUMBERS) + ", trade_date DATE"
)
INSTRUMENTS = ", ".join(f"{c} {t.upper()}" for c, t in fixed.INSTRUMENT_COLUMNS.items())

# The partition column of each table; always last, as Spark stores it.
DAILY_COLUMNS = [c.split()[0] for c in DAILY.split(", ")]
INTRADAY_COLUMNS = [c.split()[0] for c in INTRADAY.split(", ")]
OPTION_COLUMNS = [c.split()[0] for c in OPTIONS.split(", ")]

# One landed response per JSON line: the request's tags, the transport status, the body text.
# `seq` is the landing order; it decides which of two equal keys came first.
RESPONSE = (
    "seq BIGINT, scrip STRING, security_id STRING, exc_seg STRING, instrument_type STRING, "
    "from_date DATE, to_date DATE, interval_m INT, status INT, body STRING"
)
OPTION_RESPONSE = (
    "seq BIGINT, trade_date DATE, expiry_flag STRING, expiry_code INT, strike_offset INT, "
    "option_type STRING, security_ticker STRING, security_id STRING, interval INT, "
    "status INT, body STRING"
)
