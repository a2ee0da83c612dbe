"""Layouts, words and constants that results depend on."""

from datetime import date

# ---- Fixed values: exchange daily price file (header name -> stored name) ----
PRICE_COLUMNS = {
    "SYMBOL": "symbol",
    "SERIES": "series",
    "DATE1": "date",
    "PREV_CLOSE": "prev_close",
    "OPEN_PRICE": "open_price",
    "HIGH_PRICE": "high_price",
    "LOW_PRICE": "low_price",
    "LAST_PRICE": "last_price",
    "CLOSE_PRICE": "close_price",
    "AVG_PRICE": "avg_price",
    "TTL_TRD_QNTY": "ttl_trd_qnty",
    "TURNOVER_LACS": "turnover_lacs",
    "NO_OF_TRADES": "no_of_trades",
    "DELIV_QTY": "deliv_qty",
    "DELIV_PER": "deliv_per",
}

# ---- Fixed values: market-cap file (header name -> stored name) ----
MCAP_COLUMNS = {
    "Trade Date": "trade_date",
    "Symbol": "symbol",
    "Series": "series",
    "Security Name": "security_name",
    "Category": "category",
    "Last Trade Date": "last_trade_date",
    "Face Value(Rs.)": "face_value",
    "Issue Size": "issue_size",
    "Close Price/Paid up value(Rs.)": "close_price",
    "Market Cap(Rs.)": "market_cap",
}

# ---- Fixed values: instrument master ----
INSTRUMENT_COLUMNS = {
    "EXCH_ID": "string",
    "SEGMENT": "string",
    "SECURITY_ID": "bigint",
    "ISIN": "string",
    "INSTRUMENT": "string",
    "UNDERLYING_SECURITY_ID": "bigint",
    "UNDERLYING_SYMBOL": "string",
    "SYMBOL_NAME": "string",
    "DISPLAY_NAME": "string",
    "INSTRUMENT_TYPE": "string",
    "SERIES": "string",
    "LOT_SIZE": "bigint",
    "SM_EXPIRY_DATE": "date",
    "STRIKE_PRICE": "double",
    "OPTION_TYPE": "string",
    "TICK_SIZE": "double",
    "EXPIRY_FLAG": "string",
    "ASM_GSM_FLAG": "string",
    "ASM_GSM_CATEGORY": "string",
    "BUY_SELL_INDICATOR": "string",
    "MTF_LEVERAGE": "double",
}
SEGMENTS = ("D", "E", "I")
INSTRUMENTS = ("FUTSTK", "FUTIDX", "EQUITY", "INDEX", "OPTIDX")
INSTRUMENT_TYPES = (
    "FUT", "FUTIDX", "FUTSTK", "ES", "ETF", "InvITU", "MF", "REIT", "IDX", "INDEX", "OP",
)

# ---- Fixed values: candles, rollup and split check ----
PRICES = ("open", "high", "low", "close")
TEMP_EXCHANGE = "TEMP"
IST = "Asia/Kolkata"
IST_OFFSET_SECONDS = 19_800          # UTC+5:30 all year
MARKET_OPEN = "09:15:00"
MARKET_CLOSE = "18:30:00"
LIFETIME_START = "2001-01-01"
MISMATCH = "mismatch"
MISSING = "missing_bq"

# ---- Fixed values: options ----
OPTION_TYPES = {"CALL": "CE", "PUT": "PE"}
OPTION_OFFSETS = tuple(range(-10, 11))
EXPIRY_CODES = (1, 2)
DEFAULT_EXPIRY_FLAG = "WEEK"
UNKNOWN_EXPIRY = "UNKNOWN"
SECONDS_PER_CALL = 0.35

# ---- Fixed values: file-name and file-body date formats ----
# From the file's own name or, with "=", its folder's; no folder of another form counts.
PRICE_FILE_DATE = ("sec_bhavdata_full_(\\d{8})[^/]*$|/sec_bhavdata_full=(\\d{8})/[^/]*$", "ddMMyyyy")
MCAP_FILE_DATE = ("PR(\\d{6})[^/]*$|/PR=(\\d{6})/[^/]*$", "ddMMyy")
PRICE_ROW_DATE = "d-MMM-yyyy"
MCAP_ROW_DATE = "d MMM yyyy"
EXPIRY_DATES = ("d/M/yyyy", "yyyy-MM-dd", "d-MMM-yyyy", "d-M-yyyy", "d MMM yyyy", "d/M/yy")
INSTRUMENT_DATES = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")

# ---- Fixed values: exchange holidays that fall on weekdays ----
HOLIDAYS = (
    date(2025, 2, 26), date(2025, 3, 14), date(2025, 3, 31),
    date(2025, 4, 10), date(2025, 4, 14), date(2025, 4, 18),
    date(2025, 5, 1), date(2025, 8, 15), date(2025, 8, 27),
    date(2025, 10, 2), date(2025, 10, 22), date(2025, 11, 5),
    date(2025, 12, 25), date(2026, 1, 15), date(2026, 1, 26),
    date(2026, 3, 3), date(2026, 3, 26), date(2026, 3, 31),
    date(2026, 4, 3), date(2026, 4, 14), date(2026, 5, 1),
)
