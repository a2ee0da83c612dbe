"""Calendars, expiries and request grids, grown from the given tables."""

from pyspark.sql import functions as F

from barsmith.functions import columns as fn
from barsmith.operators import calendars, mutate
from checks import views as v
from checks.registry import query

WINDOWS = {"start": "2024-01-01", "n": 5, "window_days": 4, "step_days": 7}


@query("g1_stepped_windows", """SELECT c_name AS scrip, CAST(i AS INTEGER) AS window_no,
       CAST(DATE '2024-01-01' + CAST(i * 7 AS INTEGER) AS DATE) AS from_date,
       CAST(DATE '2024-01-01' + CAST(i * 7 + 4 AS INTEGER) AS DATE) AS to_date
FROM customer, range(0, 5) r(i)""")
def stepped_windows(spark, sf_dir):
    mapping = v.table(spark, sf_dir, "customer").select(F.col("c_name").alias("scrip"))
    return calendars.with_stepped_windows(mapping, **WINDOWS)


def _spans(spark, sf_dir):
    return v.ticks(spark, sf_dir).groupBy("scrip").agg(
        fn.ist_date(F.min("timestamp")).alias("oldest"), fn.ist_date(F.max("timestamp")).alias("newest"))


@query("g2_contiguous_windows", f"""WITH {v.TICKS},
spans AS (SELECT scrip, min(trade_date) AS oldest, max(trade_date) AS newest FROM ticks GROUP BY scrip)
SELECT scrip, CAST(i AS INTEGER) AS window_no, CAST(oldest + CAST(i * 5 AS INTEGER) AS DATE) AS from_date,
       CAST(least(oldest + CAST(i * 5 + 5 AS INTEGER), newest + 1) AS DATE) AS to_date
FROM spans, range(0, 100) r(i) WHERE oldest + CAST(i * 5 AS INTEGER) <= newest""")
def contiguous_windows(spark, sf_dir):
    tiled = calendars.with_contiguous_windows(_spans(spark, sf_dir), start=F.col("oldest"),
                                              end=F.col("newest"), window_days=5)
    return tiled.select("scrip", "window_no", "from_date", "to_date")


@query("g4_recent_window", f"""WITH {v.TICKS}
SELECT scrip, max(trade_date) - 4 AS from_date, max(trade_date) AS to_date FROM ticks GROUP BY scrip""")
def recent_window(spark, sf_dir):
    spans = _spans(spark, sf_dir)
    return calendars.recent_window(spans, 4, F.col("newest")).select("scrip", "from_date", "to_date")


@query("j10_candles_in_windows", f"""WITH {v.TICKS}, w AS (
  SELECT i AS window_no, DATE '2024-01-01' + CAST(i * 7 AS INTEGER) AS f, DATE '2024-01-01' + CAST(i * 7 + 9 AS INTEGER) AS t
  FROM range(0, 5) r(i))
SELECT event_id, scrip, trade_date, CAST(window_no AS INTEGER) AS window_no
FROM ticks JOIN w ON trade_date >= f AND trade_date < t""")
def candles_in_windows(spark, sf_dir):
    rows = v.ticks(spark, sf_dir).select("event_id", "scrip", fn.ist_date("timestamp").alias("trade_date"))
    return calendars.in_stepped_windows(rows, "trade_date", start="2024-01-01", n=5, window_days=9, step_days=7)


_ORDERS = "SELECT CAST(o_orderdate AS DATE) AS day FROM orders"
_SHUT = "shut AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_totalprice > 495000)"
_DAYS = f"""bounds AS (SELECT min(day) AS lo, max(day) AS hi FROM ({_ORDERS})),
every AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM bounds),
{_SHUT}, open_days AS (SELECT day FROM every WHERE isodow(day) < 6 AND day NOT IN (SELECT day FROM shut)
  AND day < (SELECT hi FROM bounds))"""
_DONE = """done AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS trade_date,
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS expiry_code FROM orders WHERE o_orderstatus = 'F')"""
_PENDING = f"""{_DAYS}, {_DONE}, pending AS (
  SELECT day AS trade_date, CAST(c AS INTEGER) AS expiry_code FROM open_days, range(1, 3) r(c)
  WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.trade_date = day AND d.expiry_code = c))"""


def _order_days(spark, sf_dir):
    return v.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))


def _open_days(spark, sf_dir):
    low, high = mutate.value_range(_order_days(spark, sf_dir), "day")
    shut = v.table(spark, sf_dir, "orders").where("o_totalprice > 495000") \
        .select(F.col("o_orderdate").cast("date").alias("holiday"))
    return calendars.trading_days(spark, low, high, shut)


@query("g3_trading_days", f"WITH {_DAYS} SELECT day FROM open_days")
def trading_days(spark, sf_dir):
    return _open_days(spark, sf_dir)


@query("g7_days", f"""WITH {_DAYS} SELECT e.day, count(o.day) AS orders FROM every e LEFT JOIN ({_ORDERS}) o ON o.day = e.day
GROUP BY e.day""")
def days(spark, sf_dir):
    dated = _order_days(spark, sf_dir)
    counted = dated.groupBy("day").agg(F.count(F.lit(1)).alias("orders"))
    return calendars.days(spark, *mutate.value_range(dated, "day")).join(counted, "day", "left") \
        .select("day", F.coalesce("orders", F.lit(0)).alias("orders"))


def _pending(spark, sf_dir):
    done = v.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderdate").cast("date").alias("trade_date"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("expiry_code"))
    return calendars.pending(calendars.expiry_pairs(_open_days(spark, sf_dir), [1, 2]), done)


@query("j5_pending_pairs", f"WITH {_PENDING} SELECT * FROM pending")
def pending_pairs(spark, sf_dir):
    return _pending(spark, sf_dir)


@query("w4_tranches", f"""WITH {_PENDING}, dates AS (SELECT DISTINCT trade_date FROM pending)
SELECT trade_date, CAST((row_number() OVER (ORDER BY trade_date) - 1) // 5 AS INTEGER) AS tranche FROM dates""")
def tranches(spark, sf_dir):
    return calendars.tranches(_pending(spark, sf_dir), 5)


_GRID = f"""{_PENDING}, grid AS (
  SELECT trade_date, expiry_code, CAST(o AS INTEGER) AS strike_offset, api_type, option_type,
         CASE WHEN o = 0 THEN 'ATM' WHEN o > 0 THEN 'ATM+' || o ELSE 'ATM' || o END AS strike_label
  FROM pending, range(-10, 11) r(o), (VALUES ('CALL', 'CE'), ('PUT', 'PE')) s(api_type, option_type))"""


@query("g5_request_grid", f"WITH {_GRID} SELECT * FROM grid")
def request_grid(spark, sf_dir):
    return calendars.option_requests(_pending(spark, sf_dir))


@query("x12_request_cost", f"WITH {_GRID} SELECT count(*) AS calls, count(*) * CAST(0.35 AS DOUBLE) / 3600 AS hours FROM grid")
def request_cost(spark, sf_dir):
    return calendars.request_cost(calendars.option_requests(_pending(spark, sf_dir)))


def _listed(spark, sf_dir):
    """Order dates as trade dates, ship dates as their listed expiries."""
    orders, lines = v.table(spark, sf_dir, "orders"), v.table(spark, sf_dir, "lineitem")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderdate").cast("date").alias("trade_date"), F.col("l_shipdate").cast("date").alias("expiry_date"))


_LOOKUP = """listed AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS trade_date, CAST(l_shipdate AS DATE) AS expiry_date
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
monthly AS (SELECT max(expiry_date) AS expiry_date FROM listed GROUP BY year(expiry_date), month(expiry_date)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY expiry_date) AS rn FROM listed WHERE expiry_date >= trade_date),
lookup AS (SELECT trade_date, CAST(rn AS INTEGER) AS expiry_code, expiry_date,
  CASE WHEN expiry_date IN (SELECT expiry_date FROM monthly) THEN 'MONTH' ELSE 'WEEK' END AS expiry_flag FROM ranked WHERE rn <= 2)"""


@query("w2_expiry_lookup", f"WITH {_LOOKUP} SELECT * FROM lookup")
def expiry_lookup(spark, sf_dir):
    return calendars.expiry_lookup(_listed(spark, sf_dir))


@query("a10_month_expiries", f"WITH {_LOOKUP} SELECT trade_date, count_if(expiry_flag = 'MONTH') AS monthly, count(*) AS n FROM lookup GROUP BY trade_date")
def month_expiries(spark, sf_dir):
    lookup = calendars.expiry_lookup(_listed(spark, sf_dir))
    return lookup.groupBy("trade_date").agg(F.count_if(F.col("expiry_flag") == "MONTH").alias("monthly"),
                                            F.count(F.lit(1)).alias("n"))


@query("j9_expiry_default_flag", f"""WITH {_PENDING}, {_LOOKUP}
SELECT p.trade_date, p.expiry_code, l.expiry_date, coalesce(l.expiry_flag, 'WEEK') AS expiry_flag
FROM pending p LEFT JOIN lookup l ON l.trade_date = p.trade_date AND l.expiry_code = p.expiry_code""")
def expiry_default_flag(spark, sf_dir):
    return calendars.with_expiry(_pending(spark, sf_dir), calendars.expiry_lookup(_listed(spark, sf_dir)))
