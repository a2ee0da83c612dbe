"""Rollup, keys, split detection and coverage."""

from pyspark.sql import functions as F

from barsmith import fixed
from barsmith.functions import columns as fn
from barsmith.operators import coverage, joins, mutate, rollup, splits
from barsmith.session import stage
from barsmith.sources.stored import daily_rows
from checks import views as v
from checks.registry import query

OHLCV = '"open", high, low, "close", volume'


@query("a1_daily_bars", f"""WITH {v.TICKS}, {v.bars_sql('bars', '("timestamp" + 19800) % 86400 BETWEEN 33300 AND 66600')}
SELECT trade_date, scrip, exchange, security_id, {OHLCV} FROM bars""")
def daily_bars(spark, sf_dir):
    return rollup.daily_bars(rollup.market_hours(v.ticks(spark, sf_dir)), order=v.order())


@query("a1_candles_15m", f"""WITH {v.TICKS}, {v.CANDLES}
SELECT scrip, exchange, security_id, "timestamp", interval_m, trade_date, {OHLCV} FROM candles""")
def candles_15m(spark, sf_dir):
    return v.candles(spark, sf_dir)


@query("a1_daily_from_candles", f"""WITH {v.TICKS}, {v.BARS}
SELECT trade_date, scrip, exchange, CAST(security_id AS VARCHAR) AS security_id, {OHLCV} FROM bars""")
def daily_from_candles(spark, sf_dir):
    return rollup.daily_bars(v.candles(spark, sf_dir))


@query("x1_row_id", f"""WITH {v.TICKS}, {v.BARS}
SELECT scrip, exchange, security_id, trade_date, {v.ID} AS row_id,
       sha256(scrip || '|' || exchange || '|' || security_id || '|' || strftime(trade_date, '%Y-%m-%d')) AS safe_id
FROM bars""")
def row_id(spark, sf_dir):
    return v.bars(spark, sf_dir).select("scrip", "exchange", "security_id", "trade_date",
                                        fn.row_id().alias("row_id"), fn.row_id(separator="|").alias("safe_id"))


@query("x2_ist_time", """SELECT event_id, CAST(ts + INTERVAL '5 hours 30 minutes' AS DATE) AS ist_date,
       (epoch_us(ts) // 1000000 + 19800) % 86400 AS second_of_day,
       (epoch_us(ts) // 1000000 + 19800) % 86400 BETWEEN 33300 AND 66600 AS market_hours
FROM events""")
def ist_time(spark, sf_dir):
    return v.ticks(spark, sf_dir).select(
        "event_id", fn.ist_date("timestamp").alias("ist_date"),
        fn.ist_second_of_day("timestamp").alias("second_of_day"),
        fn.in_market_hours("timestamp").alias("market_hours"))


@query("w1_last_two_dates", f"""WITH {v.TICKS}, {v.BARS}, {v.LAST_TWO}
SELECT (SELECT d FROM last_day) AS last_date, {v.CHECK_DAY} AS check_date""")
def last_two_dates(spark, sf_dir):
    return splits.last_two_dates(v.ticks(spark, sf_dir).select(fn.ist_date("timestamp").alias("trade_date")))


def flags(spark, sf_dir):
    fetched = v.bars(spark, sf_dir)
    check = splits.last_two_dates(v.ticks(spark, sf_dir).select(fn.ist_date("timestamp").alias("trade_date")))
    return splits.split_flags(fetched, v.stored(spark, sf_dir), check).drop("run_ts")


query("c1_split_flags", f"WITH {v.SPLIT} SELECT * FROM flags")(flags)


@query("c2_flagged_scrips", f"WITH {v.SPLIT} SELECT scrip FROM flagged")
def flagged_scrips(spark, sf_dir):
    return splits.flagged_scrips(flags(spark, sf_dir))


def flagged_list(spark, sf_dir):
    """The flagged scrips, computed once and written, as jobs do."""
    return stage(flagged_scrips(spark, sf_dir), "flagged")


@query("c3_range_check_date", f"""WITH {v.TICKS}, {v.BARS}
SELECT min(trade_date) AS check_date FROM bars WHERE trade_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""")
def range_check_date(spark, sf_dir):
    dates = v.ticks(spark, sf_dir).select(fn.ist_date("timestamp").alias("trade_date"))
    return splits.oldest_date_in(dates, F.lit("2024-01-10").cast("date"), F.lit("2024-01-20").cast("date"))


def _two_exchanges(spark, sf_dir):
    """Stored bars per exchange, where 'error' ticks belong to the temporary one."""
    both = v.ticks(spark, sf_dir).withColumn(
        "exchange", F.expr("CASE event_type WHEN 'error' THEN 'TEMP' ELSE 'NSE_EQ' END"))
    return rollup.daily_bars(both, order=v.order())


_TWO = f"""two AS (SELECT trade_date, scrip, CASE event_type WHEN 'error' THEN 'TEMP' ELSE 'NSE_EQ' END AS exchange,
  security_id, {v._AGG} FROM ticks GROUP BY ALL)"""


@query("j6_fan_out_flags", f"""WITH {v.TICKS}, {v.BARS}, {v.LAST_TWO}, {_TWO}
{v.flags_sql('bars', 'two', v.CHECK_DAY)}""")
def fan_out_flags(spark, sf_dir):
    fetched = v.bars(spark, sf_dir)
    return splits.split_flags(fetched, _two_exchanges(spark, sf_dir), splits.last_two_dates(fetched)).drop("run_ts")


@query("j6_exchange_aware_flags", f"""WITH {v.TICKS}, {v.BARS}, {v.LAST_TWO}, {_TWO},
same AS (SELECT * FROM two WHERE exchange = 'NSE_EQ')
{v.flags_sql('bars', 'same', v.CHECK_DAY)}""")
def exchange_aware_flags(spark, sf_dir):
    fetched = v.bars(spark, sf_dir)
    return splits.split_flags(fetched, _two_exchanges(spark, sf_dir), splits.last_two_dates(fetched),
                              exchange_aware=True).drop("run_ts")


@query("f6_upload_skip_flagged", f"""WITH {v.SPLIT}
SELECT trade_date, scrip, security_id, {OHLCV} FROM bars
WHERE trade_date = (SELECT d FROM last_day) AND scrip NOT IN (SELECT scrip FROM flagged)""")
def upload_skip_flagged(spark, sf_dir):
    fetched = v.bars(spark, sf_dir)
    last = splits.last_two_dates(fetched).select(F.col("last_date").alias("trade_date"))
    upload = fetched.join(F.broadcast(last), "trade_date", "left_semi")
    kept = joins.without(upload, flagged_list(spark, sf_dir))
    return kept.select("trade_date", "scrip", "security_id", *fixed.PRICES, "volume")


@query("j11_clean_vs_flagged", f"""WITH {v.SPLIT}
SELECT CASE WHEN scrip IN (SELECT scrip FROM flagged) THEN 'flagged' ELSE 'clean' END AS side,
       trade_date, scrip, "close" FROM bars""")
def clean_vs_flagged(spark, sf_dir):
    fetched, listed = v.bars(spark, sf_dir), flagged_list(spark, sf_dir)
    clean = joins.without(fetched, listed).withColumn("side", F.lit("clean"))
    flagged = joins.only(fetched, listed).withColumn("side", F.lit("flagged"))
    return clean.unionByName(flagged).select("side", "trade_date", "scrip", "close")


@query("a2_scrip_bounds", f"""WITH {v.TICKS}, {v.CANDLES},
wanted AS (SELECT DISTINCT scrip FROM ticks WHERE event_type = 'error')
SELECT scrip, min("timestamp") AS min_ts, max("timestamp") AS max_ts FROM candles
WHERE interval_m = 15 AND scrip IN (SELECT scrip FROM wanted) GROUP BY scrip""")
def scrip_bounds(spark, sf_dir):
    listed = v.ticks(spark, sf_dir).where("event_type = 'error'").select("scrip")
    return coverage.scrip_bounds(v.candles(spark, sf_dir), listed, 15)


@query("a2_overall_bounds", f"""WITH {v.TICKS}, {v.CANDLES},
wanted AS (SELECT DISTINCT scrip FROM ticks WHERE event_type = 'error')
SELECT min(trade_date) AS oldest, max(trade_date) AS newest FROM candles
WHERE interval_m = 15 AND scrip IN (SELECT scrip FROM wanted)""")
def overall_bounds(spark, sf_dir):
    return coverage.overall_bounds(scrip_bounds(spark, sf_dir))


@query("a3_latest_date", "SELECT CAST(max(o_orderdate) AS DATE) AS latest FROM orders WHERE o_orderstatus = 'F'")
def latest_date(spark, sf_dir):
    rows = v.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("trade_date"),
                                                   F.col("o_orderstatus").alias("security_ticker"))
    return coverage.latest_date(rows, "F")


@query("a4_latest_candle", f"""WITH {v.TICKS}, {v.CANDLES}
SELECT max("timestamp") AS latest FROM candles WHERE interval_m = 15""")
def latest_candle(spark, sf_dir):
    return coverage.latest_candle(v.candles(spark, sf_dir), interval=15) \
        .select(F.unix_seconds("latest").alias("latest"))


@query("a5_rows_per_date", f"""WITH {v.TICKS}, {v.MIXED}
SELECT trade_date, count(*) AS records FROM mixed WHERE exchange = 'TEMP' GROUP BY trade_date""")
def rows_per_date(spark, sf_dir):
    return coverage.rows_per_date(v.mixed_rows(spark, sf_dir), mutate.is_temp())


@query("a6_count_where", f"""WITH {v.TICKS}, {v.MIXED} SELECT count(*) AS n FROM mixed WHERE exchange = 'TEMP'""")
def count_where(spark, sf_dir):
    return coverage.count_where(v.mixed_rows(spark, sf_dir), mutate.is_temp())


@query("a8_fetch_summary", f"""WITH {v.TICKS}, {v.BARS}
SELECT count(*) AS rows, count(DISTINCT scrip) AS scrips, min(trade_date) AS first_date,
       max(trade_date) AS last_date FROM bars""")
def fetch_summary(spark, sf_dir):
    return coverage.fetch_summary(v.bars(spark, sf_dir))


@query("a9_sorted_dates", f"""WITH {v.TICKS} SELECT DISTINCT trade_date FROM ticks""")
def sorted_dates(spark, sf_dir):
    dated = v.ticks(spark, sf_dir).select("scrip", fn.ist_date("timestamp").alias("trade_date"))
    return coverage.distinct_sorted(dated, "trade_date")


@query("src12_read_daily", f"""WITH {v.TICKS}, {v.BARS}
SELECT scrip, trade_date, {OHLCV} FROM bars
WHERE trade_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
  AND scrip IN (SELECT scrip FROM ticks WHERE event_type = 'error')""")
def read_daily(spark, sf_dir):
    listed = v.ticks(spark, sf_dir).where("event_type = 'error'").select("scrip")
    return daily_rows(v.bars(spark, sf_dir), listed, "2024-01-10", "2024-01-20")
