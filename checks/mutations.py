"""Table states: upsert, delete, append-new, reload."""

from pyspark.sql import functions as F

from barsmith import fixed
from barsmith.functions import columns as fn
from barsmith.operators import coverage, dedup, joins, mutate, rollup, splits
from barsmith.session import stage
from checks import views as v
from checks.bars import OHLCV, flagged_list
from checks.registry import query

RANGE = ("2024-01-10", "2024-01-20")
FROM, TO = RANGE
ROW = f"scrip, exchange, security_id, trade_date, {OHLCV}"
IN_RANGE = f"trade_date BETWEEN DATE '{FROM}' AND DATE '{TO}'"


def _dates():
    return F.lit(FROM).cast("date"), F.lit(TO).cast("date")


@query("snk3_upsert_bars", f"""WITH {v.TICKS}, {v.BARS}, {v.STORED},
t AS (SELECT *, {v.ID} AS row_id FROM stored), s AS (SELECT *, {v.ID} AS row_id FROM bars)
SELECT coalesce(t.row_id, s.row_id) AS row_id, coalesce(t.scrip, s.scrip) AS scrip,
       coalesce(t.exchange, s.exchange) AS exchange, coalesce(t.security_id, s.security_id) AS security_id,
       coalesce(t.trade_date, s.trade_date) AS trade_date,
       CASE WHEN s.row_id IS NOT NULL THEN s."open" ELSE t."open" END AS "open",
       CASE WHEN s.row_id IS NOT NULL THEN s.high ELSE t.high END AS high,
       CASE WHEN s.row_id IS NOT NULL THEN s.low ELSE t.low END AS low,
       CASE WHEN s.row_id IS NOT NULL THEN s."close" ELSE t."close" END AS "close",
       CASE WHEN s.row_id IS NOT NULL THEN s.volume ELSE t.volume END AS volume
FROM t FULL JOIN s ON t.row_id = s.row_id""")
def upsert_bars(spark, sf_dir):
    return mutate.upsert(v.with_id(v.stored(spark, sf_dir)), v.with_id(v.bars(spark, sf_dir)), large=True)


@query("snk4_dedup_first", f"""WITH {v.TICKS}
SELECT scrip, exchange, security_id, trade_date, price AS "close", event_id FROM ticks
QUALIFY row_number() OVER (PARTITION BY scrip, exchange, security_id, trade_date ORDER BY us, event_id) = 1""")
def dedup_first(spark, sf_dir):
    rows = v.with_id(v.ticks(spark, sf_dir).withColumn("trade_date", fn.ist_date("timestamp")))
    return mutate.first_per_row_id(rows, ["us", "event_id"]).select(
        "scrip", "exchange", "security_id", "trade_date", "close", "event_id")


@query("w3_first_candle", f"""WITH {v.TICKS}
SELECT security_id, "timestamp" - "timestamp" % 900 AS "timestamp", price AS "close", event_id FROM ticks
QUALIFY row_number() OVER (PARTITION BY security_id, "timestamp" // 900 ORDER BY event_id) = 1""")
def first_candle(spark, sf_dir):
    rows = v.ticks(spark, sf_dir).withColumn(
        "timestamp", F.col("timestamp") - F.pmod("timestamp", F.lit(900))).withColumn("interval_m", F.lit(15))
    return dedup.keep_first(rows, ["security_id", "timestamp", "interval_m"], ["event_id"]) \
        .select("security_id", "timestamp", "close", "event_id")


@query("snk10_delete_range", f"WITH {v.TICKS}, {v.MIXED} SELECT * FROM mixed WHERE NOT coalesce({IN_RANGE}, false)")
def delete_range(spark, sf_dir):
    return mutate.delete_where(v.mixed_rows(spark, sf_dir), mutate.in_range(*_dates()))


@query("snk11_delete_scrips", f"""WITH {v.SPLIT}, {v.MIXED}
SELECT * FROM mixed WHERE scrip NOT IN (SELECT scrip FROM flagged)""")
def delete_scrips(spark, sf_dir):
    return mutate.delete_scrips(v.mixed_rows(spark, sf_dir), flagged_list(spark, sf_dir))


@query("snk13_delete_temp", f"WITH {v.TICKS}, {v.MIXED} SELECT * FROM mixed WHERE NOT coalesce(exchange = 'TEMP', false)")
def delete_temp(spark, sf_dir):
    return mutate.delete_where(v.mixed_rows(spark, sf_dir), mutate.is_temp())


@query("snk14_delete_old_temp", f"""WITH {v.TICKS}, {v.MIXED}
SELECT * FROM mixed WHERE NOT coalesce(exchange = 'TEMP' AND trade_date < DATE '{FROM}', false)""")
def delete_old_temp(spark, sf_dir):
    return mutate.delete_where(v.mixed_rows(spark, sf_dir), mutate.is_temp() & (F.col("trade_date") < _dates()[0]))


@query("snk15_delete_interval", f"""WITH {v.SPLIT}, {v.MIXED}
SELECT * FROM mixed WHERE NOT (interval_m = 15 AND scrip IN (SELECT scrip FROM flagged))""")
def delete_interval(spark, sf_dir):
    return mutate.delete_scrips(v.mixed_rows(spark, sf_dir), flagged_list(spark, sf_dir), F.col("interval_m") == 15)


@query("j1_append_new_prices", """WITH rows AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_partkey AS symbol, l_returnflag AS series,
         l_extendedprice AS close_price, l_linestatus FROM lineitem),
known AS (SELECT DISTINCT date, symbol, series FROM rows WHERE l_linestatus = 'F')
SELECT date, symbol, series, close_price FROM rows n
WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.date IS NOT DISTINCT FROM n.date
  AND k.symbol IS NOT DISTINCT FROM n.symbol AND k.series IS NOT DISTINCT FROM n.series)""")
def append_new_prices(spark, sf_dir):
    rows = v.table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"), F.col("l_partkey").alias("symbol"),
        F.col("l_returnflag").alias("series"), F.col("l_extendedprice").alias("close_price"), "l_linestatus")
    known = rows.where("l_linestatus = 'F'")
    return mutate.append_new(rows.drop("l_linestatus"), known, ["date", "symbol", "series"], "date")


@query("j2_append_new_mcap", """WITH rows AS (
  SELECT CAST(o_orderdate AS DATE) AS trade_date, CASE WHEN o_totalprice > 250000 THEN 'C' || o_custkey END AS symbol,
         o_orderstatus AS series, o_totalprice AS market_cap, o_orderpriority FROM orders),
known AS (SELECT DISTINCT trade_date, symbol, series FROM rows WHERE o_orderpriority = '1-URGENT')
SELECT trade_date, symbol, series, market_cap FROM rows n
WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.trade_date IS NOT DISTINCT FROM n.trade_date
  AND k.symbol IS NOT DISTINCT FROM n.symbol AND k.series IS NOT DISTINCT FROM n.series)""")
def append_new_mcap(spark, sf_dir):
    symbol = F.when(F.col("o_totalprice") > 250000, F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
    rows = v.table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("trade_date"), symbol.alias("symbol"),
        F.col("o_orderstatus").alias("series"), F.col("o_totalprice").alias("market_cap"), "o_orderpriority")
    known = rows.where("o_orderpriority = '1-URGENT'")
    return mutate.append_new(rows.drop("o_orderpriority"), known, ["trade_date", "symbol", "series"], "trade_date")


@query("j3_append_new_candles", f"""WITH {v.TICKS}, {v.CANDLES}, {v.candles_sql('known', "event_type = 'click'")}
SELECT security_id, "timestamp", interval_m, {OHLCV} FROM candles n
WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.security_id = n.security_id
  AND k."timestamp" = n."timestamp" AND k.interval_m = n.interval_m)""")
def append_new_candles(spark, sf_dir):
    known = v.candles(spark, sf_dir, "event_type = 'click'")
    fresh = mutate.append_new(v.candles(spark, sf_dir), known, ["security_id", "timestamp", "interval_m"], "trade_date")
    return fresh.select("security_id", "timestamp", "interval_m", *fixed.PRICES, "volume")


@query("j4_negative_list", """SELECT c_name AS scrip, c_custkey AS security_id FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM customer n WHERE n.c_acctbal < 0 AND n.c_name = c.c_name)""")
def negative_list(spark, sf_dir):
    customer = v.table(spark, sf_dir, "customer")
    listed = customer.select(F.col("c_name").alias("scrip"), F.col("c_custkey").alias("security_id"))
    negative = customer.select(F.when(F.col("c_acctbal") < 0, F.col("c_name")).alias("scrip"))
    return joins.without(listed, negative)


@query("f4_subset", "SELECT c_name AS scrip, c_mktsegment AS tag FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def subset(spark, sf_dir):
    mapping = v.table(spark, sf_dir, "customer").select(F.col("c_name").alias("scrip"), F.col("c_mktsegment").alias("tag"))
    return joins.subset(mapping, "tag", ["BUILDING", "MACHINERY"])


@query("w5_flag_fallback", f"""WITH {v.TICKS}, ranked AS (
  SELECT * REPLACE (CASE WHEN user_key % 5 > 0 THEN scrip END AS scrip), CASE WHEN event_type = 'click' THEN 0 ELSE 1 END AS p
  FROM (SELECT *, security_id AS user_key FROM ticks))
SELECT event_id, scrip, trade_date, event_type FROM ranked
QUALIFY p = min(p) OVER (PARTITION BY scrip, trade_date)""")
def flag_fallback(spark, sf_dir):
    scrip = F.when(F.pmod("security_id", F.lit(5)) > 0, F.col("scrip")).alias("scrip")  # NULL cells are cells too
    rows = v.ticks(spark, sf_dir).select("event_id", scrip, fn.ist_date("timestamp").alias("trade_date"), "event_type")
    return dedup.prefer_source(rows, ["scrip", "trade_date"], "event_type", "click")


_RELOAD = f"""{v.TICKS}, {v.BARS}, {v.STORED},
check_day AS (SELECT min(trade_date) AS d FROM bars WHERE {IN_RANGE}), {v.FLAGS}, {v.FLAGGED},
old AS (SELECT * FROM stored UNION ALL BY NAME
        SELECT trade_date, scrip, 'TEMP' AS exchange, security_id, {v._AGG} FROM ticks WHERE event_type = 'error' GROUP BY ALL),
clean AS (SELECT * FROM bars WHERE {IN_RANGE} AND scrip NOT IN (SELECT scrip FROM flagged)),
again AS (SELECT * FROM bars WHERE scrip IN (SELECT scrip FROM flagged))"""


def _reload(spark, sf_dir):
    """(stored, clean, again, flagged) of a range reload."""
    fetched, real = v.bars(spark, sf_dir), v.stored(spark, sf_dir)
    temp = rollup.daily_bars(v.ticks(spark, sf_dir).where("event_type = 'error'")
                             .withColumn("exchange", F.lit(fixed.TEMP_EXCHANGE)), order=v.order())
    check = splits.oldest_date_in(fetched, *_dates())
    flagged = stage(splits.flagged_scrips(splits.split_flags(fetched, real, check)), "flagged")
    clean = joins.without(fetched.where(mutate.in_range(*_dates())), flagged)
    return real.unionByName(temp), clean, joins.only(fetched, flagged), flagged


@query("job4_range_reload", f"""WITH {_RELOAD}
SELECT {ROW} FROM old WHERE NOT {IN_RANGE} AND exchange <> 'TEMP' AND scrip NOT IN (SELECT scrip FROM flagged)
UNION ALL SELECT {ROW} FROM clean UNION ALL SELECT {ROW} FROM again""")
def range_reload(spark, sf_dir):
    old, clean, again, flagged = _reload(spark, sf_dir)
    return mutate.range_reload(old, clean, again, flagged, *_dates())


@query("job5_dry_run_plan", f"""WITH {_RELOAD}
SELECT 'delete' AS action, 'temp' AS scope, count(*) AS rows, count(DISTINCT scrip) AS scrips FROM old WHERE exchange = 'TEMP'
UNION ALL SELECT 'delete', 'range', count(*), count(DISTINCT scrip) FROM old WHERE {IN_RANGE} AND exchange <> 'TEMP'
UNION ALL SELECT 'delete', 'flagged lifetime', count(*), count(DISTINCT scrip) FROM old WHERE scrip IN (SELECT scrip FROM flagged)
UNION ALL SELECT 'upsert', 'clean range', count(*), count(DISTINCT scrip) FROM clean
UNION ALL SELECT 'refetch', 'flagged lifetime', count(*), count(DISTINCT scrip) FROM flagged
UNION ALL SELECT 'lost', 'range', count(*), count(DISTINCT scrip) FROM old WHERE {IN_RANGE} AND exchange <> 'TEMP'
  AND scrip NOT IN (SELECT scrip FROM clean) AND scrip NOT IN (SELECT scrip FROM flagged)""")
def dry_run_plan(spark, sf_dir):
    old, clean, _, flagged = _reload(spark, sf_dir)
    return coverage.range_reload_plan(old, clean, flagged, *_dates())


@query("job1_daily_state", f"""WITH {v.SPLIT},
s AS (SELECT * FROM bars WHERE trade_date = (SELECT d FROM last_day))
SELECT {ROW} FROM stored t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.scrip = t.scrip AND s.trade_date = t.trade_date)
UNION ALL SELECT {ROW} FROM s""")
def daily_state(spark, sf_dir):
    fetched = v.bars(spark, sf_dir)
    last = splits.last_two_dates(fetched).select(F.col("last_date").alias("trade_date"))
    upload = fetched.join(F.broadcast(last), "trade_date", "left_semi")
    state = mutate.upsert(v.with_id(v.stored(spark, sf_dir)), v.with_id(upload))
    return state.drop("row_id")


@query("job2_temp_rollup", f"""WITH {v.TICKS}, {v.STORED},
temp AS (SELECT trade_date, scrip, 'TEMP' AS exchange, security_id, {v._AGG} FROM ticks
         WHERE ("timestamp" + 19800) % 86400 BETWEEN 33300 AND 66600 GROUP BY ALL)
SELECT {ROW}, {v.ID} AS row_id FROM stored
UNION ALL SELECT {ROW}, {v.ID} AS row_id FROM temp WHERE trade_date >= DATE '{FROM}'""")
def temp_rollup(spark, sf_dir):
    hourly = rollup.market_hours(v.ticks(spark, sf_dir)).withColumn("exchange", F.lit(fixed.TEMP_EXCHANGE))
    bars = v.with_id(rollup.daily_bars(hourly, order=v.order()))
    old = mutate.delete_where(v.with_id(v.stored(spark, sf_dir)), mutate.is_temp())
    state = mutate.upsert(old, bars)
    return mutate.delete_where(state, mutate.is_temp() & (F.col("trade_date") < _dates()[0]))


@query("job3_lifetime_reload", f"WITH {v.TICKS}, {v.BARS} SELECT {ROW}, {v.ID} AS row_id FROM bars")
def lifetime_reload(spark, sf_dir):
    fetched = v.with_id(v.bars(spark, sf_dir)).withColumn("pos", F.lit(0))
    return mutate.first_per_row_id(fetched, ["pos"]).drop("pos")


@query("job7_flagged_intraday_reload", f"""WITH {v.SPLIT}, {v.CANDLES}, {v.candles_sql('old', "event_type <> 'error'")},
eligible AS (SELECT DISTINCT scrip FROM old WHERE scrip IN (SELECT scrip FROM flagged))
SELECT scrip, "timestamp", {OHLCV} FROM old WHERE scrip NOT IN (SELECT scrip FROM eligible)
UNION ALL SELECT scrip, "timestamp", {OHLCV} FROM candles WHERE scrip IN (SELECT scrip FROM eligible)""")
def flagged_intraday_reload(spark, sf_dir):
    old = v.candles(spark, sf_dir, "event_type <> 'error'")
    eligible = stage(coverage.scrip_bounds(old, flagged_list(spark, sf_dir), 15).select("scrip"), "eligible")
    kept = mutate.delete_scrips(old, eligible, F.col("interval_m") == 15)
    state = kept.unionByName(joins.only(v.candles(spark, sf_dir), eligible).select(*kept.columns))
    return state.select("scrip", "timestamp", *fixed.PRICES, "volume")
