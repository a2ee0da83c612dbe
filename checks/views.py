"""The driver tables seen as market data, in Spark and as SQL.

ticks    one price per event; volume is the number in props
bars     daily bars of all ticks: what a re-fetch returns
stored   daily bars of the ticks known before corrections (no 'error' events)
candles  15-minute candles of all ticks
"""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from barsmith import fixed
from barsmith.functions import columns as fn
from barsmith.operators import rollup


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ticks(table(spark, sf_dir, "events"))


def as_ticks(events: DataFrame) -> DataFrame:
    stamped = events.withColumn("us", F.expr("unix_micros(CAST(ts AS TIMESTAMP))"))
    return stamped.selectExpr(
        "concat('U', CAST(user_id AS STRING)) AS scrip", "'NSE_EQ' AS exchange", "user_id AS security_id",
        "us DIV 1000000 AS timestamp", "us", "event_id", "event_type",
        *[f"value AS {c}" for c in fixed.PRICES],
        r"CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE) AS volume")


def order():
    """Time, then landing order."""
    return fn.sequence_key("us", "event_id")


def bars(spark, sf_dir) -> DataFrame:
    return rollup.daily_bars(ticks(spark, sf_dir), order=order())


def stored(spark, sf_dir) -> DataFrame:
    known = ticks(spark, sf_dir).where("event_type <> 'error'")
    return rollup.daily_bars(known, order=order())


def candles(spark, sf_dir, condition: str = "true") -> DataFrame:
    made = rollup.interval_bars(ticks(spark, sf_dir).where(condition), 15, order=order())
    return made.withColumn("security_id", F.col("security_id").cast("string")) \
        .withColumn("trade_date", fn.ist_date("timestamp"))


def with_id(df: DataFrame) -> DataFrame:
    return df.withColumn("row_id", fn.row_id())


def mixed_rows(spark, sf_dir) -> DataFrame:
    """Ticks as stored rows of several exchanges, one of them temporary and one NULL."""
    exchange = F.expr("CASE event_type WHEN 'error' THEN 'TEMP' WHEN 'view' THEN NULL ELSE 'NSE_EQ' END")
    interval = F.expr("CASE event_type WHEN 'click' THEN 15 ELSE 60 END")
    return ticks(spark, sf_dir).select(
        "event_id", "scrip", exchange.alias("exchange"), "security_id",
        fn.ist_date("timestamp").alias("trade_date"), interval.alias("interval_m"), "close", "volume")


# ---- The same views in SQL ----
TICKS = """ticks AS (
  SELECT 'U' || user_id AS scrip, 'NSE_EQ' AS exchange, user_id AS security_id, event_id, event_type,
         epoch_us(ts) // 1000000 AS "timestamp", epoch_us(ts) AS us, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
         CAST(ts + INTERVAL '5 hours 30 minutes' AS DATE) AS trade_date
  FROM events)"""

_AGG = """arg_min(price, (us, event_id)) AS "open", max(price) AS high, min(price) AS low,
         arg_max(price, (us, event_id)) AS "close", sum(volume) AS volume"""


def bars_sql(name: str, condition: str = "true") -> str:
    return f"""{name} AS (SELECT trade_date, scrip, exchange, security_id, {_AGG}
  FROM ticks WHERE {condition} GROUP BY ALL)"""


def candles_sql(name: str, condition: str = "true") -> str:
    return f"""{name} AS (SELECT scrip, exchange, CAST(security_id AS VARCHAR) AS security_id,
         "timestamp" - "timestamp" % 900 AS "timestamp", 15 AS interval_m, trade_date, {_AGG}
  FROM ticks WHERE {condition} GROUP BY ALL)"""


BARS = bars_sql("bars")
STORED = bars_sql("stored", "event_type <> 'error'")
CANDLES = candles_sql("candles")
ID = "sha256(scrip || exchange || security_id || strftime(trade_date, '%Y-%m-%d'))"
LAST_TWO = """days AS (SELECT DISTINCT trade_date FROM bars),
  last_day AS (SELECT max(trade_date) AS d FROM days),
  check_day AS (SELECT max(trade_date) AS d FROM days WHERE trade_date < (SELECT d FROM last_day))"""
MIXED = """mixed AS (SELECT event_id, scrip,
         CASE event_type WHEN 'error' THEN 'TEMP' WHEN 'view' THEN NULL ELSE 'NSE_EQ' END AS exchange,
         security_id, trade_date, CASE event_type WHEN 'click' THEN 15 ELSE 60 END AS interval_m,
         price AS "close", volume FROM ticks)"""


def flags_sql(fetched: str, known: str, day: str) -> str:
    """The split check, one arm per price field and one for scrips not stored."""
    arms = [f"""SELECT f.scrip, CAST(f.security_id AS VARCHAR) AS security_id, f.trade_date AS check_date,
         'mismatch' AS reason, '{c}' AS field, f."{c}" AS fetched_value, s."{c}" AS stored_value
  FROM {fetched} f JOIN {known} s ON f.scrip = s.scrip AND s.trade_date = {day}
  WHERE f.trade_date = {day} AND round_even(f."{c}", 2) <> round_even(s."{c}", 2)"""
            for c in ("open", "high", "low", "close")]
    arms.append(f"""SELECT f.scrip, CAST(f.security_id AS VARCHAR), f.trade_date, 'missing_bq', NULL, NULL, NULL
  FROM {fetched} f WHERE f.trade_date = {day}
   AND NOT EXISTS (SELECT 1 FROM {known} s WHERE s.scrip = f.scrip AND s.trade_date = {day})""")
    return "\n  UNION ALL ".join(arms)


CHECK_DAY = "(SELECT d FROM check_day)"
FLAGS = f"flags AS ({flags_sql('bars', 'stored', CHECK_DAY)})"
FLAGGED = "flagged AS (SELECT DISTINCT scrip FROM flags WHERE reason = 'mismatch')"
SPLIT = f"{TICKS}, {BARS}, {STORED}, {LAST_TWO}, {FLAGS}, {FLAGGED}"
