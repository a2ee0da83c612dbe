"""Cleaning, landed responses and landed files."""

from pyspark.sql import functions as F

from barsmith import fixed, schemas
from barsmith.functions import columns as fn
from barsmith.operators import coverage
from barsmith.session import scratch
from barsmith.sources import landed_files, responses
from checks import views as v
from checks.registry import query


@query("p3_numeric_coercion", """SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS price, CAST(NULL AS DOUBLE) AS priority,
       CAST(trunc(o_totalprice) AS BIGINT) AS whole, CAST(NULL AS DOUBLE) AS suffixed,
       CASE o_orderkey % 8 WHEN 4 THEN 1000::DOUBLE WHEN 5 THEN 'Infinity'::DOUBLE WHEN 6 THEN -0.5::DOUBLE END AS odd FROM orders""")
def numeric_coercion(spark, sf_dir):
    price = F.col("o_totalprice").cast("string")
    texts = v.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.concat(F.lit(" \t"), price, F.lit(" ")).alias("padded"),
        F.concat(price, F.lit("d")).alias("suffixed"),
        F.element_at(F.array(*[F.lit(t) for t in ("NaN", "-", "", "0x1F", "1e3", " inf ", "-.5", "1,000")]),
                     (F.pmod("o_orderkey", F.lit(8)) + 1).cast("int")).alias("odd"))
    return texts.select("o_orderkey", fn.coerce_double("padded").alias("price"),
                        fn.coerce_double("o_orderpriority").alias("priority"),
                        fn.coerce_long("padded").alias("whole"), fn.coerce_double("suffixed").alias("suffixed"),
                        fn.coerce_double("odd").alias("odd"))


@query("p2_strip_text", """SELECT doc_id, regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '') AS text FROM documents""")
def strip_text(spark, sf_dir):
    return v.table(spark, sf_dir, "documents").select("doc_id", fn.strip("text").alias("text"))


@query("p5_date_parse", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS price_date, CAST(o_orderdate AS DATE) AS mcap_date,
       CAST(NULL AS DATE) AS no_date FROM orders""")
def date_parse(spark, sf_dir):
    day = F.col("o_orderdate")
    return v.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.strict_date(F.concat(F.lit(" "), F.date_format(day, "dd-MMM-yyyy")), "d-MMM-yyyy").alias("price_date"),
        fn.lenient_date(F.date_format(day, "dd MMM yyyy"), "d MMM yyyy").alias("mcap_date"),
        fn.lenient_date("o_orderpriority", "d MMM yyyy").alias("no_date"))


@query("p7_scrub", """SELECT event_id, CASE WHEN event_type IN ('error', 'signup', 'view') THEN NULL ELSE value END AS value FROM events""")
def scrub(spark, sf_dir):
    odd = F.expr("""CASE event_type WHEN 'error' THEN double('NaN') WHEN 'signup' THEN double('Infinity')
                    WHEN 'view' THEN double('-Infinity') ELSE value END""")
    return v.table(spark, sf_dir, "events").select("event_id", fn.scrub(odd).alias("value"))


@query("p8_strike_round", "SELECT p_partkey, CAST(round_even(p_retailprice / 3 * 100, 0) / 100 AS DECIMAL(38, 9)) AS strike FROM part")
def strike_round(spark, sf_dir):
    return v.table(spark, sf_dir, "part").select("p_partkey", fn.strike_price(F.col("p_retailprice") / 3).alias("strike"))


_NET = "(l_extendedprice * (1 - l_discount))"
_PRODUCT = f"({_NET} * 100)"
_HIGH = f"({_NET} * 134217729 - ({_NET} * 134217729 - {_NET}))"
_ERROR = f"(({_HIGH} * 100 - {_PRODUCT}) + ({_NET} - {_HIGH}) * 100)"


@query("x7_tick_round", f"""SELECT l_orderkey, l_partkey, l_linenumber, CASE
  WHEN {_PRODUCT} - floor({_PRODUCT}) = 0.5 AND {_ERROR} > 0 THEN floor({_PRODUCT}) + 1
  WHEN {_PRODUCT} - floor({_PRODUCT}) = 0.5 AND {_ERROR} < 0 THEN floor({_PRODUCT})
  ELSE round_even({_PRODUCT}, 0) END / 100 AS net FROM lineitem""")
def tick_round(spark, sf_dir):
    net = F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))
    return v.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", fn.tick_round(net).alias("net"))


@query("x6_offset_label", """SELECT p_partkey, CASE WHEN p_size = 25 THEN 'ATM' WHEN p_size > 25 THEN 'ATM+' || (p_size - 25)
       ELSE 'ATM' || (p_size - 25) END AS label FROM part""")
def offset_label(spark, sf_dir):
    return v.table(spark, sf_dir, "part").select("p_partkey", fn.offset_label(F.col("p_size") - 25).alias("label"))


@query("f1_stale_guard", """WITH rows AS (SELECT o_orderkey, o_custkey || '-' || year(o_orderdate) AS file, CAST(o_orderdate AS DATE) AS d FROM orders),
req AS (SELECT file, min(d) AS requested FROM rows GROUP BY file),
good AS (SELECT r.file FROM rows r JOIN req q ON q.file = r.file GROUP BY r.file HAVING bool_and(coalesce(r.d = q.requested, false)))
SELECT o_orderkey, file, d AS row_date FROM rows WHERE file IN (SELECT file FROM good)""")
def stale_guard(spark, sf_dir):
    rows = v.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat_ws("-", "o_custkey", F.year("o_orderdate")).alias("file"),
        F.col("o_orderdate").cast("date").alias("row_date"))
    requested = rows.groupBy("file").agg(F.min("row_date").alias("requested_date"))
    return landed_files.drop_stale_files(rows.join(requested, "file"), "row_date").drop("requested_date")


# Both engines read these expressions.
_PART_COLUMNS = [
    "CASE p_type WHEN 'SMALL' THEN 'E' WHEN 'LARGE' THEN 'D' WHEN 'PROMO' THEN 'I' ELSE 'C' END AS SEGMENT",
    "CASE WHEN p_size > 10 THEN 'EQUITY' ELSE 'BOND' END AS INSTRUMENT",
    "CASE WHEN p_retailprice > 950 THEN 'ES' END AS INSTRUMENT_TYPE",
    "CASE WHEN p_size > 30 THEN p_name END AS ASM_GSM_CATEGORY",
    "p_brand AS EXCH_ID",
    "p_partkey AS SECURITY_ID",
]
_PART = ", ".join(_PART_COLUMNS)
_KEPT = "SEGMENT IN ('D', 'E', 'I') AND INSTRUMENT = 'EQUITY' AND INSTRUMENT_TYPE = 'ES'"


def _instruments(spark, sf_dir, *extra):
    return v.table(spark, sf_dir, "part").selectExpr(*_PART_COLUMNS, *extra)


@query("f3_instrument_filter", f"""WITH m AS (SELECT {_PART} FROM part)
SELECT SEGMENT, INSTRUMENT, INSTRUMENT_TYPE, coalesce(ASM_GSM_CATEGORY, 'None') AS ASM_GSM_CATEGORY, EXCH_ID, SECURITY_ID
FROM m WHERE {_KEPT}""")
def instrument_filter(spark, sf_dir):
    return landed_files.with_category_text(_instruments(spark, sf_dir).where(landed_files.traded()))


@query("a7_value_counts", f"""WITH m AS (SELECT {_PART} FROM part)
SELECT 'all' AS scope, EXCH_ID AS value, count(*) AS n FROM m GROUP BY EXCH_ID
UNION ALL SELECT 'filtered', EXCH_ID, count(*) FROM m WHERE {_KEPT} GROUP BY EXCH_ID""")
def value_counts(spark, sf_dir):
    return coverage.value_counts(_instruments(spark, sf_dir), "EXCH_ID", F.coalesce(landed_files.traded(), F.lit(False)))


# ---- Landed responses: each event as a response with two candles, a minute apart ----

def _landed(spark, sf_dir, envelope: bool = False, success: bool = False):
    tick = v.ticks(spark, sf_dir)
    pair = F.struct(
        F.array(F.col("timestamp"), F.col("timestamp") + 60).alias("timestamp"),
        *[F.array(F.col("open"), F.col("open") * 2).alias(c) for c in ("open", "high", "low", "close")],
        F.array("volume", "volume").alias("volume"))
    empty = F.from_json(F.lit('{"timestamp": [], "open": [], "high": [], "low": [], "close": [], "volume": []}'),
                        "timestamp ARRAY<BIGINT>, open ARRAY<DOUBLE>, high ARRAY<DOUBLE>, low ARRAY<DOUBLE>, "
                        "close ARRAY<DOUBLE>, volume ARRAY<DOUBLE>")
    pair = F.when(F.col("event_type") == "view", empty).otherwise(pair)
    body = F.to_json(F.struct(F.when(F.col("event_type") == "click", "failure").otherwise("success").alias("status"),
                              pair.alias("data"))) if envelope else F.to_json(pair)
    return tick.select(
        F.col("event_id").alias("seq"), "scrip", F.col("security_id").cast("string").alias("security_id"),
        F.lit(" NSE_EQ ").alias("exc_seg") if envelope else F.lit("NSE_EQ").alias("exc_seg"),
        F.lit("EQUITY").alias("instrument_type"), F.lit(None).cast("date").alias("from_date"),
        F.lit(None).cast("date").alias("to_date"), F.lit(60 if success else 1).alias("interval_m"),
        F.when(F.col("event_type") == "error", 429).otherwise(200).alias("status"), body.alias("body"))


def _pair_sql(keep: str) -> str:
    return f"""rows AS (SELECT event_id AS seq, scrip, security_id, "timestamp" + 60 * p AS "timestamp", price * (p + 1) AS price,
  volume, CAST(p AS INTEGER) AS pos, event_type FROM ticks, range(0, 2) r(p) WHERE {keep})"""


_DAY = "CAST(DATE '1970-01-01' + CAST((\"timestamp\" + 19800) // 86400 AS INTEGER) AS DATE)"
_FOUR = 'price AS "open", price AS high, price AS low, price AS "close", volume'


@query("src8_daily_response", f"""WITH {v.TICKS}, {_pair_sql("event_type NOT IN ('error', 'view')")}
SELECT scrip, 'NSE_EQ' AS exchange, CAST(security_id AS VARCHAR) AS security_id, {_FOUR}, {_DAY} AS trade_date, seq, pos,
       sha256(scrip || 'NSE_EQ' || security_id || strftime({_DAY}, '%Y-%m-%d')) AS row_id FROM rows""")
def daily_response(spark, sf_dir):
    return responses.daily_candles(_landed(spark, sf_dir))


@query("src9_intraday_response", f"""WITH {v.TICKS}, {_pair_sql("event_type NOT IN ('error', 'view')")}
SELECT scrip, 'NSE_EQ' AS exchange, CAST(security_id AS VARCHAR) AS security_id, "timestamp", 1 AS interval_m, {_FOUR},
       {_DAY} AS trade_date FROM rows
QUALIFY row_number() OVER (PARTITION BY security_id, "timestamp" ORDER BY seq, pos) = 1""")
def intraday_response(spark, sf_dir):
    return responses.intraday_candles(_landed(spark, sf_dir, envelope=True))


@query("src10_hourly_response", f"""WITH {v.TICKS}, {_pair_sql("event_type NOT IN ('error', 'view', 'click')")}
SELECT scrip, 'TEMP' AS exchange, security_id, "timestamp", 60 AS interval_m, {_FOUR} FROM rows
WHERE ("timestamp" + 19800) % 86400 BETWEEN 33300 AND 66600
QUALIFY row_number() OVER (PARTITION BY security_id, "timestamp" ORDER BY seq, pos) = 1""")
def hourly_response(spark, sf_dir):
    return responses.hourly_candles(_landed(spark, sf_dir, envelope=True, success=True))


@query("src13_fetch_outcomes", f"""WITH {v.TICKS}
SELECT event_id AS seq, scrip, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'none' ELSE 'ok' END AS outcome,
       CASE WHEN event_type IN ('error', 'view') THEN 0 ELSE 2 END AS rows,
       CASE event_type WHEN 'error' THEN 'HTTP 429' WHEN 'view' THEN 'no rows' END AS error FROM ticks""")
def fetch_outcomes(spark, sf_dir):
    return responses.outcomes(_landed(spark, sf_dir))


@query("src13_failed_scrips", f"WITH {v.TICKS} SELECT DISTINCT scrip FROM ticks WHERE event_type = 'error'")
def failed_scrips(spark, sf_dir):
    return responses.failed_scrips(_landed(spark, sf_dir))


@query("src11_option_response", """WITH r AS (
  SELECT o_orderkey AS seq, CAST(o_orderdate AS DATE) AS trade_date, CASE o_orderstatus WHEN 'F' THEN 'MONTH' ELSE 'WEEK' END AS flag,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS code, o_totalprice AS price, epoch_us(o_orderdate) // 1000000 AS epoch,
         CASE WHEN o_totalprice > 250000 THEN 'CE' ELSE 'PE' END AS side, CAST(o_custkey AS VARCHAR) AS sid
  FROM orders),
chosen AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY trade_date, code, side, sid ORDER BY flag <> 'WEEK', seq) = 1)
SELECT CAST(NULL AS DATE) AS expiry_date, flag AS expiry_flag, code AS expiry_code, 'NIFTY' AS security_ticker, sid AS security_id,
       1 AS "interval", epoch + 60 * p AS "timestamp", CAST(round_even(price / 7 * 100, 0) / 100 AS DECIMAL(38, 9)) AS strike_price,
       side AS option_type, 'ATM' AS strike_offset, price AS spot, price AS "open", price AS high, price AS low, price AS "close",
       CAST(seq AS BIGINT) AS volume, CAST(NULL AS DOUBLE) AS iv, CAST(seq AS BIGINT) AS oi, trade_date
FROM chosen, range(0, 2) x(p)""")
def option_response(spark, sf_dir):
    return responses.option_candles(option_landed(spark, sf_dir))


def option_landed(spark, sf_dir):
    """Each order as a landed option response of two candles."""
    twice = lambda c: F.array(c, c)
    price, key = F.col("o_totalprice"), F.col("o_orderkey").cast("bigint")
    epoch = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    arrays = F.struct(F.array(epoch, epoch + 60).alias("timestamp"), twice(price / 7).alias("strike"),
                      *[twice(price).alias(c) for c in ("spot", "open", "high", "low", "close")],
                      twice(key).alias("volume"), twice(F.lit("NaN")).alias("iv"), twice(key).alias("oi"))
    call = price > 250000
    body = F.to_json(F.struct(F.struct(F.when(call, arrays).alias("ce"), F.when(~call, arrays).alias("pe")).alias("data")))
    return v.table(spark, sf_dir, "orders").select(
        key.alias("seq"), F.col("o_orderdate").cast("date").alias("trade_date"),
        F.when(F.col("o_orderstatus") == "F", "MONTH").otherwise("WEEK").alias("expiry_flag"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("expiry_code"), F.lit(0).alias("strike_offset"),
        F.when(call, "CE").otherwise("PE").alias("option_type"), F.lit("NIFTY").alias("security_ticker"),
        F.col("o_custkey").cast("string").alias("security_id"), F.lit(1).alias("interval"),
        F.lit(200).alias("status"), body.alias("body"))


# ---- Landed files, written by Spark from the given tables ----

def _csv(df, label: str) -> str:
    path = scratch(df.sparkSession, label)
    df.write.option("header", True).csv(path)
    return path


@query("src6_scrip_list", """SELECT c_name AS scrip, CAST(c_custkey AS VARCHAR) AS security_id, c_mktsegment AS exc_seg FROM customer
WHERE c_acctbal >= 0""")
def scrip_list(spark, sf_dir):
    customer = v.table(spark, sf_dir, "customer")
    listed = customer.select(F.col("c_name").alias("scrip"), F.col("c_custkey").alias("security_id"),
                             F.col("c_mktsegment").alias("exc_seg"))
    negative = customer.where("c_acctbal < 0").select(F.col("c_name").alias("scrip"))
    return landed_files.scrip_mapping(spark, _csv(listed, "scrips"), _csv(negative, "negative"))


@query("src7_expiry_calendar", """SELECT DISTINCT CAST(o_orderdate AS DATE) AS trade_date, CAST(l_shipdate AS DATE) AS expiry_date
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def expiry_calendar(spark, sf_dir):
    orders, lines = v.table(spark, sf_dir, "orders"), v.table(spark, sf_dir, "lineitem")
    written = F.expr("""CASE o_orderstatus WHEN 'F' THEN date_format(l_shipdate, 'dd/MM/yyyy')
        WHEN 'O' THEN date_format(l_shipdate, 'yyyy-MM-dd') ELSE date_format(l_shipdate, 'dd-MMM-yyyy') END""")
    pairs = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.lit("NIFTY").alias("Symbol"), F.date_format("o_orderdate", "dd-MM-yyyy").alias("Date"), written.alias("Expiry"))
    return landed_files.expiry_calendar(spark, _csv(pairs, "expiries"))


_GIVEN = ("EXCH_ID", "SEGMENT", "SECURITY_ID", "INSTRUMENT", "INSTRUMENT_TYPE", "ASM_GSM_CATEGORY", "STRIKE_PRICE", "SM_EXPIRY_DATE")
_NONE = ", ".join(f"CAST(NULL AS {'VARCHAR' if t == 'string' else t}) AS {c}" for c, t in fixed.INSTRUMENT_COLUMNS.items() if c not in _GIVEN)


@query("src5_instrument_master", f"""WITH m AS (SELECT {_PART}, p_retailprice AS STRIKE_PRICE FROM part)
SELECT EXCH_ID, SEGMENT, SECURITY_ID, INSTRUMENT, INSTRUMENT_TYPE, ASM_GSM_CATEGORY, STRIKE_PRICE, DATE '2026-08-27' AS SM_EXPIRY_DATE,
  {_NONE} FROM m""")
def instrument_master(spark, sf_dir):
    return landed_files.instrument_master(spark, instrument_file(spark, sf_dir))


def instrument_file(spark, sf_dir) -> str:
    part = _instruments(spark, sf_dir, "p_retailprice AS STRIKE_PRICE", "'2026-08-27' AS SM_EXPIRY_DATE")
    full = part.select(*[F.col(c) if c in part.columns else F.lit(None).cast("string").alias(c) for c in fixed.INSTRUMENT_COLUMNS],
                       F.lit("x").alias("UNUSED"))
    return _csv(full, "instruments")


@query("src1_price_files", f"""WITH {v.TICKS},
rows AS (SELECT *, trade_date + CASE WHEN event_type = 'purchase' AND price > 300 THEN 1 ELSE 0 END AS file_day FROM ticks),
good AS (SELECT file_day FROM rows GROUP BY file_day HAVING bool_and(trade_date = file_day))
SELECT scrip AS symbol, event_type AS series, trade_date AS date,
  {', '.join(f'price AS {c}' for c in schemas.PRICE_NUMBERS if not c.startswith('deliv'))},
  CAST(NULL AS DOUBLE) AS deliv_qty, CAST(NULL AS DOUBLE) AS deliv_per
FROM rows WHERE file_day IN (SELECT file_day FROM good) AND file_day BETWEEN DATE '2024-01-02' AND DATE '2024-01-30'""")
def price_files(spark, sf_dir):
    return landed_files.price_files(spark, price_folder(spark, sf_dir), "2024-01-02", "2024-01-30")


def price_folder(spark, sf_dir) -> str:
    """One price file per day; a late row makes the next day's file a stale one."""
    tick = v.ticks(spark, sf_dir).withColumn("day", fn.ist_date("timestamp"))
    late = F.expr("CASE WHEN event_type = 'purchase' AND close > 300 THEN 1 ELSE 0 END")
    texts = {"SYMBOL": F.concat(F.lit(" "), "scrip"), "SERIES": F.col("event_type"), "DATE1": F.date_format("day", "dd-MMM-yyyy"),
             "DELIV_QTY": F.lit(" -"), "DELIV_PER": F.lit(" -")}
    lines = tick.select(*[texts.get(c, F.col("close")).alias(c) for c in fixed.PRICE_COLUMNS],
                        F.date_format(F.date_add("day", late), "ddMMyyyy").alias("sec_bhavdata_full"))
    path = scratch(spark, "prices")
    lines.hint("rebalance", "sec_bhavdata_full").write.partitionBy("sec_bhavdata_full").option("header", True).csv(path)
    return path
