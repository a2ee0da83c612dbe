"""The jobs themselves: each query writes its tables and landed responses from the given tables, runs the job and returns
the table it leaves, or its report."""

from pyspark.sql import DataFrame, functions as F

from barsmith import changes, commits, fixed, schemas, snapshots, tables
from barsmith.functions import columns as fn
from barsmith.operators import calendars, coverage, rollup
from barsmith.plans import daily, intraday, options, reference
from barsmith.session import scratch, stage
from barsmith.settings import Settings
from barsmith.sources import landed_files
from checks import ingest, mutations as m, views as v
from checks.bars import OHLCV, flagged_list
from checks.registry import query
from checks.streams import _new_table


WEEK = 7 * 86400


def _responses(rows: DataFrame, interval: int, envelope: bool = False) -> DataFrame:
    """One landed response per instrument and week, as windows are fetched; rows: scrip, security_id, timestamp, prices, volume and `at`,
    the landing order."""
    cells = ("timestamp", *fixed.PRICES, "volume")
    week = F.floor(F.col("timestamp") / WEEK).cast("int").alias("week")
    held = rows.groupBy("scrip", "security_id", week).agg(F.sort_array(F.collect_list(F.struct("at", *cells))).alias("c"))
    arrays = F.struct(*[F.col(f"c.{n}").alias(n) for n in cells])
    body = F.to_json(F.struct(F.lit("success").alias("status"), arrays.alias("data")) if envelope else arrays)
    return stage(held.select(
        F.col("security_id").cast("bigint").alias("seq"), "scrip", F.col("security_id").cast("string").alias("security_id"),
        F.lit("NSE_EQ").alias("exc_seg"), F.lit("EQUITY").alias("instrument_type"), F.date_from_unix_date(F.col("week") * 7).alias("from_date"),
        F.date_from_unix_date(F.col("week") * 7 + 7).alias("to_date"), F.lit(interval).alias("interval_m"), F.lit(200).alias("status"),
        body.alias("body")), "responses")


def _bar_responses(spark, sf_dir) -> DataFrame:
    """Daily bars as fetched: each stamped 09:15 IST of its date."""
    at = F.unix_date("trade_date").cast("bigint") * 86400 + (9 * 60 + 15) * 60 - fixed.IST_OFFSET_SECONDS
    return _responses(v.bars(spark, sf_dir).withColumn("timestamp", at).withColumn("at", at), 1440)


def _old_temp(spark, sf_dir) -> DataFrame:
    rows = v.ticks(spark, sf_dir).where("event_type = 'error'").withColumn("exchange", F.lit(fixed.TEMP_EXCHANGE))
    return rollup.daily_bars(rows, order=v.order())


def _daily(spark, sf_dir, temp: bool) -> Settings:
    """A daily table that holds the stored bars, with or without temporary ones (none on the date that range reloads check)."""
    known = v.stored(spark, sf_dir)
    name = _new_table(spark, "job_daily", schemas.DAILY, "trade_date", buckets=4)
    old = _old_temp(spark, sf_dir).where(F.col("trade_date") != F.lit(m.FROM).cast("date"))
    tables.append(v.with_id(known.unionByName(old) if temp else known), name)
    return Settings(daily_table=name)


@query("snk3_change_files", f"""WITH {v.TICKS}, {v.BARS}, {v.STORED},
folded AS (SELECT {m.ROW} FROM stored t WHERE NOT EXISTS (SELECT 1 FROM bars s WHERE s.scrip = t.scrip AND s.trade_date = t.trade_date)
           UNION ALL SELECT {m.ROW} FROM bars)
SELECT {m.ROW}, {v.ID} AS row_id FROM folded WHERE NOT {m.IN_RANGE}
UNION ALL SELECT {m.ROW}, {v.ID} FROM bars WHERE trade_date BETWEEN DATE '2024-01-15' AND DATE '{m.TO}'""")
def change_files(spark, sf_dir):
    """Merge on read: all bars recorded and folded in, then a range of tombstones and half of it recorded again; the view's rows."""
    name = _daily(spark, sf_dir, temp=False).daily_table
    changes.start(spark, name, location=scratch(spark, "changes"))
    fetched = stage(v.with_id(v.bars(spark, sf_dir)).select(*schemas.DAILY_COLUMNS), "fetched")
    changes.upsert(spark, name, fetched)
    changes.compact(spark, name)
    changes.delete_range(spark, name, m.FROM, m.TO)
    changes.upsert(spark, name, stage(fetched.where(f"trade_date BETWEEN DATE '2024-01-15' AND DATE '{m.TO}'"), "again"))
    return changes.current(spark, name)


_JOB1 = f"""{v.SPLIT}, s AS (SELECT * FROM bars WHERE trade_date = (SELECT d FROM last_day))"""


def _run_daily(spark, sf_dir):
    settings, landed = _daily(spark, sf_dir, temp=False), _bar_responses(spark, sf_dir)
    gone = landed.select("scrip").limit(1).select(F.lit("GONE").alias("scrip"))
    bad = landed.withColumn("status", F.when(F.pmod("seq", F.lit(10)) == 3, 429).otherwise(200)) \
        .withColumn("exc_seg", F.when(F.pmod("seq", F.lit(10)) != 4, F.col("exc_seg")))
    return settings, daily.run_daily(spark, settings, bad, landed.select("scrip").union(gone))


_LANDED = "security_id % 10 NOT IN (3, 4)"


@query("job1_run_daily", f"""WITH {v.TICKS}, {v.BARS}, {v.STORED}, {v.LAST_TWO},
s AS (SELECT * FROM bars WHERE {_LANDED} AND trade_date = (SELECT max(trade_date) FROM bars WHERE {_LANDED}))
SELECT {m.ROW}, {v.ID} AS row_id FROM stored t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.scrip = t.scrip AND s.trade_date = t.trade_date)
UNION ALL SELECT {m.ROW}, {v.ID} FROM s""")
def run_daily(spark, sf_dir):
    settings, _ = _run_daily(spark, sf_dir)
    return tables.read(spark, settings.daily_table)


@query("snk4_rejects", f"""WITH {v.TICKS}, {v.BARS}
SELECT count(*) FILTER ({_LANDED}) AS rows, count(DISTINCT scrip) FILTER ({_LANDED}) AS scrips,
       count(*) FILTER (security_id % 10 = 4) AS rejected, count(DISTINCT scrip) FILTER (security_id % 10 = 3) AS failed,
       1 AS missing, count(*) FILTER ({_LANDED} AND trade_date = (SELECT max(trade_date) FROM bars WHERE {_LANDED})) AS uploaded FROM bars""")
def daily_report(spark, sf_dir):
    """The report of the same run: keys without an exchange are counted, not merged; what failed or did not land is named."""
    _, r = _run_daily(spark, sf_dir)
    counts = (r["rows"], r["scrips"], r["rejected"], len(r["failed"]), len(r["missing"]), r["uploaded"])
    return spark.createDataFrame([counts], "rows long, scrips long, rejected long, failed long, missing int, uploaded long")


@query("job2_run_daily_from_hourly", f"""WITH {v.TICKS}, {v.STORED}, once AS (SELECT * FROM ticks
  QUALIFY row_number() OVER (PARTITION BY security_id, "timestamp" ORDER BY us, event_id) = 1),
temp AS (SELECT trade_date, scrip, 'TEMP' AS exchange, security_id, {v._AGG} FROM once
         WHERE ("timestamp" + 19800) % 86400 BETWEEN 33300 AND 66600 GROUP BY ALL)
SELECT {m.ROW}, {v.ID} AS row_id FROM stored
UNION ALL SELECT {m.ROW}, {v.ID} AS row_id FROM temp WHERE trade_date >= DATE '{m.FROM}'""")
def run_daily_from_hourly(spark, sf_dir):
    settings = _daily(spark, sf_dir, temp=True)
    landed = _responses(v.ticks(spark, sf_dir).withColumn("at", v.order()), 60, envelope=True)
    twice = landed.unionByName(landed.withColumn("interval_m", F.lit(15)))  # two intervals landed; one is named
    daily.run_daily_from_hourly(spark, settings, twice, m.FROM, interval=60)
    return tables.read(spark, settings.daily_table)


@query("job3_run_lifetime_reload", f"WITH {v.TICKS}, {v.BARS} SELECT {m.ROW}, {v.ID} AS row_id FROM bars")
def run_lifetime_reload(spark, sf_dir):
    """In a session whose overwrites are dynamic: stored and temporary rows must go all the same."""
    settings = _daily(spark, sf_dir, temp=True)
    with tables.overwrite_mode(spark, "dynamic"):
        daily.run_daily_reload(spark, settings, _bar_responses(spark, sf_dir), "lifetime")
    return tables.read(spark, settings.daily_table)


@query("snk2_snapshot_swap", f"""WITH {v.TICKS}, {v.BARS}, {v.STORED},
last AS (SELECT max(trade_date) AS d FROM bars)
SELECT 'reader before' AS seen, {m.ROW}, {v.ID} AS row_id FROM stored
UNION ALL SELECT 'after', {m.ROW}, {v.ID} FROM bars
UNION ALL SELECT 'pointed back', {m.ROW}, {v.ID} FROM stored WHERE trade_date < (SELECT d FROM last)""")
def snapshot_swap(spark, sf_dir):
    """A lifetime reload of a table with snapshots: a reader opened before it ends on the old rows, a later one sees the new ones, and
    pointed back the view shows the stored rows again (those before the last date: the copy is one of its own)."""
    settings, again = [Settings(daily_table=scratch(spark, "t").rsplit("/", 1)[1].replace("-", "_"), snapshots=True, buckets=4) for _ in "ab"]
    known = v.with_id(v.stored(spark, sf_dir)).select(*schemas.DAILY_COLUMNS)
    landed = _bar_responses(spark, sf_dir)
    for s in (settings, again):
        snapshots.ensure(spark, s.daily_table, schemas.DAILY, buckets=4, cluster=["scrip"])
        tables.append(known, snapshots.stored(spark, s.daily_table))
    before = spark.table(settings.daily_table)
    for s in (settings, again):
        daily.run_daily_reload(spark, s, landed, "lifetime")
    snapshots.point(spark, again.daily_table, 1)
    last = v.bars(spark, sf_dir).agg(F.max("trade_date")).first()[0]
    seen = {"reader before": before, "after": spark.table(settings.daily_table),
            "pointed back": spark.table(again.daily_table).where(F.col("trade_date") < F.lit(last))}
    found = None
    for label, rows in seen.items():
        rows = rows.select(F.lit(label).alias("seen"), *schemas.DAILY_COLUMNS)
        found = rows if found is None else found.unionByName(rows)
    return found


@query("job4_run_range_reload", f"""WITH {m._RELOAD}
SELECT {m.ROW}, {v.ID} AS row_id FROM old WHERE NOT {m.IN_RANGE} AND exchange <> 'TEMP' AND scrip NOT IN (SELECT scrip FROM flagged)
UNION ALL SELECT {m.ROW}, {v.ID} FROM clean UNION ALL SELECT {m.ROW}, {v.ID} FROM again""")
def run_range_reload(spark, sf_dir):
    settings, landed = _daily(spark, sf_dir, temp=True), _bar_responses(spark, sf_dir)
    daily.run_daily_reload(spark, settings, landed, "range", m.FROM, m.TO, lifetime=landed)
    return tables.read(spark, settings.daily_table)


def _candle_responses(spark, sf_dir) -> DataFrame:
    return _responses(v.candles(spark, sf_dir).withColumn("at", F.col("timestamp")), 15)


def _intraday(spark, sf_dir, condition: str) -> Settings:
    name = _new_table(spark, "job_intraday", schemas.INTRADAY, "trade_date", buckets=4)
    tables.append(v.candles(spark, sf_dir, condition), name)
    return Settings(intraday_table=name)


_CANDLE = f'scrip, exchange, security_id, "timestamp", interval_m, trade_date, {OHLCV}'


@query("job6_run_intraday", f"""WITH {v.TICKS}, {v.CANDLES}, {v.candles_sql('known', "event_type = 'click'")}
SELECT {_CANDLE} FROM known UNION ALL SELECT {_CANDLE} FROM candles n
WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.security_id = n.security_id AND k."timestamp" = n."timestamp")""")
def run_intraday(spark, sf_dir):
    settings, landed = _intraday(spark, sf_dir, "event_type = 'click'"), _candle_responses(spark, sf_dir)
    for _ in range(2):  # the second run adds nothing
        intraday.run_intraday(spark, settings, landed)
    return tables.read(spark, settings.intraday_table)


@query("job7_run_flagged_reload", f"""WITH {v.SPLIT}, {v.CANDLES}, {v.candles_sql('old', "event_type <> 'error'")},
eligible AS (SELECT DISTINCT scrip FROM old WHERE scrip IN (SELECT scrip FROM flagged))
SELECT {_CANDLE} FROM old WHERE scrip NOT IN (SELECT scrip FROM eligible)
UNION ALL SELECT {_CANDLE} FROM candles WHERE scrip IN (SELECT scrip FROM eligible)""")
def run_flagged_reload(spark, sf_dir):
    settings, landed = _intraday(spark, sf_dir, "event_type <> 'error'"), _candle_responses(spark, sf_dir)
    intraday.run_intraday_reload_for_flagged(spark, settings, stage(flagged_list(spark, sf_dir), "flagged"),
                                             lambda eligible, windows: landed)
    return tables.read(spark, settings.intraday_table)


@query("job6_windows", f"""WITH {v.TICKS}, {v.CANDLES}
SELECT scrip, DATE '1970-01-01' + CAST(7 * ("timestamp" // {WEEK}) AS INTEGER) AS from_date,
  CASE CAST(security_id AS BIGINT) % 10 WHEN 3 THEN 'failed' WHEN 4 THEN 'missing' ELSE 'ok' END AS outcome FROM candles GROUP BY ALL""")
def window_report(spark, sf_dir):
    """What became of every requested window: some failed, some never landed."""
    settings, every = _intraday(spark, sf_dir, "false"), _candle_responses(spark, sf_dir)
    digit = F.pmod("seq", F.lit(10))
    landed = every.where(digit != 4).withColumn("status", F.when(digit == 3, 500).otherwise(200))
    return intraday.run_intraday(spark, settings, landed, every)["windows"].select("scrip", "from_date", "outcome")


def _flagged_run(spark, sf_dir) -> tuple[Settings, str, dict]:
    settings = _daily(spark, sf_dir, temp=False)
    settings = Settings(daily_table=settings.daily_table, flag_table=settings.daily_table + "_flags")
    path = scratch(spark, "flags_csv")
    return settings, path, daily.run_daily(spark, settings, _bar_responses(spark, sf_dir), flags_csv=path)


@query("snk5_flag_rows", f"WITH {v.SPLIT} SELECT * FROM flags")
def flag_rows(spark, sf_dir):
    """The flag table that the daily job writes."""
    settings, _, _ = _flagged_run(spark, sf_dir)
    return spark.table(settings.flag_table).drop("run_ts")


@query("snk6_flags_csv", f"""WITH {v.SPLIT}
SELECT scrip, security_id, CAST(check_date AS VARCHAR) AS check_date, reason, field, fetched_value, stored_value FROM flags""")
def flags_csv(spark, sf_dir):
    """The CSV that the daily job writes, read back."""
    _, path, _ = _flagged_run(spark, sf_dir)
    read = spark.read.option("header", True).csv(path).drop("run_ts")
    return read.withColumns({c: F.col(c).cast("double") for c in ("fetched_value", "stored_value")})


@query("c4_empty_flags", f"""WITH {v.TICKS}, {v.BARS}
SELECT count(*) AS uploaded, 0 AS flags, 0 AS flags_written FROM bars WHERE trade_date = (SELECT max(trade_date) FROM bars)""")
def empty_flags(spark, sf_dir):
    """A fetch of one date has no date to check: typed flags without rows, all of it uploaded."""
    settings = _daily(spark, sf_dir, temp=False)
    bars = v.bars(spark, sf_dir)
    last = bars.agg(F.max("trade_date")).first()[0]
    at = F.unix_date("trade_date").cast("bigint") * 86400 + (9 * 60 + 15) * 60 - fixed.IST_OFFSET_SECONDS
    landed = _responses(bars.where(F.col("trade_date") == F.lit(last)).withColumn("timestamp", at).withColumn("at", at), 1440)
    r = daily.run_daily(spark, settings, landed)
    if r["flags"].schema != spark.createDataFrame([], schemas.FLAGS).schema:
        raise AssertionError(r["flags"].schema)
    return spark.createDataFrame([(r["uploaded"], r["flags"].count(), r["flags_written"])], "uploaded long, flags int, flags_written int")


@query("job5_run_dry", f"""WITH {m._RELOAD},
known AS (SELECT * FROM old WHERE exchange <> 'TEMP' OR trade_date <> DATE '{m.FROM}')
SELECT 'delete' AS action, 'temp' AS scope, count(*) AS rows, count(DISTINCT scrip) AS scrips FROM known WHERE exchange = 'TEMP'
UNION ALL SELECT 'delete', 'range', count(*), count(DISTINCT scrip) FROM known WHERE {m.IN_RANGE} AND exchange <> 'TEMP'
UNION ALL SELECT 'delete', 'flagged lifetime', count(*), count(DISTINCT scrip) FROM known WHERE scrip IN (SELECT scrip FROM flagged)
UNION ALL SELECT 'upsert', 'clean range', count(*), count(DISTINCT scrip) FROM clean
UNION ALL SELECT 'refetch', 'flagged lifetime', count(*), count(DISTINCT scrip) FROM flagged
UNION ALL SELECT 'lost', 'range', count(*), count(DISTINCT scrip) FROM known WHERE {m.IN_RANGE} AND exchange <> 'TEMP'
  AND scrip NOT IN (SELECT scrip FROM clean) AND scrip NOT IN (SELECT scrip FROM flagged)
UNION ALL SELECT 'table', 'after', count(*), count(DISTINCT scrip) FROM known""")
def run_dry(spark, sf_dir):
    """The plan of a range reload that only looks, and what the table holds after it."""
    settings = _daily(spark, sf_dir, temp=True)
    report = daily.run_daily_reload(spark, settings, _bar_responses(spark, sf_dir), "range", m.FROM, m.TO, dry_run=True)
    return report["plan"].unionByName(coverage.plan_line(tables.read(spark, settings.daily_table), "table", "after"))


@query("job12_latest_option", """SELECT CAST(max(o_orderdate) AS DATE) AS latest FROM orders
WHERE isodow(o_orderdate) < 6 AND substr(o_orderpriority, 1, 1) IN ('1', '2') AND o_orderstatus <> 'P'""")
def latest_option(spark, sf_dir):
    from barsmith.plans.coverage import latest_option_date

    settings, _ = _run_options(spark, sf_dir)
    return spark.createDataFrame([(latest_option_date(spark, settings),)], "latest date")


TRANCHE_DAYS = 500
_CELLS = """r AS (
  SELECT o_orderkey AS seq, CAST(o_orderdate AS DATE) AS trade_date, CASE o_orderstatus WHEN 'F' THEN 'MONTH' ELSE 'WEEK' END AS flag,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS code, o_totalprice AS price, epoch_us(o_orderdate) // 1000000 AS epoch,
         CASE WHEN o_totalprice > 250000 THEN 'CE' ELSE 'PE' END AS side, CAST(o_custkey AS VARCHAR) AS sid, o_orderstatus AS st
  FROM orders WHERE isodow(o_orderdate) < 6 AND substr(o_orderpriority, 1, 1) IN ('1', '2')),
good AS (SELECT * FROM r WHERE st <> 'P')"""


def _option_responses(spark, sf_dir) -> DataFrame:
    """Each order as an option response; the pending ones failed."""
    landed = ingest.option_landed(spark, sf_dir)
    status = v.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("bigint").alias("seq"), "o_orderstatus")
    return landed.join(status, "seq").withColumn("status", F.when(F.col("o_orderstatus") == "P", 500).otherwise(200)).drop("o_orderstatus")


def _order_range(spark, sf_dir) -> tuple:
    """All order dates: the first, and the day after the last."""
    day = F.col("o_orderdate").cast("date")
    return tuple(v.table(spark, sf_dir, "orders").agg(F.min(day), F.date_add(F.max(day), 1)).first())


def _option_table(spark) -> Settings:
    """Some two thousand trade dates of few rows each: a directory per month and load."""
    return Settings(option_table=_new_table(spark, "job_options", schemas.OPTIONS, "trade_date", by_month=True, by_load=True))


def _run_options(spark, sf_dir):
    settings = _option_table(spark)
    return settings, options.run_options(spark, settings, _option_responses(spark, sf_dir), *_order_range(spark, sf_dir), tranche_days=TRANCHE_DAYS)


@query("job8_run_options", f"""WITH {_CELLS},
chosen AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY trade_date, code, side, sid ORDER BY flag <> 'WEEK', seq) = 1)
SELECT trade_date, flag AS expiry_flag, code AS expiry_code, sid AS security_id, side AS option_type, epoch + 60 * p AS "timestamp",
       price AS "close", CAST(seq AS BIGINT) AS oi FROM chosen, range(0, 2) x(p)""")
def run_options(spark, sf_dir):
    settings, _ = _run_options(spark, sf_dir)
    return commits.read(spark, settings.option_table).select(
        "trade_date", "expiry_flag", "expiry_code", "security_id", "option_type", "timestamp", "close", "oi")


@query("job8_failed_cells", f"""WITH {_CELLS}
SELECT trade_date, code AS expiry_code, side AS option_type, CASE WHEN bool_or(st <> 'P') THEN 'ok' ELSE 'failed' END AS outcome
FROM r GROUP BY ALL""")
def failed_cells(spark, sf_dir):
    _, report = _run_options(spark, sf_dir)
    return report["cells"].where("outcome <> 'missing'").select("trade_date", "expiry_code", "option_type", "outcome")


@query("job8_repaired_cells", f"""WITH {_CELLS},
failed AS (SELECT trade_date, code, side FROM r GROUP BY ALL HAVING NOT bool_or(st <> 'P')),
late AS (SELECT r.* FROM r JOIN failed USING (trade_date, code, side) UNION ALL SELECT * FROM good)
SELECT trade_date, code AS expiry_code, side AS option_type, 2 * count(DISTINCT sid) AS rows FROM late GROUP BY ALL""")
def repaired_cells(spark, sf_dir):
    """A second run whose failed responses have been repaired fills exactly the cells that had no rows."""
    settings, _ = _run_options(spark, sf_dir)
    options.run_options(spark, settings, _option_responses(spark, sf_dir).withColumn("status", F.lit(200)), *_order_range(spark, sf_dir), tranche_days=TRANCHE_DAYS)
    return commits.read(spark, settings.option_table).groupBy("trade_date", "expiry_code", "option_type").agg(F.count("*").alias("rows"))


@query("job9_run_price_files", f"""WITH {v.TICKS},
rows AS (SELECT *, trade_date + CASE WHEN event_type = 'purchase' AND price > 300 THEN 1 ELSE 0 END AS file_day FROM ticks),
good AS (SELECT file_day FROM rows GROUP BY file_day HAVING bool_and(trade_date = file_day))
SELECT scrip AS symbol, event_type AS series, trade_date AS date,
  {', '.join(f'price AS {c}' for c in schemas.PRICE_NUMBERS if not c.startswith('deliv'))},
  CAST(NULL AS DOUBLE) AS deliv_qty, CAST(NULL AS DOUBLE) AS deliv_per
FROM rows WHERE file_day IN (SELECT file_day FROM good) AND file_day BETWEEN DATE '2024-01-02' AND DATE '2024-01-30'""")
def run_price_files(spark, sf_dir):
    settings = Settings(price_table=_new_table(spark, "job_prices", schemas.PRICE_FILE, "date", by_month=True))
    path = ingest.price_folder(spark, sf_dir)
    for _ in range(2):  # the second run adds nothing
        reference.run_price_files(spark, settings, path, "2024-01-02", "2024-01-30")
    return tables.read(spark, settings.price_table)


def archives(spark, sf_dir) -> DataFrame:
    """(path, content): one market-cap archive per order date. The first entry is no price list; some archives hold none, some are
    no archives, some are stale."""
    day = F.add_months(F.col("o_orderdate").cast("date"), 240)  # two-digit years are of this century
    cell = F.concat_ws(",", F.date_format(day, "dd MMM yyyy"), F.concat(F.lit("C"), F.col("o_orderkey").cast("string")),
                       "o_orderstatus", F.concat(F.lit('"Name, '), F.col("o_custkey").cast("string"), F.lit('"')), F.lit("Listed"), F.lit("-"),
                       F.lit("1"), F.lit("100"), F.lit("-"), F.col("o_totalprice").cast("string"))
    by_date = v.table(spark, sf_dir, "orders").groupBy(day.alias("day")).agg(F.collect_list(cell).alias("lines"))
    stale = F.day("day") == 7
    stamp = F.date_format(F.date_add("day", F.when(stale, 1).otherwise(0)), "ddMMyy")
    folder = F.when(stale, "/landing/PR010101/PR").otherwise("/landing/files/PR")
    files = by_date.select(F.concat(folder, stamp, F.lit(".zip")).alias("path"), F.day("day").alias("d"), "lines")
    header = ",".join(fixed.MCAP_COLUMNS)

    def pack(batches):
        import io
        import zipfile

        for batch in batches:
            contents = []
            for d, lines in zip(batch["d"], batch["lines"]):
                held = io.BytesIO()
                with zipfile.ZipFile(held, "w") as z:
                    z.writestr("readme.txt", "mcap")
                    z.writestr("pd.csv" if d == 8 else f"MCap{d}.csv", "\n".join([header, *lines]) + "\n")
                    z.writestr("mcap_later.csv", "another,header\n1,2\n") if d != 8 else None
                contents.append(b"no archive" if d == 9 else held.getvalue())
            yield batch[["path"]].assign(content=contents)
    return files.mapInPandas(pack, "path STRING, content BINARY")


_MCAP_SQL = """SELECT 'C' || o_orderkey AS symbol, o_orderstatus AS series, 'Name, ' || o_custkey AS security_name, 'Listed' AS category,
       CAST(NULL AS DATE) AS last_trade_date, 1.0::DOUBLE AS face_value, 100.0::DOUBLE AS issue_size, CAST(NULL AS DOUBLE) AS close_price,
       CAST(o_totalprice AS DOUBLE) AS market_cap, CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) AS trade_date
FROM orders WHERE day(o_orderdate) NOT IN (7, 8, 9)"""


@query("src3_market_cap", _MCAP_SQL)
def market_cap(spark, sf_dir):
    return landed_files.genuine(landed_files.typed_market_cap(archives(spark, sf_dir)), "trade_date")


@query("job10_run_market_cap", _MCAP_SQL)
def run_market_cap(spark, sf_dir):
    settings = Settings(mcap_table=_new_table(spark, "job_mcap", schemas.MCAP, "trade_date", by_month=True))
    reference.run_market_cap(spark, settings, stage(archives(spark, sf_dir), "archives"), "2010-01-01", "2030-01-01")
    return tables.read(spark, settings.mcap_table)


@query("job11_run_instrument_master", f"""WITH m AS (SELECT {ingest._PART}, p_retailprice AS STRIKE_PRICE FROM part)
SELECT EXCH_ID, SEGMENT, SECURITY_ID, INSTRUMENT, INSTRUMENT_TYPE, coalesce(ASM_GSM_CATEGORY, 'None') AS ASM_GSM_CATEGORY, STRIKE_PRICE,
       DATE '2026-08-27' AS SM_EXPIRY_DATE FROM m WHERE {ingest._KEPT}""")
def run_instrument_master(spark, sf_dir):
    name = _new_table(spark, "job_instruments", schemas.INSTRUMENTS, None)
    reference.run_instrument_master(spark, Settings(instrument_table=name), ingest.instrument_file(spark, sf_dir))
    return spark.table(name).select("EXCH_ID", "SEGMENT", "SECURITY_ID", "INSTRUMENT", "INSTRUMENT_TYPE", "ASM_GSM_CATEGORY",
                                    "STRIKE_PRICE", "SM_EXPIRY_DATE")


@query("job12_latest_and_counts", f"""WITH {v.TICKS}, {v.CANDLES}
SELECT max("timestamp") AS latest, count(*) AS candles FROM candles""")
def latest_and_counts(spark, sf_dir):
    from barsmith.plans.coverage import latest_intraday

    settings = _intraday(spark, sf_dir, "true")
    latest = latest_intraday(spark, settings)
    return tables.read(spark, settings.intraday_table).agg(F.unix_seconds(F.lit(latest).cast("timestamp")).alias("latest"),
                                                    F.count("*").alias("candles"))


@query("snk9_chunks", f"""WITH {_CELLS},
good_cells AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY trade_date, code, side, sid ORDER BY flag <> 'WEEK', seq) = 1)
SELECT trade_date, code AS expiry_code, CAST(2 * count(*) AS BIGINT) AS rows, 1 AS loads FROM good_cells GROUP BY ALL""")
def listed_chunks(spark, sf_dir):
    """The manifest of a run in which one tranche cannot be written whole and one chunk not at all (a strike no DECIMAL holds), and of
    the next run, which loads that chunk."""
    settings = _option_table(spark)
    landed = _option_responses(spark, sf_dir)
    usable = landed.where("expiry_code IN (1, 2) AND weekday(trade_date) < 5 AND status = 200")
    bad = usable.agg(F.min(F.struct("trade_date", "expiry_code")).alias("bad")).first()["bad"]
    spoilt = landed.withColumn("body", F.when((F.col("trade_date") == bad[0]) & (F.col("expiry_code") == bad[1]), F.regexp_replace(
        "body", r'"strike":\[[^]]*\]', '"strike":[1e40,1e40]')).otherwise(F.col("body")))
    for responses in (spoilt, landed):
        options.run_options(spark, settings, responses, *_order_range(spark, sf_dir), tranche_days=TRANCHE_DAYS)
    return spark.table(commits.manifest(settings.option_table)).groupBy("trade_date", "expiry_code").agg(
        F.sum("rows").alias("rows"), F.count("*").cast("int").alias("loads"))
