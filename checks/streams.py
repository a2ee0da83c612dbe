"""The incremental jobs: run to the end of the available input, then read the table they keep."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith import schemas, tables
from barsmith.functions import columns as fn
from barsmith.operators import splits
from barsmith.session import scratch, stage
from barsmith.streaming import candles as streaming
from checks import views as v
from checks.bars import OHLCV
from checks.registry import query


def _stream_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file as a stream of ticks."""
    schema = v.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return v.as_ticks(events)


def _new_table(spark: SparkSession, label: str, schema: str, partition: str | None, **layout) -> str:
    path = scratch(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    tables.ensure_table(spark, name, schema, partition, location=path, **layout)
    return name


def _finish(query_) -> None:
    query_.awaitTermination()
    if query_.exception():
        raise query_.exception()


@query("st1_stream_append_new", f"""WITH {v.TICKS}, known AS (SELECT security_id, "timestamp" FROM ticks WHERE event_type = 'click')
SELECT scrip, CAST(security_id AS VARCHAR) AS security_id, "timestamp", trade_date FROM ticks t
WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.security_id = t.security_id AND k."timestamp" = t."timestamp")
GROUP BY ALL
UNION ALL SELECT scrip, CAST(security_id AS VARCHAR), "timestamp", trade_date FROM ticks WHERE event_type = 'click' GROUP BY ALL""")
def stream_append_new(spark, sf_dir):
    def shaped(ticks):
        return ticks.withColumn("security_id", F.col("security_id").cast("string")).withColumn("interval_m", F.lit(1)) \
            .select(*[c for c in schemas.INTRADAY_COLUMNS if c != "trade_date"])

    name = _new_table(spark, "st1", schemas.INTRADAY, "trade_date")
    known = shaped(v.ticks(spark, sf_dir).where("event_type = 'click'")).dropDuplicates(streaming.CANDLE_KEY)
    tables.append(known.withColumn("trade_date", fn.ist_date("timestamp")), name)
    _finish(streaming.append_candles(shaped(_stream_ticks(spark, sf_dir)), name))
    return spark.table(name).select("scrip", "security_id", "timestamp", "trade_date")


@query("st2_stream_daily_bars", f"""WITH {v.TICKS}, {v.BARS}
SELECT scrip, exchange, security_id, trade_date, {OHLCV}, {v.ID} AS row_id FROM bars""")
def stream_daily_bars(spark, sf_dir):
    name = _new_table(spark, "st2", schemas.DAILY, "trade_date")
    # Every candle lands twice, in files of its own.
    made = v.candles(spark, sf_dir).select(*schemas.INTRADAY_COLUMNS)
    landed = stage(made.unionAll(made), "st2_landed")
    source = spark.readStream.schema(landed.schema).parquet(landed.inputFiles()[0].rsplit("/", 1)[0])
    kept = _new_table(spark, "st2_candles", schemas.INTRADAY, "trade_date")
    _finish(streaming.daily_bars(source.drop("trade_date"), name, kept))
    return spark.table(name)


@query("st3_stream_split_flags", f"""WITH {v.SPLIT},
first_day AS (SELECT min(trade_date) AS d FROM days),
early AS ({v.flags_sql('bars', 'stored', '(SELECT d FROM first_day)')})
SELECT * FROM flags UNION ALL SELECT * FROM early""")
def stream_split_flags(spark, sf_dir):
    """Two runs, for two check dates, into one flag table."""
    # The re-fetched and the stored bars as written tables: the stream's input and its other side.
    known = _new_table(spark, "st3_stored", schemas.DAILY, "trade_date")
    tables.append(v.with_id(v.stored(spark, sf_dir)), known)
    fetched = stage(v.bars(spark, sf_dir), "st3_fetched")
    first = fetched.agg(F.min("trade_date")).first()[0]
    flags = _new_table(spark, "st3_flags", schemas.FLAGS + ", batch_key STRING", "batch_key")
    for check in (splits.last_two_dates(fetched).first()["check_date"], first):
        source = spark.readStream.schema(fetched.schema).parquet(fetched.inputFiles()[0].rsplit("/", 1)[0])
        _finish(streaming.split_flags(source, known, flags, check, scratch(spark, "st3_run")))
    return spark.table(flags).drop("run_ts", "batch_key")
