"""Coverage checks before a run."""

from pyspark.sql import SparkSession

from barsmith import schemas, tables
from barsmith.operators import coverage
from barsmith.operators.joins import names
from barsmith.settings import Settings
from barsmith.sources.stored import chunks_or_empty, table_or_empty


def latest_intraday(spark: SparkSession, settings: Settings, scrip: str | None = None,
                    interval: int | None = None):
    """The instant of the last stored candle, or None."""
    settings.check("intraday")
    stored = table_or_empty(spark, settings.intraday_table, schemas.INTRADAY)
    if scrip and spark.catalog.tableExists(settings.intraday_table):
        stored = tables.rows_of(spark, settings.intraday_table, names(spark, [scrip]))
    return coverage.latest_candle(stored, scrip, interval).first()[0]


def latest_option_date(spark: SparkSession, settings: Settings, ticker: str = "NIFTY"):
    """The last stored trade date of a ticker, or None."""
    settings.check("options")
    stored = chunks_or_empty(spark, settings.option_table, schemas.OPTIONS)
    return coverage.latest_date(stored, ticker).first()[0]
