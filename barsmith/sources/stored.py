"""Reads of stored tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith import commits, fixed
from barsmith.functions import columns as fn
from barsmith.operators.joins import only


def table_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """The table, or a typed empty frame if it does not exist. Other errors are errors."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def chunks_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """The rows of the table's listed chunks, or a typed empty frame if it does not exist."""
    return commits.read(spark, name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def daily_rows(daily: DataFrame, scrips: DataFrame, start, end) -> DataFrame:
    """Stored bars of the listed scrips in [start, end]; an empty list gives no rows.

    Every exchange is returned, temporary rows too.
    """
    wanted = F.col("trade_date").between(F.lit(fn.to_date_arg(start)), F.lit(fn.to_date_arg(end)))
    return only(daily.where(wanted), scrips).select("scrip", "trade_date", *fixed.PRICES, "volume")
