"""Roll candles up to coarser OHLCV bars."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from barsmith.functions import columns as fn

INSTRUMENT = ("scrip", "exchange", "security_id")


def ohlcv(order: str) -> list[Column]:
    """First open, highest high, lowest low, last close, summed volume, by the `order` column.

    NULLs are skipped, so the first open is the first known one; volume without any value is 0.
    Every buffer has a fixed width: Spark plans a partial and a final hash aggregate.
    """
    return [
        F.expr(f"min_by(open, CASE WHEN open IS NOT NULL THEN {order} END) AS open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.expr(f"max_by(close, CASE WHEN close IS NOT NULL THEN {order} END) AS close"),
        F.expr("coalesce(sum(volume), 0D) AS volume"),
    ]


def all_known(keys: Sequence[str]) -> str:
    return " AND ".join(f"{k} IS NOT NULL" for k in keys)


def _grouped(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    # The order is a column of its own, so that first and last share one evaluation.
    return df.where(all_known(keys)).withColumn("_order", order).groupBy(*keys).agg(*ohlcv("_order"))


#: A bar that can take more candles: the order of its first known open and last known close beside them.
STATE_VALUES = ("open_at", "open", "high", "low", "close_at", "close", "volume")
_ORDER = "DECIMAL(38, 0)"


def bar_states(candles: DataFrame, epoch: str = "timestamp", order: Column | None = None,
               instrument: Sequence[str] = INSTRUMENT) -> DataFrame:
    """One mergeable bar per IST date and instrument, by the rules of `daily_bars`."""
    keys = ["trade_date", *instrument]
    order = (F.col(epoch) if order is None else order).cast(_ORDER)
    dated = candles.withColumn("trade_date", fn.ist_date(epoch)).where(all_known(keys)).withColumn("_order", order)
    known = dated.withColumns({"open_at": F.expr("CASE WHEN open IS NOT NULL THEN _order END"),
                               "close_at": F.expr("CASE WHEN close IS NOT NULL THEN _order END")})
    return merge_states(known, keys)


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of the same keys as one: the earliest open, the latest close, the extremes, the sum. In any order and grouping."""
    return states.groupBy(*keys).agg(
        F.min("open_at").alias("open_at"), F.min_by("open", "open_at").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max("close_at").alias("close_at"), F.max_by("close", "close_at").alias("close"), F.expr("coalesce(sum(volume), 0D) AS volume"))


def market_hours(candles: DataFrame, epoch: str = "timestamp", **clock) -> DataFrame:
    return candles.where(fn.in_market_hours(epoch, **clock))


def daily_bars(candles: DataFrame, epoch: str = "timestamp", order: Column | None = None,
               instrument: Sequence[str] = INSTRUMENT) -> DataFrame:
    """One bar per IST date and instrument. `order` breaks ties when `epoch` alone does not."""
    order = F.col(epoch) if order is None else order
    return _grouped(candles.withColumn("trade_date", fn.ist_date(epoch)),
                    ["trade_date", *instrument], order)


def interval_bars(ticks: DataFrame, minutes: int, epoch: str = "timestamp",
                  order: Column | None = None, instrument: Sequence[str] = INSTRUMENT) -> DataFrame:
    """One candle per `minutes` and instrument, stamped with its start."""
    order = F.col(epoch) if order is None else order
    width = minutes * 60
    start = (F.col(epoch) - F.pmod(F.col(epoch), F.lit(width))).alias("_start")
    bars = _grouped(ticks.withColumn("_start", start), ["_start", *instrument], order)
    return bars.withColumnRenamed("_start", "timestamp").withColumn("interval_m", F.lit(minutes))
