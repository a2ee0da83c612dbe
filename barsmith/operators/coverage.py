"""Counts, bounds and run reports."""

from pyspark.sql import Column, DataFrame, functions as F

from barsmith.functions import columns as fn
from barsmith.operators.joins import only
from barsmith.operators.mutate import in_range, is_temp


def latest_date(options: DataFrame, ticker: str | None = None) -> DataFrame:
    """One row (latest): the last trade date, of one ticker if named; NULL without rows."""
    if ticker is not None:
        options = options.where(F.col("security_ticker") == ticker)
    return options.agg(F.max("trade_date").alias("latest"))


def latest_candle(candles: DataFrame, scrip: str | None = None, interval: int | None = None) -> DataFrame:
    """One row (latest): the last candle's instant, optionally of one scrip or interval."""
    if scrip:
        candles = candles.where(F.col("scrip") == scrip)
    if interval:
        candles = candles.where(F.col("interval_m") == interval)
    return candles.agg(F.timestamp_seconds(F.max("timestamp")).alias("latest"))


def scrip_bounds(candles: DataFrame, scrips: DataFrame, interval: int) -> DataFrame:
    """Per listed scrip with candles of this interval: the first and last epoch second."""
    return (only(candles.where(F.col("interval_m") == interval), scrips)
            .groupBy("scrip").agg(F.min("timestamp").alias("min_ts"), F.max("timestamp").alias("max_ts")))


def overall_bounds(per_scrip: DataFrame) -> DataFrame:
    """One row (oldest, newest): IST dates over all scrips."""
    return per_scrip.agg(fn.ist_date(F.min("min_ts")).alias("oldest"),
                         fn.ist_date(F.max("max_ts")).alias("newest"))


def rows_per_date(df: DataFrame, condition: Column | None = None) -> DataFrame:
    df = df if condition is None else df.where(condition)
    return df.groupBy("trade_date").agg(F.count(F.lit(1)).alias("records")).orderBy("trade_date")


def count_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(F.count_if(condition).alias("n"))


def value_counts(df: DataFrame, column: str, kept: Column) -> DataFrame:
    """(scope, value, n) before and after the filter `kept`, NULLs left out, in one pass."""
    counted = (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
               .agg(F.count(F.lit(1)).alias("all"), F.count_if(kept).alias("filtered")))
    return (counted.select("value", F.stack(F.lit(2), F.lit("all"), F.col("all"),
                                            F.lit("filtered"), F.col("filtered")).alias("scope", "n"))
            .where("n > 0").orderBy("scope", F.desc("n"), "value").select("scope", "value", "n"))


def fetch_summary(df: DataFrame) -> DataFrame:
    """One row: rows, distinct scrips, first and last date."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("scrip").alias("scrips"),
                  F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """The sorted distinct values of a column, as rows."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def plan_line(df: DataFrame, action: str, scope: str) -> DataFrame:
    """One row of a dry-run plan: what a step would touch."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("scrip").alias("scrips")) \
        .select(F.lit(action).alias("action"), F.lit(scope).alias("scope"), "rows", "scrips")


def range_reload_plan(stored: DataFrame, clean: DataFrame, flagged: DataFrame, start, end,
                      clear_temp: bool = True) -> DataFrame:
    """What a range reload would delete and load; the flagged scrips' history is not fetched.

    `lost` lists stored rows in the range whose scrip is neither reloaded nor flagged. The
    stored table is counted per scrip in one pass; only one row per scrip is joined.
    """
    temp = F.coalesce(is_temp(), F.lit(False)) & F.lit(clear_temp)
    inside = F.coalesce(in_range(start, end), F.lit(False)) & ~temp
    per_scrip = stored.groupBy("scrip").agg(F.count_if(temp).alias("temp"), F.count_if(inside).alias("range"),
                                            F.count(F.lit(1)).alias("history"))
    reloaded = clean.groupBy("scrip").agg(F.count(F.lit(1)).alias("clean"))
    listed = flagged.groupBy("scrip").agg(F.lit(1).alias("flagged"))
    every = (per_scrip.join(reloaded, "scrip", "full").join(listed, "scrip", "full")
             .fillna(0, ["temp", "range", "history", "clean", "flagged"]))
    is_flagged = F.col("flagged") > 0
    lines = {
        ("delete", "range"): F.col("range"),
        ("delete", "flagged lifetime"): F.when(is_flagged, F.col("history")).otherwise(0),
        ("upsert", "clean range"): F.col("clean"),
        ("refetch", "flagged lifetime"): F.col("flagged").cast("bigint"),
        ("lost", "range"): F.when(~is_flagged & (F.col("clean") == 0), F.col("range")).otherwise(0),
    }
    if clear_temp:
        lines = {("delete", "temp"): F.col("temp")} | lines
    sums, arms = [], []
    for i, ((action, scope), n) in enumerate(lines.items()):
        sums += [F.coalesce(F.sum(n), F.lit(0)).alias(f"rows{i}"),
                 F.count_if((n > 0) & F.col("scrip").isNotNull()).alias(f"scrips{i}")]
        arms += [F.lit(action), F.lit(scope), F.col(f"rows{i}"), F.col(f"scrips{i}")]
    return every.agg(*sums).select(F.stack(F.lit(len(lines)), *arms).alias("action", "scope", "rows", "scrips"))
