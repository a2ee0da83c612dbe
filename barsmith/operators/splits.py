"""Corporate actions: re-fetched history against stored history."""

from datetime import date

from pyspark.sql import DataFrame, functions as F

from barsmith import fixed, schemas
from barsmith.functions import columns as fn


def last_two_dates(df: DataFrame, column: str = "trade_date") -> DataFrame:
    """One row (last_date, check_date): the latest and the second latest date over all rows."""
    top = (df.select(F.col(column).alias("d")).where("d IS NOT NULL").distinct()
           .orderBy(F.desc("d")).limit(2))
    return top.agg(F.max("d").alias("last_date"),
                   F.when(F.count("d") > 1, F.min("d")).alias("check_date"))


def oldest_date_in(df: DataFrame, start, end, column: str = "trade_date") -> DataFrame:
    """One row (check_date): the oldest date inside [start, end]."""
    return df.where(F.col(column).between(start, end)).agg(F.min(column).alias("check_date"))


def empty_flags(spark) -> DataFrame:
    return spark.createDataFrame([], schemas.FLAGS)


def _on_date(df: DataFrame, check) -> DataFrame:
    if isinstance(check, DataFrame):
        # One row, so a broadcast; on a table partitioned by trade_date it prunes at run time.
        wanted = check.select(F.col("check_date").alias("trade_date"))
        return df.join(F.broadcast(wanted), "trade_date", "left_semi")
    return df.where(F.col("trade_date") == F.lit(check))


def split_flags(fetched: DataFrame, stored: DataFrame, check: date | DataFrame | None,
                decimals: int = 2, exchange_aware: bool = False) -> DataFrame:
    """One row per price field that differs on the check date, or per scrip not stored.

    `check` is a date, None, or a one-row DataFrame with `check_date`. The sides meet on scrip
    alone, so a scrip stored under several exchanges is compared with each of them, unless
    `exchange_aware`. Prices compare after rounding to the tick; a missing price is skipped.
    """
    if check is None:
        return empty_flags(fetched.sparkSession)
    keys = ["scrip", "exchange"] if exchange_aware else ["scrip"]
    known = _on_date(stored, check).select(
        *keys, *[fn.nan_to_null(c).alias(f"s_{c}") for c in fixed.PRICES], F.lit(True).alias("known"))
    both = _on_date(fetched, check).join(known, keys, "left")

    arms = []
    for c in fixed.PRICES:
        arms += [F.lit(fixed.MISMATCH), F.lit(c), fn.nan_to_null(c), F.col(f"s_{c}")]
    arms += [F.lit(fixed.MISSING), F.lit(None).cast("string"),
             F.lit(None).cast("double"), F.lit(None).cast("double")]
    long = both.select(
        F.current_timestamp().alias("run_ts"), "scrip",
        F.col("security_id").cast("string").alias("security_id"),
        F.col("trade_date").alias("check_date"), "known",
        F.stack(F.lit(len(fixed.PRICES) + 1), *arms)
        .alias("reason", "field", "fetched_value", "stored_value"))
    moved = (fn.tick_round("fetched_value", decimals) != fn.tick_round("stored_value", decimals))
    return long.where(
        ((F.col("reason") == fixed.MISMATCH) & F.col("known").isNotNull() & moved)
        | ((F.col("reason") == fixed.MISSING) & F.col("known").isNull())).drop("known")


def flagged_scrips(flags: DataFrame) -> DataFrame:
    """Distinct scrips with a mismatch; a scrip that is only missing is not flagged."""
    return flags.where(F.col("reason") == fixed.MISMATCH).select("scrip").distinct()
