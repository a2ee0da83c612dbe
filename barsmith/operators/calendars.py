"""Calendars, request grids and expiry ranks as DataFrames. Grids grow by explode, not by join."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barsmith import fixed
from barsmith.functions import columns as fn
from barsmith.operators.mutate import value_range


def days(spark: SparkSession, start, end) -> DataFrame:
    """Calendar days in [start, end]."""
    start, end = fn.to_date_arg(start), fn.to_date_arg(end)
    span = max((end - start).days + 1, 0)
    return spark.range(span).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))


def recent_window(df: DataFrame, days_back: int = 4, as_of=None) -> DataFrame:
    """Add (from_date, to_date): the last `days_back` calendar days up to `as_of` or today."""
    last = F.current_date() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(fn.to_date_arg(as_of)))
    return df.withColumn("from_date", F.date_sub(last, days_back)).withColumn("to_date", last)


def with_stepped_windows(df: DataFrame, *, start, n: int, window_days: int, step_days: int) -> DataFrame:
    """Each row of `df` with each of `n` half-open windows [start + i*step, + window_days).

    `start` is a date or a date column of `df`.
    """
    start = start if isinstance(start, Column) else F.lit(fn.to_date_arg(start))
    if n < 1:
        return (df.withColumn("window_no", F.lit(0)).withColumn("from_date", start)
                .withColumn("to_date", start).where(F.lit(False)))
    return (df.withColumn("window_no", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
            .withColumn("from_date", F.date_add(start, F.col("window_no") * step_days))
            .withColumn("to_date", F.date_add(F.col("from_date"), window_days)))


def stepped_windows(spark: SparkSession, *, start, n: int, window_days: int, step_days: int) -> DataFrame:
    return with_stepped_windows(spark.range(1), start=start, n=n, window_days=window_days,
                                step_days=step_days).drop("id")


def with_contiguous_windows(df: DataFrame, *, start, end, window_days: int) -> DataFrame:
    """Each row of `df` with the half-open windows that tile [start, end] exactly.

    The last window is clipped to end + 1. A row with end before start fails the job.
    """
    if window_days < 1:
        raise ValueError("window_days must be at least 1")
    start = start if isinstance(start, Column) else F.lit(fn.to_date_arg(start))
    end = end if isinstance(end, Column) else F.lit(fn.to_date_arg(end))
    span = F.when(end < start, F.raise_error(F.lit("end is before start")).cast("int")) \
            .otherwise(F.datediff(end, start))
    last = F.floor(span / window_days).cast("int")
    return (df.withColumn("window_no", F.explode(F.sequence(F.lit(0), last)))
            .withColumn("from_date", F.date_add(start, F.col("window_no") * window_days))
            .withColumn("to_date", F.least(F.date_add(F.col("from_date"), window_days),
                                           F.date_add(end, 1))))


def contiguous_windows(spark: SparkSession, *, start, end, window_days: int) -> DataFrame:
    start, end = fn.to_date_arg(start), fn.to_date_arg(end)
    if end < start:
        raise ValueError(f"no window fits from {start} to {end}")
    return with_contiguous_windows(spark.range(1), start=start, end=end,
                                   window_days=window_days).drop("id")


def in_stepped_windows(df: DataFrame, column: str, *, start, n: int, window_days: int,
                       step_days: int) -> DataFrame:
    """Each row of `df` once per stepped window that holds its date; no join.

    A date `o` days after the start lies in windows ceil((o - window + 1) / step) .. o / step.
    """
    start = start if isinstance(start, Column) else F.lit(fn.to_date_arg(start))
    offset = F.datediff(F.col(column), start)
    first = F.greatest(F.lit(0), F.ceil((offset - window_days + 1) / step_days).cast("int"))
    last = F.least(F.lit(n - 1), F.floor(offset / step_days).cast("int"))
    return (df.withColumn("_first", first).withColumn("_last", last).where("_first <= _last")
            .withColumn("window_no", F.explode(F.sequence("_first", "_last")))
            .drop("_first", "_last"))


def holiday_table(spark: SparkSession, holidays: Sequence = fixed.HOLIDAYS) -> DataFrame:
    return spark.createDataFrame([(d,) for d in holidays], "holiday DATE")


def open_days(df: DataFrame, holidays: DataFrame, column: str = "day") -> DataFrame:
    """Rows whose date is a weekday outside `holidays`."""
    shut = holidays.select(F.col("holiday").alias(column)).distinct()
    return df.where(F.weekday(column) < 5).join(shut, column, "left_anti")


def trading_days(spark: SparkSession, start, end, holidays: DataFrame | None = None) -> DataFrame:
    """Weekdays in [start, end) that are no holidays."""
    shut = holiday_table(spark) if holidays is None else holidays
    every = days(spark, start, end).where(F.col("day") < F.lit(fn.to_date_arg(end)))
    return open_days(every, shut)


def expiry_lookup(pairs: DataFrame, codes: Sequence[int] = fixed.EXPIRY_CODES) -> DataFrame:
    """The k-th expiry on or after each trade date, for k in `codes`, and its MONTH/WEEK flag.

    `pairs` lists (trade_date, expiry_date). MONTH marks the last expiry the list has in a month.
    """
    if not codes or min(codes) < 1:
        raise ValueError("expiry codes start at 1")
    listed = pairs.select("trade_date", "expiry_date").where("expiry_date IS NOT NULL")
    # One row per calendar month: small by construction.
    monthly = (listed.groupBy(F.year("expiry_date").alias("y"), F.month("expiry_date").alias("m"))
               .agg(F.max("expiry_date").alias("expiry_date"))
               .select("expiry_date", F.lit("MONTH").alias("monthly")))
    by_date = Window.partitionBy("trade_date").orderBy("expiry_date")
    ranked = (listed.where("expiry_date >= trade_date").distinct()
              .withColumn("expiry_code", F.row_number().over(by_date))
              .where((F.col("expiry_code") <= max(codes)) & F.col("expiry_code").isin(list(codes))))
    return (ranked.join(F.broadcast(monthly), "expiry_date", "left")
            .select("trade_date", "expiry_code", "expiry_date",
                    F.coalesce("monthly", F.lit("WEEK")).alias("expiry_flag")))


def with_expiry(pairs: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Add expiry_date and expiry_flag to (trade_date, expiry_code); unknown ones get WEEK."""
    if lookup is None:
        return (pairs.withColumn("expiry_date", F.lit(None).cast("date"))
                .withColumn("expiry_flag", F.lit(fixed.DEFAULT_EXPIRY_FLAG)))
    return (pairs.join(lookup, ["trade_date", "expiry_code"], "left")
            .withColumn("expiry_flag", F.coalesce("expiry_flag", F.lit(fixed.DEFAULT_EXPIRY_FLAG))))


def expiry_pairs(trade_days: DataFrame, codes: Sequence[int], column: str = "day") -> DataFrame:
    """Every (trade_date, expiry_code)."""
    return trade_days.select(F.col(column).alias("trade_date"),
                             F.explode(F.array(*[F.lit(c) for c in codes])).alias("expiry_code"))


def pending(pairs: DataFrame, done: DataFrame) -> DataFrame:
    """Pairs that `done` lacks; a pair with any stored row counts as done.

    The pairs' date range goes to the stored scan as literals, so it prunes partitions.
    """
    keys = ["trade_date", "expiry_code"]
    low, high = value_range(pairs, "trade_date")
    inside = done.where(F.col("trade_date").between(F.lit(low), F.lit(high)))
    return pairs.join(inside.select(*keys).distinct(), keys, "left_anti")


def tranches(pairs: DataFrame, size: int, column: str = "trade_date") -> DataFrame:
    """(date, tranche): the sorted distinct dates in chunks of `size`, numbered from 0.

    The window sees one row per date, which the calendar bounds.
    """
    dates = pairs.select(column).distinct()
    n = F.row_number().over(Window.orderBy(column))
    return dates.withColumn("tranche", F.floor((n - 1) / size).cast("int"))


def option_requests(pairs: DataFrame, offsets: Sequence[int] = fixed.OPTION_OFFSETS) -> DataFrame:
    """Each pair with every strike offset and both option types."""
    sides = F.array(*[F.struct(F.lit(k).alias("api_type"), F.lit(v).alias("option_type"))
                      for k, v in fixed.OPTION_TYPES.items()])
    return (pairs.withColumn("strike_offset", F.explode(F.array(*[F.lit(o) for o in offsets])))
            .select("*", F.inline(sides))
            .withColumn("strike_label", fn.offset_label("strike_offset")))


def request_cost(requests: DataFrame) -> DataFrame:
    """One row (calls, hours) that a request grid takes."""
    calls = F.count(F.lit(1))
    return requests.agg(calls.alias("calls"), (calls * fixed.SECONDS_PER_CALL / 3600).alias("hours"))
