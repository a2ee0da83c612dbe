"""Intraday ingest and the reload of flagged scrips."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith import schemas, tables
from barsmith.functions import columns as fn
from barsmith.operators import calendars, coverage, mutate
from barsmith.operators.joins import only, without
from barsmith.session import configure, stage
from barsmith.settings import Settings
from barsmith.sources import responses as landed
from barsmith.sources.stored import table_or_empty

CANDLE_KEY = ["security_id", "timestamp", "interval_m"]


def window_requests(mapping: DataFrame, *, start, n: int = 9, window_days: int = 4, step_days: int = 7,
                    interval: int = 15) -> DataFrame:
    """The requests a fetcher has to land: each scrip with each stepped window."""
    return calendars.with_stepped_windows(mapping, start=start, n=n, window_days=window_days,
                                          step_days=step_days).withColumn("interval_m", F.lit(interval))


def _clean(responses: DataFrame) -> tuple[DataFrame, int]:
    """Staged clean candles, and how many were rejected for an unreadable key."""
    good, bad = fn.split_rejects(stage(landed.intraday_rows(responses), "rows"), "timestamp", "interval_m")
    return stage(landed.first_candles(good), "candles"), bad.count()


def _counts(responses: DataFrame) -> tuple[int, int]:
    """(responses with rows, responses without)."""
    full = F.col("outcome") == "ok"
    ok, other = landed.outcomes(responses).agg(F.count_if(full), F.count_if(~full)).first()
    return ok, other


def run_intraday(spark: SparkSession, settings: Settings, responses: DataFrame, requests: DataFrame | None = None) -> dict:
    """Append the candles that are not stored yet.

    `windows` holds the outcome of every landed window, or of every one of `requests` (`window_requests`): ok, none, failed or missing;
    `unfinished` counts those that failed or never landed.
    """
    settings.check("intraday")
    configure(spark)
    name = settings.intraday_table
    tables.ensure_table(spark, name, schemas.INTRADAY, buckets=settings.buckets, cluster=["scrip", "timestamp"])
    ok, failed = _counts(responses)
    windows = stage(landed.window_outcomes(responses, requests), "windows")
    report = {"responses": ok, "failed": failed, "loaded": 0, "table": name, "windows": windows,
              "unfinished": windows.where(F.col("outcome").isin("failed", "missing")).count()}
    candles, report["rejected"] = _clean(responses)
    fresh = stage(mutate.append_new(candles, spark.table(name), CANDLE_KEY, "trade_date"), "fresh")
    report["loaded"] = fresh.count()
    if report["loaded"]:
        tables.append(fresh, name)
    return report


def flagged_bounds(spark: SparkSession, settings: Settings, flagged: DataFrame, interval: int = 15) -> dict:
    """Flagged scrips with candles of this interval, the others, and the overall IST span."""
    stored = table_or_empty(spark, settings.intraday_table, schemas.INTRADAY)
    bounds = stage(coverage.scrip_bounds(stored, flagged, interval), "bounds")
    oldest, newest = coverage.overall_bounds(bounds).first()
    return {"eligible": bounds.select("scrip"), "not_eligible": without(flagged, bounds),
            "oldest": oldest, "newest": newest}


def run_intraday_reload_for_flagged(spark: SparkSession, settings: Settings, flagged: DataFrame, land,
                                    interval: int = 15, window_days: int = 5, dry_run: bool = False) -> dict:
    """Replace the stored candles of flagged scrips that have any at this interval.

    `land(eligible, windows)` returns the landed responses for each eligible scrip and window.
    Old and new rows are exchanged in one write, after the responses have been read; if none
    has rows, nothing is changed.
    """
    settings.check("intraday")
    configure(spark)
    name = settings.intraday_table
    tables.ensure_table(spark, name, schemas.INTRADAY, buckets=settings.buckets, cluster=["scrip", "timestamp"])
    span = flagged_bounds(spark, settings, flagged, interval)
    eligible = span["eligible"]
    report = {"eligible": sorted(r[0] for r in eligible.collect()),
              "not_eligible": sorted(r[0] for r in span["not_eligible"].select("scrip").distinct().collect()),
              "oldest": span["oldest"], "newest": span["newest"], "loaded": 0, "failed": 0,
              "windows": 0, "table": name, "dry_run": dry_run}
    if not report["eligible"]:
        return report
    windows = calendars.contiguous_windows(spark, start=span["oldest"], end=span["newest"],
                                           window_days=window_days)
    report["windows"] = windows.count()
    if dry_run:
        return report

    responses = only(land(eligible, windows), eligible)
    report["failed"] = _counts(responses)[1]
    fresh, report["rejected"] = _clean(responses)
    report["loaded"] = fresh.count()
    if not report["loaded"]:
        return report
    same, layout = F.col("interval_m") == interval, tables.layout_of(spark, name)
    touched = tables.units_with(spark, name, eligible, same) | tables.units_in(fresh, layout)
    here = tables.at(spark.table(name), layout, touched).select(*schemas.INTRADAY_COLUMNS)
    rows = mutate.delete_scrips(here, eligible, same).unionByName(fresh.select(*here.columns))
    tables.overwrite_units(spark, name, rows, touched)
    return report
