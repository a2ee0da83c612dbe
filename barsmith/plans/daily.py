"""Daily ingest with split check, rollup of hourly candles, and daily reloads."""

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith import changes, fixed, schemas, snapshots, tables
from barsmith.functions import columns as fn
from barsmith.operators import coverage, mutate, rollup, splits
from barsmith.operators.joins import only, without
from barsmith.session import configure, stage
from barsmith.settings import Settings
from barsmith.sources import responses as landed
from barsmith.sources.stored import daily_rows


def _scrip_list(df: DataFrame) -> list[str]:
    """Sorted distinct scrips for a report: as many as there are tickers."""
    return sorted(r[0] for r in df.select("scrip").distinct().collect())


def _opened(spark: SparkSession, settings: Settings) -> Settings:
    """The settings with the table that holds the daily rows, made if need be: of a view over snapshots the current one."""
    make = snapshots.ensure if settings.snapshots else tables.ensure_table
    make(spark, settings.daily_table, schemas.DAILY, buckets=settings.buckets, cluster=["scrip"])
    return replace(settings, daily_table=snapshots.stored(spark, settings.daily_table))


def _fetched(responses: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Staged daily candles, and how many were rejected: no readable timestamp, or no part of the row id."""
    good, bad = fn.split_rejects(stage(landed.daily_candles(responses), label), "trade_date", "scrip", "exchange", "security_id")
    return good, bad.count()


def _source(rows: DataFrame, order=("seq", "pos")) -> DataFrame:
    """Staged upsert source: integer ids (others fail the job), first row of each row id."""
    typed = rows.withColumn("security_id", fn.strict_long("security_id", "security_id"))
    return stage(mutate.first_per_row_id(typed, order).select(*schemas.DAILY_COLUMNS), "upsert")


def _flag(spark: SparkSession, settings: Settings, fetched: DataFrame, check) -> DataFrame:
    stored = daily_rows(changes.current(spark, settings.daily_table), fetched.select("scrip"), check, check) \
        if check is not None else None
    return stage(splits.split_flags(fetched, stored, check, settings.price_decimals), "flags")


def _record_flags(spark: SparkSession, settings: Settings, flags: DataFrame, flags_csv: str | None) -> int:
    """Write all flag rows, if any scrip is flagged at all; the number written."""
    if splits.flagged_scrips(flags).isEmpty():
        return 0
    if flags_csv:
        tables.write_flags_csv(flags, flags_csv)
    if settings.flag_table:
        tables.ensure_table(spark, settings.flag_table, schemas.FLAGS, partition=None)
        tables.append(flags, settings.flag_table)
    return flags.count()


def _upsert(spark: SparkSession, settings: Settings, source: DataFrame) -> int:
    """Merge a source into the daily table, or record it beside the table; the number of its rows."""
    name = settings.daily_table
    if settings.merge_on_read and not changes.has_changes(spark, name):
        changes.start(spark, name)
    return (changes if changes.has_changes(spark, name) else tables).upsert(spark, name, source)


def recent_window(days: int = 4, as_of=None) -> tuple[date, date]:
    """(from, to): the last `days` calendar days up to `as_of` or today."""
    last = fn.to_date_arg(as_of) or date.today()
    return last - timedelta(days=days), last


def run_daily(spark: SparkSession, settings: Settings, responses: DataFrame,
              mapping: DataFrame | None = None, flags_csv: str | None = None) -> dict:
    """Check the second-last date against the stored bars, then upsert the last date.

    With a mapping, only its scrips count, and `missing` lists those for which nothing has landed.
    """
    settings.check("daily")
    configure(spark)
    settings = _opened(spark, settings)
    if mapping is not None:
        responses = only(responses, mapping)
    fetched, rejected = _fetched(responses, "fetched")
    failed = _scrip_list(landed.failed_scrips(responses))
    missing = without(mapping.select("scrip"), responses) if mapping is not None else responses.select("scrip").limit(0)
    summary = coverage.fetch_summary(fetched).first()
    last, check = splits.last_two_dates(fetched).first()
    report = {"rows": summary["rows"], "scrips": summary["scrips"], "last_date": last,
              "check_date": check, "failed": failed, "missing": _scrip_list(missing), "rejected": rejected, "fetched": fetched}
    if last is None:
        return {**report, "flags": splits.empty_flags(spark), "flagged": [], "flags_written": 0, "uploaded": 0}

    flags = _flag(spark, settings, fetched, check)
    flagged = splits.flagged_scrips(flags)
    written = _record_flags(spark, settings, flags, flags_csv)
    upload = fetched.where(F.col("trade_date") == F.lit(last))
    if not settings.upload_mismatched:
        upload = without(upload, flagged)
    uploaded = _upsert(spark, settings, _source(upload))
    return {**report, "flags": flags, "flagged": _scrip_list(flagged), "flags_written": written,
            "uploaded": uploaded}


def run_daily_from_hourly(spark: SparkSession, settings: Settings, responses: DataFrame, start_date,
                          opens: str = fixed.MARKET_OPEN, closes: str = fixed.MARKET_CLOSE,
                          clear_old_temp: bool = True, interval: int | None = None, requests: DataFrame | None = None) -> dict:
    """Roll hourly candles up to temporary daily bars and upsert them.

    Old temporary rows go first; those before `start_date` go again at the end. Landed candles of several intervals would count
    twice, so `interval` picks one; without it they must all have the same. `failed_windows` (scrip, from_date, to_date, error)
    lists every landed window without candles, and with `requests` (scrip, from_date, to_date) every one that never landed; `rejected`
    counts candles without a readable timestamp.
    """
    settings.check("daily")
    configure(spark)
    table, name, start = settings.daily_table, _opened(spark, settings).daily_table, fn.to_date_arg(start_date)
    if interval is not None:
        responses = responses.where(F.col("interval_m") == interval)
    elif responses.select("interval_m").distinct().count() > 1:
        raise ValueError("responses of several intervals have landed: name one as interval")
    read, unread = fn.split_rejects(stage(landed.hourly_rows(responses), "hourly_rows"), "timestamp")
    candles = stage(landed.open_hours(read, opens, closes), "hourly")
    windows = stage(landed.failed_windows(responses, requests), "failed_windows")
    changes.fold_all(spark, name)
    bars = rollup.daily_bars(candles).withColumn("row_id", fn.row_id())
    source = stage(bars.select(*schemas.DAILY_COLUMNS), "bars")
    failed = _scrip_list(windows.select("scrip").unionByName(without(responses, candles.select("scrip")).select("scrip")))
    if clear_old_temp:
        tables.delete_temp(spark, name)
    uploaded = tables.upsert(spark, name, source)
    if clear_old_temp:
        tables.delete_temp(spark, name, before=start)
    return {"fetched": candles.count(), "uploaded": uploaded, "failed": failed, "failed_windows": windows,
            "rejected": unread.count(), "table": table,
            "check": coverage.rows_per_date(spark.table(name), mutate.is_temp())}


def run_lifetime_reload(spark: SparkSession, settings: Settings, responses: DataFrame | None,
                        clear_temp: bool = True, dry_run: bool = False) -> dict:
    """Replace the whole daily table by re-fetched history, in one write, or by a new snapshot of a table that has them.

    A fetch without rows leaves the history as it is. A dry run needs no responses.
    """
    settings.check("daily")
    configure(spark)
    table, name = settings.daily_table, _opened(spark, settings).daily_table
    stored = changes.current(spark, name)
    report = {"mode": "lifetime", "table": table, "dry_run": dry_run, "flagged": []}
    if dry_run:
        plan = coverage.plan_line(stored, "delete", "all")
        if clear_temp:
            plan = coverage.plan_line(stored.where(mutate.is_temp()), "delete", "temp").unionByName(plan)
        return {**report, "plan": plan, "existing_rows": stored.count(), "fetched": 0, "uploaded": 0, "failed": []}
    fetched, rejected = _fetched(responses, "lifetime")
    source = _source(fetched)
    uploaded = source.count()
    changes.fold_all(spark, name)
    if uploaded:
        snapshots.replace(source, table)
    elif clear_temp:
        tables.delete_temp(spark, name)
    return {**report, "fetched": fetched.count(), "uploaded": uploaded, "rejected": rejected,
            "failed": _scrip_list(landed.failed_scrips(responses))}


def run_range_reload(spark: SparkSession, settings: Settings, responses: DataFrame, from_date, to_date,
                     lifetime: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
                     flags_csv: str | None = None, clear_temp: bool = True,
                     drop_unfetched: bool = False, dry_run: bool = False) -> dict:
    """Reload [from_date, to_date]; flagged scrips get their whole history replaced.

    `responses` may start some days earlier; the split check uses the oldest date inside the
    range. `lifetime` holds the flagged scrips' landed history, or is a function that lands it
    for a list of scrips. While a flagged scrip has none, nothing is changed and the report lists
    it under `need_lifetime`; `drop_unfetched` deletes its history all the same.
    """
    settings.check("daily")
    configure(spark)
    table, settings = settings.daily_table, _opened(spark, settings)
    name, start, end = settings.daily_table, fn.to_date_arg(from_date), fn.to_date_arg(to_date)
    if not dry_run:
        changes.fold_all(spark, name)
    stored = changes.current(spark, name)
    fetched, rejected = _fetched(responses, "fetched")
    failed = _scrip_list(landed.failed_scrips(responses))
    report = {"mode": "range", "table": table, "dry_run": dry_run, "fetched": fetched.count(),
              "rejected": rejected, "failed": failed, "flagged": [], "need_lifetime": [], "uploaded_range": 0,
              "uploaded_lifetime": 0, "uploaded": 0, "check_date": None}
    if not report["fetched"]:
        if clear_temp and not dry_run:
            tables.delete_temp(spark, name)
        return report

    check = splits.oldest_date_in(fetched, start, end).first()[0]
    flags = _flag(spark, settings, fetched, check)
    flagged = splits.flagged_scrips(flags)
    clean = without(fetched.where(mutate.in_range(start, end)), flagged)
    report.update(check_date=check, flags=flags, flagged=_scrip_list(flagged))
    if dry_run:
        return {**report, "plan": coverage.range_reload_plan(stored, clean, flagged, start, end, clear_temp)}

    _record_flags(spark, settings, flags, flags_csv)
    history = lifetime(flagged) if callable(lifetime) else lifetime
    if history is None:
        history = responses.where(F.lit(False))
    refetched, unread = _fetched(only(history, flagged), "lifetime")
    report["rejected"] = rejected + unread
    again = _source(refetched)
    report["need_lifetime"] = _scrip_list(without(flagged, again))
    if report["need_lifetime"] and not drop_unfetched:
        return report

    clean = _source(clean)
    layout = tables.layout_of(spark, name)
    touched = tables.units_between(spark, name, start, end, layout) | tables.units_with(spark, name, flagged)
    touched |= tables.units_in(clean, layout) | tables.units_in(again, layout)
    if clear_temp and layout.buckets:  # temporary rows are dropped below, unread
        touched = {u for u in touched if u[-1] != tables.TEMP_BUCKET}
    elif clear_temp:
        touched |= tables.units_in(stored.where(mutate.is_temp()), layout)
    here = tables.at(spark.table(name), layout, touched).select(*schemas.DAILY_COLUMNS)
    tables.overwrite_units(spark, name, mutate.range_reload(here, clean, again, flagged, start, end, clear_temp), touched)
    if clear_temp:
        tables.delete_temp(spark, name)
    report.update(uploaded_range=clean.count(), uploaded_lifetime=again.count())
    report["uploaded"] = report["uploaded_range"] + report["uploaded_lifetime"]
    if callable(lifetime) or lifetime is not None:
        report["failed"] = failed + _scrip_list(landed.failed_scrips(only(history, flagged)))
    return report


def run_daily_reload(spark: SparkSession, settings: Settings, responses: DataFrame | None, mode: str,
                     from_date=None, to_date=None, **options) -> dict:
    """Reload the daily table: mode 'lifetime' or 'range'."""
    if mode == "lifetime":
        return run_lifetime_reload(spark, settings, responses, **options)
    if mode == "range":
        if not from_date or not to_date:
            raise ValueError("a range reload takes two dates: from_date, to_date")
        return run_range_reload(spark, settings, responses, from_date, to_date, **options)
    raise ValueError(f"unknown reload mode {mode!r}; there are 'lifetime' and 'range'")
