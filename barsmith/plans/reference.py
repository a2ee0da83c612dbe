"""Price files, market cap and the instrument master."""

from pyspark.sql import DataFrame, SparkSession

from barsmith import fixed, schemas, snapshots, tables
from barsmith.functions import columns as fn
from barsmith.operators import coverage, joins
from barsmith.session import configure, stage
from barsmith.settings import Settings
from barsmith.sources import landed_files


def _append_files(spark: SparkSession, settings: Settings, name: str, rows: DataFrame, schema: str, date_column: str) -> dict:
    tables.ensure_table(spark, name, schema, partition=date_column, by_month=settings.files_by_month)
    days = tables.column_values(rows, date_column)
    report = {"fetched_days": days, "loaded": 0, "table": name}
    if not days:
        return report
    stored = tables.dated(spark, name, days[0], days[-1])
    fresh = stage(joins.not_stored(rows, stored, [date_column, "symbol", "series"]), "fresh")
    report["loaded"] = fresh.count()
    if report["loaded"]:
        tables.append(fresh, name)
    return report


def _check_range(start, end) -> None:
    if fn.to_date_arg(end) < fn.to_date_arg(start):
        raise ValueError(f"no days from {start} to {end}")


def run_price_files(spark: SparkSession, settings: Settings, path: str, start, end) -> dict:
    """Append new (date, symbol, series) rows of the daily price files in [start, end]."""
    settings.check("prices")
    _check_range(start, end)
    configure(spark)
    rows = landed_files.price_files(spark, path, start, end)
    return _append_files(spark, settings, settings.price_table, rows, schemas.PRICE_FILE, "date")


def run_market_cap(spark: SparkSession, settings: Settings, archives: str | DataFrame, start, end) -> dict:
    """Append new (trade_date, symbol, series) rows of the market-cap archives in [start, end]; archives: a path, or a frame
    of (path, content)."""
    settings.check("market_cap")
    _check_range(start, end)
    configure(spark)
    rows = landed_files.market_cap_files(spark, archives, start, end)
    return _append_files(spark, settings, settings.mcap_table, rows, schemas.MCAP, "trade_date")


def run_instrument_master(spark: SparkSession, settings: Settings, path: str, segments=fixed.SEGMENTS,
                          instruments=fixed.INSTRUMENTS, types=fixed.INSTRUMENT_TYPES) -> dict:
    """Replace the instrument table by the filtered list; counts per exchange before and after."""
    settings.check("instruments")
    configure(spark)
    name = settings.instrument_table
    (snapshots.ensure if settings.snapshots else tables.ensure_table)(spark, name, schemas.INSTRUMENTS, partition=None)
    kept = landed_files.traded(segments, instruments, types)
    master = landed_files.instrument_master(spark, path)
    filtered = stage(landed_files.with_category_text(master.where(kept)), "instruments")
    snapshots.replace(filtered, name)
    return {"loaded": filtered.count(), "table": name,
            "counts": coverage.value_counts(master, "EXCH_ID", kept)}
