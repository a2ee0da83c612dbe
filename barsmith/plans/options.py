"""Options ingest with expiry lookup and resume."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith import commits, fixed, schemas
from barsmith.functions import columns as fn
from barsmith.operators import calendars
from barsmith.session import configure, stage
from barsmith.settings import Settings
from barsmith.sources import responses as landed
from barsmith.sources.stored import chunks_or_empty

PAIR = ["trade_date", "expiry_code"]


def pending_pairs(spark: SparkSession, settings: Settings, start, end,
                  codes: Sequence[int] = fixed.EXPIRY_CODES, holidays: DataFrame | None = None) -> DataFrame:
    """(trade_date, expiry_code) of [start, end) that the option table does not have yet."""
    pairs = calendars.expiry_pairs(calendars.trading_days(spark, start, end, holidays), codes)
    return calendars.pending(pairs, chunks_or_empty(spark, settings.option_table, schemas.OPTIONS))


CELL = [*PAIR, "strike_offset", "option_type"]


def stored_cells(spark: SparkSession, settings: Settings, start, end) -> DataFrame:
    """The cells of [start, end) that have rows; their label names the strike offset."""
    stored = chunks_or_empty(spark, settings.option_table, schemas.OPTIONS)
    inside = (F.col("trade_date") >= F.lit(fn.to_date_arg(start))) & (F.col("trade_date") < F.lit(fn.to_date_arg(end)))
    return stored.where(inside).select(*PAIR, F.col("strike_offset").alias("strike_label"), "option_type").distinct()


def run_options(spark: SparkSession, settings: Settings, responses: DataFrame, start, end,
                expiries: DataFrame | None = None, codes: Sequence[int] = fixed.EXPIRY_CODES,
                offsets: Sequence[int] = fixed.OPTION_OFFSETS, tranche_days: int = 5,
                holidays: DataFrame | None = None) -> dict:
    """Load the landed responses of all cells that have no rows yet, a tranche of days per write.

    A chunk is a (trade date, expiry code); its rows count once its tranche's write has listed it (`commits`). If a tranche cannot be
    written, its chunks are tried one by one: those that fail are reported in `failed_chunks` (with the error) and stay pending, the
    others are in. A cell is a (trade date, expiry code, strike offset, option type). Each counts by its own rows, so one that failed, or whose
    response had not landed, loads in a later run. `cells` holds every requested cell without stored rows and its outcome:
    ok, empty, failed or missing, failed too in a chunk that failed; a pair is pending while one of its cells is failed or missing.
    """
    settings.check("options")
    configure(spark)
    name = settings.option_table
    commits.start(spark, name, schemas.OPTIONS, PAIR)
    pairs = calendars.expiry_pairs(calendars.trading_days(spark, start, end, holidays), codes)
    grid = calendars.option_requests(pairs, offsets)
    open_cells = stage(grid.join(stored_cells(spark, settings, start, end), [*PAIR, "strike_label", "option_type"], "left_anti")
                       .select(*CELL), "cells")
    calls, hours = calendars.request_cost(open_cells).first()
    days = stage(calendars.tranches(open_cells, tranche_days), "tranches")
    last = days.agg(F.max("tranche")).first()[0]
    wanted = stage(responses.join(open_cells, CELL, "left_semi"), "wanted")
    lookup = None
    if expiries is not None:
        lookup = stage(calendars.expiry_lookup(expiries, codes), "expiries")
    best = landed.option_outcomes(wanted).groupBy(*CELL).agg(F.min_by("outcome", "rank").alias("outcome"))
    cells = stage(open_cells.join(best, CELL, "left").withColumn("outcome", F.coalesce("outcome", F.lit("missing"))), "outcomes")
    # Chunks with rows to load, and of them the tranches that have any.
    full = stage(cells.where("outcome = 'ok'").select(*PAIR).distinct().join(days, "trade_date"), "chunks")
    bounds = full.groupBy("tranche").agg(F.min("trade_date").alias("low"), F.max("trade_date").alias("high")).orderBy("tranche").collect()
    load, failed_chunks = commits.Load(spark, name, PAIR, cluster=["option_type", "expiry_code", "strike_price"]), []
    for t in bounds:
        within = wanted.where(F.col("trade_date").between(F.lit(t.low), F.lit(t.high)))
        failed_chunks += load.write_each(lambda some, within=within: landed.option_candles(within.join(some, PAIR, "left_semi"), lookup),
                                         full.where(F.col("tranche") == t.tranche).select(*PAIR), "timestamp")
    if failed_chunks:
        lost = spark.createDataFrame([(c["trade_date"], c["expiry_code"]) for c in failed_chunks], "trade_date DATE, expiry_code INT")
        cells = cells.join(lost.withColumn("_lost", F.lit(True)), PAIR, "left").withColumn(
            "outcome", F.when(F.col("_lost") & (F.col("outcome") == "ok"), "failed").otherwise(F.col("outcome"))).drop("_lost")
    count = {r.outcome: r["count"] for r in cells.groupBy("outcome").count().collect()}
    waiting = cells.where(F.col("outcome").isin("failed", "missing"))
    return {"pending_pairs": open_cells.select(*PAIR).distinct().count(), "calls": calls, "hours": hours,
            "tranches": 0 if last is None else last + 1, "loaded": load.rows, "rejected": load.rejected, "table": name,
            "failed_chunks": failed_chunks,
            "cells": cells, "failed": count.get("failed", 0), "empty": count.get("empty", 0), "missing": count.get("missing", 0),
            "still_pending": waiting.select(*PAIR).distinct().count()}
