"""Streams of landed candles: append new ones, keep daily bars current, flag splits."""

import hashlib

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from barsmith import fixed, schemas, tables
from barsmith.functions import columns as fn
from barsmith.operators import mutate, rollup, splits
from barsmith.operators.dedup import keep_first
from barsmith.operators.joins import only
from barsmith.session import configure, scratch, shared_dir, stage, written

CANDLE_KEY = ["security_id", "timestamp", "interval_m"]


def _start(stream: DataFrame, each_batch, checkpoint: str) -> StreamingQuery:
    configure(stream.sparkSession)
    return (stream.writeStream.foreachBatch(each_batch).outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _fresh(batch: DataFrame, table: str) -> DataFrame:
    """The batch's candles that are not stored, each once. The table is the only state, so a candle may be of any age.

    Of the table only the keys of the batch's dates and of its scrips' buckets are read.
    """
    spark = batch.sparkSession
    order = [c for c in ("seq", "pos") if c in batch.columns] or [c for c in (*fixed.PRICES, "volume") if c in batch.columns]
    once = keep_first(batch.withColumn("trade_date", fn.ist_date("timestamp")), CANDLE_KEY, order)
    stored = tables.in_buckets(spark.table(table), tables.layout_of(spark, table), batch)
    return mutate.append_new(once, stored, CANDLE_KEY, "trade_date")


def append_candles(candles: DataFrame, table: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append candles that are not stored yet, however old. A replayed batch adds nothing."""
    spark = candles.sparkSession
    tables.ensure_table(spark, table, schemas.INTRADAY)

    def write(batch: DataFrame, _: int) -> None:
        held = batch.persist()
        try:
            tables.append(_fresh(held, table), table)
        finally:
            held.unpersist()

    return _start(candles, write, checkpoint or scratch(spark, "stream"))


def bar_state_table(table: str) -> str:
    return f"{table}_state"


def _with_ids(states: DataFrame, batch: str) -> DataFrame:
    return states.withColumn("row_id", fn.row_id()).withColumn("batch", F.lit(batch))


def _states(candles: DataFrame, order) -> DataFrame:
    return rollup.bar_states(candles.withColumn("security_id", fn.strict_long("security_id", "security_id")), order=order)


def _start_states(spark, table: str, candle_table: str, order) -> None:
    """A state table for the bars, made of the candles that are stored already."""
    name = bar_state_table(table)
    if not spark.catalog.tableExists(name):
        tables.ensure_table(spark, name, schemas.BAR_STATE, buckets=tables.layout_of(spark, table).buckets)
        stored = spark.table(candle_table)
        if tables.units_of(spark, candle_table):
            tables.append(_with_ids(_states(stored, order), ""), name)


def daily_bars(candles: DataFrame, table: str, candle_table: str, order=None, checkpoint: str | None = None) -> StreamingQuery:
    """Keep one bar per IST date and instrument current, from a stored state per bar into which new candles merge.

    A late candle touches its own bar's state; no stored candle is read but the keys of the batch's dates, to know what is new. So
    `candle_table` must be fed by this stream alone once it has a state (`<table>_state`, at first made of the candles stored by then).
    Late, doubled and replayed candles all end in the same bars: a batch's new candles are written under the batch's name before
    anything else, and a state remembers the last batch merged into it, so a repeated batch merges nothing twice.
    """
    spark = candles.sparkSession
    tables.ensure_table(spark, table, schemas.DAILY)
    tables.ensure_table(spark, candle_table, schemas.INTRADAY)
    _start_states(spark, table, candle_table, order)
    checkpoint = checkpoint or scratch(spark, "stream")
    run = hashlib.sha256(f"{checkpoint} {table}".encode()).hexdigest()[:16]

    def write(batch: DataFrame, batch_id: int) -> None:
        session, key = batch.sparkSession, f"{run}-{batch_id}"
        path = f"{shared_dir(session)}/barsmith/bars-{key}"
        if not written(session, path):
            held = batch.persist()
            try:
                _fresh(held, candle_table).write.mode("overwrite").parquet(path)
            finally:
                held.unpersist()
        fresh = session.read.parquet(path)
        if not fresh.isEmpty():
            tables.append(mutate.append_new(fresh, session.table(candle_table), CANDLE_KEY, "trade_date"), candle_table)
            _merge(session, table, _with_ids(_states(fresh, order), key), key)

    return _start(candles, write, checkpoint)


def _merge(spark, table: str, added: DataFrame, key: str) -> None:
    """Merge a batch's states into the stored ones, and upsert the bars they make."""
    name, added = bar_state_table(table), stage(added, "states")
    layout = tables.layout_of(spark, name)
    stored = tables.at(spark.table(name), layout, tables.units_in(added, layout)).drop(*layout.added)
    stored = stored.join(added.select("row_id"), "row_id", "left_semi").select(*added.columns)
    done = stored.where(F.col("batch") == key)
    both = stored.where(F.col("batch") != key).unionByName(added.join(done.select("row_id"), "row_id", "left_anti").select(*added.columns))
    merged = rollup.merge_states(both, ["trade_date", *rollup.INSTRUMENT, "row_id"]).withColumn("batch", F.lit(key))
    merged = stage(merged.unionByName(done.select(*merged.columns)), "merged")
    tables.upsert(spark, name, merged, values=[*rollup.STATE_VALUES, "batch"])
    tables.upsert(spark, table, merged.select(*schemas.DAILY_COLUMNS))


def split_flags(fetched: DataFrame, stored_table: str, flag_table: str, check_date, checkpoint: str,
                decimals: int = 2) -> StreamingQuery:
    """Compare each micro-batch of re-fetched bars with the stored bars of the check date.

    A batch's flags are keyed by run - the checkpoint, which is what Spark counts batches by - check date and batch id: a
    replay replaces them, and no other run or date touches them.
    """
    spark = fetched.sparkSession
    check = fn.to_date_arg(check_date)
    tables.ensure_table(spark, flag_table, schemas.FLAGS + ", batch_key STRING", partition="batch_key")
    run = hashlib.sha256(f"{checkpoint} {check}".encode()).hexdigest()[:16]

    def write(batch: DataFrame, batch_id: int) -> None:
        session, key = batch.sparkSession, f"{run}-{batch_id}"
        stored = session.table(stored_table).where(F.col("trade_date") == F.lit(check))
        flags = stage(splits.split_flags(batch, only(stored, batch), check, decimals).withColumn("batch_key", F.lit(key)), "flags")
        tables.overwrite_units(session, flag_table, flags, [(key,)], [] if flags.isEmpty() else [(key,)])
        spark.catalog.refreshTable(flag_table)

    return _start(fetched, write, checkpoint)
