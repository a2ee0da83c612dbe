from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barsmith import schemas, tables
from barsmith.functions import columns as fn
from barsmith.operators import rollup
from barsmith.session import stage
from barsmith.streaming import candles as streaming
from tests.conftest import rows

T0 = 1785987900                                        # 2026-08-06 09:15 IST
DDL = "scrip string, exchange string, security_id string, timestamp bigint, interval_m int, open double, high double, low double, close double, volume double"


def land(spark, folder, *candles):
    data = [(s, "NSE", "7", t, 15, c, c, c, c, 1.0) for s, t, c in candles]
    spark.createDataFrame(data, DDL).coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder):
    return spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(str(folder))


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def test_append_candles_in_batches_and_on_replay(spark, tmp_path, table_name):
    name, src = table_name("st1"), tmp_path / "in"
    land(spark, src, ("A", T0, 1.0), ("A", T0, 1.0), ("A", T0 + 900, 2.0))
    land(spark, src, ("A", T0, 1.0), ("A", T0 + 1800, 3.0))
    for run in ("a", "b"):                             # a second checkpoint replays everything
        finish(streaming.append_candles(stream(spark, src), name, checkpoint=str(tmp_path / run)))
        assert rows(spark.table(name), "timestamp", "trade_date") == [(T0 + d, date(2026, 8, 6)) for d in (0, 900, 1800)]


def test_append_candles_of_any_age(spark, tmp_path, table_name):
    name, src = table_name("st1_old"), tmp_path / "in"
    land(spark, src, ("A", T0, 1.0))
    finish(streaming.append_candles(stream(spark, src), name, checkpoint=str(tmp_path / "cp")))
    land(spark, src, ("A", T0 - 30 * 86400, 2.0))      # a backfill, long after a newer candle
    finish(streaming.append_candles(stream(spark, src), name, checkpoint=str(tmp_path / "cp")))
    assert rows(spark.table(name), "close") == [(1.0,), (2.0,)]


def test_daily_bars_take_late_candles(spark, tmp_path, table_name):
    name, src, kept = table_name("st2"), tmp_path / "in", table_name("st2_candles")
    checkpoint = str(tmp_path / "cp")

    def numbered(df):
        return df.withColumn("security_id", F.col("security_id").cast("bigint"))

    land(spark, src, ("A", T0 + 900, 5.0), ("A", T0 + 86400, 9.0))
    finish(streaming.daily_bars(stream(spark, src), name, kept, checkpoint=checkpoint))
    land(spark, src, ("A", T0, 2.0), ("A", T0 + 900, 5.0))  # late, and earlier than the first open; one landed twice
    finish(streaming.daily_bars(stream(spark, src), name, kept, checkpoint=checkpoint))
    once = numbered(spark.read.schema(DDL).parquet(str(src)).distinct())
    batch = rollup.daily_bars(once).withColumn("row_id", fn.row_id())
    assert rows(spark.table(name), *schemas.DAILY_COLUMNS) == rows(batch, *schemas.DAILY_COLUMNS)
    assert rows(spark.table(name), "open", "close") == [(2.0, 5.0), (9.0, 9.0)]


def test_a_late_candle_reads_no_other_candle(spark, tmp_path, table_name):
    name, src, kept = table_name("st2_one"), tmp_path / "in", table_name("st2_one_candles")
    checkpoint = str(tmp_path / "cp")
    land(spark, src, ("A", T0 + 900, 5.0), ("A", T0 + 1800, 7.0), ("B", T0 + 2700, 1.0))
    finish(streaming.daily_bars(stream(spark, src), name, kept, checkpoint=checkpoint))
    before = {f: Path(f.removeprefix("file://")).stat().st_mtime_ns for f in spark.table(kept).inputFiles()}
    for column in ("open", "high", "low", "close"):  # whatever the stored prices are now, the bars know theirs
        spoilt = spark.table(kept).withColumn(column, F.lit(1000.0))
        tables.replace(stage(spoilt, "spoilt"), kept)
    land(spark, src, ("A", T0, 2.0))
    finish(streaming.daily_bars(stream(spark, src), name, kept, checkpoint=checkpoint))
    assert before and rows(spark.table(name), "scrip", "open", "high", "low", "close", "volume") == [("A", 2.0, 7.0, 2.0, 7.0, 3.0), ("B", 1.0, 1.0, 1.0, 1.0, 1.0)]


@pytest.mark.parametrize("step", ["append", "state", "bars"])
def test_a_batch_that_dies_is_merged_once(spark, tmp_path, table_name, monkeypatch, step):
    name, src, kept = table_name("st2_die") + step, tmp_path / "in", table_name("st2_die_candles") + step
    checkpoint = str(tmp_path / "cp")
    land(spark, src, ("A", T0 + 900, 5.0), ("B", T0 + 86400, 9.0))
    finish(streaming.daily_bars(stream(spark, src), name, kept, checkpoint=checkpoint))
    land(spark, src, ("A", T0, 2.0), ("A", T0 + 900, 5.0), ("A", T0 + 1800, 4.0))
    target = {"append": kept, "state": streaming.bar_state_table(name), "bars": name}[step]
    append, upsert = tables.append, tables.upsert

    def dies_after(call):
        def run(*args, **more):
            done = call(*args, **more)
            if target in args:
                raise RuntimeError("killed")
            return done
        return run

    monkeypatch.setattr(tables, "append", dies_after(append))
    monkeypatch.setattr(tables, "upsert", dies_after(upsert))
    query = streaming.daily_bars(stream(spark, src), name, kept, checkpoint=checkpoint)
    with pytest.raises(Exception, match="killed"):
        query.awaitTermination()
    monkeypatch.undo()
    finish(streaming.daily_bars(stream(spark, src), name, kept, checkpoint=checkpoint))
    assert rows(spark.table(name), "scrip", "open", "high", "low", "close", "volume") == [("A", 2.0, 5.0, 2.0, 4.0, 3.0), ("B", 9.0, 9.0, 9.0, 9.0, 1.0)]
    assert spark.table(kept).count() == 4


def test_states_start_from_stored_candles(spark, tmp_path, table_name):
    name, src, kept = table_name("st2_old"), tmp_path / "in", table_name("st2_old_candles")
    land(spark, src, ("A", T0, 2.0), ("A", T0 + 900, 5.0))
    finish(streaming.append_candles(stream(spark, src), kept, checkpoint=str(tmp_path / "a")))
    land(spark, src, ("A", T0 + 1800, 3.0))
    finish(streaming.daily_bars(stream(spark, src), name, kept, checkpoint=str(tmp_path / "b")))
    assert rows(spark.table(name), "open", "high", "low", "close", "volume") == [(2.0, 5.0, 2.0, 3.0, 3.0)]


def test_states_merge_in_any_grouping(spark):
    data = [("A", "NSE", 7, T0 + 60 * i, o, 10.0 + i, 5.0 - i, c, v) for i, (o, c, v) in enumerate(
        [(None, 3.0, 1.0), (4.0, None, None), (5.0, 6.0, 2.0), (None, None, None), (7.0, None, 3.0)])] + [("B", "NSE", 8, T0, None, None, None, None, None)]
    df = spark.createDataFrame(data, "scrip string, exchange string, security_id bigint, timestamp bigint, open double, high double, low double, close double, volume double")
    want = rows(rollup.daily_bars(df), "scrip", "open", "high", "low", "close", "volume")
    keys = ["trade_date", *rollup.INSTRUMENT]
    for cut in range(6):
        two = [rollup.bar_states(part) for part in (df.where(F.col("timestamp") < T0 + 60 * cut), df.where(F.col("timestamp") >= T0 + 60 * cut))]
        assert rows(rollup.merge_states(two[1].unionByName(two[0]), keys), "scrip", "open", "high", "low", "close", "volume") == want


def test_split_flags_once_per_batch(spark, tmp_path, table_name):
    stored, flags, src = table_name("st3"), table_name("st3_flags"), tmp_path / "in"
    day = date(2026, 8, 6)
    tables.ensure_table(spark, stored, schemas.DAILY)
    bar = spark.createDataFrame([("A", "NSE", 7, 10.0, day), ("B", "NSE", 8, 10.0, day)],
                                "scrip string, exchange string, security_id bigint, close double, trade_date date") \
        .selectExpr("*", "close open", "close high", "close low", "1D volume").withColumn("row_id", fn.row_id())
    tables.append(bar, stored)
    moved = bar.withColumn("close", F.when(F.col("scrip") == "A", 5.0).otherwise(10.0))
    moved.select("scrip", "security_id", "trade_date", "open", "high", "low", "close").coalesce(1).write.parquet(str(src))
    schema = "scrip string, security_id bigint, trade_date date, open double, high double, low double, close double"
    for _ in range(2):                                 # the second run finds nothing new
        finish(streaming.split_flags(spark.readStream.schema(schema).parquet(str(src)), stored, flags, day, checkpoint=str(tmp_path / "cp")))
        assert rows(spark.table(flags), "scrip", "field", "fetched_value", "stored_value") == [("A", "close", 5.0, 10.0)]
    finish(streaming.split_flags(spark.readStream.schema(schema).parquet(str(src)), stored, flags, date(2026, 8, 7),
                                 checkpoint=str(tmp_path / "other")))  # another run leaves the first one's flags
    assert rows(spark.table(flags), "scrip", "field") == [("A", "close")]
