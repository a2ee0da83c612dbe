"""Snapshots: readers see the old rows or the new ones, whatever becomes of a write."""

import pytest
from pyspark.sql import functions as F

import barsmith
from barsmith import Settings, schemas, snapshots, tables
from barsmith.session import stage
from tests.conftest import rows
from tests.test_jobs import fetch
from tests.test_tables import D, HISTORY, daily, expected

NEW = [("Z", "NSE", D[1], 5.0), ("A", "NSE", D[2], 6.0), ("Q", "TEMP", D[2], 7.0)]


def seen(df):
    return rows(df, "scrip", "exchange", "trade_date", "close")


@pytest.fixture
def kept(spark, table_name):
    name = table_name("snap")
    snapshots.ensure(spark, name, schemas.DAILY, buckets=4, cluster=["scrip"])
    tables.append(daily(spark, HISTORY), snapshots.stored(spark, name))
    return name


def test_a_reader_opened_before_the_swap_finishes(spark, kept):
    before = spark.table(kept)
    assert snapshots.current(spark, kept) == 1 and seen(before) == expected(HISTORY)
    assert snapshots.swap(daily(spark, NEW), kept) == 2
    assert seen(before) == expected(HISTORY) and seen(spark.table(kept)) == expected(NEW)
    assert spark.table(kept).columns == schemas.DAILY_COLUMNS
    now = snapshots.stored(spark, kept)
    assert now == f"{kept}__s2" and tables.layout_of(spark, now) == tables.layout_of(spark, f"{kept}__s1")
    assert "PartitionFilters: [isnotnull(trade_date" in spark.table(kept).where(F.col("trade_date") == F.lit(D[1]))._jdf.queryExecution().toString()
    snapshots.point(spark, kept, 1)
    assert seen(spark.table(kept)) == expected(HISTORY)
    snapshots.point(spark, kept, 2)
    assert snapshots.release(spark, kept, keep=1) == [] and snapshots.release(spark, kept) == [1]
    assert snapshots.numbers(spark, kept) == [2] and seen(spark.table(kept)) == expected(NEW)


def test_a_write_that_fails_leaves_the_old_rows(spark, kept):
    broken = daily(spark, NEW).withColumn("close", F.when(F.col("scrip") == "A", F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("close")))
    with pytest.raises(Exception, match="lost"):
        snapshots.swap(broken, kept)
    assert seen(spark.table(kept)) == expected(HISTORY) and snapshots.current(spark, kept) == 1
    assert snapshots.swap(daily(spark, NEW), kept) == 3  # the unfinished one is no obstacle
    assert seen(spark.table(kept)) == expected(NEW) and snapshots.release(spark, kept) == [1, 2]


def test_swapping_a_table_for_rows_of_itself_and_for_none(spark, kept):
    snapshots.replace(spark.table(kept).where("scrip < 'C'"), kept)
    assert seen(spark.table(kept)) == expected([r for r in HISTORY if r[0] < "C"])
    snapshots.replace(spark.table(kept).limit(0), kept)
    assert spark.table(kept).isEmpty() and snapshots.current(spark, kept) == 3
    tables.append(daily(spark, NEW), snapshots.stored(spark, kept))
    assert seen(spark.table(kept)) == expected(NEW)


def test_tables_without_snapshots_are_overwritten(spark, table_name):
    name = table_name("plain")
    tables.ensure_table(spark, name, schemas.DAILY)
    tables.append(daily(spark, HISTORY), name)
    snapshots.replace(stage(daily(spark, NEW), "s"), name)
    assert snapshots.stored(spark, name) == name and seen(spark.table(name)) == expected(NEW)


def test_names_in_a_database_and_alike(spark, table_name):
    spark.sql("CREATE DATABASE IF NOT EXISTS snaps")
    name = f"snaps.{table_name('T')}"
    for n in (name, f"{name}__s", f"{name}2"):
        snapshots.ensure(spark, n, schemas.DAILY, buckets=2)
    snapshots.swap(daily(spark, NEW), name)
    assert snapshots.numbers(spark, name) == [1, 2] and snapshots.numbers(spark, f"{name}2") == [1]
    assert seen(spark.table(name)) == expected(NEW) and spark.table(f"{name}2").isEmpty()


def test_jobs_over_snapshots(spark, tmp_path, table_name):
    settings = Settings(daily_table=table_name("jobs"), snapshots=True)
    with pytest.raises(ValueError, match="not both"):
        Settings(daily_table="t", snapshots=True, merge_on_read=True).check("daily")

    def days(n, *scrips):
        return fetch(spark, tmp_path, {s: {d: 10.0 + i for i, d in enumerate(D[:n])} for s in scrips}, name=f"{n}{''.join(scrips)}.json")

    first = barsmith.run_daily(spark, settings, days(2, "A", "B"))
    assert first["uploaded"] == 2 and snapshots.current(spark, settings.daily_table) == 1
    before = spark.table(settings.daily_table)
    report = barsmith.run_daily_reload(spark, settings, days(3, "A"), "lifetime")
    assert report["table"] == settings.daily_table and report["uploaded"] == 3
    assert snapshots.current(spark, settings.daily_table) == 2 and before.count() == 2 and spark.table(settings.daily_table).count() == 3
    again = barsmith.run_daily(spark, settings, days(4, "A"))
    assert again["uploaded"] == 1 and not again["flagged"] and snapshots.current(spark, settings.daily_table) == 2
    ranged = barsmith.run_daily_reload(spark, settings, days(4, "A"), "range", D[1], D[3])
    assert ranged["table"] == settings.daily_table and ranged["uploaded_range"] == 3 and spark.table(settings.daily_table).count() == 4
