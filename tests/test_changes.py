"""Merge on read: what the view gives is what rewriting would give, before and after compaction."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import barsmith
from barsmith import Settings, changes, schemas, tables
from barsmith.operators import joins, mutate
from barsmith.session import stage
from tests.conftest import rows
from tests.test_jobs import closes, fetch, names, store  # noqa: F401
from tests.test_tables import D, HISTORY, daily, expected, files, new


def now(spark, name):
    return rows(changes.current(spark, name), "scrip", "exchange", "trade_date", "close")


@pytest.fixture
def kept(spark, tmp_path, table_name):
    """A stored table with its change table, and the folder of each."""
    name = new(spark, tmp_path / "t", table_name("mor"), HISTORY, buckets=4)
    changes.start(spark, name, location=str(tmp_path / "c"))
    return name, tmp_path / "t", tmp_path / "c"


def test_one_row_is_one_file(spark, kept):
    name, stored, beside = kept
    before = files(stored)
    source = stage(daily(spark, [("C", "NSE", D[1], 99.0)]), "s")
    assert changes.upsert(spark, name, source) == 1
    assert files(stored) == before and len(files(beside)) == 1
    want = expected([r for r in HISTORY if (r[0], r[2]) != ("C", D[1])] + [("C", "NSE", D[1], 99.0)])
    assert now(spark, name) == want
    assert changes.compact(spark, name) == 1
    assert now(spark, name) == want and rows(tables.read(spark, name), "scrip", "exchange", "trade_date", "close") == want
    assert changes.sequences(spark, name) == [] and changes.compact(spark, name) == 0
    assert len([p for p, t in before.items() if files(stored).get(p) != t]) == 1


def test_entries_in_order_and_tombstones(spark, kept):
    name, stored, _ = kept
    changes.upsert(spark, name, stage(daily(spark, [("A", "NSE", D[0], 50.0), ("Q", "NSE", D[0], 51.0)]), "s"))
    changes.delete(spark, name, F.col("scrip").isin("A", "Q"))
    assert not [r for r in now(spark, name) if r[0] in "AQ"]
    changes.upsert(spark, name, stage(daily(spark, [("A", "NSE", D[0], 52.0)]), "s"))  # back after its tombstone
    changes.delete(spark, name, F.col("scrip") == "nobody")  # no entry at all
    changes.delete_range(spark, name, D[3], D[4])
    want = expected([r for r in HISTORY if r[0] != "A" and r[2] < D[3]] + [("A", "NSE", D[0], 52.0)])
    assert changes.sequences(spark, name) == [1, 2, 3, 4] and now(spark, name) == want
    changes.compact(spark, name, upto=2)  # a part: later entries still win
    assert changes.sequences(spark, name) == [3, 4] and now(spark, name) == want
    changes.compact(spark, name)
    assert now(spark, name) == want and tables.units_of(spark, name) == tables.units_in(tables.read(spark, name), tables.layout_of(spark, name))


def test_compaction_may_be_repeated(spark, kept, monkeypatch):
    name, _, _ = kept
    changes.upsert(spark, name, stage(daily(spark, [("A", "NSE", D[0], 50.0)]), "s"))
    changes.delete(spark, name, F.col("scrip") == "B")
    want = now(spark, name)
    drop = tables.drop_units

    def dies(spark, table, *rest):
        if table == changes.change_table(name):
            raise RuntimeError("killed")
        return drop(spark, table, *rest)

    monkeypatch.setattr(tables, "drop_units", dies)
    with pytest.raises(RuntimeError, match="killed"):
        changes.compact(spark, name)
    assert now(spark, name) == want  # folded, and not dropped yet
    monkeypatch.setattr(tables, "drop_units", drop)
    changes.compact(spark, name)
    assert now(spark, name) == want and changes.sequences(spark, name) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_view_equals_rewriting(spark, kept, table_name, tmp_path, seed):
    name, _, _ = kept
    other, rng = table_name("rewritten") + str(seed), random.Random(seed)
    new(spark, tmp_path / "o", other, HISTORY, buckets=4)
    for step in range(4):
        data = {(rng.choice("ABCXYZ"), rng.choice(["NSE", "BSE"]), rng.choice(D)): float(step * 100 + i) for i in range(6)}
        source = stage(daily(spark, [(*k, c) for k, c in data.items()]), "s").withColumn("close", F.expr("IF(close % 7 = 0, NULL, close)"))
        assert changes.upsert(spark, name, source) == tables.upsert(spark, other, source)
        gone = (F.col("scrip") == rng.choice("ABCXYZ")) & (F.col("trade_date") > F.lit(rng.choice(D)))
        changes.delete(spark, name, gone)
        tables.delete(spark, other, gone)
        assert now(spark, name) == rows(tables.read(spark, other), "scrip", "exchange", "trade_date", "close")
        if step == 2:
            changes.compact(spark, name)
    assert rows(changes.current(spark, name), *schemas.DAILY_COLUMNS) == rows(tables.read(spark, other), *schemas.DAILY_COLUMNS)


def test_dates_prune_both_sides(spark, kept):
    name, _, _ = kept
    changes.upsert(spark, name, stage(daily(spark, [("A", "NSE", D[0], 50.0), ("A", "NSE", D[1], 50.0)]), "s"))
    read = changes.current(spark, name).where(F.col("trade_date") == F.lit(D[1]))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert rows(read.where("scrip = 'A'"), "close") == [(50.0,)]
    scans = [line for line in plan.splitlines() if f".{name}[" in line]
    assert len(scans) == 2 and all("2026-08-04" in line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in scans)
    assert any("2026-08-04" in line for line in plan.splitlines() if f".{changes.change_table(name)}[" in line)


def test_a_source_row_without_id_fails(spark, kept):
    with pytest.raises(Exception, match="no row_id"):
        changes.upsert(spark, kept[0], stage(daily(spark, [("A", "NSE", D[0], 1.0)]).withColumn("row_id", F.lit(None).cast("string")), "s"))


def test_jobs_over_changes(spark, tmp_path, names):  # noqa: F811
    store(spark, names.daily_table, {"S": {D[0]: 100, D[1]: 100}, "T": {D[1]: 10}})
    settings = Settings(daily_table=names.daily_table, merge_on_read=True)
    report = barsmith.run_daily(spark, settings, fetch(spark, tmp_path, {"S": {D[1]: 100, D[2]: 51}, "T": {D[1]: 10, D[2]: 11}}))
    assert report["uploaded"] == 2 and report["flagged"] == [] and spark.table(names.daily_table).count() == 3
    # The next run checks against what the first one recorded.
    report = barsmith.run_daily(spark, settings, fetch(spark, tmp_path, {"S": {D[2]: 25, D[3]: 26}, "T": {D[2]: 11, D[3]: 12}}, "b.json"))
    assert (report["check_date"], report["flagged"]) == (D[2], ["S"])
    assert changes.current(spark, names.daily_table).count() == 7 and spark.table(names.daily_table).count() == 3
    again = fetch(spark, tmp_path, {"S": {D[0]: 50, D[1]: 50, D[2]: 25, D[3]: 26}, "T": {D[2]: 11}}, "c.json")
    report = barsmith.run_daily_reload(spark, settings, again, "range", D[2], D[3], lifetime=again)  # folds first
    assert report["flagged"] == ["S"] and changes.sequences(spark, names.daily_table) == []
    assert closes(spark, names.daily_table) == rows(changes.current(spark, names.daily_table), "scrip", "exchange", "trade_date", "close")
    assert [r[3] for r in closes(spark, names.daily_table) if r[0] == "S"] == [50.0, 50.0, 25.0, 26.0]
