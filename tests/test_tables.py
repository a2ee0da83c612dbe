"""Layouts: units of date and bucket, temporary rows apart, months."""

from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barsmith import schemas, tables
from barsmith.functions import columns as fn
from barsmith.operators import joins, mutate
from barsmith.session import stage
from tests.conftest import rows

D = [date(2026, 8, 3) + timedelta(days=i) for i in range(5)]
SCRIPS = [chr(65 + i) for i in range(12)]


def daily(spark, data):
    """(scrip, exchange, date, close) as daily rows."""
    rows_ = [(s, e, ord(s[0]), c, c, c, c, 1.0, d) for s, e, d, c in data]
    df = spark.createDataFrame(rows_, "scrip string, exchange string, security_id bigint, open double, high double, low double, close double, volume double, trade_date date")
    return df.withColumn("row_id", F.coalesce(fn.row_id(), F.expr("concat(scrip, 'x')")))


def new(spark, folder, name, data, **layout):
    tables.ensure_table(spark, name, schemas.DAILY, location=str(folder), **layout)
    tables.append(daily(spark, data), name)
    return name


def files(folder):
    """Every data file with its modification time."""
    return {str(p): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def state(spark, name):
    return rows(tables.read(spark, name), "scrip", "exchange", "trade_date", "close")


def expected(data):
    return sorted(((s, e, d, c) for s, e, d, c in data), key=lambda t: tuple((v is None, 0 if v is None else v) for v in t))


HISTORY = [(s, "NSE", d, float(i)) for s in SCRIPS for i, d in enumerate(D)]


def bucket_of(spark, scrip, n):
    return spark.range(1).select(F.pmod(F.xxhash64(F.lit(scrip)), F.lit(n))).first()[0]


def test_layout_is_kept_with_the_table(spark, tmp_path, table_name):
    name = new(spark, tmp_path / "t", table_name("lay"), HISTORY, buckets=4)
    layout = tables.layout_of(spark, name)
    assert layout == tables.Layout(("trade_date", "bucket"), "trade_date", 4, ())
    tables.ensure_table(spark, name, schemas.DAILY, buckets=9)  # an existing table keeps its own
    assert tables.layout_of(spark, name) == layout and tables.read(spark, name).columns == schemas.DAILY_COLUMNS
    assert tables.units_of(spark, name) == tables.units_in(tables.read(spark, name), layout)
    spark.sql(f"CREATE TABLE {name}_old ({schemas.DAILY}) USING parquet PARTITIONED BY (trade_date)")
    assert tables.layout_of(spark, f"{name}_old") == tables.Layout(("trade_date",), "trade_date", 0)


def test_a_scrip_goes_without_touching_other_buckets(spark, tmp_path, table_name):
    name, folder = table_name("scrips"), tmp_path / "t"
    new(spark, folder, name, [*HISTORY, ("A", "TEMP", D[0], 7.0), ("B", "TEMP", D[0], 7.0)], buckets=4)
    before, mine = files(folder), bucket_of(spark, "A", 4)
    tables.delete_scrips(spark, name, joins.names(spark, ["A"]), F.col("exchange") != "TEMP")
    assert state(spark, name) == expected([r for r in HISTORY if r[0] != "A"] + [("A", "TEMP", D[0], 7.0), ("B", "TEMP", D[0], 7.0)])
    after = files(folder)
    others = {p for p in before if f"bucket={mine}/" not in p}
    assert len(others) > len(D) and all(after.get(p) == before[p] for p in others)
    tables.delete_scrips(spark, name, joins.names(spark, ["A", None]))  # now the temporary one too; NULL removes nothing
    assert ("A", "TEMP", D[0], 7.0) not in state(spark, name) and ("B", "TEMP", D[0], 7.0) in state(spark, name)
    tables.delete_scrips(spark, name, joins.names(spark, []))


def test_an_upsert_rewrites_only_its_units(spark, tmp_path, table_name):
    name, folder = table_name("ups"), tmp_path / "t"
    new(spark, folder, name, HISTORY, buckets=4)
    before, mine = files(folder), bucket_of(spark, "C", 4)
    source = stage(daily(spark, [("C", "NSE", D[1], 99.0), ("C", "BSE", D[1], 98.0)]), "source")
    assert tables.upsert(spark, name, source) == 2
    want = [r for r in HISTORY if (r[0], r[2]) != ("C", D[1])] + [("C", "NSE", D[1], 99.0), ("C", "BSE", D[1], 98.0)]
    assert state(spark, name) == expected(want)
    same = {p for p in before if f"trade_date={D[1]}/bucket={mine}/" not in p}
    assert len(same) < len(before) and all(files(folder).get(p) == before[p] for p in same)


@pytest.mark.parametrize("buckets", [0, 4])
def test_temporary_rows_go_with_null_dates(spark, tmp_path, table_name, buckets):
    name, folder = table_name(f"temp{buckets}"), tmp_path / "t"
    temp = [(s, "TEMP", d, 1.0) for s in "AB" for d in (*D, None)]
    keep = [*HISTORY, ("A", None, D[0], 5.0), ("Z", "NSE", None, 6.0), (None, "NSE", D[0], 8.0)] if buckets else [*HISTORY, ("Z", "NSE", None, 6.0)]
    keep = [r for r in keep if r[0] is not None]
    new(spark, folder, name, [*keep, *temp], buckets=buckets)
    before = files(folder)
    tables.delete_temp(spark, name, before=D[2])
    assert state(spark, name) == expected([*keep, *(r for r in temp if r[2] is None or r[2] >= D[2])])
    tables.delete_temp(spark, name)
    assert state(spark, name) == expected(keep)
    if buckets:
        assert all(files(folder).get(p) == t for p, t in before.items() if "bucket=-1/" not in p)
        assert not [u for u in tables.units_of(spark, name) if u[1] == tables.TEMP_BUCKET]
    tables.delete_temp(spark, name)


def test_null_dates_are_deleted_like_others(spark, tmp_path, table_name):
    name = new(spark, tmp_path / "t", table_name("nulls"), [("A", "NSE", None, 1.0), ("B", "NSE", None, 2.0), ("A", "NSE", D[0], 3.0)], buckets=2)
    tables.delete(spark, name, F.col("scrip") == "A")
    assert state(spark, name) == [("B", "NSE", None, 2.0)]
    tables.delete(spark, name, F.col("scrip") == "B")
    assert state(spark, name) == [] and tables.units_of(spark, name) == set()


def test_dropped_units_do_not_come_back(spark, tmp_path, table_name):
    name = new(spark, tmp_path / "t", table_name("back"), [("A", "NSE", D[0], 1.0), ("B", "NSE", D[1], 2.0), ("B", "NSE", None, 3.0)], buckets=1)
    tables.delete_range(spark, name, D[0], D[0])
    tables.delete(spark, name, F.col("trade_date").isNull())
    tables.append(daily(spark, [("A", "NSE", D[0], 5.0), ("B", "NSE", None, 6.0)]), name)
    assert state(spark, name) == expected([("A", "NSE", D[0], 5.0), ("B", "NSE", D[1], 2.0), ("B", "NSE", None, 6.0)])


def test_months_prune_and_cut(spark, tmp_path, table_name):
    name, folder = table_name("months"), tmp_path / "t"
    days = [date(2026, 1, 1) + timedelta(days=i) for i in range(120)]
    data = [("A", "NSE", d, float(d.toordinal())) for d in days] + [("A", "NSE", None, 0.0)]
    new(spark, folder, name, data, by_month=True)
    assert tables.partition_dates(spark, name) == ["2026-01", "2026-02", "2026-03", "2026-04"]
    got = tables.dated(spark, name, "2026-02-10", "2026-03-02")
    assert rows(got, "trade_date") == [(d,) for d in days if date(2026, 2, 10) <= d <= date(2026, 3, 2)]
    assert {f.split("month=")[1][:7] for f in got.inputFiles()} == {"2026-02", "2026-03"}
    before = files(folder)
    tables.delete_range(spark, name, "2026-01-20", "2026-03-05")
    kept = [r for r in data if r[2] is None or not date(2026, 1, 20) <= r[2] <= date(2026, 3, 5)]
    assert state(spark, name) == expected(kept)
    assert all(files(folder).get(p) == t for p, t in before.items() if "month=2026-04" in p)
    assert tables.upsert(spark, name, stage(daily(spark, [("A", "NSE", days[-1], 1.0)]), "s")) == 1
    assert ("A", "NSE", days[-1], 1.0) in state(spark, name) and len(state(spark, name)) == len(kept)


def test_a_scrip_is_read_from_its_bucket_and_files_are_sorted(spark, tmp_path, table_name):
    name, folder = table_name("sorted"), tmp_path / "t"
    new(spark, folder, name, HISTORY[::-1], buckets=4, cluster=["scrip"])
    assert tables.layout_of(spark, name).cluster == ("scrip",)
    held = [[r.scrip for r in spark.read.parquet(f).collect()] for f in files(folder)]
    assert held and all(h == sorted(h) for h in held) and max(map(len, held)) > 2
    got = tables.rows_of(spark, name, joins.names(spark, ["A"]))
    assert rows(got, "scrip", "trade_date") == [("A", d) for d in D]
    tables.append(daily(spark, [("B", "TEMP", D[0], 1.0)]), name)
    read = {f.split("bucket=")[1].split("/")[0] for f in tables.in_buckets(spark.table(name), tables.layout_of(spark, name), joins.names(spark, ["A"])).inputFiles()}
    assert read == {"-1", str(bucket_of(spark, "A", 4))}


def test_units_as_literals(spark):
    layout = tables.Layout(("trade_date", "bucket"), "trade_date", 4)
    data = [(d, b) for d in (*D, None) for b in (-1, 0, 1, 2)]
    df = spark.createDataFrame(data, "trade_date date, bucket int")
    for units in ([], [(D[0], 0)], [(None, 1), (D[1], 1), (D[2], 1), (D[2], 2)], data):
        assert sorted(map(repr, tables.at(df, layout, units).collect())) == sorted(repr(r) for r in df.collect() if tuple(r) in set(units))


def test_full_join_upsert_equals_the_small_one(spark):
    target = daily(spark, HISTORY[:20])
    source = daily(spark, [("A", "NSE", D[0], 50.0), ("Q", "NSE", D[0], 51.0)])
    small, large = mutate.upsert(target, source), mutate.upsert(target, source, large=True)
    assert rows(small, *schemas.DAILY_COLUMNS) == rows(large, *schemas.DAILY_COLUMNS)
