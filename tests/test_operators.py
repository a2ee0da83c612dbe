from datetime import date, timedelta

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from barsmith import fixed, schemas
from barsmith.functions import columns as fn
from barsmith.operators import calendars, coverage, dedup, joins, mutate, rollup, splits
from tests.conftest import rows

D1, D2, D3 = date(2026, 8, 5), date(2026, 8, 6), date(2026, 8, 7)
BAR = "scrip string, exchange string, security_id string, trade_date date, open double, high double, low double, close double, volume double"


def bar(scrip, day, close=10.0, exchange="NSE", open_=10.0, high=12.0, low=9.0):
    return (scrip, exchange, "1", day, open_, high, low, close, 5.0)


# ---- rollup ----

def test_rollup_skips_nulls(spark):
    data = [(1785987900, None, 4.0, 1.0, 3.0), (1785991500, 2.0, 5.0, 2.0, 4.0), (1785995100, 3.0, 3.0, 3.0, None)]
    df = spark.createDataFrame(data, "timestamp bigint, open double, high double, low double, close double") \
        .selectExpr("*", "cast(null as double) volume", "'A' scrip", "'N' exchange", "1L security_id")
    assert rows(rollup.daily_bars(df), "open", "high", "low", "close", "volume") == [(2.0, 5.0, 1.0, 4.0, 0.0)]


def test_rollup_drops_null_keys_and_keeps_price_order(spark):
    df = spark.createDataFrame([("A", None), ("A", "N")], "scrip string, exchange string").selectExpr(
        "*", "1785987900L timestamp", "1D open", "2D high", "0.5D low", "1D close", "1D volume", "1L security_id")
    out = rollup.daily_bars(df)
    assert out.count() == 1
    assert out.where("low <= open AND close <= high").count() == 1


def test_rollup_is_a_hash_aggregate(spark):
    df = spark.createDataFrame([], "timestamp bigint, open double, high double, low double, close double, volume double, scrip string, exchange string, security_id bigint, seq bigint")
    for order in (None, fn.sequence_key("timestamp", "seq")):
        plan = rollup.daily_bars(df, order=order)._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan


# ---- dedup ----

def test_keep_first(spark):
    df = spark.createDataFrame([("1", 100, 15, 11.0, 1), ("1", 100, 15, 10.0, 0), (None, 1, 15, 1.0, 0), (None, 1, 15, 2.0, 1)],
                               "security_id string, timestamp bigint, interval_m int, close double, seq int")
    kept = dedup.keep_first(df, ["security_id", "timestamp", "interval_m"], ["seq"])
    assert rows(kept, "close") == [(1.0,), (10.0,)]
    assert "WindowGroupLimit" in kept._jdf.queryExecution().toString()


def test_prefer_source(spark):
    df = spark.createDataFrame([("a", "MONTH", 1), ("a", "MONTH", 2), ("b", "MONTH", 3), ("b", "WEEK", 4)], "cell string, flag string, n int")
    assert rows(dedup.prefer_source(df, ["cell"], "flag", "WEEK"), "n", "flag") == [(1, "MONTH"), (2, "MONTH"), (4, "WEEK")]


# ---- joins ----

def test_negative_list_with_null(spark):
    listed = spark.createDataFrame([("A",), ("B",)], "scrip string")
    negative = spark.createDataFrame([("A",), (None,)], "scrip string")
    assert rows(joins.without(listed, negative)) == [("B",)]
    assert rows(joins.only(listed, negative)) == [("A",)]
    assert rows(joins.subset(listed, "scrip", ["B", "C"])) == [("B",)]


def test_lists_are_joined_without_a_job(spark):
    big = spark.range(10).withColumnRenamed("id", "scrip")
    spark.sparkContext.setJobGroup("planning", "a list join")
    try:
        kept = joins.only(big, big.where("scrip < 3"))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert kept.count() == 3


def test_append_new_keeps_batch_duplicates_and_matches_nulls(spark):
    ddl = "date date, symbol string, series string, n int"
    new = spark.createDataFrame([(D1, "A", "EQ", 1), (D1, "A", "EQ", 2), (D1, "B", None, 3), (D2, "C", "EQ", 4)], ddl)
    stored = spark.createDataFrame([(D1, "B", None, 0), (D2, "C", "BE", 0), (D1, "B", None, 9)], ddl)
    fresh = mutate.append_new(new, stored, ["date", "symbol", "series"], "date")
    assert rows(fresh, "n") == [(1,), (2,), (4,)]
    assert mutate.append_new(new, new, ["date", "symbol", "series"], "date").count() == 0


def test_append_new_shares_one_shuffle_of_the_stored_keys(spark):
    ddl = "date date, symbol string, series string"
    a, b = (spark.createDataFrame([(D1, "A", "EQ")], ddl) for _ in range(2))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = joins.not_stored(a, b, ["date", "symbol", "series"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


# ---- splits ----

def frame(spark, data):
    return spark.createDataFrame(data, BAR)


def test_last_two_dates(spark):
    days = spark.createDataFrame([(D1,), (D2,), (D3,), (D3,), (None,)], "trade_date date")
    assert rows(splits.last_two_dates(days)) == [(D3, D2)]
    assert rows(splits.last_two_dates(days.where(F.col("trade_date") == F.lit(D1)))) == [(D1, None)]
    assert rows(splits.last_two_dates(days.where("false"))) == [(None, None)]


def test_split_check(spark):
    fetched = frame(spark, [bar("S", D2, 50.0), bar("T", D2, 10.001), bar("N", D2), bar("Z", D2, open_=None, close=1.0), bar("O", D3)])
    stored = frame(spark, [bar("S", D2, 100.0), bar("T", D2, 10.0), bar("Z", D2, close=2.0), bar("N", D1)])
    flags = splits.split_flags(fetched, stored, D2)
    assert rows(flags, "scrip", "reason", "field", "fetched_value", "stored_value") == [
        ("N", "missing_bq", None, None, None), ("S", "mismatch", "close", 50.0, 100.0), ("Z", "mismatch", "close", 1.0, 2.0)]
    assert rows(flags, "security_id", "check_date")[0] == ("1", D2)
    assert flags.select("run_ts").distinct().count() == 1
    assert rows(splits.flagged_scrips(flags)) == [("S",), ("Z",)]
    assert [f.name for f in flags.schema] == [c.split()[0] for c in schemas.FLAGS.split(", ")]
    check = spark.createDataFrame([(D2,)], "check_date date")
    assert rows(splits.split_flags(fetched, stored, check), "scrip") == rows(flags, "scrip")
    assert splits.split_flags(fetched, stored, None).count() == 0
    assert splits.split_flags(fetched, stored, D1).count() == 0
    assert splits.split_flags(fetched, stored.where("false"), D2).where("reason = 'missing_bq'").count() == 4


def test_split_check_is_run_per_stored_exchange(spark):
    fetched = frame(spark, [bar("S", D2, 10.0)])
    stored = frame(spark, [bar("S", D2, 10.0), bar("S", D2, 20.0, exchange="TEMP")])
    assert rows(splits.split_flags(fetched, stored, D2), "stored_value") == [(20.0,)]
    assert splits.split_flags(fetched, stored, D2, exchange_aware=True).count() == 0


def test_range_check_date(spark):
    assert rows(splits.oldest_date_in(frame(spark, [bar("A", D1), bar("A", D2), bar("A", D3)]), F.lit(D2), F.lit(D3))) == [(D2,)]


# ---- calendars ----

def test_stepped_windows(spark):
    w = calendars.stepped_windows(spark, start="2024-01-01", n=2, window_days=4, step_days=7)
    assert rows(w, "from_date", "to_date") == [(date(2024, 1, 1), date(2024, 1, 5)), (date(2024, 1, 8), date(2024, 1, 12))]
    assert calendars.stepped_windows(spark, start="2024-01-01", n=0, window_days=4, step_days=7).count() == 0


def test_contiguous_windows(spark):
    w = calendars.contiguous_windows(spark, start="2024-01-01", end="2024-01-12", window_days=5)
    assert rows(w, "from_date", "to_date") == [(date(2024, 1, 1), date(2024, 1, 6)), (date(2024, 1, 6), date(2024, 1, 11)),
                                               (date(2024, 1, 11), date(2024, 1, 13))]
    with pytest.raises(ValueError):
        calendars.contiguous_windows(spark, start="2024-01-02", end="2024-01-01", window_days=5)
    with pytest.raises(ValueError):
        calendars.contiguous_windows(spark, start="2024-01-01", end="2024-01-02", window_days=0)


@settings(max_examples=8, deadline=None)
@given(st.dates(date(2000, 1, 1), date(2030, 1, 1)), st.integers(0, 60), st.integers(1, 12))
def test_contiguous_windows_tile_every_day_once(spark, start, span, width):
    end = start + timedelta(days=span)
    out = calendars.contiguous_windows(spark, start=start, end=end, window_days=width).collect()
    covered = [r.from_date + timedelta(days=i) for r in out for i in range((r.to_date - r.from_date).days)]
    assert sorted(covered) == [start + timedelta(days=i) for i in range(span + 1)]


@settings(max_examples=8, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(1, 5))
def test_rows_in_windows_equal_a_containment_join(spark, width, step, n):
    start = date(2024, 1, 10)
    data = [(start + timedelta(days=i),) for i in range(-5, 60)]
    got = calendars.in_stepped_windows(spark.createDataFrame(data, "d date"), "d", start=start, n=n, window_days=width, step_days=step)
    want = [(d, i) for (d,) in data for i in range(n)
            if start + timedelta(days=i * step) <= d < start + timedelta(days=i * step + width)]
    assert rows(got, "d", "window_no") == sorted(want)


def test_trading_days(spark):
    assert [r[0].day for r in calendars.trading_days(spark, "2026-01-14", "2026-01-20").orderBy("day").collect()] == [14, 16, 19]
    assert calendars.days(spark, "2026-01-01", "2026-01-03").count() == 3


def test_recent_window(spark):
    assert rows(calendars.recent_window(spark.range(1), as_of="2026-08-07"), "from_date", "to_date") == [(date(2026, 8, 3), D3)]


def test_expiry_lookup(spark):
    pairs = spark.createDataFrame([(date(2026, 8, 4), date(2026, 8, d)) for d in (4, 11, 25)] * 2 + [(date(2026, 8, 4), date(2026, 8, 3))],
                                  "trade_date date, expiry_date date")
    lookup = calendars.expiry_lookup(pairs, [1, 2, 3, 4])
    assert rows(lookup, "expiry_code", "expiry_date", "expiry_flag") == [
        (1, date(2026, 8, 4), "WEEK"), (2, date(2026, 8, 11), "WEEK"), (3, date(2026, 8, 25), "MONTH")]
    with pytest.raises(ValueError):
        calendars.expiry_lookup(pairs, [0])
    known = calendars.with_expiry(spark.createDataFrame([(date(2026, 8, 4), 4)], "trade_date date, expiry_code int"), lookup)
    assert rows(known, "expiry_date", "expiry_flag") == [(None, "WEEK")]


def test_pending_tranches_and_grid(spark):
    days = spark.createDataFrame([(date(2026, 1, i),) for i in range(1, 8)], "day date")
    pairs = calendars.expiry_pairs(days, [1, 2])
    done = spark.createDataFrame([(date(2026, 1, 1), 1), (date(2026, 1, 2), 1), (date(2026, 1, 2), 2)], "trade_date date, expiry_code int")
    left = calendars.pending(pairs, done)
    assert left.count() == 11
    assert [r.tranche for r in calendars.tranches(left, 5).orderBy("trade_date").collect()] == [0] * 5 + [1]
    grid = calendars.option_requests(left)
    assert grid.count() == 11 * 21 * 2
    assert rows(calendars.request_cost(grid)) == [(462, 462 * 0.35 / 3600)]
    assert rows(grid.select("api_type", "option_type").distinct()) == [("CALL", "CE"), ("PUT", "PE")]


# ---- mutation ----

DAILY = "row_id string, scrip string, exchange string, trade_date date, open double, high double, low double, close double, volume double"


def test_upsert(spark):
    target = spark.createDataFrame([("r1", "A", "X", D1, 1.0, 1.0, 1.0, 5.0, 1.0), ("r0", "A", None, D1, 1.0, 1.0, 1.0, 1.0, 1.0)], DAILY)
    source = spark.createDataFrame([("r1", "A", "Y", D1, None, 1.0, 1.0, 6.0, 1.0), ("r2", "B", "Y", D1, 1.0, 1.0, 1.0, 2.0, 1.0),
                                    ("r0", "A", "Y", D1, 1.0, 1.0, 1.0, 3.0, 1.0)], DAILY)
    new = mutate.upsert(target, source)
    assert rows(new, "row_id", "exchange", "open", "close") == [("r0", None, 1.0, 3.0), ("r1", "X", None, 6.0), ("r2", "Y", 1.0, 2.0)]
    assert rows(mutate.upsert(new, source)) == rows(new)


def test_delete_keeps_rows_with_null_predicate(spark):
    df = spark.createDataFrame([("TEMP",), (None,), ("NSE",)], "exchange string")
    assert rows(mutate.delete_where(df, mutate.is_temp())) == [("NSE",), (None,)]


def test_delete_scrips_with_condition(spark):
    df = spark.createDataFrame([("A", 15), ("A", 60), ("B", 15), (None, 15)], "scrip string, interval_m int")
    gone = spark.createDataFrame([("A",), ("A",)], "scrip string")
    assert rows(mutate.delete_scrips(df, gone, F.col("interval_m") == 15)) == [("A", 60), ("B", 15), (None, 15)]
    assert rows(mutate.delete_scrips(df, gone)) == [("B", 15), (None, 15)]


def test_range_reload_is_a_fixpoint(spark):
    stored = frame(spark, [bar("S", D1, 100.0), bar("S", D2, 100.0), bar("T", D1, 9.0), bar("T", D2, 9.0), bar("T", D2, 9.0, exchange="TEMP")])
    clean, again = frame(spark, [bar("T", D2, 8.0)]), frame(spark, [bar("S", D1, 50.0), bar("S", D2, 50.0)])
    flagged = joins.names(spark, ["S"])
    new = mutate.range_reload(stored, clean, again, flagged, D2, D3)
    assert rows(new, "scrip", "trade_date", "close") == [("S", D1, 50.0), ("S", D2, 50.0), ("T", D1, 9.0), ("T", D2, 8.0)]
    assert rows(mutate.range_reload(new, clean, again, flagged, D2, D3)) == rows(new)


# ---- coverage ----

def test_value_counts(spark):
    df = spark.createDataFrame([("NSE", 1), ("NSE", 0), ("BSE", 0), (None, 1)], "e string, k int")
    assert [tuple(r) for r in coverage.value_counts(df, "e", F.col("k") == 1).collect()] == [("all", "NSE", 2), ("all", "BSE", 1), ("filtered", "NSE", 1)]


def test_bounds_are_overall(spark):
    df = spark.createDataFrame([("A", 1785957300, 15), ("B", 1786130100, 15), ("C", 1, 15), ("A", 1, 60)], "scrip string, timestamp bigint, interval_m int")
    per = coverage.scrip_bounds(df, joins.names(spark, ["A", "B", "X"]), 15)
    assert rows(per, "scrip") == [("A",), ("B",)]
    assert rows(coverage.overall_bounds(per)) == [(D2, date(2026, 8, 8))]


def test_latest(spark):
    df = spark.createDataFrame([("A", 100, 15), ("B", 200, 60)], "scrip string, timestamp bigint, interval_m int")
    assert coverage.latest_candle(df, "A").select(F.unix_seconds("latest")).first()[0] == 100
    assert coverage.latest_candle(df, interval=60).select(F.unix_seconds("latest")).first()[0] == 200
    assert coverage.latest_candle(df, "Z").first()[0] is None
    assert rows(coverage.count_where(df, F.col("scrip") == "A")) == [(1,)]


def test_fixed_holidays_are_weekdays():
    assert all(d.weekday() < 5 for d in fixed.HOLIDAYS)
