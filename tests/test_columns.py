import hashlib
from datetime import date, datetime
from decimal import Decimal

import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from barsmith import Settings
from barsmith.functions import columns as fn


def one(spark, values, ddl, column):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"x {ddl}").select(column).collect()]


def test_strip_removes_every_white_space(spark):
    assert one(spark, [" TCS", "\tA\n", " B\x0b", "a b", None], "string", fn.strip("x")) == ["TCS", "A", "B", "a b", None]


def test_coerce_double_agrees_with_pandas(spark):
    texts = [" 1.5", "-", " - ", "1e3", "Infinity", "-inf", "1,000", "0x10", "1_000", "nan", "1.0d", "2f", ".5", "5.", "+3", "", "NA"]
    expected = [None if pd.isna(v) else float(v) for v in pd.to_numeric(pd.Series(texts), errors="coerce")]
    assert one(spark, texts, "string", fn.coerce_double("x")) == expected


def test_coerce_long(spark):
    texts = ["12", "12.0", " 7 ", "x", None, "1785957300"]
    assert one(spark, texts, "string", fn.coerce_long("x")) == [12, 12, 7, None, None, 1785957300]


def test_strict_long_fails_on_junk(spark):
    with pytest.raises(Exception, match="security_id is not an integer: abc"):
        one(spark, ["1", "abc"], "string", fn.strict_long("x", "security_id"))


def test_split_rejects(spark):
    good, bad = fn.split_rejects(spark.createDataFrame([(1,), (None,)], "x int"), "x")
    assert (good.count(), bad.count()) == (1, 1)


def test_dates(spark):
    assert one(spark, ["07-Aug-2026", " 7-AUG-2026 "], "string", fn.strict_date("x", "d-MMM-yyyy")) == [date(2026, 8, 7)] * 2
    assert one(spark, ["07 Aug 2026", "-", "UNKNOWN", None], "string", fn.lenient_date("x", "d MMM yyyy")) == [date(2026, 8, 7), None, None, None]
    with pytest.raises(Exception):
        one(spark, ["junk"], "string", fn.strict_date("x", "d-MMM-yyyy"))


def test_scrub(spark):
    assert one(spark, [float("nan"), float("inf"), float("-inf"), 1.5, None], "double", fn.scrub("x")) == [None, None, None, 1.5, None]


def test_tick_round_known_values(spark):
    values = [2.675, 0.125, 1.005, 0.375, -2.675, 10.001, 1e12 + 0.125]
    assert one(spark, values, "double", fn.tick_round("x")) == [round(v, 2) for v in values]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.floats(-1e9, 1e9), st.integers(-10**8, 10**8).map(lambda n: n / 1000)), min_size=30, max_size=60),
       st.integers(0, 4))
def test_tick_round_is_python_round(spark, values, decimals):
    assert one(spark, values, "double", fn.tick_round("x", decimals)) == [float(round(v, decimals)) for v in values]


def test_strike_price(spark):
    assert one(spark, [19500.126, float("nan"), 2.675], "double", fn.strike_price("x")) == [Decimal("19500.13"), None, Decimal("2.68")]


def test_row_id(spark):
    df = spark.createDataFrame([("A1", "", "2", date(2026, 1, 1)), ("A", "", "12", date(2026, 1, 1)),
                                ("A", "", "012", date(2026, 1, 1)), ("A", None, "12", date(2026, 1, 1))],
                               "scrip string, exchange string, security_id string, trade_date date")
    plain = [r[0] for r in df.select(fn.row_id()).collect()]
    assert plain[0] == plain[1] == hashlib.sha256(b"A122026-01-01").hexdigest()
    assert plain[2] != plain[1] and plain[3] is None
    safe = [r[0] for r in df.select(fn.row_id(separator="|")).collect()]
    assert safe[0] != safe[1]


def test_ist(spark):
    epoch = 1785957300                       # 2026-08-05 19:15 UTC
    assert one(spark, [epoch], "bigint", fn.ist_date("x")) == [date(2026, 8, 6)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, [epoch], "bigint", fn.ist_date("x")) == [date(2026, 8, 6)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    native = F.to_date(F.from_utc_timestamp(F.timestamp_seconds("x"), "Asia/Kolkata"))
    moments = [epoch - 2700 + i for i in (-1, 0, 1)] + [0, 978307200]
    assert one(spark, moments, "bigint", fn.ist_date("x")) == one(spark, moments, "bigint", native)


def test_market_hours_edges(spark):
    midnight = 1785954600                    # 2026-08-06 00:00 IST
    seconds = [9 * 3600 + 14 * 60 + 59, 9 * 3600 + 15 * 60, 18 * 3600 + 30 * 60, 18 * 3600 + 30 * 60 + 1]
    assert one(spark, [midnight + s for s in seconds], "bigint", fn.in_market_hours("x")) == [False, True, True, False]


def test_offset_label(spark):
    assert one(spark, [-3, 0, 3], "int", fn.offset_label("x")) == ["ATM-3", "ATM", "ATM+3"]


def test_sequence_key_orders_like_a_pair(spark):
    pairs = [(1, 5), (1, 2**63 - 1), (2, 0), (-1, 3)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint").orderBy(fn.sequence_key("a", "b"))
    assert [tuple(r) for r in df.collect()] == sorted(pairs)


def test_to_date_arg():
    assert fn.to_date_arg("2026-01-02") == fn.to_date_arg(datetime(2026, 1, 2, 5)) == fn.to_date_arg(date(2026, 1, 2)) == date(2026, 1, 2)


def test_settings_list_all_missing():
    with pytest.raises(ValueError, match="no name yet: daily_table"):
        Settings().check("daily")
    assert Settings(daily_table="d").check("daily").daily_table == "d"
