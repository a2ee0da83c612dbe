import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import barsmith
from barsmith import Settings, fixed, schemas, tables
from barsmith.functions import columns as fn
from barsmith.operators import joins, mutate
from barsmith.session import stage
from barsmith.sources import responses
from tests.conftest import rows
from tests.test_sources import archive, option_body, price_file, price_line

D = [date(2026, 8, 3) + timedelta(days=i) for i in range(5)]           # Monday .. Friday


def epoch(day, hour=9, minute=15):
    """Epoch seconds of an IST wall-clock time."""
    return int(datetime(day.year, day.month, day.day, hour, minute).timestamp() - datetime(1970, 1, 1).timestamp()) - 19800


def candle_body(points):
    """{(epoch): close} as parallel arrays."""
    stamps = list(points)
    closes = [float(points[t]) for t in stamps]
    return {"timestamp": stamps, "open": closes, "high": closes, "low": closes, "close": closes, "volume": [10] * len(stamps)}


def fetch(spark, tmp_path, history, name="fetch.json", status=None, interval=1440, wrap=lambda b: b, ids=None):
    """Landed responses, one per scrip: {scrip: {epoch or date: close}}."""
    lines = []
    for i, (scrip, points) in enumerate(history.items()):
        points = {epoch(t) if isinstance(t, date) else t: c for t, c in points.items()}
        lines.append(json.dumps({"seq": i, "scrip": scrip, "security_id": (ids or {}).get(scrip, str(100 + ord(scrip[0]))), "exc_seg": "NSE_EQ",
                                 "interval_m": interval, "status": (status or {}).get(scrip, 200), "body": json.dumps(wrap(candle_body(points)))}))
    path = tmp_path / name
    path.write_text("\n".join(lines))
    return responses.read_responses(spark, str(path))


@pytest.fixture
def names(table_name):
    return Settings(daily_table=table_name("daily"), flag_table=table_name("flags"), intraday_table=table_name("intraday"),
                    option_table=table_name("options"), price_table=table_name("prices"), mcap_table=table_name("mcap"),
                    instrument_table=table_name("instruments"))


def store(spark, name, history, exchange="NSE_EQ"):
    tables.ensure_table(spark, name, schemas.DAILY, buckets=4)
    data = [(s, exchange, 100 + ord(s[0]), float(c), float(c), float(c), float(c), 1.0, d) for s, h in history.items() for d, c in h.items()]
    df = spark.createDataFrame(data, "scrip string, exchange string, security_id bigint, open double, high double, low double, close double, volume double, trade_date date")
    tables.append(df.withColumn("row_id", fn.row_id()), name)


def closes(spark, name):
    return rows(spark.table(name), "scrip", "exchange", "trade_date", "close")


def partitions(spark, name):
    """The dates that have directories."""
    return sorted({r[0].split("/")[0].split("=")[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()})


# ---- tables ----

def test_upsert_is_idempotent_and_touches_only_its_dates(spark, names):
    store(spark, names.daily_table, {"A": {D[0]: 1, D[1]: 2}})
    source = spark.table(names.daily_table).where(F.col("trade_date") == F.lit(D[1])).withColumn("close", F.lit(9.0))
    source = stage(source, "t")
    for _ in range(2):
        assert tables.upsert(spark, names.daily_table, source) == 1
        assert closes(spark, names.daily_table) == [("A", "NSE_EQ", D[0], 1.0), ("A", "NSE_EQ", D[1], 9.0)]


def test_delete_drops_emptied_partitions(spark, names):
    name = names.daily_table
    store(spark, name, {"A": {D[0]: 1, D[1]: 2}, "B": {D[1]: 3}})
    store(spark, name, {"A": {D[2]: 1}}, exchange=None)
    tables.delete(spark, name, F.col("scrip") == "A")
    assert closes(spark, name) == [("B", "NSE_EQ", D[1], 3.0)]
    assert partitions(spark, name) == [str(D[1])]


def test_delete_keeps_null_exchange(spark, names):
    name = names.daily_table
    store(spark, name, {"A": {D[0]: 1}}, exchange=None)
    store(spark, name, {"A": {D[0]: 2, D[1]: 2}}, exchange="TEMP")
    tables.delete(spark, name, mutate.is_temp())
    assert rows(spark.table(name), "exchange", "close") == [(None, 1.0)]
    assert partitions(spark, name) == [str(D[0])]
    tables.delete(spark, name, mutate.is_temp())


def test_delete_range_and_scrips(spark, names):
    name = names.daily_table
    store(spark, name, {"A": {D[0]: 1, D[1]: 2, D[2]: 3}, "B": {D[2]: 4}})
    tables.delete_range(spark, name, D[0], D[1])
    assert partitions(spark, name) == [str(D[2])]
    tables.delete_scrips(spark, name, joins.names(spark, []))
    assert spark.table(name).count() == 2
    tables.delete_scrips(spark, name, joins.names(spark, ["A"]))
    assert closes(spark, name) == [("B", "NSE_EQ", D[2], 4.0)]


# ---- daily ----

def test_run_daily(spark, tmp_path, names):
    store(spark, names.daily_table, {"S": {D[0]: 100, D[1]: 100}, "T": {D[1]: 10}})
    got = fetch(spark, tmp_path, {"S": {D[1]: 50, D[2]: 51}, "T": {D[1]: 10.001, D[2]: 11}, "N": {D[1]: 7, D[2]: 8}, "F": {}, "X": {D[2]: 1}}, status={"F": 404})
    mapping = joins.names(spark, ["S", "T", "N", "F"])
    report = barsmith.run_daily(spark, names, got, mapping, flags_csv=str(tmp_path / "flags"))
    assert (report["last_date"], report["check_date"], report["rows"], report["scrips"]) == (D[2], D[1], 6, 3)
    assert (report["flagged"], report["failed"], report["uploaded"], report["flags_written"]) == (["S"], ["F"], 3, 5)
    assert rows(spark.table(names.flag_table), "scrip", "reason").count(("S", "mismatch")) == 4
    assert rows(spark.table(names.flag_table).where("reason = 'missing_bq'"), "scrip") == [("N",)]
    assert spark.read.option("header", True).csv(str(tmp_path / "flags")).count() == 5
    assert closes(spark, names.daily_table) == [("N", "NSE_EQ", D[2], 8.0), ("S", "NSE_EQ", D[0], 100.0), ("S", "NSE_EQ", D[1], 100.0),
                                                ("S", "NSE_EQ", D[2], 51.0), ("T", "NSE_EQ", D[1], 10.0), ("T", "NSE_EQ", D[2], 11.0)]


def test_run_daily_skips_flagged_and_writes_no_flags_for_new_scrips(spark, tmp_path, names):
    store(spark, names.daily_table, {"S": {D[1]: 100}})
    skip = Settings(daily_table=names.daily_table, flag_table=names.flag_table, upload_mismatched=False)
    report = barsmith.run_daily(spark, skip, fetch(spark, tmp_path, {"S": {D[1]: 50, D[2]: 51}, "N": {D[1]: 1, D[2]: 2}}))
    assert report["uploaded"] == 1 and report["flagged"] == ["S"]
    only_new = Settings(daily_table=names.daily_table, flag_table=names.flag_table + "_2")
    report = barsmith.run_daily(spark, only_new, fetch(spark, tmp_path, {"M": {D[1]: 1, D[2]: 2}}, "b.json"))
    assert report["flags"].count() == 1 and report["flags_written"] == 0
    assert not spark.catalog.tableExists(only_new.flag_table)


def test_run_daily_with_one_date_or_none(spark, tmp_path, names):
    report = barsmith.run_daily(spark, names, fetch(spark, tmp_path, {"S": {D[1]: 50}}))
    assert (report["check_date"], report["uploaded"], report["flags"].count()) == (None, 1, 0)
    report = barsmith.run_daily(spark, names, fetch(spark, tmp_path, {"S": {}}, "b.json"))
    assert (report["last_date"], report["uploaded"], report["failed"]) == (None, 0, [])


def test_unreadable_timestamps_are_rejected_and_counted(spark, tmp_path, names):
    def spoil(body):
        return body | {"timestamp": ["later", *body["timestamp"][1:]]} if body["timestamp"] else body

    report = barsmith.run_daily(spark, names, fetch(spark, tmp_path, {"S": {D[1]: 50, D[2]: 51}}, wrap=spoil))
    assert (report["rejected"], report["rows"], report["uploaded"]) == (1, 1, 1)
    report = barsmith.run_intraday(spark, names, fetch(spark, tmp_path, {"S": {D[1]: 50, D[2]: 51}}, "b.json", interval=15, wrap=spoil))
    assert (report["rejected"], report["loaded"]) == (1, 1)


def test_recent_window():
    assert barsmith.recent_window(as_of="2026-08-07") == (D[0], D[4])


def test_run_daily_fails_on_text_id(spark, tmp_path, names):
    with pytest.raises(Exception, match="security_id is not an integer"):
        barsmith.run_daily(spark, names, fetch(spark, tmp_path, {"S": {D[1]: 50}}, ids={"S": "abc"}))


def test_run_daily_from_hourly(spark, tmp_path, names):
    store(spark, names.daily_table, {"A": {D[0]: 5, D[1]: 5}})
    store(spark, names.daily_table, {"Q": {D[4]: 1}}, exchange="TEMP")
    hours = {epoch(D[0], 10): 1, epoch(D[1], 9): 99, epoch(D[1], 9, 15): 2, epoch(D[1], 12): 4, epoch(D[1], 18, 30): 3, epoch(D[1], 19): 98}
    got = fetch(spark, tmp_path, {"A": hours, "E": {}}, interval=60, wrap=lambda b: {"status": "success", "data": b})
    for _ in range(2):
        report = barsmith.run_daily_from_hourly(spark, names, got, D[1])
        assert (report["fetched"], report["uploaded"], report["failed"]) == (4, 2, ["E"])
        assert rows(report["check"]) == [(D[1], 1)]
        assert closes(spark, names.daily_table) == [("A", "NSE_EQ", D[0], 5.0), ("A", "NSE_EQ", D[1], 5.0), ("A", "TEMP", D[1], 3.0)]
    bar = spark.table(names.daily_table).where("exchange = 'TEMP'").first()
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume) == (2.0, 4.0, 2.0, 3.0, 30.0)


def test_lifetime_reload(spark, tmp_path, names):
    store(spark, names.daily_table, {"A": {D[0]: 5}, "B": {D[1]: 6}})
    store(spark, names.daily_table, {"A": {D[4]: 1}}, exchange="TEMP")
    dry = barsmith.run_daily_reload(spark, names, None, "lifetime", dry_run=True)
    assert dry["existing_rows"] == 3 and rows(dry["plan"], "scope", "rows") == [("all", 3), ("temp", 1)]
    empty = barsmith.run_daily_reload(spark, names, fetch(spark, tmp_path, {"A": {}}), "lifetime")
    assert empty["uploaded"] == 0 and closes(spark, names.daily_table) == [("A", "NSE_EQ", D[0], 5.0), ("B", "NSE_EQ", D[1], 6.0)]
    got = fetch(spark, tmp_path, {"A": {D[0]: 50, D[2]: 51}}, "b.json")
    assert barsmith.run_daily_reload(spark, names, got, "lifetime")["uploaded"] == 2
    assert closes(spark, names.daily_table) == [("A", "NSE_EQ", D[0], 50.0), ("A", "NSE_EQ", D[2], 51.0)]
    assert partitions(spark, names.daily_table) == [str(D[0]), str(D[2])]


def test_range_reload(spark, tmp_path, names):
    store(spark, names.daily_table, {"S": {D[0]: 100, D[1]: 100, D[3]: 100}, "T": {D[0]: 9, D[1]: 10, D[3]: 9}, "L": {D[1]: 1}})
    store(spark, names.daily_table, {"T": {D[4]: 1}}, exchange="TEMP")
    before = closes(spark, names.daily_table)
    got = fetch(spark, tmp_path, {"S": {D[0]: 50, D[1]: 50}, "T": {D[0]: 77, D[1]: 10, D[2]: 12}})
    dry = barsmith.run_daily_reload(spark, names, got, "range", D[1], D[2], dry_run=True)
    assert dry["check_date"] == D[1] and dry["flagged"] == ["S"]
    assert rows(dry["plan"], "action", "scope", "rows", "scrips") == sorted([
        ("delete", "temp", 1, 1), ("delete", "range", 3, 3), ("delete", "flagged lifetime", 3, 1), ("upsert", "clean range", 2, 1),
        ("refetch", "flagged lifetime", 1, 1), ("lost", "range", 1, 1)])
    assert closes(spark, names.daily_table) == before and not spark.catalog.tableExists(names.flag_table)

    waiting = barsmith.run_daily_reload(spark, names, got, "range", D[1], D[2])
    assert waiting["need_lifetime"] == ["S"] and closes(spark, names.daily_table) == before

    asked = []

    def land(flagged):
        asked.append(rows(flagged))
        return fetch(spark, tmp_path, {"S": {D[0]: 50, D[1]: 50, D[3]: 50}}, "life.json")

    report = barsmith.run_daily_reload(spark, names, got, "range", D[1], D[2], lifetime=land)
    assert asked == [[("S",)]]
    assert (report["uploaded_range"], report["uploaded_lifetime"], report["uploaded"]) == (2, 3, 5)
    after = [("S", "NSE_EQ", D[0], 50.0), ("S", "NSE_EQ", D[1], 50.0), ("S", "NSE_EQ", D[3], 50.0),
             ("T", "NSE_EQ", D[0], 9.0), ("T", "NSE_EQ", D[1], 10.0), ("T", "NSE_EQ", D[2], 12.0), ("T", "NSE_EQ", D[3], 9.0)]
    assert closes(spark, names.daily_table) == after
    assert partitions(spark, names.daily_table) == [str(d) for d in D[:4]]
    again = barsmith.run_daily_reload(spark, names, got, "range", D[1], D[2], lifetime=land)
    assert again["flagged"] == [] and closes(spark, names.daily_table) == after


def test_range_reload_with_empty_fetch_clears_temp_only(spark, tmp_path, names):
    store(spark, names.daily_table, {"A": {D[1]: 1}})
    store(spark, names.daily_table, {"A": {D[1]: 2}}, exchange="TEMP")
    report = barsmith.run_daily_reload(spark, names, fetch(spark, tmp_path, {"A": {}}), "range", D[0], D[2])
    assert report["fetched"] == 0 and closes(spark, names.daily_table) == [("A", "NSE_EQ", D[1], 1.0)]


def test_reload_arguments(spark, names):
    with pytest.raises(ValueError, match="from_date"):
        barsmith.run_daily_reload(spark, names, None, "range")
    with pytest.raises(ValueError, match="lifetime"):
        barsmith.run_daily_reload(spark, names, None, "weekly")
    with pytest.raises(ValueError, match="daily_table"):
        barsmith.run_daily_reload(spark, Settings(), None, "lifetime")


# ---- intraday ----

def test_run_intraday_and_reload(spark, tmp_path, names):
    first = fetch(spark, tmp_path, {"A": {epoch(D[0]): 1, epoch(D[1]): 2}, "B": {epoch(D[0]): 3}, "E": {}}, interval=15)
    report = barsmith.run_intraday(spark, names, first)
    assert (report["responses"], report["failed"], report["loaded"]) == (2, 1, 3)
    assert barsmith.run_intraday(spark, names, first)["loaded"] == 0
    more = fetch(spark, tmp_path, {"A": {epoch(D[1]): 9, epoch(D[1], 9, 30): 5}}, "b.json", interval=15)
    assert barsmith.run_intraday(spark, names, more)["loaded"] == 1
    assert barsmith.latest_intraday(spark, names) is not None
    assert barsmith.latest_intraday(spark, names, scrip="Z") is None

    flagged = joins.names(spark, ["A", "Z"])
    dry = barsmith.run_intraday_reload_for_flagged(spark, names, flagged, None, window_days=1, dry_run=True)
    assert (dry["eligible"], dry["not_eligible"], dry["oldest"], dry["newest"], dry["windows"]) == (["A"], ["Z"], D[0], D[1], 2)
    nothing = barsmith.run_intraday_reload_for_flagged(spark, names, flagged, lambda e, w: fetch(spark, tmp_path, {"A": {}}, "c.json", interval=15))
    assert nothing["loaded"] == 0 and spark.table(names.intraday_table).count() == 4

    def land(eligible, windows):
        assert rows(eligible) == [("A",)] and windows.count() == 1
        return fetch(spark, tmp_path, {"A": {epoch(D[0]): 10, epoch(D[2]): 20}, "B": {epoch(D[0]): 99}}, "d.json", interval=15)

    report = barsmith.run_intraday_reload_for_flagged(spark, names, flagged, land)
    assert report["loaded"] == 2
    assert rows(spark.table(names.intraday_table), "scrip", "trade_date", "close") == [("A", D[0], 10.0), ("A", D[2], 20.0), ("B", D[0], 3.0)]
    assert barsmith.run_intraday_reload_for_flagged(spark, names, joins.names(spark, ["Z"]), None)["eligible"] == []


def test_requested_windows_that_never_landed(spark, tmp_path, names):
    window = {"from_date": D[0], "to_date": D[4]}

    def dated(df):
        return df.withColumns({k: F.lit(v) for k, v in window.items()})

    asked = dated(joins.names(spark, ["A", "E", "F", "M"])).withColumn("interval_m", F.lit(15))
    got = dated(fetch(spark, tmp_path, {"A": {epoch(D[0]): 1}, "E": {}, "F": {}, "U": {epoch(D[0]): 1}}, interval=15, status={"F": 500}))
    report = barsmith.run_intraday(spark, names, got, asked)
    assert rows(report["windows"], "scrip", "outcome", "error") == [
        ("A", "ok", None), ("E", "none", "no rows"), ("F", "failed", "HTTP 500"), ("M", "missing", "never landed")]
    assert report["unfinished"] == 2 and rows(report["windows"].select("from_date", "to_date").distinct()) == [(D[0], D[4])]
    hourly = dated(fetch(spark, tmp_path, {"A": {epoch(D[1], 10): 1}, "F": {}}, "h.json", interval=60, status={"F": 500}, wrap=lambda b: {"status": "success", "data": b}))
    report = barsmith.run_daily_from_hourly(spark, names, hourly, D[0], requests=asked.drop("interval_m"))
    assert rows(report["failed_windows"], "scrip", "error") == [("E", "never landed"), ("F", "HTTP 500"), ("M", "never landed")]


def test_window_requests(spark):
    grid = barsmith.window_requests(joins.names(spark, ["A", "B"]), start="2024-01-01", n=3)
    assert grid.count() == 6


# ---- options ----

def test_run_options_resumes(spark, tmp_path, names):
    def land(name, *cells):
        lines = [json.dumps({"seq": i, "trade_date": str(d), "expiry_flag": "WEEK", "expiry_code": code, "strike_offset": off, "option_type": "CE",
                             "security_ticker": "NIFTY", "security_id": "13", "interval": 1, "status": 200,
                             "body": json.dumps(option_body("ce", [epoch(d), epoch(d) + 60]))}) for i, (d, code, off) in enumerate(cells)]
        (tmp_path / name).write_text("\n".join(lines))
        return responses.read_responses(spark, str(tmp_path / name), schemas.OPTION_RESPONSE)

    expiries = spark.createDataFrame([(D[0], D[3]), (D[1], D[3])], "trade_date date, expiry_date date")
    report = barsmith.run_options(spark, names, land("a.json", (D[0], 1, 0), (D[0], 1, 1), (D[4], 1, 0)), D[0], D[4], expiries, tranche_days=3)
    assert (report["pending_pairs"], report["calls"], report["tranches"], report["loaded"]) == (8, 8 * 42, 2, 4)
    assert rows(spark.table(names.option_table).select("trade_date", "expiry_date", "expiry_flag").distinct()) == [(D[0], D[3], "WEEK")]
    report = barsmith.run_options(spark, names, land("b.json", (D[0], 1, 0), (D[1], 2, 0)), D[0], D[4], expiries)
    assert (report["pending_pairs"], report["loaded"]) == (8, 2)
    # A failed cell stays open; its repaired response loads later, an empty one counts as known.
    failed = land("c.json", (D[2], 1, 0), (D[2], 1, 1)).withColumn("status", F.expr("IF(strike_offset = 0, 500, 200)"))
    report = barsmith.run_options(spark, names, failed, D[2], D[3], expiries, offsets=(0, 1))
    assert (report["loaded"], report["failed"], report["missing"], report["still_pending"]) == (2, 1, 6, 2)
    report = barsmith.run_options(spark, names, land("d.json", (D[2], 1, 0), (D[2], 1, 1)), D[2], D[3], expiries, offsets=(0, 1))
    assert (report["loaded"], report["failed"], report["missing"]) == (2, 0, 6)
    assert spark.table(names.option_table).where("trade_date = DATE'2026-08-05'").count() == 4
    assert barsmith.latest_option_date(spark, names) == D[2]
    assert barsmith.latest_option_date(spark, names, "BANKNIFTY") is None
    assert partitions(spark, names.option_table) == [str(D[0]), str(D[1]), str(D[2])]


# ---- files ----

def test_run_price_files_twice(spark, tmp_path, names):
    price_file(tmp_path, "03082026", price_line("A", "03-Aug-2026"), price_line("A", "03-Aug-2026"))
    report = barsmith.run_price_files(spark, names, str(tmp_path), "2026-08-01", "2026-08-05")
    assert (report["fetched_days"], report["loaded"]) == ([D[0]], 2)
    assert barsmith.run_price_files(spark, names, str(tmp_path), "2026-08-01", "2026-08-05")["loaded"] == 0
    price_file(tmp_path, "04082026", price_line("A", "04-Aug-2026"))
    assert barsmith.run_price_files(spark, names, str(tmp_path), "2026-08-01", "2026-08-05")["loaded"] == 1
    assert spark.table(names.price_table).count() == 3
    with pytest.raises(ValueError):
        barsmith.run_price_files(spark, names, str(tmp_path), "2026-08-05", "2026-08-01")


def test_run_market_cap_twice(spark, tmp_path, names):
    archive(tmp_path, "030826", "mcap03082026.csv", "03 Aug 2026,TCS,EQ,T,Listed,-,1,100,10.5,1050")
    assert barsmith.run_market_cap(spark, names, str(tmp_path), "2026-08-01", "2026-08-05")["loaded"] == 1
    report = barsmith.run_market_cap(spark, names, str(tmp_path), "2026-08-01", "2026-08-05")
    assert (report["fetched_days"], report["loaded"]) == ([D[0]], 0)


def test_run_instrument_master_replaces(spark, tmp_path, names):
    row = dict.fromkeys(fixed.INSTRUMENT_COLUMNS, "") | {"EXCH_ID": "NSE", "SEGMENT": "E", "SECURITY_ID": "1", "INSTRUMENT": "EQUITY", "INSTRUMENT_TYPE": "ES"}
    path = tmp_path / "m.csv"
    for ids in (["1", "2"], ["3"]):
        lines = [",".join((row | {"SECURITY_ID": i}).values()) for i in ids] + [",".join((row | {"SEGMENT": "C"}).values())]
        path.write_text("\n".join([",".join(row), *lines]) + "\n")
        report = barsmith.run_instrument_master(spark, names, str(path))
        assert report["loaded"] == len(ids)
        assert rows(spark.table(names.instrument_table), "SECURITY_ID", "ASM_GSM_CATEGORY") == [(int(i), "None") for i in ids]
        assert rows(report["counts"], "scope", "n") == [("all", len(ids) + 1), ("filtered", len(ids))]
