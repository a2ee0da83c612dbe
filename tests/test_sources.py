import json
import zipfile
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from barsmith import fixed, schemas
from barsmith.sources import landed_files, responses
from barsmith.sources.stored import daily_rows, table_or_empty
from barsmith.operators import joins
from tests.conftest import rows

HEADER = ("SYMBOL, SERIES, DATE1, PREV_CLOSE, OPEN_PRICE, HIGH_PRICE, LOW_PRICE, LAST_PRICE, CLOSE_PRICE, "
          "AVG_PRICE, TTL_TRD_QNTY, TURNOVER_LACS, NO_OF_TRADES, DELIV_QTY, DELIV_PER")


def price_line(symbol, day, deliv=" -, -"):
    return f"{symbol}, EQ, {day}, 1, 2, 3, 1, 2, 2.5, 2.1, 100, 5.5, 7,{deliv}"


def price_file(folder, stamp, *lines, header=HEADER):
    (folder / f"sec_bhavdata_full_{stamp}.csv").write_text("\n".join([header, *lines]) + "\n")


def test_price_files(spark, tmp_path):
    price_file(tmp_path, "07082026", price_line("TCS", "07-Aug-2026"), price_line("NA", "07-Aug-2026", " 40, 40.5"))
    price_file(tmp_path, "08082026", price_line("TCS", "07-Aug-2026"))                                             # stale
    price_file(tmp_path, "09082026", price_line("A", "07-Aug-2026"), price_line("B", "09-Aug-2026"))               # mixed
    price_file(tmp_path, "10082026", price_line("TCS", "10-Aug-2026"), price_line("TCS", "10-Aug-2026"))           # duplicate
    price_file(tmp_path, "11082026", price_line("TCS", "11-Aug-2026"))                                             # out of range
    df = landed_files.price_files(spark, str(tmp_path), "2026-08-07", "2026-08-10")
    assert rows(df, "symbol", "series", "date", "deliv_qty", "close_price") == [
        ("NA", "EQ", date(2026, 8, 7), 40.0, 2.5), ("TCS", "EQ", date(2026, 8, 7), None, 2.5),
        ("TCS", "EQ", date(2026, 8, 10), None, 2.5), ("TCS", "EQ", date(2026, 8, 10), None, 2.5)]
    none = landed_files.price_files(spark, str(tmp_path), "2026-07-01", "2026-07-02")
    assert none.count() == 0 and none.columns == [c.split()[0] for c in schemas.PRICE_FILE.split(", ")]


def test_price_files_are_read_by_their_own_headers(spark, tmp_path):
    price_file(tmp_path, "07082026", price_line("TCS", "07-Aug-2026"))
    swapped = HEADER.replace("OPEN_PRICE", "X").replace("HIGH_PRICE", "OPEN_PRICE").replace("X", "HIGH_PRICE")
    price_file(tmp_path, "08082026", price_line("TCS", "08-Aug-2026"), header=swapped)
    price_file(tmp_path, "09082026")                                                                               # a header only
    price_file(tmp_path, "10082026", "9," + price_line("TCS", "10-Aug-2026"), header="EXTRA, " + HEADER)
    got = landed_files.price_files(spark, str(tmp_path), "2026-08-07", "2026-08-10")
    assert rows(got, "date", "symbol", "open_price", "high_price", "close_price") == [
        (date(2026, 8, 7), "TCS", 2.0, 3.0, 2.5), (date(2026, 8, 8), "TCS", 3.0, 2.0, 2.5), (date(2026, 8, 10), "TCS", 2.0, 3.0, 2.5)]


def test_missing_column_is_named(spark, tmp_path):
    price_file(tmp_path, "07082026", "A,EQ", header="SYMBOL,SERIES")
    with pytest.raises(Exception, match="07082026.csv lacks column DATE1"):
        landed_files.price_files(spark, str(tmp_path), "2026-08-07", "2026-08-08")
    assert landed_files.price_files(spark, str(tmp_path), "2026-08-08", "2026-08-09").count() == 0  # not asked for, not opened


def test_no_price_files_give_a_typed_empty_frame(spark, tmp_path):
    none = landed_files.price_files(spark, str(tmp_path), "2026-08-07", "2026-08-08")
    assert none.count() == 0 and none.schema.simpleString() == spark.createDataFrame([], schemas.PRICE_FILE).schema.simpleString()


MCAP = "Trade Date,Symbol,Series,Security Name,Category,Last Trade Date,Face Value(Rs.),Issue Size,Close Price/Paid up value(Rs.),Market Cap(Rs.)"


def archive(folder, stamp, member, *lines, header=MCAP):
    with zipfile.ZipFile(folder / f"PR{stamp}.zip", "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr(member, "\n".join([header, *lines]) + "\n")


def test_market_cap_files(spark, tmp_path):
    (tmp_path / "PR202608").mkdir()  # a folder's date of another form does not count
    archive(tmp_path / "PR202608", "120826", "mcap.csv", "12 Aug 2026,OUT,EQ,T,Listed,-,1,100,10.5,1050")
    assert landed_files.market_cap_files(spark, str(tmp_path / "PR202608"), "2026-08-12", "2026-08-12").count() == 1
    archive(tmp_path, "070826", "MCAP07082026.csv", '07 Aug 2026,TCS ,EQ,"Tata, Ltd", Listed,06 Aug 2026,1,100,10.5,1050',
            "07 Aug 2026,NA,EQ,,Listed,-,1,100,-,1050")
    archive(tmp_path, "080826", "pd080826.csv", "x")
    (tmp_path / "PR090826.zip").write_bytes(b"no archive")
    archive(tmp_path, "100826", "mcap10082026.csv", "07 Aug 2026,TCS,EQ,T,Listed,06 Aug 2026,1,100,10.5,1050")      # stale
    archive(tmp_path, "110826", "mcap11082026.csv", "11 Aug 2026,TCS,EQ,T,Listed,06 Aug 2026,1,100,10.5,1050",
            header=" " + MCAP.replace(",", " ,"))
    df = landed_files.market_cap_files(spark, str(tmp_path), "2026-08-07", "2026-08-11")
    assert rows(df, "symbol", "trade_date", "security_name", "last_trade_date", "close_price", "market_cap") == [
        ("NA", date(2026, 8, 7), None, None, None, 1050.0),
        ("TCS", date(2026, 8, 7), "Tata, Ltd", date(2026, 8, 6), 10.5, 1050.0),
        ("TCS", date(2026, 8, 11), "T", date(2026, 8, 6), 10.5, 1050.0)]
    assert landed_files.market_cap_files(spark, str(tmp_path), "2026-08-08", "2026-08-09").count() == 0


def test_instrument_master(spark, tmp_path):
    names = [*fixed.INSTRUMENT_COLUMNS, "EXTRA"]
    row = dict.fromkeys(names, "") | {"EXCH_ID": "NSE", "SEGMENT": "E", "SECURITY_ID": "11536", "INSTRUMENT": "EQUITY",
                                      "INSTRUMENT_TYPE": "ES", "LOT_SIZE": "1.0", "SM_EXPIRY_DATE": "0001-01-01x", "STRIKE_PRICE": "12.5"}
    lines = [",".join(names), ",".join(row.values()), ",".join((row | {"SEGMENT": "C", "EXCH_ID": "BSE"}).values()),
             ",".join((row | {"ASM_GSM_CATEGORY": "IV", "SM_EXPIRY_DATE": "2026-08-27"}).values())]
    (tmp_path / "m.csv").write_text("\n".join(lines) + "\n")
    master = landed_files.instrument_master(spark, str(tmp_path / "m.csv"))
    kept = landed_files.with_category_text(master.where(landed_files.traded()))
    assert rows(kept, "SECURITY_ID", "LOT_SIZE", "STRIKE_PRICE", "ASM_GSM_CATEGORY", "SM_EXPIRY_DATE") == [
        (11536, 1, 12.5, "IV", date(2026, 8, 27)), (11536, 1, 12.5, "None", None)]
    assert kept.columns == list(fixed.INSTRUMENT_COLUMNS)


def test_scrip_mapping_keeps_text(spark, tmp_path):
    (tmp_path / "list.csv").write_text("scrip,security_id,exc_seg,intraday\nA,007,NSE_EQ,yes\nB,7,NSE_EQ,\n")
    (tmp_path / "neg.csv").write_text("scrip\nA\n\"\"\n")
    mapping = landed_files.scrip_mapping(spark, str(tmp_path / "list.csv"), str(tmp_path / "neg.csv"))
    assert rows(mapping) == [("B", "7", "NSE_EQ", "")]
    assert rows(landed_files.scrip_mapping(spark, str(tmp_path / "list.csv")), "security_id") == [("007",), ("7",)]


def test_expiry_calendar_mixed_dates(spark, tmp_path):
    dates = ["03/04/2026", "2026-04-03", "13-Mar-2026", "03-04-2026", "3 Apr 2026", "03/04/26", ""]
    (tmp_path / "e.csv").write_text("Symbol,Date,Expiry\n" + "".join(f"NIFTY,{d},13-Mar-2026\n" for d in dates))
    df = landed_files.expiry_calendar(spark, str(tmp_path / "e.csv"))
    assert rows(df, "trade_date") == [(date(2026, 3, 13),), (date(2026, 4, 3),), (None,)]
    (tmp_path / "junk.csv").write_text("Symbol,Date,Expiry\nNIFTY,junk,13-Mar-2026\n")
    with pytest.raises(Exception, match="not a known date form"):
        landed_files.expiry_calendar(spark, str(tmp_path / "junk.csv")).collect()


# ---- responses ----

def landed(spark, tmp_path, *bodies, schema=schemas.RESPONSE, **tags):
    base = {"scrip": "A", "security_id": "007", "exc_seg": "NSE_EQ", "interval_m": 15, "status": 200} | tags
    lines = []
    for i, body in enumerate(bodies):
        over = {}
        if isinstance(body, tuple):
            body, over = body
        lines.append(json.dumps(base | {"seq": i, "body": body if isinstance(body, str) else json.dumps(body)} | over))
    (tmp_path / "r.json").write_text("\n".join(lines))
    return responses.read_responses(spark, str(tmp_path / "r.json"), schema)


def arrays(stamps, close=10.0, **over):
    n = len(stamps)
    return {"timestamp": stamps, "open": [1.0] * n, "high": [2.0] * n, "low": [0.5] * n, "close": [close] * n, "volume": [7] * n} | over


T0 = 1785987900                                        # 2026-08-06 09:15 IST


def test_daily_candles(spark, tmp_path):
    df = responses.daily_candles(landed(spark, tmp_path, arrays([T0, T0 + 86400]), arrays([T0], open=["x"], low=[None])))
    assert rows(df, "seq", "pos", "trade_date", "open", "low", "exchange", "security_id") == [
        (0, 0, date(2026, 8, 6), 1.0, 0.5, "NSE_EQ", "007"), (0, 1, date(2026, 8, 7), 1.0, 0.5, "NSE_EQ", "007"),
        (1, 0, date(2026, 8, 6), None, None, "NSE_EQ", "007")]


def test_nan_token_voids_only_itself(spark, tmp_path):
    body = '{"timestamp": [%d, %d], "open": [NaN, 2], "high": [1, 2], "low": [1, 2], "close": [1, 2], "volume": [1, 2]}' % (T0, T0 + 60)
    assert rows(responses.daily_candles(landed(spark, tmp_path, body)), "pos", "open") == [(0, None), (1, 2.0)]


def test_outcomes(spark, tmp_path):
    no_volume = arrays([T0])
    del no_volume["volume"]
    df = landed(spark, tmp_path, arrays([T0]), arrays([]), ("gone", {"status": 404}), ("", {"status": 429, "scrip": "B"}), no_volume,
                arrays([T0], close=1.0, high=[1.0, 2.0]), {"remarks": "closed"})
    out = responses.outcomes(df)
    assert rows(out, "seq", "outcome", "rows") == [(0, "ok", 1), (1, "none", 0), (2, "failed", 0), (3, "failed", 0),
                                                   (4, "none", 0), (5, "failed", 0), (6, "none", 0)]
    assert rows(out.where("seq IN (2, 6)"), "error") == [("HTTP 404",), ("closed",)]
    assert rows(responses.failed_scrips(df)) == [("A",), ("B",)]
    assert responses.daily_candles(df).count() == 1


def test_intraday_candles(spark, tmp_path):
    df = responses.intraday_candles(landed(spark, tmp_path, {"data": arrays([T0], 10.0)}, arrays([T0, T0 + 900], 11.0), scrip=" A "))
    assert rows(df, "scrip", "timestamp", "interval_m", "close", "trade_date") == [
        ("A", T0, 15, 10.0, date(2026, 8, 6)), ("A", T0 + 900, 15, 11.0, date(2026, 8, 6))]


def test_bad_timestamp_fails_the_job(spark, tmp_path):
    with pytest.raises(Exception, match="timestamp is not an integer"):
        responses.intraday_candles(landed(spark, tmp_path, arrays(["later"]))).collect()


def test_hourly_candles(spark, tmp_path):
    early = T0 - 60
    ok = {"status": "success", "data": arrays([early, T0, T0 + 3600])}
    bad = {"status": "failure", "remarks": "no", "data": arrays([T0 + 7200])}
    df = responses.hourly_candles(landed(spark, tmp_path, ok, ok, bad, interval_m=60))
    assert rows(df, "timestamp", "exchange", "security_id") == [(T0, "TEMP", 7), (T0 + 3600, "TEMP", 7)]


def option_body(side, stamps, strike=100.126, **over):
    n = len(stamps)
    data = {k: [1.5] * n for k in ("spot", "open", "high", "low", "close", "iv")}
    return {"data": {side: data | {"timestamp": stamps, "strike": [strike] * n, "volume": [3] * n, "oi": ["4"] * n} | over}}


def test_option_candles(spark, tmp_path):
    tags = {"trade_date": "2026-08-06", "expiry_flag": "WEEK", "expiry_code": 1, "strike_offset": -3, "option_type": "CE",
            "security_ticker": "NIFTY", "security_id": "13", "interval": 1, "status": 200}
    lookup = spark.createDataFrame([(date(2026, 8, 6), 1, date(2026, 8, 11), "WEEK"), (date(2026, 8, 6), 2, date(2026, 8, 25), "MONTH")],
                                   "trade_date date, expiry_code int, expiry_date date, expiry_flag string")
    df = landed(spark, tmp_path,
                option_body("ce", []), (option_body("ce", [T0, T0 + 60]), {"expiry_flag": "MONTH"}),          # WEEK empty, MONTH used
                (option_body("pe", [T0]), {"option_type": "PE"}),                                             # both have rows
                (option_body("pe", [T0, T0 + 60]), {"option_type": "PE", "expiry_flag": "MONTH"}),
                (option_body("ce", [T0], iv=[None], strike=1e999), {"expiry_code": 2, "expiry_flag": "MONTH"}),
                (option_body("ce", [T0]), {"expiry_code": 3}), schema=schemas.OPTION_RESPONSE, **tags)
    out = responses.option_candles(df, lookup)
    assert out.columns == schemas.OPTION_COLUMNS
    assert rows(out, "expiry_code", "option_type", "timestamp", "expiry_flag", "expiry_date", "strike_price", "iv") == [
        (1, "CE", T0, "MONTH", date(2026, 8, 11), Decimal("100.13"), 1.5), (1, "CE", T0 + 60, "MONTH", date(2026, 8, 11), Decimal("100.13"), 1.5),
        (1, "PE", T0, "WEEK", date(2026, 8, 11), Decimal("100.13"), 1.5), (2, "CE", T0, "MONTH", date(2026, 8, 25), None, None),
        (3, "CE", T0, "WEEK", None, Decimal("100.13"), 1.5)]
    assert rows(out.select("strike_offset", "volume", "oi", "trade_date").distinct()) == [("ATM-3", 3, 4, date(2026, 8, 6))]
    assert responses.option_candles(df).where("expiry_date IS NOT NULL").count() == 0


# ---- stored reads ----

def test_stored_read(spark):
    daily = spark.createDataFrame([("A", "NSE", date(2026, 8, 6), 1.0), ("A", "TEMP", date(2026, 8, 6), 2.0), ("B", "NSE", date(2026, 8, 6), 1.0),
                                   ("A", "NSE", date(2026, 8, 8), 1.0)], "scrip string, exchange string, trade_date date, open double") \
        .selectExpr("*", "open high", "open low", "open close", "open volume")
    got = daily_rows(daily, joins.names(spark, ["A", "A"]), "2026-08-06", "2026-08-07")
    assert rows(got, "scrip", "open") == [("A", 1.0), ("A", 2.0)]
    empty = daily_rows(daily, joins.names(spark, []), "2026-08-06", "2026-08-07")
    assert empty.count() == 0 and empty.columns == ["scrip", "trade_date", "open", "high", "low", "close", "volume"]
    assert table_or_empty(spark, "no_such_table", schemas.DAILY).count() == 0


def test_price_file_filter_prunes_the_listing(spark, tmp_path):
    for d in range(1, 10):
        price_file(tmp_path, f"0{d}082026", price_line("TCS", f"0{d}-Aug-2026"))
    asked = landed_files.file_date(fixed.PRICE_FILE_DATE).between(F.lit("2026-08-03").cast("date"), F.lit("2026-08-04").cast("date"))
    heads = landed_files.headers(spark, str(tmp_path), asked)
    assert heads.count() == 2
    df = spark.read.schema(landed_files.CELLS).csv(str(tmp_path)).where(asked)
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 2
