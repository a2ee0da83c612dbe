"""Chunk commits of the options job: a chunk that fails stays out, the others are in, the next run loads exactly it."""

import json

import pytest
from pyspark.sql import functions as F

import barsmith
from barsmith import commits, schemas, tables
from barsmith.sources import responses
from tests.conftest import rows
from tests.test_jobs import D, epoch, names  # noqa: F401
from tests.test_sources import option_body


def land(spark, path, cells):
    """{(date, code): number of candles}, landed as calls at the money."""
    lines = [json.dumps({"seq": i, "trade_date": str(d), "expiry_flag": "WEEK", "expiry_code": code, "strike_offset": 0, "option_type": "CE",
                         "security_ticker": "NIFTY", "security_id": "13", "interval": 1, "status": 200,
                         "body": json.dumps(option_body("ce", [epoch(d) + 60 * k for k in range(n)]))}) for i, ((d, code), n) in enumerate(cells.items())]
    path.write_text("\n".join(lines))
    return responses.read_responses(spark, str(path), schemas.OPTION_RESPONSE)


CELLS = {(d, code): 2 + code for d in D[:4] for code in (1, 2)}


def run(spark, names, landed, **more):  # noqa: F811
    return barsmith.run_options(spark, names, landed, D[0], D[4], offsets=(0,), **more)


def stored(spark, name):
    return rows(commits.read(spark, name).groupBy("trade_date", "expiry_code").count())


WHOLE = sorted((d, code, n) for (d, code), n in CELLS.items())


def test_a_failed_chunk_is_reported_and_loaded_later(spark, tmp_path, names, monkeypatch):  # noqa: F811
    landed, parse = land(spark, tmp_path / "a.json", CELLS), responses.option_candles

    def spoilt(*args):
        bad = (F.col("trade_date") == F.lit(D[1])) & (F.col("expiry_code") == 2)
        return parse(*args).withColumn("close", F.when(bad, F.raise_error(F.lit("torn")).cast("double")).otherwise(F.col("close")))

    monkeypatch.setattr(responses, "option_candles", spoilt)
    report = run(spark, names, landed, tranche_days=2)
    assert [(c["trade_date"], c["expiry_code"], "torn" in c["error"]) for c in report["failed_chunks"]] == [(D[1], 2, True)]
    assert (report["loaded"], report["failed"], report["still_pending"]) == (sum(CELLS.values()) - 4, 1, 8)
    assert rows(report["cells"].where("outcome = 'failed'"), "trade_date", "expiry_code") == [(D[1], 2)]
    assert stored(spark, names.option_table) == [c for c in WHOLE if c[:2] != (D[1], 2)]
    monkeypatch.setattr(responses, "option_candles", parse)
    report = run(spark, names, landed, tranche_days=2)
    assert (report["loaded"], report["failed_chunks"]) == (4, []) and stored(spark, names.option_table) == WHOLE
    assert run(spark, names, landed)["loaded"] == 0
    listed = rows(spark.table(commits.manifest(names.option_table)), "trade_date", "expiry_code", "rows")
    assert listed == WHOLE  # every chunk once


def test_rows_without_a_listed_chunk_do_not_count(spark, tmp_path, names, monkeypatch):  # noqa: F811
    landed = land(spark, tmp_path / "a.json", CELLS)

    def killed(*args):
        raise KeyboardInterrupt  # between the write and the listing

    monkeypatch.setattr(commits.Load, "_list", killed)
    with pytest.raises(KeyboardInterrupt):
        run(spark, names, landed)
    assert spark.table(names.option_table).count() > 0
    assert stored(spark, names.option_table) == [] and barsmith.latest_option_date(spark, names) is None
    monkeypatch.undo()
    assert run(spark, names, landed)["loaded"] == sum(CELLS.values())
    assert stored(spark, names.option_table) == WHOLE
    assert spark.table(names.option_table).count() > sum(CELLS.values())
    assert commits.clear_unlisted(spark, names.option_table) > 0
    assert spark.table(names.option_table).count() == sum(CELLS.values()) and stored(spark, names.option_table) == WHOLE


def test_a_manifest_that_cannot_be_written_leaves_no_doubles(spark, tmp_path, names, monkeypatch):  # noqa: F811
    landed, listing, calls = land(spark, tmp_path / "a.json", CELLS), commits.Load._list, []

    def once(self, *args):
        calls.append(1)
        if len(calls) == 1:
            raise OSError("full")
        listing(self, *args)

    monkeypatch.setattr(commits.Load, "_list", once)
    report = run(spark, names, landed)
    assert report["failed_chunks"] == [] and report["loaded"] == sum(CELLS.values())
    assert stored(spark, names.option_table) == WHOLE


def test_a_table_without_loads_goes_on(spark, tmp_path, names):  # noqa: F811
    tables.ensure_table(spark, names.option_table, schemas.OPTIONS)
    landed = land(spark, tmp_path / "a.json", CELLS)
    assert run(spark, names, landed)["loaded"] == sum(CELLS.values()) and run(spark, names, landed)["loaded"] == 0
    assert stored(spark, names.option_table) == WHOLE and not commits.has_manifest(spark, names.option_table)
