import numpy as np
import pandas as pd
import pytest

from helpers import random_walk, to_bars
from quantloom.operators import gates, validate as V


def flat(rows=30, ticker="AAA"):
    days = pd.date_range("2023-01-01", periods=rows, freq="B")
    return pd.DataFrame({"ticker": ticker, "date": days, "open": 150.0, "high": 155.0, "low": 148.0, "close": 152.0, "volume": 1e6})


def check(spark, frame, **kw):
    return V.validate_bars(to_bars(spark, frame), **kw).first()


def test_clean_bars_pass(spark):
    row = check(spark, flat())
    assert row.passed and row.errors == [] and row.warnings == [] and row.row_count == 30


def test_too_few_rows(spark):
    assert check(spark, flat(9)).errors == ["row_count: 9"]
    assert check(spark, flat(10)).passed


def test_missing_column_and_types(spark):
    bars = to_bars(spark, flat()).drop("volume", "high")
    row = V.validate_bars(bars).first()
    assert row.errors == ["absent: high, volume"]
    text = V.validate_bars(to_bars(spark, flat()).withColumn("date", V.F.col("date").cast("string"))).first()
    assert text.errors == ["order_type date: string"]
    zoned = V.validate_bars(to_bars(spark, flat()).withColumn("date", V.F.col("date").cast("timestamp"))).first()
    assert zoned.passed and zoned.warnings == ["order_type date: has a time zone"]


@pytest.mark.parametrize("nulls, passed, text", [(5, True, "null_share close: 5.0%"), (6, False, "null_share close: 6.0%")])
def test_null_share_is_strict(spark, nulls, passed, text):
    frame = flat(100)
    frame.loc[: nulls - 1, "close"] = np.nan
    row = check(spark, frame)
    assert row.passed is passed
    assert (row.warnings if passed else row.errors) == [text]


def test_price_limits(spark):
    frame = flat()
    frame.loc[3, "low"] = -1.0
    assert check(spark, frame).errors == ["price_floor low: 0.01"]
    frame = flat()
    frame.loc[3, "high"] = 2e6
    row = check(spark, frame)
    assert row.passed and row.warnings == ["price_ceiling high: 1000000.0"]


def test_volume(spark):
    frame = flat(20)
    frame.loc[:1, "volume"] = 0.0
    assert check(spark, frame).warnings == []
    frame.loc[:2, "volume"] = 0.0
    assert check(spark, frame).warnings == ["zero_share volume: 15.0%"]
    frame.loc[0, "volume"] = -1.0
    assert "sign volume: negative" in check(spark, frame).errors


def test_price_order_ignores_rows_with_nulls(spark):
    frame = flat()
    frame.loc[0, "high"] = 100.0
    frame.loc[1, ["high", "open"]] = [100.0, np.nan]
    frame.loc[2, "low"] = 200.0
    row = check(spark, frame)
    # a low above the high breaks both rules in that row
    assert "bad_high rows: 2" in row.errors
    assert "bad_low rows: 2" in row.errors


def test_requested_keys_status_and_routing(spark):
    bars = to_bars(spark, pd.concat([flat(30, "AAA"), flat(5, "BBB"), flat(30, "CCC")]))
    keys = V.requested_keys(bars, ["AAA", "BBB", "NONE"])
    report = V.validate_bars(bars, keys)
    rows = {r.ticker: r for r in report.collect()}
    assert set(rows) == {"AAA", "BBB", "NONE"}
    assert rows["NONE"].errors == ["no_rows"] and rows["NONE"].row_count == 0
    good, bad = V.route_valid(bars, report)
    assert {r.ticker for r in good.select("ticker").distinct().collect()} == {"AAA"}
    assert {r.ticker for r in bad.select("ticker").distinct().collect()} == {"BBB"}
    assert V.run_counts(V.key_status(keys, report)).first().asDict() == {"total": 3, "success": 1, "failed": 2}
    summary = V.ingest_summary(report)
    assert summary.first().asDict() == {"total": 3, "downloaded": 2, "validated": 1, "stored": 1, "failed_validation": 1}
    gates.require_stored(summary)


def test_gates(spark):
    bars = to_bars(spark, flat(5))
    with pytest.raises(gates.GateError, match="stored 0 of 1"):
        gates.require_stored(V.ingest_summary(V.validate_bars(bars)))
    keys = V.requested_keys(bars, ["AAA", "BBB"])
    made = spark.createDataFrame([("AAA", "train"), ("AAA", "val"), ("BBB", "train")], "ticker string, output string")
    missing = gates.check_outputs(gates.expected_outputs(keys, ["train", "val"]), made)
    assert [tuple(r) for r in missing.collect()] == [("BBB", "val")]
    with pytest.raises(gates.GateError, match="BBB/val"):
        gates.require_complete(missing)
    mixed = to_bars(spark, random_walk(4)).withColumn("split", V.F.when(V.F.dayofmonth("date") % 2 == 0, "val").otherwise("train"))
    assert gates.check_no_leakage(mixed).filter("NOT ok").count() == 1
