import datetime as dt

import pandas as pd
import pytest

from helpers import random_walk, to_bars
from quantloom.sources import bars as B
from quantloom.sources.stage import stage, stage_folder


def at(day, hour=0, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


@pytest.fixture(scope="module")
def ticks(spark):
    rows = [
        ("a", at(1, 9, 30), 3, 10.0, 1.0),
        ("a", at(1, 9, 30), 1, 20.0, 2.0),
        ("a", at(1, 16, 59), 7, 5.0, 1.5),
        ("a", at(2, 0, 0), 8, 7.0, 1.0),
        ("b", at(1, 23, 59), 9, None, 1.0),
    ]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long, price double, size double")


def test_bars_from_ticks_orders_by_time_then_sequence(ticks):
    by_seq = B.bars_from_ticks(ticks, "k", "ts", "price", "size", seq="id")
    by_struct = B.bars_from_ticks(ticks, "k", "ts", "price", "size", order_by=["ts", "id"])
    rows = {(r.ticker, r.date): r[2:] for r in by_seq.collect()}
    assert rows == {(r.ticker, r.date): r[2:] for r in by_struct.collect()}
    assert rows[("a", at(1))] == (20.0, 20.0, 5.0, 5.0, 4.5)
    assert rows[("a", at(2))] == (7.0, 7.0, 7.0, 7.0, 1.0)
    assert rows[("b", at(1))] == (None, None, None, None, 1.0)


def test_sequence_path_is_hash_based(ticks):
    plan = B.bars_from_ticks(ticks, "k", "ts", "price", seq="id")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("bucket, starts", [("hour", {at(1, 9), at(1, 16), at(2), at(1, 23)}), ("minute", {at(1, 9, 30), at(1, 16, 59), at(2), at(1, 23, 59)}), ("month", {at(1)})])
def test_buckets(ticks, bucket, starts):
    assert {r.date for r in B.bars_from_ticks(ticks, "k", "ts", "price", seq="id", bucket=bucket).collect()} == starts


def test_dedup_keeps_first_of_a_delivery_and_latest_run(spark):
    rows = [("a", at(2), 1.0, 0, "2024-02-01"), ("a", at(2), 2.0, 1, "2024-02-01"), ("a", at(2), None, 0, "2024-02-02"), ("a", at(3), 4.0, 0, "2024-02-01")]
    df = spark.createDataFrame(rows, "ticker string, date timestamp_ntz, close double, seq long, run_date string")
    one = df.filter("run_date = '2024-02-01'").drop("run_date")
    assert sorted((r.date.day, r.close) for r in B.dedup_first(one).collect()) == [(2, 1.0), (3, 4.0)]
    # the latest run wins as a whole row, also where its value is null
    assert sorted((r.date.day, r.close) for r in B.dedup_latest(df).collect()) == [(2, None), (3, 4.0)]


def test_drop_empty_prices(spark):
    rows = [("a", at(1), None, None, None, None, 1.0), ("a", at(2), None, 1.0, None, None, 1.0)]
    df = spark.createDataFrame(rows, B.BAR_SCHEMA)
    assert [r.date.day for r in B.drop_empty_prices(df).collect()] == [2]


def test_normalize_tz(spark):
    naive = spark.createDataFrame([(dt.datetime(2024, 1, 2, 19, 0),)], "date timestamp_ntz")
    got = B.normalize_tz(naive, zone="America/New_York").first()[0]
    assert got == dt.datetime(2024, 1, 3, 0, 0)
    assert B.normalize_tz(naive).first()[0] == dt.datetime(2024, 1, 2, 19, 0)
    zoned = spark.sql("SELECT TIMESTAMP'2024-01-02 19:00:00-05:00' AS date")
    out = B.normalize_tz(zoned)
    assert out.schema["date"].dataType.simpleString() == "timestamp_ntz"
    assert out.first()[0] == dt.datetime(2024, 1, 3, 0, 0)


def test_clean_bars_projects_and_tolerates_absent_columns(spark):
    df = spark.createDataFrame([(at(1), 1.0, 2, "x")], "d timestamp_ntz, Close double, Volume long, junk string")
    out = B.clean_bars(df, B.F.lit("a"), "d")
    assert out.columns == ["ticker", "date", "close", "volume"]


def test_date_range_and_lookback(spark):
    bars = to_bars(spark, random_walk(30, start="2024-01-01"))
    assert B.date_range(bars, "2024-01-05", "2024-01-08").count() == 3
    late = to_bars(spark, random_walk(200, start="2024-01-01"))
    days = [r.date.date() for r in B.lookback(late, 5, "2024-06-01").collect()]
    assert min(days) == dt.date(2024, 6, 1) - dt.timedelta(days=65) and max(days) == dt.date(2024, 5, 31)


def test_rerun_replaces_its_day_only(spark, tmp_path):
    path = str(tmp_path / "bars")
    first = to_bars(spark, pd.concat([random_walk(20, 1, "AAA"), random_walk(20, 2, "BBB")]))
    B.write_bars(first, path, "2024-03-01")
    B.write_bars(first.filter("ticker = 'AAA'").withColumn("close", B.F.lit(1.0)), path, "2024-03-02")
    B.write_bars(first.filter("ticker = 'AAA'").withColumn("close", B.F.lit(2.0)), path, "2024-03-02")
    got = B.read_bars(spark, path)
    assert got.count() == 40
    assert got.filter("ticker = 'AAA'").select("close").distinct().first()[0] == 2.0
    assert got.filter("ticker = 'BBB' AND close = 2.0").count() == 0
    missing = B.missing_keys(got, spark.createDataFrame([("AAA",), ("ZZZ",)], "ticker string"))
    assert [r.ticker for r in missing.collect()] == ["ZZZ"]


def test_read_prunes_partitions_and_pushes_dates(spark, tmp_path):
    path = str(tmp_path / "bars")
    B.write_bars(to_bars(spark, random_walk(20)), path, "2024-03-01")
    plan = B.read_bars(spark, path, ["AAA"], "2020-01-05")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date" in plan and "PartitionFilters: [isnotnull(ticker" in plan.replace("PartitionFilters: [ticker", "PartitionFilters: [isnotnull(ticker")


class FakeSession:
    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = master
        self.applicationId = "fake"

    def getConf(self):
        return self.conf


def test_stage_uses_the_session_folder(spark):
    assert stage_folder(FakeSession("hdfs:///shared/", "yarn")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        stage_folder(FakeSession(None, "yarn"))
    df = stage(spark.range(5), "x")
    assert df.count() == 5 and "parquet" in df._jdf.queryExecution().executedPlan().toString()


def test_stored_keys_keep_their_spelling(spark, tmp_path):
    from quantloom.sources.bars import read_stored

    keys = ["0700", "0005", "1E5", "2024-01-01", "a/b"]
    spark.createDataFrame([(k, float(i)) for i, k in enumerate(keys)], "ticker string, x double").write.partitionBy("ticker").parquet(f"{tmp_path}/t")
    got = read_stored(spark, f"{tmp_path}/t").collect()
    assert sorted((r.ticker, r.x) for r in got) == sorted((k, float(i)) for i, k in enumerate(keys))
