import pandas as pd

from helpers import random_walk, to_bars
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.schema import BAR_SCHEMA
from quantloom.operators.validate import Limits, add_counts, bar_counts, validate_bars
from quantloom.sources.bars import bars_from_ticks, read_bars, write_bars
from quantloom.streaming.ticks import TickColumns, ingest_ticks
from quantloom.streaming.ingest import _versions, compact_profile, ingest_new_files, store_delivery, stored_counts


def test_only_new_files_are_taken_and_later_runs_win(spark, tmp_path):
    source, root, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = T.StructType([*BAR_SCHEMA.fields, T.StructField("seq", T.LongType())])

    def deliver(frame, close=None):
        df = to_bars(spark, frame).withColumn("seq", F.lit(0).cast("long"))
        again = df.withColumn("seq", F.lit(1).cast("long")).withColumn("close", F.lit(-1.0))
        df = df if close is None else df.withColumn("close", F.lit(close))
        df.union(again).coalesce(1).write.mode("append").parquet(source)

    def ingest(day):
        ingest_new_files(spark, source, schema, root, check, day)

    deliver(pd.concat([random_walk(20, 1, "AAA"), random_walk(5, 2, "SHORT")]))
    ingest("2024-01-01")
    stored = read_bars(spark, f"{root}/bars")
    assert {r.ticker for r in stored.select("ticker").distinct().collect()} == {"AAA"}
    assert stored.count() == 20 and stored.filter("close < 0").count() == 0

    late = random_walk(20, 1, "AAA")
    for c in ("open", "high", "low", "close"):
        late[c] = 50.0
    deliver(late.tail(12))
    ingest("2024-01-02")
    ingest("2024-01-03")
    stored = read_bars(spark, f"{root}/bars")
    assert stored.count() == 20 and stored.filter("close = 50").count() == 12
    reports = spark.read.parquet(f"{root}/reports")
    assert reports.filter("run_date = '2024-01-01' AND NOT passed").first().ticker == "SHORT"
    assert reports.filter("run_date = '2024-01-03'").count() == 0


def test_increments_of_any_size_add_up(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = random_walk(40, 1, "AAA")
    small = random_walk(12, 2, "0700")

    def store(frame, batch, day="2024-01-01"):
        df = to_bars(spark, frame).withColumn("seq", F.lit(0).cast("long"))
        report = store_delivery(df, root, day, batch=batch).collect()
        return {r.ticker: r.passed for r in report}

    def count(key):
        return read_bars(spark, f"{root}/bars").filter(F.col("ticker") == key).count()

    # two batches of one date, then one bar
    assert store(pd.concat([rows.head(20), small.head(5)]), 0) == {"AAA": True, "0700": False}
    assert store(rows.iloc[20:39], 1) == {"AAA": True}
    assert store(pd.concat([rows.tail(1), small.iloc[5:9]]), 2) == {"AAA": True, "0700": False}
    assert (count("AAA"), count("0700")) == (40, 0)
    # held rows come in when there are enough; repeating a batch changes nothing
    for _ in range(2):
        assert store(small.iloc[9:11], 3, "2024-01-02") == {"0700": True}
        assert count("0700") == 11
    # a key that is stored no longer looks at its held rows
    late = small.head(1).copy()
    for c in ("open", "high", "low", "close"):
        late[c] = 50.0
    assert store(late, 4, "2024-01-03") == {"0700": True}
    assert store(small.tail(1), 5, "2024-01-04") == {"0700": True}
    stored = read_bars(spark, f"{root}/bars").filter("ticker = '0700'")
    assert stored.count() == 12 and stored.filter("close = 50").count() == 1
    assert spark.read.parquet(f"{root}/reports").select("batch").distinct().count() == 6


def test_a_bad_increment_is_not_held(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = to_bars(spark, random_walk(20, 1, "AAA")).withColumn("seq", F.lit(0).cast("long"))
    store_delivery(rows, root, "2024-01-01")
    store_delivery(rows.limit(3).withColumn("close", F.lit(-5.0)), root, "2024-01-02")
    assert read_bars(spark, f"{root}/bars").filter("close < 0").count() == 0
    assert store_delivery(rows.limit(1), root, "2024-01-03").first().passed


def counted(spark, root):
    rows = add_counts(stored_counts(spark, root)).collect()
    want = bar_counts(read_bars(spark, f"{root}/bars")).collect()
    assert {r.ticker: r.asDict() for r in rows} == {r.ticker: r.asDict() for r in want}


def test_profile_takes_overwritten_bars_out(spark, tmp_path):
    root = str(tmp_path / "out")
    frame = pd.concat([random_walk(300, 1, "AAA"), random_walk(200, 2, "BBB")])

    def store(rows, day, batch=0, **changes):
        df = to_bars(spark, rows).withColumn("seq", F.lit(0).cast("long")).withColumns({c: F.lit(v).cast("double") for c, v in changes.items()})
        report = {r.ticker: r for r in store_delivery(df, root, day, batch=batch).collect()}
        full = {r.ticker: r for r in validate_bars(read_bars(spark, f"{root}/bars")).collect()}
        for k, r in report.items():
            assert not r.passed or (r.errors, r.warnings, r.row_count) == (full[k].errors, full[k].warnings, full[k].row_count)
        counted(spark, root)
        return report

    store(frame, "2024-01-01")
    # zero volumes in, then out again; high prices stay in one month
    some = frame[(frame.ticker == "AAA")].iloc[100:180] if "ticker" in frame else frame.iloc[100:180]
    assert "zero_share" in store(some, "2024-01-02", volume=0)["AAA"].warnings[0]
    assert not store(some, "2024-01-03", volume=5)["AAA"].warnings
    assert any("price_ceiling" in w for w in store(some.head(3), "2024-01-04", high=1e9)["AAA"].warnings)
    # a batch that is repeated with fewer rows gives up the others, also when later ones exist
    assert any("price_ceiling" in w for w in store(some.head(1), "2024-01-04", high=1e9)["AAA"].warnings)
    store(some.head(40), "2024-01-02", volume=7)
    # a key that would fail is not stored and not counted
    assert not store(some.head(3), "2024-01-05", close=-1)["AAA"].passed
    compact_profile(spark, root)
    assert len(_versions(spark, f"{root}/profile")) == 1
    counted(spark, root)
    store(some.head(2), "2024-01-06", high=1e9)


def test_increment_reads_only_touched_months(spark, tmp_path):
    root = str(tmp_path / "out")
    frame = random_walk(300, 1, "AAA")
    df = to_bars(spark, frame).withColumn("seq", F.lit(0).cast("long"))
    store_delivery(df, root, "2024-01-01")
    # bars that no delivery brought, in the first month: a check that reads them fails
    stray = to_bars(spark, frame.head(5)).withColumn("close", F.lit(-5.0))
    write_bars(stray, f"{root}/bars", "2024-01-01", 7)
    newest = df.orderBy(F.desc("date")).limit(5)
    report = store_delivery(newest, root, "2024-01-02").first()
    assert report.passed and report.row_count == 300
    # with other limits the profile does not hold, and all months are counted
    report = store_delivery(newest, root, "2024-01-03", limits=Limits(min_price=0.02)).first()
    assert not report.passed and report.errors == ["price_floor close: 0.02", *report.errors[1:]]


def ticks(spark, days, per_day, keys=("AAA", "B 1")):
    rows = []
    for k, key in enumerate(keys):
        for d in range(days):
            for i in range(per_day):
                at = pd.Timestamp("2024-01-01") + pd.Timedelta(days=d, minutes=(i * 37 + k) % 1440)
                rows.append((key, at.to_pydatetime(), float((i * 7919 + d * 31) % 97), len(rows)))
    return spark.createDataFrame(rows, "sym string, at timestamp_ntz, px double, n long"), rows


def test_replay_in_any_file_order_gives_the_batch_bars(spark, tmp_path):
    source, path, check = (str(tmp_path / n) for n in ("in", "bars", "check"))
    df, _rows = ticks(spark, 12, 25)
    columns = TickColumns("sym", "at", "px", "n")
    # files hold days at random, and each trigger takes two of them
    df.repartition(7, F.xxhash64("n")).write.parquet(source)
    counted = ingest_ticks(spark, source, df.schema, path, check, columns, "2024-02-01", delay="30 days", files_per_trigger=2)
    assert counted == {"rows": 600, "late": 0}
    got = {tuple(r) for r in read_bars(spark, path).select(*BAR_SCHEMA.names).collect()}
    assert got == {tuple(r) for r in bars_from_ticks(df, "sym", "at", "px", seq="n").collect()} and len(got) == 24
    # more files later on: open bars are handed out again
    more = df.limit(3).withColumn("px", F.lit(1000.0)).withColumn("n", F.col("n") + 10_000)
    more.write.mode("append").parquet(source)
    assert ingest_ticks(spark, source, df.schema, path, check, columns, "2024-02-01", delay="30 days") == {"rows": 3, "late": 0}
    both = bars_from_ticks(df.union(more), "sym", "at", "px", seq="n")
    assert {tuple(r) for r in read_bars(spark, path).select(*BAR_SCHEMA.names).collect()} == {tuple(r) for r in both.collect()}


def test_late_ticks_are_counted_and_left_out(spark, tmp_path):
    source, path, check = (str(tmp_path / n) for n in ("in", "bars", "check"))
    df, _rows = ticks(spark, 10, 12, ("AAA",))
    columns, bounds = TickColumns("sym", "at", "px", "n"), {"delay": "1 day", "bucket": "hour"}
    df.coalesce(1).write.parquet(source)
    assert ingest_ticks(spark, source, df.schema, path, check, columns, "2024-02-01", **bounds)["late"] == 0
    closed = {tuple(r) for r in read_bars(spark, path).select(*BAR_SCHEMA.names).collect()}
    late = df.filter("at < timestamp_ntz'2024-01-04'").withColumn("px", F.lit(-1.0)).withColumn("n", F.col("n") + 10_000)
    late.coalesce(1).write.mode("append").parquet(source)
    assert ingest_ticks(spark, source, df.schema, path, check, columns, "2024-02-01", **bounds) == {"rows": 36, "late": 36}
    assert {tuple(r) for r in read_bars(spark, path).select(*BAR_SCHEMA.names).collect()} == closed
