"""The physical plans that matter at scale."""

import re

import pytest

from quantloom.operators import drift, prep, validate
from quantloom.operators.features import compute_features
from quantloom.operators.layout import DAILY, HOURLY
from quantloom.plans.queries import table
from quantloom.schema import BAR_SCHEMA, FEATURES
from quantloom.sources import bars as B
from quantloom.sources.stage import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bars(spark):
    ticks = table(spark, SF, "orders")
    return stage(B.bars_from_ticks(ticks, "o_orderpriority", "o_orderdate", "o_totalprice", seq="o_orderkey"), "plan-bars")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"\bExchange (?:hash|range|Single|RoundRobin)", plan(df)))


def test_bars_schema(bars):
    assert [(f.name, f.dataType) for f in bars.schema.fields] == [(f.name, f.dataType) for f in BAR_SCHEMA.fields]


def test_features_need_one_exchange_and_no_python(bars):
    df = compute_features(bars)
    text = plan(df)
    assert exchanges(df) == 1
    assert text.count("+- Sort [") == 2
    assert "Python" not in text and "Pandas" not in text and "Join" not in text


def test_plain_window_features_share_one_window_group(bars):
    cols = [c for c in FEATURES if c.startswith(("sma", "returns", "close_lag", "return_lag", "bb_", "volume_"))]
    text = plan(compute_features(bars, drop_warmup=False).select(*cols))
    # row numbers, then all lags and rolling frames
    assert text.count("+- Window [") <= 2


def test_segments_never_window_over_a_whole_key(bars):
    text = plan(compute_features(bars, HOURLY))
    big = [w for w in re.findall(r"Window \[.*?\], \[(.*?)\], \[", text)]
    names = [re.sub(r"#\d+L?", "", w) for w in big]
    assert all("_seg" in n or "_slice" in n or n == "ticker" for n in names)
    # windows by key alone work on the counts per time slice only
    for line in text.splitlines():
        if "Window [" in line and "], [ticker#" in line and "_slice" in line and "_seg" not in line:
            assert "sum(_rows" in line or "row_number()" in line


def test_column_pruning_reaches_the_scan(bars):
    text = plan(compute_features(bars).select("ticker", "date", "sma_10"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "volume" not in schema and "open" not in schema


def test_small_sides_are_broadcast(bars):
    split = stage(prep.chrono_split(compute_features(bars)), "plan-split")
    scaler = stage(prep.fit_robust_scaler(split), "plan-scaler")
    df = prep.apply_scaler(split, scaler)
    df.write.format("noop").mode("overwrite").save()
    assert "BroadcastHashJoin" in plan(df) or "BroadcastHashJoin" in final_plan(df)
    report = stage(validate.validate_bars(bars), "plan-report")
    assert "BroadcastHashJoin" in plan(validate.route_valid(bars, report)[0])


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_validation_is_one_aggregate(bars):
    df = validate.validate_bars(bars)
    assert exchanges(df) == 1 and "partial_count" in plan(df)


def test_drift_reads_each_side_once(bars):
    features = stage(compute_features(bars), "plan-features")
    text = plan(drift.data_drift(features, features, series=DAILY))
    assert text.count("FileScan") == 2 and "Python" not in text and "CartesianProduct" not in text


def test_distributions_need_one_exchange(spark):
    rows = spark.createDataFrame([("A", 1.0, 2.0), ("B", 2.0, 3.0)], "ticker string, x double, y double")
    assert exchanges(drift.ecdf_pair(rows, rows, ["x", "y"])) == 1
    assert exchanges(drift.sample_statistics(rows, rows, ["x", "y"])) == 1
