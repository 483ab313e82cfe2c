import numpy as np
import pandas as pd
import pytest

from helpers import random_walk, to_bars
from quantloom.operators import gates, prep
from quantloom.operators.features import compute_features
from quantloom.operators.layout import DAILY, HOURLY, Series, with_positions
from quantloom.schema import FEATURES

CUT = Series(bucket="hour", segment_rows=50)


def table(spark, rows, ticker="AAA", seed=0):
    frame = random_walk(rows, seed, ticker)
    return to_bars(spark, frame).withColumn("target_next_close", prep.F.col("close") + 1), frame


@pytest.mark.parametrize("series", [DAILY, HOURLY])
def test_positions(spark, series):
    df, _ = table(spark, 90)
    rows = with_positions(df, series).orderBy("date").collect()
    assert [r._pos for r in rows] == list(range(90)) and {r._n for r in rows} == {90}


@pytest.mark.parametrize("n", [1, 2, 90, 100, 170, 180, 300])
def test_split_bounds_are_double_products(spark, n):
    df, _ = table(spark, n)
    for series in (DAILY, HOURLY):
        report = prep.split_report(prep.chrono_split(df, series=series), ["close"]).first()
        a, b = int(n * 0.70), int(n * (0.70 + 0.15))
        assert (report.train_rows, report.val_rows, report.test_rows) == (a, b - a, n - b)


def test_no_leakage(spark):
    df, _ = table(spark, 120)
    assert gates.check_no_leakage(prep.chrono_split(df)).filter("NOT ok").count() == 0


@pytest.mark.parametrize("exact_groups", [True, False])
def test_scaler_is_exact(spark, exact_groups):
    parts = [table(spark, 400, "AAA", 1), table(spark, 77, "BBB", 2)]
    df = parts[0][0].union(parts[1][0])
    df = df.withColumn("open", prep.F.round("open", 0)).withColumn("high", prep.F.lit(3.0))
    cols = ["open", "high", "close", "volume"]
    split = prep.chrono_split(df).withColumn("close", prep.F.when(prep.F.dayofmonth("date") != 7, prep.F.col("close")))
    got = {(r.ticker, r.feature): (r.center, r.scale) for r in prep.fit_robust_scaler(split, cols, exact_groups=exact_groups).collect()}
    train = split.filter("split = 'train'").toPandas()
    assert len(got) == 8
    for (ticker, c), (center, scale) in got.items():
        x = train[train.ticker == ticker][c].dropna()
        q = np.quantile(x, [0.25, 0.5, 0.75])
        assert center == pytest.approx(q[1], rel=1e-12)
        assert scale == pytest.approx(q[2] - q[0] if q[2] > q[0] else 1.0, rel=1e-12)


def test_scaled_train_has_median_zero_and_keeps_targets(spark):
    features = compute_features(to_bars(spark, random_walk(200)))
    split = prep.chrono_split(features)
    scaled = prep.apply_scaler(split, prep.fit_robust_scaler(split)).toPandas().sort_values("date")
    train = scaled[scaled.split == "train"]
    assert np.allclose(train[FEATURES].median(), 0, atol=1e-9)
    raw = features.toPandas().sort_values("date")
    np.testing.assert_array_equal(scaled.target_next_close.values, raw.target_next_close.values)


@pytest.mark.parametrize("series", [DAILY, CUT])
def test_sequences_stay_in_their_split(spark, series):
    df, frame = table(spark, 200)
    split = prep.chrono_split(df).cache()
    got = prep.make_sequences(split, ["open", "close"], 10, series=series).toPandas().sort_values("date")
    assert got.groupby("split").size().to_dict() == {"train": 130, "val": 20, "test": 20}
    values = frame[["open", "close"]].values.astype(np.float32)
    index = {d: i for i, d in enumerate(frame.date)}
    for r in got.itertuples():
        i = index[pd.Timestamp(r.date)]
        np.testing.assert_array_equal(np.array([list(x) for x in r.X], dtype=np.float32), values[i - 10 : i])
        assert np.float32(r.y) == np.float32(frame.close[i] + 1)
    now = prep.make_sequences(split, ["close"], 10, include_current=True, series=series)
    assert now.count() == got.shape[0] + 3


def test_split_of_exactly_seq_len_rows_has_no_sequence(spark):
    df, _ = table(spark, 40)
    one = df.withColumn("split", prep.F.lit("train"))
    assert prep.make_sequences(one, ["close"], 40).count() == 0
    assert prep.make_sequences(one, ["close"], 39).count() == 1


def test_feature_columns_ignore_added_columns(spark):
    features = compute_features(to_bars(spark, random_walk(60))).withColumn("extra", prep.F.lit(1.0))
    assert prep.feature_columns(features) == FEATURES
