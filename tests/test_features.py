import dataclasses

import numpy as np
import pandas as pd
import pytest

from helpers import expected_features, random_walk, to_bars
from quantloom.functions.ewm import ewm_mean
from quantloom.operators.features import compute_features
from quantloom.operators.layout import DAILY, HOURLY, Series, lay_out
from quantloom.schema import FEATURES, TARGETS


def sorted_frame(df):
    return df.toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)


def assert_same(got, want, columns, tol=1e-9):
    assert len(got) == len(want)
    for c in columns:
        np.testing.assert_allclose(
            got[c].astype(float).values, want[c].astype(float).values, rtol=tol, atol=tol, err_msg=c
        )


@pytest.fixture(scope="module")
def two_keys():
    return pd.concat([random_walk(400, 1, "AAA"), random_walk(130, 2, "BBB")])


@pytest.fixture(scope="module")
def wanted(two_keys):
    parts = [expected_features(g) for _, g in two_keys.groupby("ticker")]
    return pd.concat(parts).sort_values(["ticker", "date"]).reset_index(drop=True)


def test_features_match_definitions(spark, two_keys, wanted):
    got = sorted_frame(compute_features(to_bars(spark, two_keys), drop_warmup=False))
    assert list(got.columns) == ["ticker", "date", *FEATURES, *TARGETS]
    assert len(FEATURES) == 40
    assert_same(got, wanted, FEATURES + TARGETS)


def test_segmented_layout_gives_the_same(spark, two_keys, wanted):
    cut = Series(bucket="hour", segment_rows=64)
    got = sorted_frame(compute_features(to_bars(spark, two_keys), cut, drop_warmup=False))
    assert_same(got, wanted, FEATURES + TARGETS)


def test_long_key_crosses_blocks_and_segments(spark):
    frame = random_walk(9000, 5, freq="h")
    want = expected_features(frame)
    for series in (DAILY, HOURLY, Series(bucket="hour", segment_rows=2500)):
        got = sorted_frame(compute_features(to_bars(spark, frame), series, drop_warmup=False))
        assert_same(got, want, FEATURES + TARGETS)


def test_warmup_drops_49_first_and_one_last_row(spark):
    for rows, left in ((50, 0), (51, 1), (120, 70)):
        bars = to_bars(spark, random_walk(rows))
        assert compute_features(bars).count() == left
        assert compute_features(bars, require_target=False).count() == max(left + 1, 0) if rows >= 50 else 0


def test_bounds_and_target_alignment(spark, two_keys):
    got = sorted_frame(compute_features(to_bars(spark, two_keys)))
    assert got.rsi_14.between(0, 100).all()
    assert (got.atr_14 >= 0).all()
    assert (got.bb_upper >= got.bb_lower).all()
    for _, g in got.groupby("ticker"):
        np.testing.assert_allclose(g.target_next_close.values[:-1], g.close.values[1:])


def test_constant_series_and_zero_price(spark):
    flat = random_walk(60)
    for c in ("open", "high", "low", "close"):
        flat[c] = 150.0
    got = sorted_frame(compute_features(to_bars(spark, flat)))
    assert np.allclose(got.bb_width, 0, atol=1e-9) and np.allclose(got.rsi_14, 0, atol=1e-6)
    flat.loc[55, ["open", "close"]] = 0.0
    assert compute_features(to_bars(spark, flat), drop_warmup=False).filter("returns_1d is null").count() >= 2


NULL_PATTERNS = {
    "none": lambda x: x,
    "first": lambda x: x.where(x.index > 3),
    "scattered": lambda x: x.where(np.random.default_rng(0).random(len(x)) > 0.2),
    "runs": lambda x: x.where((x.index // 40) % 3 != 1),
    "long run": lambda x: x.where((x.index < 500) | (x.index > 3900)),
    "few before a long run": lambda x: x.where((x.index < 2245) | (x.index > 5500)),
}


@pytest.mark.parametrize("pattern", NULL_PATTERNS)
@pytest.mark.parametrize(
    "how", [dict(span=12, adjust=False), dict(span=9, adjust=False), dict(com=13, adjust=True, min_periods=14), dict(span=200, adjust=False)]
)
def test_ewm_matches_pandas(spark, pattern, how):
    frame = random_walk(6000, 3, freq="h")
    frame["close"] = NULL_PATTERNS[pattern](frame["close"])
    want = frame["close"].ewm(**how).mean()
    got = sorted_frame(ewm_mean(to_bars(spark, frame), "close", "y", **how))
    np.testing.assert_allclose(got.y.astype(float).values, want.values, rtol=1e-11)


@pytest.mark.parametrize("pattern", NULL_PATTERNS)
@pytest.mark.parametrize("rows", [100, 1000])
def test_segmented_ewm(spark, pattern, rows):
    parts = []
    for k, key in enumerate(("AAA", "BBB")):
        frame = random_walk(6000 - 700 * k, 3 + k, key, freq="h")
        frame["close"] = NULL_PATTERNS[pattern](frame["close"])
        parts.append(frame)
    bars = to_bars(spark, pd.concat(parts))
    cut = dataclasses.replace(HOURLY, segment_rows=rows)
    for how in (dict(span=26, adjust=False), dict(com=13, adjust=True, min_periods=14), dict(span=200, adjust=False), dict(span=1, adjust=False)):
        want = np.concatenate([f["close"].ewm(**how).mean().values for f in parts])
        got = sorted_frame(ewm_mean(bars, "close", "y", series=cut, **how))
        np.testing.assert_allclose(got.y.astype(float).values, want, rtol=1e-11)


@pytest.mark.parametrize("pattern", ["scattered", "runs", "long run", "few before a long run"])
def test_segmented_features_with_nulls(spark, pattern):
    frame = random_walk(6000, 9, freq="h")
    for c in ("open", "high", "low", "close"):
        frame[c] = NULL_PATTERNS[pattern](frame[c])
    bars = to_bars(spark, frame)
    want = sorted_frame(compute_features(bars, drop_warmup=False))
    for rows in (150, 1000):
        got = sorted_frame(compute_features(bars, dataclasses.replace(HOURLY, segment_rows=rows), drop_warmup=False))
        assert_same(got, want, FEATURES + TARGETS)


def test_hot_key_is_spread_over_segments(spark):
    # one key holds two thirds of all rows
    frame = pd.concat([random_walk(6000, 1, "HOT", freq="min"), random_walk(3000, 2, "COLD", freq="min")])
    cut = Series(bucket="minute", segment_rows=500)
    layout = lay_out(to_bars(spark, frame), cut, before=50, after=1)
    sizes = layout.df.groupBy(*layout.part).count().toPandas()
    assert sizes["count"].max() <= 500 + 50 + 1 and len(sizes) == 18
    assert layout.finish(layout.df).groupBy("ticker", "date").count().filter("count > 1").count() == 0
    assert layout.finish(layout.df).count() == 9000
