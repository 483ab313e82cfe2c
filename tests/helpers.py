"""Small bar tables, and the features of one key worked out row by row from their definitions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd

from quantloom.schema import BAR_SCHEMA

TICKS = 6


def random_walk(rows: int, seed: int = 42, ticker: str = "AAA", start: str = "2020-01-01", freq: str = "D") -> pd.DataFrame:
    """Bars of six ticks each; the log of the price takes normal steps."""
    rng = np.random.default_rng(seed)
    price = 100 * np.exp(rng.normal(0, 0.004, rows * TICKS).cumsum()).reshape(rows, TICKS)
    bars = {"open": price[:, 0], "high": price.max(axis=1), "low": price.min(axis=1), "close": price[:, -1]}
    traded = rng.integers(10_000, 300_000, (rows, TICKS)).sum(axis=1).astype(float)
    return pd.DataFrame({"ticker": ticker, "date": pd.date_range(start, periods=rows, freq=freq), **bars, "volume": traded})


def to_bars(spark, frame: pd.DataFrame):
    values = [
        tuple(None if (isinstance(v, float) and np.isnan(v)) else (v.to_pydatetime() if isinstance(v, pd.Timestamp) else v) for v in row)
        for row in frame[[f.name for f in BAR_SCHEMA.fields]].itertuples(index=False, name=None)
    ]
    return spark.createDataFrame(values, BAR_SCHEMA)


class _Smooth:
    """A recursive mean that starts with its first value."""

    def __init__(self, span: int):
        self.gain, self.level = 2 / (span + 1), None

    def push(self, x: float) -> float:
        self.level = x if self.level is None else self.level + self.gain * (x - self.level)
        return self.level


class _Decay:
    """A mean whose weights fall by 13/14 a row, known from the 14th value on."""

    def __init__(self):
        self.total, self.weight, self.seen = 0.0, 0.0, 0

    def push(self, x: float) -> float:
        self.total, self.weight, self.seen = self.total * 13 / 14 + x, self.weight * 13 / 14 + 1, self.seen + 1
        return self.total / self.weight if self.seen >= 14 else math.nan


def expected_features(frame: pd.DataFrame) -> pd.DataFrame:
    """The bars of one key without nulls, in order, with the 40 features and both targets."""
    bars = list(frame.itertuples(index=False))
    close = [b.close for b in bars]
    volume = [b.volume for b in bars]

    def back(i: int, n: int) -> float:
        return close[i - n] if 0 <= i - n < len(close) else math.nan

    def growth(i: int, n: int) -> float:
        return back(i, 0) / back(i, n) - 1

    def mean(values: list[float], i: int, n: int) -> float:
        return math.fsum(values[i - n + 1 : i + 1]) / n if i >= n - 1 else math.nan

    def deviation(i: int, n: int) -> float:
        middle = mean(close, i, n)
        return math.sqrt(math.fsum((x - middle) ** 2 for x in close[max(0, i - n + 1) : i + 1]) / (n - 1))

    fast, slow, signal = _Smooth(12), _Smooth(26), _Smooth(9)
    rise, fall, span = _Decay(), _Decay(), _Decay()
    rows = []
    for i, bar in enumerate(bars):
        row = bar._asdict()
        for n in (1, 5, 10):
            row[f"returns_{n}d"] = growth(i, n)
        for n in (1, 2, 3, 5, 10):
            row[f"close_lag_{n}"], row[f"return_lag_{n}"] = back(i, n), growth(i - 1, n)
        s10, s20, s50 = (mean(close, i, n) for n in (10, 20, 50))
        row |= {"sma_10": s10, "sma_20": s20, "sma_50": s50, "sma10_sma20_cross": s10 / s20 - 1}
        row |= {"close_to_sma20": bar.close / s20 - 1, "close_to_sma50": bar.close / s50 - 1}
        row |= {"high_low_range": (bar.high - bar.low) / bar.close, "close_open_spread": (bar.close - bar.open) / bar.open}

        row["ema_12"], row["ema_26"] = fast.push(bar.close), slow.push(bar.close)
        row["macd"] = row["ema_12"] - row["ema_26"]
        row["macd_signal"] = signal.push(row["macd"])
        row["macd_hist"] = row["macd"] - row["macd_signal"]

        row["rsi_14"] = math.nan
        reach = bar.high - bar.low
        if i:
            step = bar.close - close[i - 1]
            gained, lost = rise.push(max(step, 0.0)), fall.push(max(-step, 0.0))
            row["rsi_14"] = 100 - 100 / (1 + gained / (lost + 1e-9))
            reach = max(bar.high, close[i - 1]) - min(bar.low, close[i - 1])
        row["atr_14"] = span.push(reach)

        wide = 2 * deviation(i, 20)
        row |= {"bb_upper": s20 + wide, "bb_lower": s20 - wide, "bb_width": 2 * wide / s20}
        row["bb_pos"] = (bar.close - s20 + wide) / (2 * wide + 1e-9)

        usual = mean(volume, i, 10)
        row |= {"volume_sma_10": usual, "volume_ratio": bar.volume / (usual + 1e-9), "log_volume": math.log1p(bar.volume)}
        row |= {"target_next_close": back(i, -1), "target_next_return": growth(i + 1, 1) if i + 1 < len(bars) else math.nan}
        rows.append(row)
    return pd.DataFrame(rows)
