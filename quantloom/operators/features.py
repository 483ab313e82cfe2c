"""The 40 technical features, the two targets and the warm-up filter."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quantloom.functions.ewm import Ewm, add_blocks, add_ewm, alpha_from, block_rows
from quantloom.functions.rolling import change, full_frame, lag
from quantloom.operators.layout import DAILY, Series, lay_out
from quantloom.schema import BAR_VALUES, FEATURES, LAGS, SMA_WINDOWS, TARGETS, WARMUP_COLUMNS

# Smoothing lengths, and the guard against a zero divisor.
_FAST, _SLOW, _SIGNAL, _PERIOD = 12, 26, 9, 14
_TINY = "1e-9D"

_FIRST_PASS = [
    Ewm("close", "ema_12", alpha_from(span=_FAST), adjust=False),
    Ewm("close", "ema_26", alpha_from(span=_SLOW), adjust=False),
    Ewm("_gain", "_avg_gain", alpha_from(com=_PERIOD - 1), adjust=True, min_periods=_PERIOD),
    Ewm("_loss", "_avg_loss", alpha_from(com=_PERIOD - 1), adjust=True, min_periods=_PERIOD),
    Ewm("_range", "atr_14", alpha_from(com=_PERIOD - 1), adjust=True, min_periods=_PERIOD),
]
_SECOND_PASS = [Ewm("macd", "macd_signal", alpha_from(span=_SIGNAL), adjust=False, starts="_starts")]
_BLOCK = block_rows(_FIRST_PASS + _SECOND_PASS)

# features of one row only, in terms of the columns before them
_ROW_FEATURES = {
    "high_low_range": "try_divide(high - low, close)",
    "close_open_spread": "try_divide(close - open, open)",
    "close_to_sma20": "try_divide(close, sma_20) - 1",
    "close_to_sma50": "try_divide(close, sma_50) - 1",
    "sma10_sma20_cross": "try_divide(sma_10, sma_20) - 1",
    "bb_width": "try_divide(bb_upper - bb_lower, sma_20)",
    "bb_pos": f"try_divide(close - bb_lower, bb_upper - bb_lower + {_TINY})",
    "volume_ratio": f"try_divide(volume, volume_sma_10 + {_TINY})",
    "log_volume": "log1p(volume)",
    "macd_hist": "macd - macd_signal",
    "rsi_14": f"100 - 100 / (1 + _avg_gain / (_avg_loss + {_TINY}))",
}


def _with(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"{sql} AS {name}" for name, sql in columns.items()])


_CHANGES = [1, 5, 10]
_LAGS_USED = sorted({1, *_CHANGES, *LAGS, *(n + 1 for n in LAGS)})
_REACH = max(*_LAGS_USED, *SMA_WINDOWS)


def _window_features(over: str) -> dict[str, str]:
    """Lags, the next close and rolling frames: one window group, one sort. Each lag is read once."""
    return {
        **{f"_back_{n}": lag("close", over, n) for n in _LAGS_USED},
        **{f"sma_{n}": full_frame("avg", "close", over, n) for n in SMA_WINDOWS},
        "_std": full_frame("stddev_samp", "close", over, 20),
        "volume_sma_10": full_frame("avg", "volume", over, 10),
        "target_next_close": f"lead(close, 1) OVER ({over})",
    }


def _lag_features() -> dict[str, str]:
    """Changes over some rows, and the same changes as seen one row ago."""
    return {
        **{f"returns_{n}d": change("close", f"_back_{n}") for n in _CHANGES},
        **{f"close_lag_{n}": f"_back_{n}" for n in LAGS},
        **{f"return_lag_{n}": change("_back_1", f"_back_{n + 1}") for n in LAGS},
        "target_next_return": change("target_next_close", "close"),
        "bb_upper": "sma_20 + 2 * _std",
        "bb_lower": "sma_20 - 2 * _std",
    }


def compute_features(
    bars: DataFrame,
    series: Series = DAILY,
    require_target: bool = True,
    drop_warmup: bool = True,
) -> DataFrame:
    """Key, order column, the 40 features and both targets.

    ``drop_warmup`` removes rows whose long windows are not filled yet. ``require_target`` also removes the newest row
    of a key, whose next close is unknown; scoring sets it to False.
    """
    key, order = series.key, series.order
    layout = lay_out(bars.select(key, order, *BAR_VALUES), series, before=_REACH, after=1)
    group = f"PARTITION BY {', '.join(layout.part)}"
    by_block = f"{group} ORDER BY _blk, {order}"
    by_row = f"{group} ORDER BY {order}" if series.per_key else by_block
    df = add_blocks(layout.df, _BLOCK)
    # smoothing first, on narrow rows; the wide rolling and lag features come last
    seen = f"count(close) OVER ({by_row} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    df = _with(df, {"_before": lag("close", by_row, 1), "_starts": f"close IS NOT NULL AND {seen} = 1"})
    df = _with(
        df,
        {
            "_gain": "CASE WHEN close - _before IS NOT NULL THEN greatest(close - _before, 0D) END",
            "_loss": "CASE WHEN close - _before IS NOT NULL THEN greatest(_before - close, 0D) END",
            "_range": "greatest(high - low, abs(high - _before), abs(low - _before))",
        },
    )
    df = add_ewm(df, _FIRST_PASS, layout, order, _BLOCK)
    df = add_ewm(_with(df, {"macd": "ema_12 - ema_26"}), _SECOND_PASS, layout, order, _BLOCK)
    df = _with(_with(df, _window_features(by_block)), _lag_features())
    df = layout.finish(_with(df, _ROW_FEATURES))
    if drop_warmup:
        needed = WARMUP_COLUMNS + (["target_next_close"] if require_target else [])
        df = df.na.drop(subset=needed)
    return df.select(key, order, *FEATURES, *TARGETS)
