"""Column names, limits and fixed values shared by all modules."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "ticker"
ORDER = "date"
PRICES = ["open", "high", "low", "close"]
BAR_VALUES = PRICES + ["volume"]
TARGETS = ["target_next_close", "target_next_return"]

BAR_SCHEMA = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField(ORDER, T.TimestampNTZType()),
        *[T.StructField(c, T.DoubleType()) for c in BAR_VALUES],
    ]
)

# The lags and window lengths of the feature set.
LAGS = [1, 2, 3, 5, 10]
SMA_WINDOWS = [10, 20, 50]

# The 40 feature names in output order.
FEATURES = [
    "returns_1d", "returns_5d", "returns_10d", "high_low_range", "close_open_spread",
    "sma_10", "sma_20", "sma_50", "ema_12", "ema_26",
    "close_to_sma20", "close_to_sma50", "sma10_sma20_cross",
    "rsi_14",
    "macd", "macd_signal", "macd_hist",
    "bb_upper", "bb_lower", "bb_width", "bb_pos",
    "atr_14",
    "volume_sma_10", "volume_ratio", "log_volume",
    "close_lag_1", "close_lag_2", "close_lag_3", "close_lag_5", "close_lag_10",
    "return_lag_1", "return_lag_2", "return_lag_3", "return_lag_5", "return_lag_10",
    "open", "high", "low", "close", "volume",
]

# A row is kept only when these are known.
WARMUP_COLUMNS = ["sma_50", "rsi_14", "close_lag_10"]

# Validation limits.
MIN_ROWS = 10
MAX_NULL_SHARE = 0.05
MIN_PRICE = 0.01
MAX_PRICE = 1_000_000.0
MAX_ZERO_VOLUME_SHARE = 0.1

# Split shares, sequence length, scoring and drift settings.
TRAIN_SHARE = 0.70
VAL_SHARE = 0.15
SEQ_LEN = 30
WARMUP_DAYS = 60
SCORE_LOOKBACK_DAYS = 90
MONITOR_LOOKBACK_DAYS = 120
DRIFT_THRESHOLD = 0.1
KS_EXACT_ROWS = 10_000  # the largest sample with an exact p-value
KS_ALPHA = 0.05
KS_MAX_REFERENCE_ROWS = 1000
WASSERSTEIN_LIMIT = 0.1
MIN_REFERENCE_STD = 0.001

# Model names in tie-break order.
MODELS = ["random_forest", "boosted_trees", "sequence"]
