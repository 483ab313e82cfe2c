"""Chronological split, robust scaling, sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.operators.layout import DAILY, Series, lay_out, with_positions
from quantloom.operators.ranks import long_values, quantiles, running_counts
from quantloom.schema import FEATURES, KEY, SEQ_LEN, TARGETS, TRAIN_SHARE, VAL_SHARE

_ZERO_SCALE = 10 * 2.220446049250313e-16  # a smaller spread counts as none


def feature_columns(df: DataFrame, features: Sequence[str] = FEATURES) -> list[str]:
    """The feature columns of ``df``, by an explicit list: columns added later cannot slip in."""
    return [c for c in features if c in df.columns and c not in TARGETS]


def _split_column(train: float, val: float) -> Column:
    train_end = F.floor(F.col("_n") * F.lit(float(train)))
    val_end = F.floor(F.col("_n") * F.lit(float(train) + float(val)))
    return (
        F.when(F.col("_pos") < train_end, F.lit("train"))
        .when(F.col("_pos") < val_end, F.lit("val"))
        .otherwise(F.lit("test"))
    )


def chrono_split(
    df: DataFrame, train: float = TRAIN_SHARE, val: float = VAL_SHARE, series: Series = DAILY
) -> DataFrame:
    """Add ``split``: the first rows of a key are ``train``, then ``val``, the rest ``test``. Bounds are double products."""
    return with_positions(df, series).withColumn("split", _split_column(train, val)).drop("_pos", "_n")


def reference_slice(features: DataFrame, series: Series = DAILY, train: float = TRAIN_SHARE) -> DataFrame:
    """The training part of the unscaled features: the baseline for drift."""
    return chrono_split(features, train=train, series=series).filter("split = 'train'").drop("split")


def fit_robust_scaler(
    split_df: DataFrame, cols: Sequence[str] | None = None, series: Series = DAILY, exact_groups: bool | None = None
) -> DataFrame:
    """``ticker, feature, center, scale``: median and interquartile range of the training rows, linear interpolation.

    With a proven bound on the rows of a key one hash aggregate keeps the values of a group. Otherwise the quantiles are
    picked from counts ranked in slices, which never holds a whole group in one task. Both are exact.
    """
    key = series.key
    cols = list(cols or feature_columns(split_df))
    train = split_df.filter("split = 'train'")
    if exact_groups if exact_groups is not None else series.per_key:
        points = train.groupBy(key).agg(
            *[F.expr(f"percentile({c}, array(0.25D, 0.5D, 0.75D)) AS {c}") for c in cols]
        )
        stacked = points.unpivot([key], cols, "feature", "_q")
        low, mid, high = (F.element_at("_q", i) for i in (1, 2, 3))
    else:
        ranked = running_counts(long_values(train, cols, key, {"n": F.lit(1)}), ["n"], key, sliced=True)
        stacked = quantiles(ranked, "n", [0.25, 0.5, 0.75], key)
        low, mid, high = F.col("q0"), F.col("q1"), F.col("q2")
    spread = high - low
    return stacked.select(
        F.col(key).alias(KEY),
        "feature",
        mid.alias("center"),
        F.when(spread < _ZERO_SCALE, F.lit(1.0)).otherwise(spread).alias("scale"),
    )


def wide_scaler(scaler: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per key with a ``<feature>_center`` and a ``<feature>_scale`` column for each feature."""
    return (
        scaler.groupBy(KEY)
        .pivot("feature", list(cols))
        .agg(F.first("center").alias("center"), F.first("scale").alias("scale"))
    )


def apply_scaler(df: DataFrame, scaler: DataFrame, cols: Sequence[str] | None = None, key: str = KEY) -> DataFrame:
    """``(x - center) / scale`` for the given columns; all others stay as they are.

    The scaler has one row per key. Spark broadcasts it when it is small; beyond its limit the join shuffles on the key.
    """
    cols = list(cols or feature_columns(df))
    wide = wide_scaler(scaler, cols).withColumnRenamed(KEY, key)
    joined = df.join(wide, key)
    return joined.selectExpr(
        *[f"(`{c}` - `{c}_center`) / `{c}_scale` AS `{c}`" if c in cols else f"`{c}`" for c in df.columns]
    )


def make_sequences(
    scaled: DataFrame,
    cols: Sequence[str] | None = None,
    seq_len: int = SEQ_LEN,
    include_current: bool = False,
    series: Series = DAILY,
) -> DataFrame:
    """``ticker, date, split, X, y``: the ``seq_len`` rows before a row as array of arrays, and that row's target.

    A sequence stays inside one split. The row itself is left out unless ``include_current`` is set. Values are floats.
    """
    key, order = series.key, series.order
    cols = list(cols or feature_columns(scaled))
    layout = lay_out(scaled.select(key, order, "split", TARGETS[0], *cols), series, before=seq_len, positions=False)
    ordered = Window.partitionBy(*layout.part, "split").orderBy(order)
    last = 0 if include_current else -1
    frame = ordered.rowsBetween(last - seq_len + 1, last)
    row = F.expr(f"array({', '.join(f'float(`{c}`)' for c in cols)})")
    framed = layout.df.withColumn("_row", row).withColumns(
        {"X": F.collect_list("_row").over(frame), "_back": F.count(F.lit(1)).over(frame)}
    )
    return layout.finish(framed.filter(F.col("_back") == seq_len)).select(
        key, order, "split", "X", F.col(TARGETS[0]).cast("float").alias("y")
    )


def split_report(split_df: DataFrame, cols: Sequence[str] | None = None, key: str = KEY) -> DataFrame:
    """``ticker, train_rows, val_rows, test_rows, feature_count``."""
    n = len(cols or feature_columns(split_df))
    return split_df.groupBy(key).agg(
        *[F.count_if(F.col("split") == s).alias(f"{s}_rows") for s in ("train", "val", "test")],
        F.lit(n).cast("long").alias("feature_count"),
    )
