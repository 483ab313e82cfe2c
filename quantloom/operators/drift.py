"""Two-sample drift of features and predictions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom import schema as S
from quantloom.operators.layout import DAILY, Series
from quantloom.operators.ranks import long_values, running_counts
from quantloom.schema import FEATURES, KEY

_SERIES_TERMS = 8
_SERIES_SWITCH = 1.18  # below it the second series converges faster


def numeric_columns(reference: DataFrame, current: DataFrame, features: Sequence[str] = FEATURES) -> list[str]:
    """Numeric feature columns of the reference; none when the current table lacks one of them."""
    kinds = {f.name: f.dataType for f in reference.schema.fields}
    cols = [c for c in features if c in kinds and isinstance(kinds[c], T.NumericType)]
    return cols if all(c in current.columns for c in cols) else []


ROWS = "__rows__"  # pseudo feature that counts the rows of both sides


def _side(df: DataFrame, cols: Sequence[str], key: str, count_rows: bool, name: str = "n") -> DataFrame:
    """``key, feature, value`` and a 1 under ``name``, a row for each known value; with ``count_rows`` also one for each row."""
    df = df.select(key, *cols)
    names = [*cols, ROWS] if count_rows else list(cols)
    return long_values(df.withColumn(ROWS, F.lit(0.0)) if count_rows else df, names, key, {name: F.lit(1)})


def _both_sides(reference: DataFrame, current: DataFrame, series: Series) -> DataFrame:
    """Distinct values per key and feature with running counts of both sides, each given with its counts ``n``."""
    zero = F.lit(0).cast("long")
    columns = [series.key, "feature", "value"]
    tall = reference.select(*columns, F.col("n").alias("n_ref"), zero.alias("n_cur")).union(current.select(*columns, zero, "n"))
    return running_counts(tall, ["n_ref", "n_cur"], series.key, sliced=not series.per_key)


def baseline(reference: DataFrame, cols: Sequence[str] | None = None, series: Series = DAILY) -> DataFrame:
    """``key, feature, value, n``: the distinct values of every feature with their numbers, and the number of rows as a
    feature of its own. What a comparison needs of the reference, to be stored once."""
    cols = list(numeric_columns(reference, reference) if cols is None else cols)
    return _side(reference, cols, series.key, True).groupBy(series.key, "feature", "value").agg(F.sum("n").alias("n"))


def _functions(ranked: DataFrame, key: str) -> DataFrame:
    """Both distribution functions; null on a side without values."""
    return ranked.select(
        F.col(key).alias(KEY),
        "feature",
        "value",
        "next_value",
        "least",
        F.col("n_ref").alias("_here"),
        F.col("n_ref_all").alias("n_ref"),
        F.col("n_cur_all").alias("n_cur"),
        F.try_divide("n_ref_upto", "n_ref_all").alias("f_ref"),
        F.try_divide("n_cur_upto", "n_cur_all").alias("f_cur"),
    )


def ecdf_pair(reference: DataFrame, current: DataFrame, cols: Sequence[str], series: Series = DAILY) -> DataFrame:
    """Both empirical distribution functions on the union of values.

    ``ticker, feature, value, next_value, n_ref, n_cur, f_ref, f_cur``; only groups with values on both sides.
    """
    sides = (_side(df, cols, series.key, False) for df in (reference, current))
    both = _functions(_both_sides(*sides, series), series.key)
    return both.filter((F.col("n_ref") > 0) & (F.col("n_cur") > 0)).drop("_here", "least")


def ks_pvalue(statistic: Column, n_ref: Column, n_cur: Column, exact_rows: int = S.KS_EXACT_ROWS) -> Column:
    """Two-sided p-value of the Kolmogorov-Smirnov statistic.

    Samples of at most ``exact_rows`` values have the exact law, larger ones and ``exact_rows=0`` the limit law.
    """
    exact = _exact_pvalue(statistic, n_ref.cast("long"), n_cur.cast("long"))
    return F.when(F.greatest(n_ref, n_cur) <= exact_rows, exact).otherwise(_limit_pvalue(statistic, n_ref, n_cur))


def _exact_pvalue(statistic: Column, n_ref: Column, n_cur: Column) -> Column:
    """The share of lattice paths that leave the strip of the statistic.

    Without ties all orders of both samples are equally likely: a walk from (0, 0) to (n_ref, n_cur) that draws the next
    value from one of the samples, in proportion to what they still hold. Step by step the fold keeps the probabilities
    of the places inside the strip, one number for each place of the walk's diagonal, and sums up what leaves. The
    strip of statistic d has about d * n_ref * n_cur / (n_ref + n_cur) places to each side.
    """
    both = n_ref + n_cur
    reach = F.round(statistic * n_ref * n_cur).cast("long")
    start = F.struct(F.lit(0).cast("long").alias("low"), F.array(F.lit(1.0)).alias("inside"), F.lit(0.0).alias("left"))

    def bounds(t: Column) -> tuple[Column, Column]:
        """Least and largest number of draws from the reference after t draws."""
        low = F.greatest(F.floor((t * n_ref - reach) / both) + 1, t - n_cur, F.lit(0).cast("long"))
        high = F.least(F.ceil((t * n_ref + reach) / both) - 1, n_ref, t)
        return low.cast("long"), high.cast("long")

    def step(acc: Column, t: Column) -> Column:
        low, high = bounds(t + 1)
        rest, old = (both - t).cast("double"), acc["low"]
        last = old + F.size(acc["inside"]) - 1

        def at(i: Column) -> Column:
            return F.coalesce(F.get(acc["inside"], (i - old).cast("int")), F.lit(0.0))

        def from_current(i: Column) -> Column:
            return at(i) * (n_cur - t + i) / rest

        def from_reference(i: Column) -> Column:
            return at(i) * (n_ref - i) / rest

        inside = F.when(low <= high, F.transform(F.sequence(low, high), lambda i: from_current(i) + from_reference(i - 1)))
        gone = F.when(low > old, from_current(old)).otherwise(0.0) + F.when(high <= last, from_reference(last)).otherwise(0.0)
        return F.struct(low.alias("low"), F.coalesce(inside, F.array().cast("array<double>")).alias("inside"), (acc["left"] + gone).alias("left"))

    walked = F.aggregate(F.sequence(F.lit(0).cast("long"), both - 1), start, step, lambda acc: F.least(F.lit(1.0), acc["left"]))
    return F.when(reach <= 0, F.lit(1.0)).when((n_ref > 0) & (n_cur > 0), walked)


def _limit_pvalue(statistic: Column, n_ref: Column, n_cur: Column) -> Column:
    """The p-value by the limit of large samples."""
    size = (n_ref.cast("double") * n_cur) / (n_ref + n_cur)
    lam = F.sqrt(size) * statistic
    squared = lam * lam
    tail = F.lit(0.0)
    body = F.lit(0.0)
    for k in range(1, _SERIES_TERMS + 1):
        tail = tail + (1.0 if k % 2 else -1.0) * F.exp(-2.0 * k * k * squared)
        body = body + F.exp(F.try_divide(F.lit(-((2 * k - 1) ** 2) * math.pi**2 / 8), squared))
    small = 1 - F.try_divide(F.lit(math.sqrt(2 * math.pi)), lam) * body
    value = F.when(lam <= 0, F.lit(1.0)).when(lam < _SERIES_SWITCH, small).otherwise(2 * tail)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def _gap() -> Column:
    return F.abs(F.col("f_ref") - F.col("f_cur"))


def _statistics() -> list[Column]:
    width = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    return [
        F.max("n_ref").alias("n_ref"),
        F.max("n_cur").alias("n_cur"),
        F.max(_gap()).alias("ks"),
        F.sum(_gap() * width).alias("wasserstein"),
    ]


def two_sample(ecdf: DataFrame) -> DataFrame:
    """``ticker, feature, n_ref, n_cur, ks, wasserstein``: largest gap and area between both functions."""
    return ecdf.groupBy(KEY, "feature").agg(*_statistics())


def sample_statistics(
    reference: DataFrame, current: DataFrame, cols: Sequence[str], series: Series = DAILY
) -> DataFrame:
    """``two_sample`` of every feature with the reference's spread, and a ``ROWS`` row per key with the row counts.

    A feature without values on one side keeps its counts and has null statistics. The spread is the population
    standard deviation, at least the fixed minimum. It is summed from distances to the smallest value.
    """
    return baseline_statistics(_side(reference, cols, series.key, True), current, cols, series)


def baseline_statistics(stored: DataFrame, current: DataFrame, cols: Sequence[str], series: Series = DAILY) -> DataFrame:
    """``sample_statistics`` against a stored ``baseline``: the reference's rows are not read."""
    stored = stored.filter(F.col("feature").isin([*cols, ROWS]))
    functions = _functions(_both_sides(stored, _side(current, cols, series.key, True), series), series.key)
    distance = F.col("value") - F.col("least")
    mean, mean_square = (
        F.try_divide(F.sum(F.col("_here") * x), F.sum("_here")) for x in (distance, distance * distance)
    )
    spread = F.sqrt(F.greatest(mean_square - mean * mean, F.lit(0.0)))
    return functions.groupBy(KEY, "feature").agg(
        *_statistics(), F.greatest(spread, F.lit(S.MIN_REFERENCE_STD)).alias("spread")
    )


def _comparable() -> Column:
    return (F.col("feature") != ROWS) & (F.col("n_ref") > 0) & (F.col("n_cur") > 0)


def _with_pvalue(statistics: DataFrame) -> DataFrame:
    """Add ``ks_pvalue``; where the distance decides, it is that of the limit law."""
    args = [F.col(c) for c in ("ks", "n_ref", "n_cur")]
    decides = F.col("n_ref") <= S.KS_MAX_REFERENCE_ROWS
    return statistics.withColumn("ks_pvalue", F.when(decides, ks_pvalue(*args)).otherwise(ks_pvalue(*args, exact_rows=0)))


def _drifted() -> Column:
    by_rank = F.col("ks_pvalue") < S.KS_ALPHA
    by_distance = F.col("wasserstein") / F.col("spread") >= S.WASSERSTEIN_LIMIT
    return F.when(F.col("n_ref") <= S.KS_MAX_REFERENCE_ROWS, by_rank).otherwise(by_distance)


def column_verdicts(statistics: DataFrame) -> DataFrame:
    """``column_drift`` from a result of ``sample_statistics``."""
    small = F.col("n_ref") <= S.KS_MAX_REFERENCE_ROWS
    return (
        _with_pvalue(statistics.filter(_comparable()))
        .withColumn("wasserstein_normed", F.col("wasserstein") / F.col("spread"))
        .select(
            KEY,
            "feature",
            "n_ref",
            "n_cur",
            "ks",
            "ks_pvalue",
            "wasserstein_normed",
            F.when(small, F.lit("ks")).otherwise(F.lit("wasserstein")).alias("test"),
            F.when(small, F.col("ks_pvalue")).otherwise(F.col("wasserstein_normed")).alias("score"),
            _drifted().alias("drifted"),
        )
    )


def column_drift(
    reference: DataFrame, current: DataFrame, cols: Sequence[str] | None = None, series: Series = DAILY
) -> DataFrame:
    """One row per key and feature with values on both sides: test, score, drifted.

    Up to 1000 reference values the Kolmogorov-Smirnov p-value decides, above that the Wasserstein distance in units
    of the reference's standard deviation.
    """
    cols = list(numeric_columns(reference, current) if cols is None else cols)
    return column_verdicts(sample_statistics(reference, current, cols, series))


def data_drift(
    reference: DataFrame,
    current: DataFrame,
    keys: DataFrame | None = None,
    threshold: float = S.DRIFT_THRESHOLD,
    cols: Sequence[str] | None = None,
    series: Series = DAILY,
) -> DataFrame:
    """One row per key: share of drifted features, whether it exceeds ``threshold``, and their names.

    A key without current rows or without comparable features shows no drift, score 0 and the reason in ``error``.
    Without ``keys`` every key of the reference is reported. Each table is read once.
    """
    cols = list(numeric_columns(reference, current) if cols is None else cols)
    return key_verdicts(sample_statistics(reference, current, cols, series), keys, threshold)


def key_verdicts(
    statistics: DataFrame, keys: DataFrame | None = None, threshold: float = S.DRIFT_THRESHOLD
) -> DataFrame:
    """``data_drift`` from a result of ``sample_statistics``."""
    drifted = _drifted()
    feature = _comparable()
    rows = F.col("feature") == ROWS
    per_key = _with_pvalue(statistics).groupBy(KEY).agg(
        F.avg(F.when(feature, drifted.cast("double"))).alias("_share"),
        F.sort_array(F.collect_list(F.when(feature & drifted, F.col("feature")))).alias("_names"),
        F.count_if(feature).alias("_total"),
        F.max(F.when(rows, F.col("n_ref"))).alias("_ref"),
        F.max(F.when(rows, F.col("n_cur"))).alias("_cur"),
    )
    result = keys.select(KEY).join(per_key, KEY, "left") if keys is not None else per_key.filter("_ref > 0")
    none = F.coalesce("_total", F.lit(0)) == 0
    return result.select(
        KEY,
        F.coalesce(F.col("_share") > threshold, F.lit(False)).alias("drift_detected"),
        F.round(F.coalesce("_share", F.lit(0.0)), 4).alias("drift_score"),
        F.coalesce("_names", F.array().cast("array<string>")).alias("drifted_features"),
        F.coalesce("_total", F.lit(0)).cast("long").alias("total_features"),
        F.when(F.coalesce("_cur", F.lit(0)) == 0, F.lit("no current rows"))
        .when(none, F.lit("no feature to compare"))
        .alias("error"),
    )


def prediction_drift(
    reference: DataFrame,
    current: DataFrame,
    keys: DataFrame | None = None,
    threshold: float = S.DRIFT_THRESHOLD,
    column: str = "predictions",
    series: Series = DAILY,
) -> DataFrame:
    """One row per key: the Kolmogorov-Smirnov statistic of two samples of predictions against ``threshold``."""
    key = series.key
    stats = two_sample(ecdf_pair(reference, current, [column], series))
    if keys is None:
        keys = reference.select(F.col(key).alias(KEY)).distinct()
    hit = F.coalesce(F.col("ks") > threshold, F.lit(False))
    return (
        keys.select(KEY)
        .join(stats, KEY, "left")
        .select(
            KEY,
            hit.alias("drift_detected"),
            F.round(F.coalesce("ks", F.lit(0.0)), 4).alias("drift_score"),
            F.when(hit, F.array(F.lit("predictions"))).otherwise(F.array().cast("array<string>")).alias("drifted_features"),
            F.lit(1).cast("long").alias("total_features"),
            F.when(F.col("ks").isNotNull(), ks_pvalue(F.col("ks"), F.col("n_ref"), F.col("n_cur"))).alias("p_value"),
            F.when(F.col("ks").isNull(), F.lit("No predictions on one side")).alias("error"),
        )
    )


def monitor(keys: DataFrame, data: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row per requested key: both verdicts joined. A failed key has status ``failed``, never a silent no-drift."""
    d = data.select(
        KEY,
        F.col("drift_detected").alias("data_drift"),
        F.col("drift_score").alias("data_score"),
        F.col("error").alias("data_error"),
    )
    p = predictions.select(
        KEY,
        F.col("drift_detected").alias("prediction_drift"),
        F.col("drift_score").alias("prediction_score"),
        F.col("error").alias("prediction_error"),
    )
    failed = (
        F.col("data_drift").isNull()
        | F.col("prediction_drift").isNull()
        | F.col("data_error").isNotNull()
        | F.col("prediction_error").isNotNull()
    )
    no = F.lit(False)
    return (
        keys.select(KEY)
        .join(d, KEY, "left")
        .join(p, KEY, "left")
        .select(
            KEY,
            F.when(failed, F.lit("failed")).otherwise(F.lit("ok")).alias("status"),
            (F.coalesce("data_drift", no) | F.coalesce("prediction_drift", no)).alias("drift_detected"),
            F.coalesce("data_drift", no).alias("data_drift"),
            F.coalesce("prediction_drift", no).alias("prediction_drift"),
            F.coalesce("data_score", F.lit(0.0)).alias("data_score"),
            F.coalesce("prediction_score", F.lit(0.0)).alias("prediction_score"),
            F.concat_ws("; ", "data_error", "prediction_error").alias("error"),
        )
    )


def monitor_totals(monitored: DataFrame) -> DataFrame:
    """``total, drift_detected, drifted, failed`` over all keys."""
    return monitored.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("drift_detected"),
        F.count_if("drift_detected").alias("drifted"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )


def retrain_list(monitored: DataFrame) -> DataFrame:
    """Keys that drifted and should be trained again."""
    return monitored.filter("drift_detected").select(KEY)


def write_drift_summary(table: DataFrame, path: str, run_date: str) -> None:
    """Store one run; writing the same run date again replaces it."""
    (
        table.withColumn("run_date", F.lit(run_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .parquet(path)
    )
