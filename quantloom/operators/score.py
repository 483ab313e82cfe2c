"""Batch scoring of the newest bar of every key."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.operators import linear
from quantloom.operators.features import compute_features
from quantloom.operators.layout import DAILY, Series
from quantloom.operators.models import POOLED, label_scale, load_model, sequence_vectors
from quantloom.operators.prep import apply_scaler, feature_columns
from quantloom.schema import FEATURES, KEY, ORDER, SCORE_LOOKBACK_DAYS, SEQ_LEN
from quantloom.sources.bars import lookback
from quantloom.sources.stage import stage, stage_folder

MIN_LOOKBACK, MAX_LOOKBACK = 60, 365  # fixed values


def latest_features(features: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """The newest feature row of every key. Partial aggregates keep one row per task and key."""
    values = [c for c in features.columns if c not in (key, order)]
    newest = features.groupBy(key).agg(F.max(order).alias(order), *[F.expr(f"max_by(`{c}`, `{order}`) AS `{c}`") for c in values])
    return newest.select(*features.columns)


def next_weekday(order: str = ORDER) -> Column:
    """The weekday after a bar."""
    day = F.col(order).cast("date")
    return F.date_add(day, F.when(F.dayofweek(day) == 6, 3).when(F.dayofweek(day) == 7, 2).otherwise(1))


def scoring_rows(
    bars: DataFrame,
    scaler: DataFrame,
    asof: str | None = None,
    lookback_days: int = SCORE_LOOKBACK_DAYS,
    require_target: bool = False,
    series: Series = DAILY,
) -> DataFrame:
    """Features of the look-back period, scaled with the stored scaler.

    Without ``asof`` the period ends with the newest bar, which one aggregate finds.
    """
    if not MIN_LOOKBACK <= lookback_days <= MAX_LOOKBACK:
        raise ValueError(f"lookback_days must be {MIN_LOOKBACK} to {MAX_LOOKBACK}")
    if asof is None:
        newest = bars.agg(F.date_add(F.max(ORDER).cast("date"), 1).cast("string")).first()[0]
        asof = newest or "1970-01-01"
    recent = lookback(bars, lookback_days, asof)
    return apply_scaler(compute_features(recent, series, require_target=require_target), scaler)


def last_sequence(
    scaled: DataFrame, cols: Sequence[str], seq_len: int = SEQ_LEN, tiled: bool = False, key: str = KEY, order: str = ORDER
) -> DataFrame:
    """``ticker, date, X``: the last ``seq_len`` rows of every key, or the newest row repeated when ``tiled``."""
    row = F.expr(f"array({', '.join(f'float(`{c}`)' for c in cols)})")
    if tiled:
        newest = latest_features(scaled.select(key, order, *cols))
        return newest.select(key, order, F.array_repeat(row, seq_len).alias("X"))
    newest_first = Window.partitionBy(key).orderBy(F.col(order).desc())
    tail = scaled.select(key, order, row.alias("_row")).withColumn("_back", F.row_number().over(newest_first))
    return (
        tail.filter(F.col("_back") <= seq_len)
        .groupBy(key)
        .agg(F.max(order).alias(order), F.sort_array(F.collect_list(F.struct(order, "_row"))).alias("_rows"))
        .filter(F.size("_rows") == seq_len)
        .select(key, order, F.transform("_rows", lambda r: r["_row"]).alias("X"))
    )


def predict_rows(
    scaled: DataFrame, registry: DataFrame, scaler: DataFrame, sequences: DataFrame | None = None, parallelism: int = 4
) -> DataFrame:
    """``ticker, date, model, yhat`` of the best model of each key.

    The registry says which saved model serves which keys. Rows are dealt out by saved model and stored once, so that each
    model reads its own rows alone, and its forecasts are stored in turn: no plan grows with the number of models. Ridge
    models are one table for all keys, so they take one join however many keys they serve.
    """
    spark = scaled.sparkSession
    saved = registry.select("best_model", "model_path").distinct().collect()
    if not saved:
        raise ValueError("the registry is empty")
    if sequences is None and any(r.best_model == "sequence" for r in saved):
        raise ValueError("a key is served by the sequence model: give sequences")
    folder = f"{stage_folder(spark)}/scored-{uuid.uuid4().hex}"

    def dealt(rows: DataFrame, served: Column, name: str) -> DataFrame:
        assigned = registry.filter(served).select(KEY, F.col("model_path").alias("_path"))
        rows = rows.join(assigned, KEY)
        rows.hint("rebalance", "_path").write.partitionBy("_path").parquet(f"{folder}/{name}")
        fields = [f for f in rows.schema.fields if f.name != "_path"]
        return spark.read.schema(T.StructType([*fields, T.StructField("_path", T.StringType())])).parquet(f"{folder}/{name}")

    by_sequence = F.col("best_model") == "sequence"
    by_row = dealt(scaled, ~by_sequence, "rows")
    in_order = dealt(sequences, by_sequence, "sequences") if sequences is not None else None

    def predict(number: int, model: str, path: str) -> tuple[str, T.StructType]:
        rows = (in_order if model == "sequence" else by_row).filter(F.col("_path") == path)
        if model == "sequence":
            rows = sequence_vectors(rows)
        if model == linear.NAME:  # one table holds the models of all its keys
            out = linear.predict_ridge(rows, spark.read.parquet(path), feature_columns(rows)).select(KEY, ORDER, F.lit(model).alias("model"), "yhat")
            out.write.parquet(f"{folder}/out/{number}")
            return f"{folder}/out/{number}", out.schema
        yhat = F.col("_prediction")
        if path.rsplit("/", 1)[-1] == POOLED:
            rows = rows.join(label_scale(scaler), KEY)
            yhat = yhat * F.col("_scale") + F.col("_center")
        out = load_model(path).transform(rows).select(KEY, ORDER, F.lit(model).alias("model"), yhat.alias("yhat"))
        out.write.parquet(f"{folder}/out/{number}")
        return f"{folder}/out/{number}", out.schema

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        made = [f.result() for f in [pool.submit(predict, i, *r) for i, r in enumerate(saved)]]
    return spark.read.schema(made[0][1]).parquet(*[path for path, _ in made])


def score_latest(
    bars: DataFrame,
    registry: DataFrame,
    scaler: DataFrame,
    asof: str | None = None,
    lookback_days: int = SCORE_LOOKBACK_DAYS,
    newest_bar: bool = True,
    tiled: bool = False,
    calendar_date: bool = False,
    series: Series = DAILY,
    seq_len: int = SEQ_LEN,
) -> DataFrame:
    """One forecast per key: predicted close, model, date and the validation metrics of the model.

    ``newest_bar=False`` scores the last bar whose next close is known. ``tiled`` repeats the newest row for the
    sequence model instead of using the true last rows. ``calendar_date`` dates the forecast one day ahead, not one
    weekday. ``seq_len`` is the length that the sequence model was fitted on.
    """
    scaled = stage(scoring_rows(bars, scaler, asof, lookback_days, not newest_bar, series), "scoring")
    cols = feature_columns(scaled, FEATURES)
    newest = latest_features(scaled.select(KEY, ORDER, *cols))
    sequences = last_sequence(scaled, cols, seq_len, tiled)
    predicted = predict_rows(newest, registry, scaler, sequences)
    when = F.date_add(F.col(ORDER).cast("date"), 1) if calendar_date else next_weekday()
    info = registry.select(KEY, F.col("val_metrics.rmse").alias("val_rmse"), F.col("val_metrics.r2").alias("val_r2"))
    return predicted.join(info, KEY).select(
        KEY,
        F.round("yhat", 4).alias("predicted_close"),
        F.col("model").alias("model_used"),
        when.alias("prediction_date"),
        "val_rmse",
        "val_r2",
        F.lit(len(cols)).cast("long").alias("features_used"),
    )
