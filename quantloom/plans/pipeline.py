"""The stages end to end: ingest, prepare, train, score, monitor. Each stage reads stored tables and stores its own.

``root`` is any folder Spark can write to that all executors share. Layout below it: ``bars``, ``features``, ``splits``,
``scaler``, ``baseline``, ``sequences``, ``models``, ``registry``, ``run_log``, ``drift``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.operators import drift, gates, linear, metrics, models, prep, score, validate
from quantloom.operators.features import compute_features
from quantloom.operators.layout import DAILY, Series
from quantloom.schema import KEY, MONITOR_LOOKBACK_DAYS, SCORE_LOOKBACK_DAYS, SEQ_LEN
from quantloom.sources import bars as B
from quantloom.sources.stage import stage


def ingest(bars: DataFrame, keys: DataFrame, root: str, run_date: str, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Clean and validate a delivery, store the keys that pass, and return the report and the summary.

    Rows without any price go. Where the delivery numbers its rows in column ``seq``, the first of the rows of one key and
    date stays. Storing no key fails.
    """
    cleaned = B.drop_empty_prices(bars)
    delivery = stage(B.dedup_first(cleaned, seq) if seq in bars.columns else cleaned, "delivery")
    report = stage(validate.validate_bars(delivery, keys), "report")
    good, _bad = validate.route_valid(delivery, report)
    summary = validate.ingest_summary(report)
    gates.require_stored(summary)
    B.write_bars(good, f"{root}/bars", run_date)
    return report, summary


def prepare(
    spark: SparkSession,
    root: str,
    keys: DataFrame,
    sequence_features: Sequence[str] | None = None,
    seq_len: int = SEQ_LEN,
    series: Series = DAILY,
) -> tuple[DataFrame, DataFrame]:
    """Features, splits, scaler and sequences of the stored bars.

    Returns the split report and the outputs that are missing: a key with too few bars lacks all of them, and the other
    keys are not held up by it.
    """
    bars = B.read_bars(spark, f"{root}/bars")
    B.write_features(compute_features(bars, series), f"{root}/features")
    features = B.read_stored(spark, f"{root}/features")
    split = prep.chrono_split(features, series=series)
    B.write_scaler(prep.fit_robust_scaler(split, series=series), f"{root}/scaler")
    write_baseline(features, root, series)
    scaler = B.read_stored(spark, f"{root}/scaler")
    B.write_splits(prep.apply_scaler(split, scaler), f"{root}/splits")
    scaled = read_splits(spark, root)
    B.write_sequences(prep.make_sequences(scaled, sequence_features, seq_len, series=series), f"{root}/sequences")
    sequences = B.read_stored(spark, f"{root}/sequences")
    produced = (
        scaled.select(KEY, F.col("split").alias("output"))
        .union(scaler.select(KEY, F.lit("scaler")))
        .union(sequences.select(KEY, F.concat("split", F.lit("_sequences"))))
    )
    missing = gates.check_outputs(gates.expected_outputs(keys, gates.ETL_OUTPUTS), produced)
    return prep.split_report(scaled), missing


def write_baseline(features: DataFrame, root: str, series: Series = DAILY) -> None:
    """Store the distinct values of the training part of the features, sorted, as the reference of later comparisons."""
    counts = drift.baseline(prep.reference_slice(features, series), series=series)
    counts.repartition(series.key, "feature").sortWithinPartitions(series.key, "feature", "value").write.mode("overwrite").parquet(f"{root}/baseline")


def read_splits(spark: SparkSession, root: str) -> DataFrame:
    """The scaled rows, keys spelled as they were stored."""
    return B.read_stored(spark, f"{root}/splits")


def _merged(spark: SparkSession, fresh: DataFrame, path: str) -> DataFrame:
    """The registry with the rows of ``fresh`` in place of older ones of the same keys; other keys stay."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return fresh
    return fresh.unionByName(B.read_stored(spark, path).join(fresh.select(KEY), KEY, "left_anti").select(*fresh.columns))


def train(
    spark: SparkSession,
    root: str,
    run_id: str,
    keys: Sequence[str] | None = None,
    specs: Sequence[models.ModelSpec] | None = None,
    *,
    mode: str,
    seq_len: int = SEQ_LEN,
    series: Series = DAILY,
) -> tuple[DataFrame, list[str]]:
    """Fit all models, choose the best per key, store registry and run log. Returns the registry and failed fits.

    ``mode`` is that of ``models.train_all`` or ``tables``: a ridge model for every key, all in one table.
    """
    if mode == "tables":
        result = linear.train_tables(read_splits(spark, root), f"{root}/models/{run_id}", keys)
    else:
        result = models.train_all(
            read_splits(spark, root),
            f"{root}/models/{run_id}",
            keys,
            specs,
            mode=mode,
            scaler=B.read_stored(spark, f"{root}/scaler"),
            seq_len=seq_len,
            series=series,
        )
    result.predictions.write.mode("overwrite").parquet(f"{root}/predictions/{run_id}")
    scored = stage(metrics.forecast_metrics(result.predictions), "metrics")
    # stored before the registry is replaced, because it is read from there
    merged = stage(_merged(spark, metrics.build_registry(scored, result.models, run_id), f"{root}/registry"), "registry")
    merged.write.mode("overwrite").parquet(f"{root}/registry")
    (
        metrics.run_log(scored, run_id, result.settings, result.losses, result.models)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(f"{root}/run_log")
    )
    return B.read_stored(spark, f"{root}/registry"), result.failed


def score_keys(
    spark: SparkSession,
    root: str,
    asof: str | None = None,
    lookback_days: int = SCORE_LOOKBACK_DAYS,
    series: Series = DAILY,
    **options,
) -> DataFrame:
    """One forecast for every key of the registry."""
    return score.score_latest(
        B.read_bars(spark, f"{root}/bars"),
        B.read_stored(spark, f"{root}/registry"),
        B.read_stored(spark, f"{root}/scaler"),
        asof,
        lookback_days,
        series=series,
        **options,
    )


def monitor(
    spark: SparkSession,
    root: str,
    keys: DataFrame,
    asof: str,
    run_date: str,
    lookback_days: int = MONITOR_LOOKBACK_DAYS,
    series: Series = DAILY,
    seq_len: int = SEQ_LEN,
) -> DataFrame:
    """Feature and prediction drift of every requested key; stores the summary and the detail per feature.

    Features are compared with the baseline that ``prepare`` stored, the reference rows are not read.
    """
    reference = B.read_stored(spark, f"{root}/baseline")
    registry = B.read_stored(spark, f"{root}/registry")
    scaler = B.read_stored(spark, f"{root}/scaler")
    recent = B.lookback(B.read_bars(spark, f"{root}/bars"), lookback_days, asof)
    current = stage(compute_features(recent, series), "current")

    def predicted(scaled: DataFrame) -> DataFrame:
        sequences = prep.make_sequences(scaled, None, seq_len, series=series).filter("split = 'val'")
        rows = scaled.filter("split = 'val'")
        best = score.predict_rows(rows, registry, scaler, sequences)
        return stage(best.select(KEY, F.col("yhat").alias("predictions")), "predictions")

    cols = drift.numeric_columns(current, current)
    statistics = stage(drift.baseline_statistics(reference, current, cols, series), "statistics")
    drift.write_drift_summary(drift.column_verdicts(statistics), f"{root}/drift/columns", run_date)
    live = stage(prep.apply_scaler(current, scaler).withColumn("split", F.lit("val")), "live")
    predictions = drift.prediction_drift(predicted(read_splits(spark, root)), predicted(live), keys, series=series)
    verdicts = drift.monitor(keys, drift.key_verdicts(statistics, keys), predictions)
    drift.write_drift_summary(verdicts, f"{root}/drift/summary", run_date)
    return spark.read.parquet(f"{root}/drift/summary").filter(F.col("run_date") == run_date)
