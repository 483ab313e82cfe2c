"""Forecast metrics, choice of the best model, run log and registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantloom.schema import KEY, MODELS

METRICS = ["mae", "rmse", "mape", "r2"]


def forecast_metrics(
    predictions: DataFrame,
    by: Sequence[str] = (KEY, "model", "split"),
    y: str = "y",
    yhat: str = "yhat",
    digits: int | None = 4,
) -> DataFrame:
    """``mae, rmse, mape, r2`` per group, in one aggregate that combines on the map side.

    MAPE skips rows with y = 0 and is infinite when none is left. R2 is 1 - ss_res/ss_tot and 0 for a constant y.
    """
    error = F.col(y) - F.col(yhat)
    relative = F.when(F.col(y) != 0, F.abs(F.try_divide(error, F.col(y))))
    spread = F.var_pop(y)
    out = predictions.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.coalesce(F.avg(relative) * 100, F.lit(float("inf"))).alias("mape"),
        F.when(spread > 0, 1 - F.try_divide(F.avg(error * error), spread)).otherwise(F.lit(0.0)).alias("r2"),
    )
    if digits is None:
        return out
    return out.select(*by, *[F.round(m, digits).alias(m) for m in METRICS])


def model_rank(order: Sequence[str] = MODELS) -> Column:
    """Place of a model in the tie-break order; a model that is not listed comes after the listed ones."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model")).cast("int")
    return F.when(place > 0, place).otherwise(len(order) + 1)


def select_best(metrics: DataFrame, order: Sequence[str] = MODELS) -> DataFrame:
    """``ticker, best_model, val_rmse``: lowest rounded validation RMSE, first in ``order`` on a tie."""
    val = metrics.filter("split = 'val'").withColumn("_rank", F.struct(F.round("rmse", 4), model_rank(order)))
    return val.groupBy(KEY).agg(
        F.min_by("model", "_rank").alias("best_model"), F.round(F.min("rmse"), 4).alias("val_rmse")
    )


def metric_struct() -> Column:
    return F.struct(*METRICS)


def build_registry(metrics: DataFrame, models: DataFrame, run_id: str, order: Sequence[str] = MODELS) -> DataFrame:
    """One row per key: best model with its path and metrics, and the results of all models.

    ``models`` holds ``ticker, model, model_path``. A key without any model has no row.
    """
    sides = metrics.groupBy(KEY, "model").agg(
        F.max(F.when(F.col("split") == "val", metric_struct())).alias("val_metrics"),
        F.max(F.when(F.col("split") == "test", metric_struct())).alias("test_metrics"),
    )
    ranked = (
        sides.join(models.select(KEY, "model", "model_path"), [KEY, "model"])
        .filter("val_metrics IS NOT NULL")
        .withColumn("_rank", F.struct(F.round("val_metrics.rmse", 4).alias("rmse"), model_rank(order).alias("place")))
    )
    result = F.struct("_rank.place", "model", "val_metrics", "model_path")
    best = F.struct("model", "model_path", "val_metrics", "test_metrics")
    return (
        ranked.groupBy(KEY)
        .agg(F.min_by(best, "_rank").alias("_best"), F.array_sort(F.collect_list(result)).alias("_all"))
        .select(
            KEY,
            F.col("_best.model").alias("best_model"),
            "_best.model_path",
            F.lit(run_id).alias("run_id"),
            "_best.val_metrics",
            "_best.test_metrics",
            F.transform("_all", lambda r: F.struct(r["model"].alias("model"), r["val_metrics"].alias("val_metrics"), r["model_path"].alias("model_path"))).alias(
                "all_results"
            ),
        )
    )


def run_log(
    metrics: DataFrame,
    run_id: str,
    params: Mapping[str, Mapping[str, object]] | None = None,
    losses: DataFrame | None = None,
    models: DataFrame | None = None,
) -> DataFrame:
    """``run_id, ticker, model, kind, name, value, step``: every metric and parameter of a run, in long form.

    With ``losses`` (ticker, model, step, loss) also the loss after each step, with ``models`` (ticker, model, seconds)
    the time of each fit.
    """

    def logged(df: DataFrame, kind: str, name: str, value: str, step: Column) -> DataFrame:
        return df.select(
            F.lit(run_id).alias("run_id"), KEY, "model", F.lit(kind).alias("kind"), F.lit(name).alias("name"),
            F.col(value).cast("string").alias("value"), step.cast("long").alias("step"),
        )

    names = [m for m in METRICS if m in metrics.columns]
    wide = metrics.select(KEY, "model", "split", *[F.col(m).cast("string") for m in names])
    tall = wide.unpivot([KEY, "model", "split"], names, "metric", "value")
    rows = tall.select(
        F.lit(run_id).alias("run_id"),
        KEY,
        "model",
        F.lit("metric").alias("kind"),
        F.concat_ws("_", "split", "metric").alias("name"),
        "value",
        F.lit(0).cast("long").alias("step"),
    )
    if losses is not None:
        rows = rows.unionByName(logged(losses, "loss", "train_loss", "loss", F.col("step")))
    if models is not None:
        rows = rows.unionByName(logged(models, "time", "seconds", "seconds", F.lit(0)))
    if not params:
        return rows
    pairs = [(m, k, str(v)) for m, settings in params.items() for k, v in settings.items()]
    table = metrics.sparkSession.createDataFrame(pairs, "model string, name string, value string")
    used = metrics.select(KEY, "model").distinct().join(table, "model")
    return rows.unionByName(
        used.select(
            F.lit(run_id).alias("run_id"), KEY, "model", F.lit("param").alias("kind"), "name", "value",
            F.lit(0).cast("long").alias("step"),
        )
    )


def list_keys(registry: DataFrame) -> DataFrame:
    """Keys that have a registry row, sorted."""
    return registry.select(KEY).distinct().orderBy(KEY)


def list_models(registry: DataFrame) -> DataFrame:
    """The registry, sorted by key."""
    return registry.orderBy(KEY)


def get_model(registry: DataFrame, ticker: str) -> DataFrame:
    """The registry row of one key; case does not matter."""
    return registry.filter(F.upper(KEY) == ticker.upper())
