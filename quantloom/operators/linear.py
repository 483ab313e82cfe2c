"""A ridge model for every key, kept as one table: however many keys there are, fitting and scoring are a few jobs.

A key's rows are reduced to their moments (count, sums, sums of products) in one aggregate with map-side partial sums, so a
key with very many rows is never in one task. Moments add up: those of stored rows and of new ones give the fit of both.
The normal equations of a key are one row, solved by elimination in a fold over arrays. Scoring joins rows with the table.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantloom.operators.models import LINEAR, LOSSES, TrainResult
from quantloom.operators.prep import feature_columns
from quantloom.schema import KEY, ORDER, TARGETS
from quantloom.sources.stage import stage

NAME = "ridge"
TINY = 1e-12  # a pivot below this share of its column's variance is rounding: the column follows from earlier ones


def moments(rows: DataFrame, cols: Sequence[str], label: str = TARGETS[0], key: str = KEY) -> DataFrame:
    """``key, features, n, sums, products`` of the columns and, last, the label.

    Rows with a null or NaN in any of them are left out; a key without other rows has no moments. Give scaled columns:
    products of values far from zero lose digits.
    """
    names = [*cols, label]
    x = [F.col(f"`{c}`").cast("double") for c in names]
    known = rows.select(key, *[F.nanvl(c, F.lit(None)).alias(f"m{i}") for i, c in enumerate(x)]).dropna(subset=[f"m{i}" for i in range(len(x))])
    product = {(i, j): F.sum(F.col(f"m{i}") * F.col(f"m{j}")) for i in range(len(x)) for j in range(i, len(x))}
    return known.groupBy(key).agg(
        F.array(*[F.lit(c) for c in cols]).alias("features"),
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(f"m{i}") for i in range(len(x))]).alias("sums"),
        F.array(*[F.array(*[product[min(i, j), max(i, j)] for j in range(len(x))]) for i in range(len(x))]).alias("products"),
    )


def add_moments(stored: DataFrame, fresh: DataFrame, key: str = KEY) -> DataFrame:
    """Moments of the rows of both tables; both must be of the same features, a key whose features differ gives an error."""
    plus = lambda a, b: a + b
    old = stored.select(key, *[F.col(c).alias(f"o_{c}") for c in ("features", "n", "sums", "products")])
    both = fresh.join(old, key, "full")
    differ = F.col("features").isNotNull() & F.col("o_features").isNotNull() & (F.col("features") != F.col("o_features"))

    def merged(name: str, total: Column) -> Column:
        return F.when(differ, F.raise_error(F.lit("moments of different features"))).otherwise(F.coalesce(total, name, f"o_{name}")).alias(name)

    return both.select(
        key,
        F.coalesce("features", "o_features").alias("features"),
        merged("n", F.col("n") + F.col("o_n")),
        merged("sums", F.zip_with("sums", "o_sums", plus)),
        merged("products", F.zip_with("products", "o_products", lambda a, b: F.zip_with(a, b, plus))),
    )


def _solved(system: Column, size: Column) -> Column:
    """Solution of ``size`` equations, rows of coefficients with the right side last, of a matrix without negative pivots.

    Elimination needs no exchange of rows here. The unknown of a vanishing pivot is 0.
    """

    def step(m: Column, k: Column) -> Column:
        pivot_row, pivot = F.get(m, k), F.get(F.get(m, k), k)

        def reduced(row: Column, i: Column) -> Column:
            gone = F.transform(row, lambda v: F.lit(0.0))
            rest = F.zip_with(row, pivot_row, lambda v, p: v - F.get(row, k) / pivot * p)
            return F.when(pivot < TINY, F.when(i == k, gone).otherwise(row)).when(i == k, F.transform(row, lambda v: v / pivot)).otherwise(rest)

        return F.transform(m, reduced)

    final = F.aggregate(F.sequence(F.lit(0), size - 1), system, step)
    return F.transform(final, lambda row: F.get(row, size))


def fit_ridge(stats: DataFrame, reg: float = LINEAR["regParam"], key: str = KEY) -> DataFrame:
    """``key, features, n, intercept, coefficients`` from the moments of each key.

    The penalty ``reg`` acts on standardised columns and label, so the unit of the label changes nothing; the intercept is
    free. A column that is constant, or without
    penalty a combination of earlier ones, gets 0; a constant label gives 0 for all. One row of moments is a few thousand
    numbers, whatever the number of rows behind it.
    """
    size = F.size("features")
    at = lambda name, i: F.get(F.col(name), i)
    cov = F.transform("products", lambda row, i: F.transform(row, lambda v, j: (v - at("sums", i) * at("sums", j) / F.col("n")) / F.col("n")))
    raw = F.transform("products", lambda row, i: F.get(row, i) / F.col("n"))
    t = stats.select(key, "features", "n", F.transform("sums", lambda s: s / F.col("n")).alias("mean"), cov.alias("cov"), raw.alias("raw"))
    # a variance that is rounding next to the mean square counts as 0
    spread = F.transform("cov", lambda row, i: F.when(F.get(row, i) > at("raw", i) * TINY, F.sqrt(F.get(row, i))).otherwise(F.lit(0.0)))
    t = stage(t.withColumn("sd", spread).drop("raw"), "ridge-moments")
    corr = F.transform(
        F.slice("cov", F.lit(1), size),
        lambda row, i: F.transform(
            row,
            lambda v, j: F.when(i == j, F.lit(1.0 + reg)).when((at("sd", i) == 0) | (at("sd", j) == 0), 0.0).otherwise(v / at("sd", i) / at("sd", j)),
        ),
    )
    t = stage(t.select(key, "features", "n", "mean", "sd", _solved(corr, size).alias("beta")), "ridge-solved")
    weights = F.transform("beta", lambda b, i: F.when(at("sd", i) == 0, F.lit(0.0)).otherwise(b * at("sd", size) / at("sd", i)))
    t = t.select(key, "features", "n", "mean", weights.alias("coefficients"))
    level = at("mean", size) - _dot(F.col("coefficients"), F.slice("mean", F.lit(1), size))
    return t.select(key, "features", "n", level.alias("intercept"), "coefficients")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def predict_ridge(rows: DataFrame, table: DataFrame, cols: Sequence[str], key: str = KEY) -> DataFrame:
    """Add ``yhat``. Rows of keys without a model, of models of other features and with a null feature are left out."""
    fitted = table.select(key, "features", F.col("intercept").alias("_intercept"), F.col("coefficients").alias("_coefficients"))
    fitted = fitted.filter(F.col("features") == F.array(*[F.lit(c) for c in cols])).drop("features")
    row = F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
    yhat = F.col("_intercept") + _dot(F.col("_coefficients"), row)
    return rows.join(fitted, key).withColumn("yhat", yhat).drop("_intercept", "_coefficients").filter("yhat IS NOT NULL")


def train_tables(scaled: DataFrame, root: str, keys: Sequence[str] | None = None, reg: float = LINEAR["regParam"]) -> TrainResult:
    """Fit the models of all keys, store them as one table under ``root`` and predict all splits, in a constant number of jobs.

    A key without training rows has no model. Give ``scaled`` as a stored table: it is read twice.
    """
    spark, cols, started = scaled.sparkSession, feature_columns(scaled), time.monotonic()
    data = scaled.select(KEY, ORDER, "split", *cols, F.col(TARGETS[0]).cast("double").alias("y")).filter("y IS NOT NULL")
    if keys is not None:
        data = data.join(spark.createDataFrame([(k,) for k in keys], f"{KEY} string"), KEY, "left_semi")
    path = f"{root}/{NAME}"
    fit_ridge(stage(moments(data.filter("split = 'train'"), cols, "y"), "moments"), reg).write.mode("overwrite").parquet(path)
    table = spark.read.parquet(path)
    seconds = time.monotonic() - started
    named = F.lit(NAME).alias("model")
    predictions = predict_ridge(data, table, cols).select(KEY, ORDER, named, "split", "y", "yhat")
    models = table.select(KEY, named, F.lit(path).alias("model_path"), F.lit(seconds).alias("seconds"))
    return TrainResult(models, predictions, spark.createDataFrame([], LOSSES), [], {NAME: {"regParam": reg, "mode": "tables"}})
