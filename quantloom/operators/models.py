"""Regressors on Spark ML: forest, boosted trees and a linear model on sequences."""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import (
    GBTRegressionModel,
    GBTRegressor,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.operators.layout import DAILY, Series
from quantloom.operators.prep import feature_columns, make_sequences
from quantloom.schema import KEY, ORDER, SEQ_LEN, TARGETS
from quantloom.sources.stage import stage_folder

# Model settings.
FOREST = {"numTrees": 200, "maxDepth": 10, "seed": 42}
BOOSTED = {
    "maxIter": 200,
    "stepSize": 0.05,
    "maxDepth": 6,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "seed": 42,
}
LINEAR = {"regParam": 0.1, "elasticNetParam": 0.0, "maxIter": 100}

POOLED = "__pooled__"
TASK_VALUES = 1 << 20  # fixed value: one task reads at least so many values a level of trees, or starting it costs more than its work
LOSSES = f"{KEY} string, model string, step long, loss double"


@dataclass(frozen=True)
class ModelSpec:
    """A model kind: its name, its input (``row`` or ``sequence``), its estimator and its settings."""

    name: str
    input: str
    estimator: Callable
    settings: dict = field(default_factory=dict)

    def build(self, features: Sequence[str]) -> Pipeline:
        regressor = self.estimator(featuresCol="_features", labelCol="_label", predictionCol="_prediction", **self.settings)
        if self.input == "sequence":
            return Pipeline(stages=[regressor])
        return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="skip"), regressor])

    @property
    def steps(self) -> int:
        """About how many jobs a fit runs one after the other: a level of a tree is one, and the trees of a forest grow together."""
        return self.settings.get("maxIter", 1) * self.settings.get("maxDepth", 0)


def random_forest(**overrides) -> ModelSpec:
    return ModelSpec("random_forest", "row", RandomForestRegressor, {**FOREST, **overrides})


def boosted_trees(**overrides) -> ModelSpec:
    return ModelSpec("boosted_trees", "row", GBTRegressor, {**BOOSTED, **overrides})


def sequence_model(**overrides) -> ModelSpec:
    return ModelSpec("sequence", "sequence", LinearRegression, {**LINEAR, **overrides})


def default_models() -> list[ModelSpec]:
    return [random_forest(), boosted_trees(), sequence_model()]


@dataclass
class TrainResult:
    """``models``: ticker, model, model_path, seconds. ``predictions``: ticker, date, model, split, y, yhat. ``losses``:
    ticker, model, step, loss on the training rows after each step of a fit that has steps."""

    models: DataFrame
    predictions: DataFrame
    losses: DataFrame
    failed: list[str]
    settings: dict


def sequence_vectors(sequences: DataFrame) -> DataFrame:
    """Add ``_features``: the rows of a sequence one after the other."""
    return sequences.withColumn("_features", array_to_vector(F.flatten("X").cast("array<double>"))).drop("X")


def label_scale(scaler: DataFrame) -> DataFrame:
    """``ticker, _center, _scale`` of the close: puts the targets of all keys on one scale for a pooled fit."""
    return scaler.filter("feature = 'close'").select(
        KEY, F.col("center").alias("_center"), F.col("scale").alias("_scale")
    )


def _inputs(spec: ModelSpec, scaled: DataFrame, sequences: DataFrame | None, cols: list[str]) -> DataFrame:
    if spec.input == "sequence":
        return sequence_vectors(sequences).withColumn("y", F.col("y").cast("double"))
    return scaled.select(KEY, ORDER, "split", *cols, F.col(TARGETS[0]).alias("y")).filter("y IS NOT NULL")


def step_losses(model: PipelineModel, rows: DataFrame) -> list[float]:
    """Mean squared error of boosted trees after each round, in one pass over ``rows``; the solver's history of a linear
    model; nothing for a model that is fitted in one step."""
    last = model.stages[-1]
    if isinstance(last, GBTRegressionModel):
        ready = PipelineModel(model.stages[:-1]).transform(rows)
        return [float(x) for x in last.evaluateEachIteration(ready, "squared")]
    if isinstance(last, LinearRegressionModel) and last.hasSummary:
        return [float(x) for x in last.summary.objectiveHistory]
    return []


def _fit(spec: ModelSpec, train: DataFrame, cols: list[str]) -> PipelineModel:
    """Fit a model of rows on assembled rows that are stored and dealt to as many tasks as their values call for.

    Boosting runs a job for every level of every tree. The rows as they are read come in a task for each file, and each
    task of each job carries the plan behind them; stored rows are few tasks with a short lineage. A forest visits a
    row once for every tree.
    """
    pipeline = spec.build(cols)
    if spec.input == "sequence":
        if train.isEmpty():
            raise ValueError("no training rows")
        return pipeline.fit(train)
    rows = train.count()
    if not rows:
        raise ValueError("no training rows")
    *prepared, regressor = pipeline.getStages()
    ready = PipelineModel(prepared).transform(train).select("_features", "_label")
    tasks = math.ceil(rows * len(cols) * spec.settings.get("numTrees", 1) / TASK_VALUES)
    return PipelineModel([*prepared, regressor.fit(ready.coalesce(tasks).checkpoint())])


def _keep_lineage_short(spark: SparkSession) -> None:
    """Boosting checkpoints its rows every few rounds where a folder is set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{stage_folder(spark)}/boosting")


def train_all(
    scaled: DataFrame,
    root: str,
    keys: Sequence[str] | None = None,
    specs: Sequence[ModelSpec] | None = None,
    *,
    mode: str,
    scaler: DataFrame | None = None,
    seq_len: int = SEQ_LEN,
    parallelism: int = 4,
    series: Series = DAILY,
) -> TrainResult:
    """Fit every model, save it under ``root`` and predict all splits.

    ``per_key`` fits one model per key and kind, however many keys there are; each fit is a distributed job and the
    driver starts them and holds the names of the keys. ``pooled`` fits one model per kind over all keys, on targets
    scaled per key (``scaler`` is needed). Which of them it is does not depend on the data. A fit that fails is listed
    in ``failed`` and the rest go on. Predictions are stored fit by fit. Give ``scaled`` as a stored table: every fit
    reads it.
    """
    spark = scaled.sparkSession
    specs = list(specs or default_models())
    cols = feature_columns(scaled)
    _keep_lineage_short(spark)
    if mode not in ("per_key", "pooled"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "per_key" and keys is None:
        keys = sorted(r[KEY] for r in scaled.select(KEY).dropna().distinct().toLocalIterator())
    stored = f"{stage_folder(spark)}/fits-{uuid.uuid4().hex}"
    if mode == "pooled" and scaler is None:
        raise ValueError("mode 'pooled' needs the scaler table")
    sequences = None
    if any(s.input == "sequence" for s in specs):
        sequences = make_sequences(scaled, cols, seq_len, series=series)

    def job(number: int, key: str, spec: ModelSpec):
        started = time.monotonic()
        data = _inputs(spec, scaled, sequences, cols)
        if key != POOLED:
            data = data.filter(F.col(KEY) == key).withColumn("_label", F.col("y"))
        else:
            data = data.join(label_scale(scaler), KEY).withColumn("_label", (F.col("y") - F.col("_center")) / F.col("_scale"))
            if keys is not None:
                wanted = spark.createDataFrame([(k,) for k in keys], f"{KEY} string")
                data = data.join(wanted, KEY, "left_semi")
        train = data.filter("split = 'train'")
        model = _fit(spec, train, cols)
        path = f"{root}/{spec.name}/{key}"
        model.write().overwrite().save(path)
        yhat = F.col("_prediction") * F.col("_scale") + F.col("_center") if key == POOLED else F.col("_prediction")
        predicted = model.transform(data).select(
            KEY, ORDER, F.lit(spec.name).alias("model"), "split", "y", yhat.alias("yhat")
        )
        seconds = time.monotonic() - started
        predicted.write.parquet(f"{stored}/{number}")
        steps = [(key, spec.name, i, x) for i, x in enumerate(step_losses(model, train), 1)]
        spark.createDataFrame(steps, LOSSES).coalesce(1).write.parquet(f"{stored}/losses/fit={number}")
        return key, spec.name, path, seconds, f"{stored}/{number}", predicted.schema

    tasks = [(k, s) for k in ([POOLED] if mode == "pooled" else keys) for s in specs]
    done, failed = [], []
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        # the fits with most jobs in a row go first, so that none of them is left alone at the end
        started = {i: pool.submit(job, i, *tasks[i]) for i in sorted(range(len(tasks)), key=lambda i: -tasks[i][1].steps)}
        for i, (key, spec) in enumerate(tasks):
            try:
                done.append(started[i].result())
            except Exception as problem:  # one bad fit must not stop the others
                failed.append(f"{spec.name}/{key}: {problem}")
    if not done:
        raise RuntimeError("no model could be fitted: " + "; ".join(failed))
    predictions = spark.read.schema(done[0][5]).parquet(*[item[4] for item in done])
    losses = spark.read.schema(LOSSES).parquet(f"{stored}/losses/*")
    table = spark.createDataFrame(
        [(k, m, p, float(s)) for k, m, p, s, *_ in done], f"{KEY} string, model string, model_path string, seconds double"
    )
    if mode == "pooled":
        names = scaled.select(KEY).distinct()
        if keys is not None:
            names = names.filter(F.col(KEY).isin(list(keys)))
        pairs = F.array(
            *[
                F.struct(F.lit(m).alias("model"), F.lit(p).alias("model_path"), F.lit(float(t)).alias("seconds"))
                for _, m, p, t, *_ in done
            ]
        )
        table = names.withColumn("_pairs", pairs).select(KEY, F.inline("_pairs"))
    return TrainResult(table, predictions, losses, failed, {s.name: {**s.settings, "mode": mode} for s in specs})


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
