import numpy as np
import pandas as pd
import pytest

from helpers import random_walk, to_bars
from quantloom.operators import models as M, score
from quantloom.operators.validate import requested_keys
from quantloom.plans import pipeline as P
from quantloom.schema import FEATURES

SMALL = [M.random_forest(numTrees=5, maxDepth=4), M.boosted_trees(maxIter=3, maxDepth=3), M.sequence_model()]
SEQ = 5


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("run"))
    frames = [random_walk(260, 1, "AAA"), random_walk(240, 2, "BBB"), random_walk(40, 3, "SHORT")]
    bars = to_bars(spark, pd.concat(frames))
    keys = requested_keys(bars, ["AAA", "BBB", "SHORT", "NONE"])
    P.ingest(bars, keys, root, "2024-01-01")
    report, missing = P.prepare(spark, root, keys, seq_len=SEQ)
    return root, keys, report.collect(), missing.collect()


def test_prepare_reports_missing_outputs(run):
    _root, _keys, report, missing = run
    assert {r.ticker: (r.train_rows, r.val_rows, r.test_rows) for r in report} == {"AAA": (147, 31, 32), "BBB": (133, 28, 29)}
    assert {r.ticker for r in missing} == {"SHORT", "NONE"} and len(missing) == 10


@pytest.mark.parametrize("mode", ["per_key", "pooled"])
def test_train_score_monitor(spark, run, mode):
    root, keys, _r, _m = run
    registry, failed = P.train(spark, root, f"run-{mode}", specs=SMALL, mode=mode, seq_len=SEQ)
    assert failed == []
    rows = registry.collect()
    assert {r.ticker for r in rows} == {"AAA", "BBB"}
    for r in rows:
        assert len(r.all_results) == 3 and np.isfinite(r.val_metrics.rmse) and np.isfinite(r.test_metrics.r2)
        best = min(x.val_metrics.rmse for x in r.all_results)
        assert r.val_metrics.rmse == best
    if mode == "per_key":
        scored = {r.ticker: r for r in P.score_keys(spark, root, seq_len=SEQ).collect()}
        assert set(scored) == {"AAA", "BBB"} and scored["AAA"].features_used == len(FEATURES)
        assert all(np.isfinite(r.predicted_close) for r in scored.values())
        with pytest.raises(ValueError, match="60 to 365"):
            P.score_keys(spark, root, lookback_days=10)
    else:
        asof = "2020-08-20"
        table = P.monitor(spark, root, keys, asof, "2024-01-02", seq_len=SEQ)
        status = {r.ticker: r.status for r in table.collect()}
        assert status == {"AAA": "ok", "BBB": "ok", "SHORT": "failed", "NONE": "failed"}


def test_failing_model_is_listed_and_others_go_on(spark, run):
    root = run[0]
    bad = M.ModelSpec("boosted_trees", "row", M.GBTRegressor, {"maxDepth": -1})
    result = M.train_all(P.read_splits(spark, root), f"{root}/partial", ["AAA", "GONE"], [SMALL[0], bad], mode="per_key")
    assert len(result.failed) == 3 and [r.model for r in result.models.collect()] == ["random_forest"]
    with pytest.raises(RuntimeError, match="no model"):
        M.train_all(P.read_splits(spark, root), f"{root}/none", ["GONE"], [SMALL[0]], mode="per_key")


def test_small_tables_are_fitted_in_one_task_with_a_short_lineage(spark, run):
    seen = []

    class Watched(M.GBTRegressor):
        def _fit(self, dataset):
            rows = dataset._jdf.queryExecution().toRdd()
            seen.append((rows.getNumPartitions(), "FileScan" in rows.toDebugString(), dataset.count()))
            return super()._fit(dataset)

    root = run[0]
    scaled = P.read_splits(spark, root)
    assert scaled.filter("split = 'train'").rdd.getNumPartitions() > 1
    spec = M.ModelSpec("boosted_trees", "row", Watched, {"maxIter": 2, "maxDepth": 2})
    result = M.train_all(scaled, f"{root}/few", specs=[spec], mode="pooled", scaler=P.B.read_stored(spark, f"{root}/scaler"))
    assert result.failed == [] and seen == [(1, False, 280)]
    assert result.predictions.count() == scaled.filter("target_next_close IS NOT NULL").count()


def test_tasks_grow_with_the_work(spark, run, monkeypatch):
    seen = []

    class Watched(M.RandomForestRegressor):
        def _fit(self, dataset):
            seen.append(dataset._jdf.queryExecution().toRdd().getNumPartitions())
            return super()._fit(dataset)

    root = run[0]
    scaled = P.read_splits(spark, root).repartition(9)
    monkeypatch.setattr(M, "TASK_VALUES", 147 * len(FEATURES))
    for trees in (1, 3, 40):
        spec = M.ModelSpec("random_forest", "row", Watched, {"numTrees": trees, "maxDepth": 2})
        M.train_all(scaled, f"{root}/work{trees}", ["AAA"], [spec], mode="per_key")
    assert seen == [1, 3, 9]


def test_default_settings():
    forest, boosted, _seq = M.default_models()
    assert (forest.settings["numTrees"], forest.settings["maxDepth"]) == (200, 10)
    assert (boosted.settings["maxIter"], boosted.settings["stepSize"], boosted.settings["maxDepth"]) == (200, 0.05, 6)


def test_latest_row_and_sequences(spark):
    bars = to_bars(spark, pd.concat([random_walk(40, 1, "AAA"), random_walk(20, 2, "BBB")]))
    newest = {r.ticker: r for r in score.latest_features(bars).collect()}
    assert newest["AAA"].date.strftime("%Y-%m-%d") == "2020-02-09" and len(newest) == 2
    last = {r.ticker: r for r in score.last_sequence(bars, ["close"], 30).collect()}
    assert set(last) == {"AAA"}
    want = random_walk(40, 1).close.values[-30:].astype(np.float32)
    np.testing.assert_array_equal(np.array(last["AAA"].X, dtype=np.float32).ravel(), want)
    tiled = score.last_sequence(bars, ["close"], 4, tiled=True).filter("ticker = 'AAA'").first()
    assert len(tiled.X) == 4 and len({x[0] for x in tiled.X}) == 1


def test_next_weekday(spark):
    days = spark.createDataFrame([("2024-01-04",), ("2024-01-05",), ("2024-01-06",), ("2024-01-07",)], "date string")
    got = [str(r[0]) for r in days.select(score.next_weekday()).collect()]
    assert got == ["2024-01-05", "2024-01-08", "2024-01-08", "2024-01-08"]
