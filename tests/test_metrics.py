import math

import pytest

from quantloom.operators import metrics as M


def preds(spark, rows):
    return spark.createDataFrame(rows, "ticker string, model string, split string, y double, yhat double")


def one(spark, y, yhat):
    return M.forecast_metrics(preds(spark, [("a", "m", "val", a, b) for a, b in zip(y, yhat)])).first()


def test_known_values(spark):
    assert one(spark, [100.0, 100.0], [110.0, 90.0]).mae == 10.0
    row = one(spark, [0.0, 0.0], [3.0, 4.0])
    assert row.rmse == round(math.sqrt(12.5), 4) and row.mape == math.inf and row.r2 == 0.0
    assert one(spark, [100.0, 200.0], [110.0, 180.0]).mape == 10.0
    assert one(spark, [0.0, 200.0], [5.0, 180.0]).mape == 10.0
    perfect = one(spark, [1.0, 2.0, 3.0], [1.0, 2.0, 3.0])
    assert (perfect.mae, perfect.rmse, perfect.r2) == (0.0, 0.0, 1.0)
    assert one(spark, [1.0, 2.0, 3.0], [3.0, 2.0, 1.0]).r2 == -3.0


def test_best_model_and_tie_break(spark):
    rows = [("a", m, "val", 10.0, 10.0 + e) for m, e in (("sequence", 1.0), ("boosted_trees", 1.00000001), ("random_forest", 2.0))]
    rows += [("b", m, "val", 10.0, 11.0) for m in ("sequence", "random_forest")]
    best = {r.ticker: r.best_model for r in M.select_best(M.forecast_metrics(preds(spark, rows))).collect()}
    assert best == {"a": "boosted_trees", "b": "random_forest"}


def test_registry_queries(spark):
    rows = [(t, m, s, 10.0, 10.0 + e) for t in ("b", "A") for m, e in (("random_forest", 2.0), ("sequence", 1.0)) for s in ("train", "val", "test")]
    scored = M.forecast_metrics(preds(spark, rows))
    paths = scored.select("ticker", "model").distinct().withColumn("model_path", M.F.concat_ws("/", "model", "ticker"))
    registry = M.build_registry(scored, paths, "run-9")
    row = M.get_model(registry, "a").first()
    assert (row.best_model, row.model_path, row.run_id, row.val_metrics.rmse) == ("sequence", "sequence/A", "run-9", 1.0)
    assert [r.model for r in row.all_results] == ["random_forest", "sequence"]
    assert [r.ticker for r in M.list_keys(registry).collect()] == ["A", "b"]
    assert M.get_model(registry, "zzz").count() == 0
    log = M.run_log(scored, "run-9", {"sequence": {"regParam": 0.1}})
    assert log.filter("kind = 'metric'").count() == 2 * 2 * 3 * 4
    assert log.filter("kind = 'param' AND name = 'regParam'").count() == 2


def test_infinite_mape_does_not_break_the_log(spark):
    scored = M.forecast_metrics(preds(spark, [("a", "m", "val", 0.0, 1.0)]))
    value = M.run_log(scored, "r").filter("name = 'val_mape'").first().value
    assert value == pytest.approx(math.inf) if not isinstance(value, str) else value == "Infinity"


def test_unlisted_model_loses_a_tie(spark):
    from quantloom.operators.metrics import select_best

    rows = [("A", "mystery", "val", 1.0), ("A", "xgboost", "val", 1.0)]
    got = select_best(spark.createDataFrame(rows, "ticker string, model string, split string, rmse double"), ["random_forest", "xgboost"])
    assert got.first().best_model == "xgboost"
