import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from helpers import random_walk, to_bars
from quantloom.operators import linear as L
from quantloom.operators.validate import requested_keys
from quantloom.plans import pipeline as P
from quantloom.schema import FEATURES

COLS = ["a", "b", "c"]


def frame(n, seed, key="K"):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, 5, 0.1] + [0, 3, 1]
    y = x @ [2.0, -1.0, 30.0] + 7 + rng.normal(size=n)
    return pd.DataFrame({"ticker": key, "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y})


def fitted(df, reg=0.1):
    return {r.ticker: r for r in L.fit_ridge(L.moments(df, COLS, "y"), reg).collect()}


@pytest.mark.parametrize("reg", [0.0, 0.1, 3.0])
def test_equals_the_general_solver(spark, reg):
    df = spark.createDataFrame(pd.concat([frame(200, 1, "A"), frame(90, 2, "B")]))
    for key, row in fitted(df, reg).items():
        ready = VectorAssembler(inputCols=COLS, outputCol="x").transform(df.filter(F.col("ticker") == key))
        # there the penalty is in units of the label, here it is on the standardised label
        unit = df.filter(F.col("ticker") == key).agg(F.stddev_pop("y")).first()[0]
        want = LinearRegression(featuresCol="x", labelCol="y", regParam=reg * unit, solver="normal").fit(ready)
        np.testing.assert_allclose(row.coefficients, want.coefficients.toArray(), rtol=1e-6)
        assert row.intercept == pytest.approx(want.intercept, rel=1e-6)


def test_degenerate_columns_and_rows(spark):
    base = frame(60, 3)
    base["c"] = 2 * base.a - base.b
    flat = frame(30, 4, "FLAT").assign(b=5.0)
    still = frame(30, 5, "STILL").assign(y=4.0)
    one = frame(1, 6, "ONE")
    gaps = frame(50, 7, "GAPS")
    holes = pd.concat([gaps, gaps.head(9).assign(a=np.nan, y=1e9), gaps.head(9).assign(y=np.nan)])
    none = frame(3, 8, "NONE").assign(a=np.nan)
    got = fitted(spark.createDataFrame(pd.concat([base, flat, still, one, holes, none])), 0.0)
    assert set(got) == {"K", "FLAT", "STILL", "ONE", "GAPS"}
    assert got["K"].coefficients[2] == 0 and got["FLAT"].coefficients[1] == 0
    assert got["STILL"].coefficients == [0, 0, 0] and got["STILL"].intercept == pytest.approx(4)
    assert got["ONE"].coefficients == [0, 0, 0] and got["ONE"].intercept == pytest.approx(one.y[0])
    assert got["GAPS"].n == 50 and got["GAPS"].coefficients == pytest.approx(fitted(spark.createDataFrame(gaps), 0.0)["GAPS"].coefficients)
    empty = spark.createDataFrame(base).filter("false")
    assert fitted(empty) == {}


def test_moments_add_up(spark):
    first, second = frame(80, 1, "A"), pd.concat([frame(50, 2, "A"), frame(20, 3, "B")])
    parts = [L.moments(spark.createDataFrame(x), COLS, "y") for x in (first, second)]
    got = {r.ticker: r for r in L.fit_ridge(L.add_moments(*parts)).collect()}
    want = fitted(spark.createDataFrame(pd.concat([first, second])))
    assert set(got) == {"A", "B"} and got["A"].n == 130
    for k in got:
        assert got[k].coefficients == pytest.approx(want[k].coefficients, rel=1e-9)
    other = L.moments(spark.createDataFrame(first), ["a", "c", "b"], "y")
    with pytest.raises(Exception, match="different features"):
        L.add_moments(parts[0], other).collect()


def test_rows_without_a_fitting_model_get_no_forecast(spark):
    df = spark.createDataFrame(frame(40, 1, "A"))
    table = L.fit_ridge(L.moments(df, COLS, "y"))
    rows = spark.createDataFrame(pd.concat([frame(5, 2, "A"), frame(5, 3, "B"), frame(2, 4, "A").assign(b=np.nan)]))
    got = L.predict_ridge(rows.withColumn("b", F.nanvl("b", F.lit(None))), table, COLS)
    assert got.count() == 5 and got.columns == [*rows.columns, "yhat"]
    assert L.predict_ridge(rows, table, ["b", "a", "c"]).count() == 0


def test_number_of_jobs_does_not_follow_the_number_of_keys(spark, tmp_path):
    def jobs(n):
        df = spark.range(n * 6).select((F.col("id") % n).cast("string").alias("ticker"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("date"), F.lit("train").alias("split"),
            F.rand(1).alias("close"), F.rand(2).alias("open"), F.rand(3).alias("target_next_close"))
        spark.sparkContext.setJobGroup(f"keys-{n}", "")
        result = L.train_tables(df, str(tmp_path / str(n)))
        assert result.models.count() == n and result.predictions.count() == 6 * n
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"keys-{n}"))

    few, many = jobs(10), jobs(20_000)
    assert abs(many - few) <= 2


def test_tables_from_ingestion_to_monitoring(spark, tmp_path):
    root = str(tmp_path)
    bars = to_bars(spark, pd.concat([random_walk(260, 1, "AAA"), random_walk(240, 2, "BBB")]))
    keys = requested_keys(bars, ["AAA", "BBB"])
    P.ingest(bars, keys, root, "2024-01-01")
    P.prepare(spark, root, keys, seq_len=5)
    registry, failed = P.train(spark, root, "t", mode="tables")
    assert failed == [] and {(r.ticker, r.best_model) for r in registry.collect()} == {("AAA", "ridge"), ("BBB", "ridge")}
    assert registry.select("model_path").distinct().count() == 1
    scored = {r.ticker: r for r in P.score_keys(spark, root, seq_len=5).collect()}
    assert set(scored) == {"AAA", "BBB"} and all(np.isfinite(r.predicted_close) and r.features_used == len(FEATURES) for r in scored.values())
    table = P.monitor(spark, root, keys, "2020-08-20", "2024-01-02", seq_len=5)
    assert {r.status for r in table.collect()} == {"ok"}
