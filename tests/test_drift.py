import math

import numpy as np
import pytest

from quantloom.operators import drift as D
from quantloom.operators.layout import DAILY, HOURLY


def samples(spark, **cols):
    keys = cols.pop("ticker", "a")
    n = max(len(v) for v in cols.values())
    rows = [(keys, *[None if i >= len(v) or v[i] is None else float(v[i]) for v in cols.values()]) for i in range(n)]
    return spark.createDataFrame(rows, "ticker string, " + ", ".join(f"{c} double" for c in cols))


def brute(a, b):
    grid = np.sort(np.unique(np.concatenate([a, b])))
    fa = np.array([(a <= v).mean() for v in grid])
    fb = np.array([(b <= v).mean() for v in grid])
    gap = np.abs(fa - fb)
    return gap.max(), float((gap[:-1] * np.diff(grid)).sum())


CASES = {
    "continuous": (lambda r: r.normal(0, 1, 300), lambda r: r.normal(0.3, 1.5, 120)),
    "ties": (lambda r: r.integers(0, 6, 200).astype(float), lambda r: r.integers(2, 9, 90).astype(float)),
    "identical": (lambda r: np.arange(50.0), lambda r: np.arange(50.0)),
    "disjoint": (lambda r: r.random(40), lambda r: r.random(30) + 5),
    "one value": (lambda r: np.ones(30), lambda r: np.ones(20)),
}


@pytest.mark.parametrize("series", [DAILY, HOURLY], ids=["plain", "sliced"])
@pytest.mark.parametrize("case", CASES)
def test_statistics_match_brute_force(spark, case, series):
    rng = np.random.default_rng(7)
    a, b = (f(rng) for f in CASES[case])
    row = D.two_sample(D.ecdf_pair(samples(spark, x=a), samples(spark, x=b), ["x"], series)).first()
    ks, w = brute(a, b)
    assert row.ks == pytest.approx(ks, abs=1e-12) and row.wasserstein == pytest.approx(w, abs=1e-9)
    other = D.two_sample(D.ecdf_pair(samples(spark, x=b), samples(spark, x=a), ["x"], series)).first()
    assert other.ks == pytest.approx(ks, abs=1e-12)
    stats = D.sample_statistics(samples(spark, x=a), samples(spark, x=b), ["x"], series).filter("feature = 'x'").first()
    assert stats.spread == pytest.approx(max(a.std(), 0.001), rel=1e-9)


def test_pvalue_of_the_limit_distribution(spark):
    # known points of the Kolmogorov distribution: P(K > 1.3581) = 0.05, P(K > 1.6276) = 0.01, P(K > 0.8276) = 0.5
    for lam, p in ((1.3581, 0.05), (1.6276, 0.01), (0.8276, 0.5), (0.1, 1.0), (3.0, 2 * np.exp(-18))):
        n = 20000
        d = lam / np.sqrt(n / 2)
        got = spark.range(1).select(D.ks_pvalue(D.F.lit(float(d)), D.F.lit(n), D.F.lit(n)).alias("p")).first().p
        assert got == pytest.approx(p, rel=2e-3)
    assert spark.range(1).select(D.ks_pvalue(D.F.lit(0.0), D.F.lit(5), D.F.lit(5)).alias("p")).first().p == 1.0


def test_pvalue_counts_all_orders(spark):
    from itertools import combinations

    cases, want = [], {}
    for n in range(1, 7):
        for m in range(1, 6):
            found = []
            for chosen in combinations(range(n + m), n):
                i = j = most = 0
                for k in range(n + m):
                    i, j = (i + 1, j) if k in chosen else (i, j + 1)
                    most = max(most, abs(i * m - j * n))
                found.append(most)
            for h in range(0, n * m + 1):
                cases.append((n, m, h))
                want[n, m, h] = sum(x >= h for x in found) / len(found)
    df = spark.createDataFrame(cases, "n int, m int, h int")
    got = df.withColumn("p", D.ks_pvalue(D.F.col("h") / (D.F.col("n") * D.F.col("m")), D.F.col("n"), D.F.col("m"))).collect()
    assert all(r.p == pytest.approx(want[r.n, r.m, r.h], rel=1e-12) for r in got)


def test_exact_pvalue_of_larger_samples(spark):
    # disjoint samples: two of all orders; and the exact law approaches the limit
    n, m = 40, 60
    one = spark.range(1)
    law = lambda d, a, b, **k: one.select(D.ks_pvalue(D.F.lit(float(d)), D.F.lit(a), D.F.lit(b), **k).alias("p")).first().p
    assert law(1.0, n, m) == pytest.approx(2 / math.comb(n + m, n), rel=1e-9)
    for d in (0.02, 0.05, 0.08):
        assert law(d, 1500, 1200) == pytest.approx(law(d, 1500, 1200, exact_rows=0), rel=0.08, abs=1e-3)
    assert law(0.5, 20000, 3) == law(0.5, 20000, 3, exact_rows=0) and law(0.0, 5, 4) == 1.0


def test_small_reference_uses_ks_and_large_uses_distance(spark):
    rng = np.random.default_rng(1)
    cur = samples(spark, close=rng.normal(0, 1, 100), open=rng.normal(9, 1, 100))
    for n, test in ((1000, "ks"), (1001, "wasserstein")):
        ref = samples(spark, close=rng.normal(0, 1, n), open=rng.normal(0, 1, n))
        rows = {r.feature: r for r in D.column_drift(ref, cur).collect()}
        assert {r.test for r in rows.values()} == {test}
        assert rows["open"].drifted and rows["open"].n_ref == n


def test_data_drift_verdicts_and_errors(spark):
    rng = np.random.default_rng(2)
    ref = samples(spark, close=rng.normal(0, 1, 200), open=rng.normal(0, 1, 200), high=[None] * 200)
    ref = ref.union(ref.withColumn("ticker", D.F.lit("b"))).union(ref.withColumn("ticker", D.F.lit("c")))
    same = ref.filter("ticker = 'a'").limit(80)
    cur = same.withColumn("open", D.F.col("open") + 9)
    cur = cur.union(cur.select(D.F.lit("c").alias("ticker"), *[D.F.lit(None).cast("double").alias(c) for c in ("close", "open", "high")]))
    rows = {r.ticker: r for r in D.data_drift(ref, cur, threshold=0.4).collect()}
    assert rows["a"].drifted_features == ["open"] and rows["a"].drift_score == 0.5 and rows["a"].drift_detected
    assert rows["a"].total_features == 2 and rows["a"].error is None
    assert rows["b"].error == "no current rows" and not rows["b"].drift_detected
    assert rows["c"].error == "no feature to compare"
    # the limit is strict
    assert not [r for r in D.data_drift(ref, cur, threshold=0.5).collect() if r.drift_detected]
    # a column the current table lacks leaves nothing to compare
    assert {r.error for r in D.data_drift(ref, cur.drop("high")).collect()} == {"no feature to compare", "no current rows"}


def test_prediction_drift(spark):
    rng = np.random.default_rng(3)
    ref = samples(spark, predictions=rng.normal(150, 5, 300))
    far = D.prediction_drift(ref, samples(spark, predictions=rng.normal(300, 5, 50))).first()
    assert far.drift_detected and far.drift_score == 1.0 and far.drifted_features == ["predictions"] and far.p_value < 1e-6
    same = D.prediction_drift(ref, ref).first()
    assert not same.drift_detected and same.drift_score == 0.0 and same.drifted_features == [] and same.p_value == 1.0


def test_monitor_marks_failed_keys(spark, tmp_path):
    rng = np.random.default_rng(4)
    ref = samples(spark, close=rng.normal(0, 1, 100))
    keys = spark.createDataFrame([("a",), ("zz",)], "ticker string")
    data = D.data_drift(ref, ref, keys)
    p = ref.withColumnRenamed("close", "predictions")
    moved = p.withColumn("predictions", D.F.col("predictions") + 5)
    table = D.monitor(keys, data, D.prediction_drift(p, moved, keys))
    rows = {r.ticker: r for r in table.collect()}
    assert rows["a"].status == "ok" and rows["a"].drift_detected and not rows["a"].data_drift
    assert rows["zz"].status == "failed" and not rows["zz"].drift_detected and "no current" in rows["zz"].error
    assert D.monitor_totals(table).first().asDict() == {"total": 2, "drift_detected": True, "drifted": 1, "failed": 1}
    assert [r.ticker for r in D.retrain_list(table).collect()] == ["a"]
    path = str(tmp_path / "drift")
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        D.write_drift_summary(table, path, day)
    assert spark.read.parquet(path).count() == 4
