"""Partial autocorrelations, unit-root surface and stratified folds against plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import ml
from tessera.operators import timeseries as TS


def _levinson(r):
    """Partial autocorrelations by solving each order's Yule-Walker system."""
    out = []
    for k in range(1, len(r) + 1):
        full = np.array([[1.0 if i == j else r[abs(i - j) - 1] for j in range(k)] for i in range(k)])
        out.append(np.linalg.solve(full, r[:k])[-1])
    return out


def test_pacf_solves_the_yule_walker_systems(spark):
    rng = np.random.default_rng(4)
    sizes = {1: 400, 2: 60, 3: 5}
    walk = {i: np.convolve(rng.normal(size=n + 3), [1, 0.6, -0.3, 0.2], "valid")[:n] for i, n in sizes.items()}
    rows = [(i, t, float(v)) for i, x in walk.items() for t, v in enumerate(x, 1)]
    rows += [(4, t, 2.0) for t in range(1, 30)] + [(5, 1, 1.0)]
    df = spark.createDataFrame(rows, "series_id long, t long, value double")
    got = TS.pacf(df).collect()
    assert {r["series_id"] for r in got} == {1, 2, 3}  # constant and one-value series have none
    for i, x in walk.items():
        d = x - x.mean()
        lags = min(math.floor(round(10 * math.log10(len(x)), 9)), len(x) - 1)
        r = [float(d[k:] @ d[:-k] / (d @ d)) for k in range(1, lags + 1)]
        mine = sorted((x["lag"], x["pacf"]) for x in got if x["series_id"] == i)
        assert [m[0] for m in mine] == list(range(1, lags + 1))
        assert np.allclose([m[1] for m in mine], _levinson(r), atol=1e-9)
    assert TS.pacf(df.limit(0), 5).count() == 0


def test_unit_root_surface_gives_the_published_values(spark):
    rows = spark.createDataFrame([(25,), (100,), (500,), (10 ** 9,)], "t long")
    got = [r[0] for r in rows.orderBy("t").select(TS.tau_critical(F.col("t"))).collect()]
    assert [round(v, 3) for v in got] == [-2.986, -2.891, -2.867, -2.862]
    for percent, tau in ((1, -3.43035), (5, -2.86154), (10, -2.56677)):
        assert abs(TS.tau_p_value(tau) - percent / 100) < 1e-3
    assert TS.tau_p_value(None) is None and TS.tau_p_value(5.0) == 1.0 and TS.tau_p_value(-50.0) == 0.0
    assert abs(TS.tau_p_value(TS.TAU_SWITCH) - TS.tau_p_value(TS.TAU_SWITCH + 1e-9)) < 1e-3


def test_adf_carries_its_p_value(spark):
    rng = np.random.default_rng(2)
    noise, walk = rng.normal(size=300), np.cumsum(rng.normal(size=300))
    df = spark.createDataFrame([(i, t, float(v)) for i, x in ((1, noise), (2, walk)) for t, v in enumerate(x, 1)]
                               + [(3, 1, 1.0), (3, 2, 2.0)], "series_id long, t long, value double")
    got = {r["series_id"]: r for r in TS.adf(df).collect()}
    assert got[1]["p_value"] < 0.01 and got[2]["p_value"] > 0.05 and got[3]["p_value"] is None
    assert got[1]["stationary"] and got[3]["stationary"] is None


@pytest.mark.parametrize("folds", [3, 30])
def test_folds_are_exactly_stratified(spark, folds):
    df = spark.range(1003).select(F.col("id").alias("key"), F.when(F.col("id") % 9 == 0, 1).when(F.col("id") % 50 != 7, 0).alias("y"))
    dealt = ml.stratified_folds(df.repartition(5), "y", "key", folds)
    assert dealt.select("key").distinct().count() == 1003 and set(dealt.columns) == {"key", "y", "fold"}
    for group in (["fold", "y"], ["fold"]):
        sizes = {}
        for r in dealt.groupBy(*group).count().collect():
            sizes.setdefault(r["y"] if "y" in group else "all", {})[r["fold"]] = r["count"]
        for by_fold in sizes.values():
            counts = [by_fold.get(k, 0) for k in range(folds)]
            assert max(counts) - min(counts) <= 1
    again = ml.stratified_folds(df.repartition(11), "y", "key", folds)
    assert dealt.exceptAll(again).count() == 0
    assert ml.stratified_folds(df.limit(0), "y", "key", folds).count() == 0
