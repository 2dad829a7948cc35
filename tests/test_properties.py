"""Property tests where SQL can't check."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators import features as FE
from tessera.operators import ml
from tessera.operators import sorting
from tessera.operators import timeseries as TS


def _series(spark, gens, n=200, seed=7):
    random.seed(seed)
    rows = []
    for sid, gen in enumerate(gens):
        acc = 0.0
        for t in range(1, n + 1):
            v = gen()
            if isinstance(v, tuple):      # random walk marker
                acc += v[0]
                v = acc
            rows.append((sid, t, float(v)))
    return spark.createDataFrame(rows, "series_id long, t int, value double")


def test_block_lags_equal_plain_window_lags(spark):
    df = _series(spark, [lambda: random.gauss(0, 1)] * 3, n=50)
    got = TS.lagged(df, 4, block=7).select("series_id", "t", *[f"lag_value_{k}" for k in range(1, 5)])
    w = Window.partitionBy("series_id").orderBy("t")
    exp = df.select("series_id", "t", *[F.lag("value", k).over(w).alias(f"lag_value_{k}") for k in range(1, 5)])
    assert got.count() == 150
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_acf_matches_numpy(spark):
    df = _series(spark, [lambda: random.gauss(0, 1)], n=120)
    x = np.array([r["value"] for r in df.orderBy("t").collect()])
    d = x - x.mean()
    exp = [float((d[k:] * d[:-k]).sum() / (d * d).sum()) for k in range(1, 6)]
    got = [r["acf"] for r in TS.acf(df, 5, block=16).orderBy("lag").collect()]
    assert np.allclose(got, exp, atol=1e-12)


def test_pacf_lag1_is_acf_lag1(spark):
    df = _series(spark, [lambda: random.gauss(0, 1)], n=150)
    a = TS.acf(df, 3).where("lag = 1").first()["acf"]
    p = TS.pacf(df, 3).where("lag = 1").first()["pacf"]
    assert abs(a - p) < 1e-12


def test_chi2_tail_known_value():
    assert abs(TS.chi2_sf(31.41, 20) - 0.0500) < 5e-4
    assert abs(TS.chi2_sf(3.841, 1) - 0.05) < 1e-3
    assert TS.chi2_sf(0.0, 5) == 1.0


def test_ljung_box_p_in_unit_interval(spark):
    df = _series(spark, [lambda: random.gauss(0, 1), lambda: (random.gauss(0, 1),)], n=200)
    rows = {r["series_id"]: r for r in TS.ljung_box(df, 20).collect()}
    for r in rows.values():
        assert 0.0 <= r["p_value"] <= 1.0
    assert rows[1]["statistic"] > rows[0]["statistic"] and rows[1]["p_value"] < rows[0]["p_value"]


def test_adf_walk_needs_a_difference_noise_does_not(spark):
    df = _series(spark, [lambda: random.gauss(0, 1), lambda: (random.gauss(0, 1),)], n=300)
    nd = {r["series_id"]: r["ndiffs"] for r in TS.ndiffs(df).collect()}
    assert nd == {0: 0, 1: 1}


def _royston_w(x):
    """Shapiro-Wilk W by Royston's coefficients with exact normal quantiles, in plain Python."""
    from statistics import NormalDist
    x = sorted(x)
    n = len(x)
    m = [NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    summ2 = sum(v * v for v in m)
    rsn = 1 / math.sqrt(n)
    a1 = TS._poly(TS._SW_C1, rsn) + m[-1] / math.sqrt(summ2)
    a2 = TS._poly(TS._SW_C2, rsn) + m[-2] / math.sqrt(summ2)
    fac = math.sqrt((summ2 - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * a1 ** 2 - 2 * a2 ** 2))
    a = [v / fac for v in m]
    a[-1], a[-2], a[0], a[1] = a1, a2, -a1, -a2
    mean = sum(x) / n
    return sum(ai * xi for ai, xi in zip(a, x)) ** 2 / sum((xi - mean) ** 2 for xi in x)


def test_shapiro_matches_plain_python(spark):
    df = _series(spark, [lambda: random.gauss(0, 1), lambda: random.expovariate(1.0)], n=300)
    got = {x["series_id"]: x["statistic"] for x in TS.shapiro(df).collect()}
    for sid in (0, 1):
        values = [r["value"] for r in df.where(F.col("series_id") == sid).collect()]
        assert abs(got[sid] - _royston_w(values)) < 1e-8


def test_shapiro_w_bounds(spark):
    from statistics import NormalDist
    n = 300
    quantiles = [(0, t, NormalDist().inv_cdf((t - 0.5) / n)) for t in range(1, n + 1)]
    random.seed(2)
    skewed = [(1, t, random.expovariate(1.0)) for t in range(1, n + 1)]
    df = spark.createDataFrame(quantiles + skewed, "series_id long, t int, value double")
    r = {x["series_id"]: x for x in TS.shapiro(df).collect()}
    assert 0.99 < r[0]["statistic"] <= 1.0 and r[0]["p_value"] > 0.5
    assert 0 < r[1]["statistic"] < r[0]["statistic"] and r[1]["p_value"] < 0.001


def test_top_k_per_group_matches_brute_force(spark):
    random.seed(3)
    rows = [(random.choice("ab"), i, random.randint(0, 20)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, id int, v int")
    got = sorting.top_k_per_group(df, ["g"], [F.col("v").asc(), F.col("id").asc()], 5, spread=4)
    exp = sorted(rows, key=lambda r: (r[0], r[2], r[1]))
    for g in "ab":
        want = [r[1] for r in exp if r[0] == g][:5]
        have = [r["id"] for r in got.where(F.col("g") == g).orderBy("rank").collect()]
        assert have == want


def test_folds_disjoint_and_complete(spark):
    df = spark.range(1000).withColumnRenamed("id", "key")
    f = df.select("key", ml.fold_column("key", 30).alias("fold"))
    assert f.select("key").distinct().count() == 1000
    counts = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert len(counts) == 30 and sum(counts) == 1000


def test_hash_split_is_stable(spark):
    df = spark.range(500).withColumnRenamed("id", "key")
    a = FE.hash_split(df, "key")[1].collect()
    b = FE.hash_split(df.repartition(7), "key")[1].collect()
    assert sorted(r["key"] for r in a) == sorted(r["key"] for r in b) and 60 < len(a) < 140


def test_logistic_fit_is_stationary_point(spark):
    random.seed(11)
    rows = []
    for i in range(400):
        x1, x2 = random.gauss(0, 1), random.gauss(0, 1)
        y = 1 if random.random() < 1 / (1 + math.exp(-(0.5 + 1.5 * x1 - x2))) else 0
        rows.append((i, x1, x2, y))
    df = spark.createDataFrame(rows, "id long, x1 double, x2 double, y int")
    model = ml.fit_logistic(df, ["x1", "x2"], "y", C=1.0, tol=1e-10)
    lr = model.stages[-1]
    w = np.array(lr.coefficients.toArray())
    b = lr.intercept
    X = np.array([[r[1], r[2]] for r in rows])
    y = np.array([r[3] for r in rows])
    p = 1 / (1 + np.exp(-(X @ w + b)))
    grad_w = (p - y) @ X + w          # C = 1: sum of losses + |w|^2 / 2
    grad_b = (p - y).sum()
    assert np.max(np.abs(grad_w)) < 1e-3 and abs(grad_b) < 1e-3


def test_relieff_ranks_informative_feature_first(spark):
    random.seed(5)
    rows = []
    for i in range(600):
        y = i % 2
        rows.append((i, y + random.gauss(0, 0.3), random.gauss(0, 1), y))
    df = spark.createDataFrame(rows, "id long, good double, noise double, y int")
    imp = {r["feature"]: r["importance"] for r in FE.relieff(df, ["good", "noise"], "y", "id", anchors=50, k=5).collect()}
    assert imp["good"] > imp["noise"]


def test_position_and_running_sum_with_hot_key(spark):
    random.seed(9)
    rows = [(0 if i % 3 else random.randint(1, 5), i, random.random()) for i in range(3000)]   # key 0 is hot
    df = spark.createDataFrame(rows, "k long, ts long, v double")
    got = sorting.position_within(df, ["k"], ["ts"], name="pos", partitions=16)
    w = Window.partitionBy("k").orderBy("ts")
    exp = df.withColumn("pos", F.row_number().over(w))
    assert got.select("k", "ts", "pos").exceptAll(exp.select("k", "ts", "pos")).count() == 0
    assert got.count() == 3000
    rs = {(r["k"], r["ts"]): r["running_sum"] for r in sorting.running_sum_within(df, ["k"], ["ts"], "v", partitions=16).collect()}
    ref = {(r["k"], r["ts"]): r["c"] for r in df.withColumn(
        "c", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))).collect()}
    assert rs.keys() == ref.keys() and all(abs(rs[x] - ref[x]) < 1e-9 for x in ref)


def test_newton_fit_matches_spark_ml(spark):
    random.seed(13)
    rows = []
    for i in range(500):
        x1, x2 = random.gauss(0, 1), random.gauss(0, 2)
        y = 1 if random.random() < 1 / (1 + math.exp(-(-0.3 + x1 - 0.5 * x2))) else 0
        rows.append((i, x1, x2, y))
    df = spark.createDataFrame(rows, "id long, x1 double, x2 double, y int")
    lr = ml.fit_logistic(df, ["x1", "x2"], "y", tol=1e-10).stages[-1]
    w = ml.fit_logistic_newton(df, ["x1", "x2"], "y")
    assert abs(w[0] - lr.intercept) < 1e-5 and np.max(np.abs(w[1:] - lr.coefficients.toArray())) < 1e-5


def test_probit_accuracy(spark):
    from statistics import NormalDist
    ps = [1e-6, 0.001, 0.02, 0.02425, 0.1, 0.3, 0.5, 0.7, 0.9, 0.97576, 0.99, 0.999999]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in ps], "p double").select(TS.probit("p")).collect()]
    for g, p in zip(got, ps):
        z = NormalDist().inv_cdf(p)
        assert abs(g - z) <= 2e-9 * max(1.0, abs(z))


def test_series_without_spread_or_of_unusual_length(spark):
    rows = ([(1, t, 3.0) for t in range(1, 41)] + [(2, 1, 2.0)]
            + [(3, t, float(math.sin(t * t))) for t in range(1, 5002)])
    s = spark.createDataFrame(rows, "series_id long, t int, value double")
    found = {r["series_id"]: r for r in TS.shapiro(s).collect()}
    assert set(found) == {1, 2, 3}
    assert all(r["statistic"] is None and r["p_value"] is None for r in found.values())
    short = s.where("series_id <> 3")
    assert {r["series_id"]: r["ndiffs"] for r in TS.ndiffs(short).collect()} == {1: 0, 2: 0}
    assert TS.strict_white_noise(s.where("series_id = 3")).first()["verdict"] in ("normality not tested", "WN", "not WN")
    flat = s.where("series_id = 1").select(C.normal_pdf("value", 3.0, 0.0).alias("d")).first()
    assert flat["d"] is None


def test_lags_follow_the_length_of_each_series(spark):
    rng = np.random.default_rng(8)
    sizes = {1: 2300, 2: 100, 3: 9}
    df = spark.createDataFrame([(i, t, float(v)) for i, n in sizes.items() for t, v in enumerate(rng.normal(size=n), 1)],
                               "series_id long, t long, value double")
    want = {1: 33, 2: 20, 3: 8}
    for out in (TS.acf(df), TS.pacf(df)):
        assert {r[0]: r[1] for r in out.groupBy("series_id").agg(F.max("lag")).collect()} == want
    assert {r["series_id"]: r["lags"] for r in TS.adf(df).collect()}[1] == 13


def test_diagnose_is_the_whole_battery(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(1, t, float(v)) for t, v in enumerate(rng.normal(size=60), 1)],
                               "series_id long, t long, value double")
    have = {(r["transform"], r["test"]): r["statistic"] for r in TS.diagnose(df).collect()}
    for name in ("y", "y2", "z"):
        assert {(name, f"{k}_{lag}") for k in ("acf", "pacf") for lag in range(1, 18)} | {(name, "ljung_box")} <= set(have)
    assert {("y", m) for m in ("mean", "sd", "skewness", "kurtosis", "shapiro", "ndiffs")} | {("z", "mean")} <= set(have)
    assert have["y", "mean"] == df.agg(F.avg("value")).first()[0]


def test_attrition_attempt2_drops_outliers_and_weak_features(spark, monkeypatch):
    from tessera.plans import hr as plan
    from tessera.sources import bindings as B
    from tests.conftest import SF_SMALL

    hr, seen = B.hr(spark, SF_SMALL), {}
    evaluate = plan._evaluate
    monkeypatch.setattr(plan, "_evaluate", lambda name, df, feats, folds: seen.update({name: (df, feats)}) or hr.limit(0))
    monkeypatch.setattr(FE, "below_threshold", lambda importance, threshold: [])
    plan.attrition_pipeline(hr, 2)
    base, out = plan.encoded(hr), FE.outlier_rows(plan.encoded(hr), list(plan.NUMERIC[:5]), plan.ID)
    assert out.count() > 0 and seen["attempt2"][0].count() == base.count() - out.distinct().count()
    every = seen["attempt2"][1]
    monkeypatch.setattr(FE, "below_threshold", lambda importance, threshold: every)
    plan.attrition_pipeline(hr, 2)
    assert seen["attempt2"][1] == []
    assert evaluate("none", seen["attempt2"][0], [], 2).first()["n_features"] == 0


def _plain_adf(y, p):
    """t value of the lagged level by least squares on the regression's own rows."""
    x = np.diff(y)
    rows = range(p + 1, len(y))  # 0-based targets
    a = np.array([[1.0, y[t - 1], *(x[t - 1 - j] for j in range(1, p + 1))] for t in rows])
    b = np.array([x[t - 1] for t in rows])
    beta, *_ = np.linalg.lstsq(a, b, rcond=None)
    rest = b - a @ beta
    return beta[1] / np.sqrt(rest @ rest / (len(b) - a.shape[1]) * np.linalg.inv(a.T @ a)[1, 1])


def test_adf_over_blocks_matches_plain_regression(spark):
    """Hot, short and far-from-zero series, whose lags reach over block ends; one block size after another."""
    rng = np.random.default_rng(8)
    ys = {1: np.cumsum(rng.normal(size=700)) + 1e4, 2: rng.normal(size=60), 3: np.cumsum(rng.normal(size=33)), 4: rng.normal(size=9),
          5: np.full(50, 3.0), 6: np.array([1.0, 2.0]), 7: np.array([5.0])}
    df = spark.createDataFrame([(k, t, float(v)) for k, y in ys.items() for t, v in enumerate(y, 1)],
                               "series_id long, t long, value double").repartition(5)
    for block in (16, 64, 4096):
        got = {r.series_id: r for r in TS.adf(df, block=block).collect()}
        assert set(got) == set(ys)
        for k in (1, 2, 3):
            p = int((len(ys[k]) - 1) ** (1 / 3) + 1e-9)
            assert got[k].lags == p and got[k].statistic == pytest.approx(_plain_adf(ys[k], p), rel=1e-8)
        assert all(got[k].statistic is None and got[k].stationary is None for k in (5, 6, 7))


def test_adf_of_a_long_series(spark):
    """One series of a million points: the same statistic, from a plan of a fixed size."""
    n = 1_000_000
    df = spark.range(1, n + 1).select(F.lit(1).cast("long").alias("series_id"), F.col("id").alias("t"),
                                      (F.sin(F.col("id") / 7) * 5 + F.pmod(F.xxhash64("id"), F.lit(1000)) / 100).alias("value"))
    y = df.orderBy("t").toPandas()["value"].to_numpy()
    got = TS.adf(df, max_p=30).first()
    x = np.diff(y)
    rows = np.lib.stride_tricks.sliding_window_view(x, 31)  # x[t-30..t]
    a = np.column_stack([np.ones(len(rows)), y[30:-1] - y.mean(), rows[:, :-1][:, ::-1]])
    b = rows[:, -1]
    gram = a.T @ a
    beta = np.linalg.solve(gram, a.T @ b)
    rest = b - a @ beta
    want = beta[1] / np.sqrt(rest @ rest / (len(b) - a.shape[1]) * np.linalg.inv(gram)[1, 1])
    assert got.statistic == pytest.approx(want, rel=1e-8)
    nodes = lambda d: len(TS.adf(d)._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert nodes(df.where("t <= 100")) == nodes(df.where("t <= 900000"))


# ------------------------------------------------------------ exact selection ---

def test_exact_quantiles_of_distinct_and_hot_groups(spark):
    from tessera.operators import selection
    n, probs = 60_000, [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    kind = F.col("id") % 3
    rows = spark.range(n).select(
        F.when(kind == 0, "distinct").when(kind == 1, "hot").alias("k"),  # and a group without a key
        F.when(kind == 0, F.exp(F.sin("id") * 40)).when(kind == 1, F.when(F.col("id") % 9 < 6, 5.0).otherwise(F.sin("id") * 10))
        .otherwise((F.col("id") % 7).cast("double")).alias("v"))
    rows = rows.union(spark.createDataFrame([("one", 3.0), ("two", 1.0), ("two", 2.0), ("none", None), ("inf", float("inf")),
                                             ("inf", float("inf")), ("nan", 1.0), ("nan", float("nan"))], "k string, v double"))
    values = {}
    for k, v in rows.where(F.col("v").isNotNull()).collect():
        values.setdefault(k, []).append(v)
    for finish in (selection.FINISH, 10):  # the second takes further rounds
        got = {(r.k, r.p): r.v for r in selection.exact_quantiles(rows, "v", probs, ["k"], finish=finish).collect()}
        assert set(got) == {(k, p) for k in values for p in probs}
        assert got["inf", 0.5] == float("inf") and got["nan", 0.0] == 1.0 and got["nan", 1.0] != got["nan", 1.0]
        for k in ("distinct", "hot", None, "one", "two"):
            assert np.allclose([got[k, p] for p in probs], np.quantile(values[k], probs), rtol=1e-12, atol=0), (k, finish)
    assert selection.exact_quantiles(rows.limit(0), "v", probs).count() == 0
    wide = selection.quantile_columns(rows.where("k = 'two'"), "v", {"q1": 0.25, "q3": 0.75}).collect()
    assert [tuple(r) for r in wide] == [(1.25, 1.75)]


def test_describe_of_an_empty_column(spark):
    from tessera.operators import profile
    rows = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    got = {(r["column"], r["stat"]): r["value"] for r in profile.describe(rows, ["a", "b"]).collect()}
    assert len(got) == 16 and got["a", "50%"] == 2.0 and got["b", "50%"] is None and got["b", "count"] == 0


# --------------------------------------------------------------- pretty breaks ---

def test_pretty_breaks_published_examples(spark):
    from tessera.operators import distributions as D
    cases = [(1.0, 10.0, 5, 2.0, 0.0, 10.0), (1.0, 10.0, 21, 0.5, 1.0, 10.0), (1.0, 20.0, 2, 10.0, 0.0, 20.0), (1.0, 20.0, 10, 2.0, 0.0, 20.0),
             (0.0, 1.0, 5, 0.2, 0.0, 1.0), (1.0, 100.0, 5, 20.0, 0.0, 100.0), (1.0, 234.0, 5, 50.0, 0.0, 250.0), (-1.0, 1.0, 5, 0.5, -1.0, 1.0)]
    stats = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, lo double, hi double, n int, u double, a double, b double")
    for r in D.with_pretty_breaks(stats, "lo", "hi", "n").collect():
        assert math.isclose(r["_unit"], r.u) and math.isclose(r["_first"] * r["_unit"], r.a, abs_tol=1e-12) \
            and math.isclose(r["_last"] * r["_unit"], r.b, abs_tol=1e-12), r


def test_density_histogram_covers_all_rows(spark):
    from tessera.operators import distributions as D
    rows = spark.createDataFrame([("c", 5.0)] * 9 + [("z", 0.0)] * 9 + [("t", float(i)) for i in range(1, 11)]
                                 + [("t", None), ("t", float("nan")), ("e", None)], "k string, v double")
    got = {}
    for r in D.histogram_density(rows, "v", by="k").collect():
        got.setdefault(r.k, []).append(r)
    assert set(got) == {"c", "z", "t"}
    for k, n in (("c", 9), ("z", 9), ("t", 10)):
        assert sum(r["count"] for r in got[k]) == n and math.isclose(sum(r.density * (r.hi - r.lo) for r in got[k]), 1.0)
    assert [(r.lo, r.hi, r["count"]) for r in sorted(got["t"], key=lambda r: r.bin)] == [(2.0 * i, 2.0 * i + 2, 2) for i in range(5)]
    assert all(r.lo <= 5.0 <= r.hi for r in got["c"]) and all(r.lo <= 0.0 <= r.hi for r in got["z"])
    assert D.histogram_density(rows.limit(0), "v", by="k").count() == 0
