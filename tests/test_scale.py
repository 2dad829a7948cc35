"""Work that must not grow faster than the tables: passes over the input and shuffles of the large side."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import ml, ratios
from tessera.operators import timeseries as TS
from tessera.plans import flights as FL
from tessera.sources import bindings as B
from tests.conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_flights_join_growing_tables_by_key_at_any_size(spark):
    plan = B.delays(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    assert plan.count("SortMergeJoin") == 3
    assert plan.count("Exchange hashpartitioning(l_") == 2  # lineitem is dealt by part and by order, never again


def test_share_counts_the_table_once(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 3 != 0, F.col("id")).alias("x"))
    out = ratios.share_by(df, "k", where=F.col("x").isNotNull(), count_col="x")
    assert "Range" not in plan_of(out)
    want = {k: sum(1 for i in range(1000) if i % 7 == k and i % 3) for k in range(7)}
    assert {r.k: (r.n, r.ratio) for r in out.collect()} == {k: (n, round(n / 10 + 1e-9, 1)) for k, n in want.items()}


def test_distance_summary_reads_the_flights_once(spark):
    flights = spark.range(500).select((F.col("id") % 90 * 50).cast("int").alias("Distance"),
                                      F.when(F.col("id") % 5 != 0, (F.col("id") % 40).cast("int")).alias("ArrDelay"))
    out = FL.distance_summary(flights, digits=6)
    assert "Range" not in plan_of(out)
    rows = [(i % 90 * 50, i % 40 if i % 5 else None) for i in range(500)]
    got = {(r.subset, r.stat): r.value for r in out.collect()}
    for subset, values in (("all", [d for d, _ in rows]), ("delayed", [d for d, a in rows if a is not None and a >= 15])):
        assert got[subset, "count"] == len(values)
        for stat, p in (("25%", 25), ("50%", 50), ("75%", 75)):
            assert got[subset, stat] == round(float(np.percentile(values, p)), 6)


def test_ndiffs_reads_the_series_a_fixed_number_of_times(spark):
    """All orders of difference come from one reading, with the results of the tests one by one; a null has no result."""
    rng = np.random.default_rng(4)
    ys = {1: rng.normal(size=90), 2: np.cumsum(rng.normal(size=200)), 3: np.cumsum(np.cumsum(rng.normal(size=150))),
          4: np.arange(40.0), 5: np.full(30, 2.5), 6: rng.normal(size=4), 7: np.arange(60.0) ** 2, 8: rng.normal(size=50)}
    rows = [(k, t, None if (k, t) == (8, 20) else float(v)) for k, y in ys.items() for t, v in enumerate(y, 1)]
    df = spark.createDataFrame(rows, "series_id long, t long, value double").repartition(3)
    got = {r.series_id: r.ndiffs for r in TS.ndiffs(df).collect()}
    want, orders, current = {}, [], df
    for _ in range(3):
        same = {r.series_id for r in current.groupBy("series_id").agg(F.min("value").alias("a"), F.max("value").alias("b")).where("a = b").collect()}
        orders.append({r.series_id: r.series_id in same or r.stationary for r in TS.adf(current).collect()})
        current = TS.difference(current)
    for k in ys:
        tests = [o.get(k) for o in orders]
        want[k] = next((d if t else None for d, t in enumerate(tests) if t or t is None), 2)
    assert got == want and want[2] == 1 and want[5] == 0 and want[8] is None
    many = spark.range(1, 100).select(F.lit(1).cast("long").alias("series_id"), F.col("id").alias("t"), F.rand(1).alias("value"))
    assert plan_of(TS.ndiffs(many)).count("Range") <= 3


def test_battery_computes_its_input_once(spark):
    many = spark.range(1, 80).select(F.lit(1).cast("long").alias("series_id"), F.col("id").alias("t"),
                                     (F.col("id") * 7 % 31).cast("double").alias("value"))
    out = TS.diagnose(many)
    assert "Range" not in plan_of(out)
    assert plan_of(out).count("lag(") == 0  # lag sums are written, not taken again by each test


def test_fold_models_share_one_hessian_pass(spark, monkeypatch):
    """The optimum of every fold model, without a Hessian per row and model."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 3))
    y = (rng.random(3000) < 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.5] - 0.3)))).astype(float)
    fold = np.arange(3000) % 5
    df = spark.createDataFrame([(*map(float, r), float(t), int(k)) for r, t, k in zip(x, y, fold)],
                               "a double, b double, c double, y double, _fold int")
    kinds, one_pass = [], ml._pass

    def counted(*args):
        kinds.append((args[4].shape[0], args[5]))
        return one_pass(*args)

    monkeypatch.setattr(ml, "_pass", counted)
    got = ml.fit_logistic_folds(df, ["a", "b", "c"], "y", "_fold", 5)
    assert [k for n, k in kinds if n == 5].count("shared") == 1 and (5, "own") not in kinds and (5, None) in kinds
    for k in range(5):
        rows = np.column_stack([np.ones(3000), x])[fold != k]
        p = 1 / (1 + np.exp(-(rows @ got[k])))
        gradient = rows.T @ (p - y[fold != k]) + np.array([0, *got[k][1:]])
        assert np.abs(gradient).max() < 1e-5


def test_fold_models_from_a_bad_start_reach_the_optimum(spark):
    rows = [(float(i % 7) - 3, float((i * 5) % 11 > 4 + i % 3), i % 3) for i in range(90)]
    df = spark.createDataFrame(rows, "a double, y double, _fold int")
    far = ml.fit_logistic_folds(df, ["a"], "y", "_fold", 3, init=np.array([0.8, 0.6]))
    assert np.allclose(far, ml.fit_logistic_folds(df, ["a"], "y", "_fold", 3), atol=1e-7)


def _rows_of(blocks, features, folds):
    """(fold, label, features..) of each row of packed blocks."""
    out = []
    for x, y, weights, own in ml._opened(blocks.toArrow().to_batches(), features + 1, folds):
        for k, (a, b) in enumerate(own):
            out += [(k, float(y[i]), *x[1:, i].tolist()) for i in range(a, b) for _ in range(int(weights[i]))]
    return sorted(out, key=str)


@pytest.mark.parametrize("cell, block", [(100_000, 32_768), (170, 64)])
def test_rows_in_blocks_have_the_folds_of_rows(spark, monkeypatch, cell, block):
    """Both forms of the folds agree: null ids and labels, fractions, flags and one value in all rows."""
    monkeypatch.setattr(ml, "CELL", cell)
    monkeypatch.setattr(ml, "BLOCK", block)
    monkeypatch.setattr(ml, "CHUNK", 4 * cell)
    i = F.col("i")
    df = spark.range(2003).toDF("i").select(
        F.when(i != 77, i).alias("key"), F.when(i % 9 == 0, 1).when(i % 50 != 7, 0).alias("y"),
        F.sin(i).alias("a"), (i % 2).cast("int").alias("b"), F.when(i % 400 != 3, i * 1000).alias("c"))
    for feats in (["a", "b", "c"], ["b"], []):
        rows = ml.stratified_folds(df, "y", "key", 7).select("fold", F.col("y").cast("double"), *[F.col(c).cast("double") for c in feats])
        nan = lambda v: float("nan") if v is None else v
        want = sorted([(r[0], *map(nan, r[1:])) for r in rows.collect()], key=str)
        blocks = ml.stratified_folds(df.repartition(5), "y", "key", 7, features=feats)
        assert _rows_of(blocks, len(feats), 7) == want or str(_rows_of(blocks, len(feats), 7)) == str(want)
        if feats == ["b"] and cell > 2003:  # equal rows of a fold are kept once
            assert blocks.agg(F.sum(F.length("_body"))).first()[0] < 2003
    assert ml.stratified_folds(df.limit(0), "y", "key", 7, features=["a"]).count() == 0


def test_fit_on_blocks_is_the_fit_on_rows(spark):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=4000), rng.integers(0, 2, 4000), rng.integers(0, 3, 4000)])
    y = (rng.random(4000) < 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.5] - 0.3)))).astype(float)
    df = spark.createDataFrame([(k, *map(float, r), float(t)) for k, (r, t) in enumerate(zip(x, y))], "id long, a double, b double, c double, y double")
    for feats in (["a", "b", "c"], ["b", "c"]):
        rows = ml.stratified_folds(df, "y", "id", 5, "_fold")
        blocks = ml.stratified_folds(df, "y", "id", 5, features=feats)
        whole = ml.fit_logistic_newton(df, feats, "y")
        assert np.allclose(ml.fit_logistic_newton(df, feats, "y", blocks=blocks, folds=5), whole, atol=1e-9)
        want = ml.fit_logistic_folds(rows, feats, "y", "_fold", 5)
        assert np.allclose(ml.fit_logistic_folds(blocks, feats, "y", "_fold", 5, init=whole), want, atol=1e-8)
        names = {f"w{k}": c for k, c in enumerate(feats)}
        got = {(r["fold"], r["y"], r["prediction"]): r["n"] for r in ml._predicted(blocks, want, "y").groupBy("fold", "y", "prediction").agg(F.count("*").alias("n")).collect()}
        by_hand = {}
        for r in rows.collect():
            margin = want[r["_fold"]][0] + sum(want[r["_fold"]][k + 1] * r[names[f"w{k}"]] for k in range(len(feats)))
            key = (r["_fold"], int(r["y"]), int(margin > 0))
            by_hand[key] = by_hand.get(key, 0) + 1
        assert got == by_hand


def test_a_missing_feature_ends_the_fit(spark):
    df = spark.createDataFrame([(k, float(k % 3) if k != 5 else None, k % 2) for k in range(60)], "id long, a double, y int")
    blocks = ml.stratified_folds(df, "y", "id", 3, features=["a"])
    for fit in (lambda: ml.fit_logistic_newton(df, ["a"], "y"), lambda: ml.fit_logistic_newton(df, ["a"], "y", blocks=blocks, folds=3),
                lambda: ml.cross_validate(df, ["a"], "y", "id", 3)):
        with pytest.raises(ValueError, match="null"):
            fit()


def test_fits_end_without_a_pass_that_only_confirms(spark, monkeypatch):
    df = spark.range(3000).select(F.sin("id").alias("a"), (F.sin("id") + F.cos(F.col("id") * 7) > 0.3).cast("int").alias("y"))
    steps, solve = [], np.linalg.solve
    monkeypatch.setattr(np.linalg, "solve", lambda h, g: steps.append(np.abs(solve(h, g)).max()) or solve(h, g))
    w = ml.fit_logistic_newton(df, ["a"], "y")
    assert steps[-1] * steps[-1] / steps[-2] < 1e-9 <= steps[-2] ** 2 / steps[-3]
    monkeypatch.undo()
    x, y = np.array(df.collect(), dtype=float).T
    p = 1 / (1 + np.exp(-(w[0] + w[1] * x)))
    assert abs((p - y).sum()) < 1e-5 and abs(((p - y) * x).sum() + w[1]) < 1e-5


def test_statistics_of_many_columns_stay_small_plans(spark):
    """Spark compiles neither aggregates above 100 fields nor long methods, so columns are taken a few at a time."""
    from tessera.operators import features as FE
    n = 40
    df = spark.range(50).select("id", *[((F.col("id") * (k + 3)) % (k + 2)).cast("int").alias(f"c{k}") for k in range(n)])
    cols = [f"c{k}" for k in range(n)]
    plan = FE.skewness_table(df, cols)._jdf.queryExecution().optimizedPlan().toString()
    assert max(line.count("skewness(") for line in plan.splitlines() if "Aggregate [" in line) <= FE.AT_ONCE
    scaled = FE.minmax(FE.fix_skewness(df, cols[1:]), cols)
    plan = scaled._jdf.queryExecution().optimizedPlan().toString()
    assert max(line.count("LOG1P(") for line in plan.splitlines()) <= FE.SCALED_AT_ONCE
    rows, got = df.toPandas(), scaled.toPandas().sort_values("id")
    assert list(got.columns) == ["id", *cols]
    for c in cols:
        x = rows[c].to_numpy(dtype=float) if c == "c0" else np.log1p(rows[c].to_numpy(dtype=float) - rows[c].min())
        assert np.allclose(got[c], (x - x.min()) / (x.max() - x.min()) if x.max() > x.min() else 0.0, atol=1e-15)


def test_relieff_gives_out_neighbours_once_a_task(spark, monkeypatch):
    """Weights as by hand over flags and fractions; what leaves a task does not grow with its rows."""
    from tessera.operators import features as FE
    rng = np.random.default_rng(6)
    n, anchors, k = 900, 30, 4
    x = np.column_stack([rng.integers(0, 2, n), rng.integers(0, 2, n), rng.normal(size=n), np.full(n, 3.0), rng.integers(0, 5, n)])
    y = ((x[:, 0] + rng.random(n)) > 1).astype(int)
    feats = ["f", "g", "a", "one", "m"]
    df = spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "id long, f double, g double, a double, one double, m double, y int").coalesce(1)
    sizes, top = [], FE.top_k_per_group
    monkeypatch.setattr(FE, "top_k_per_group", lambda cand, *a, **b: sizes.append(cand.count()) or top(cand, *a, **b))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = {r[0]: r[1] for r in FE.relieff(df, feats, "y", "id", anchors=anchors, k=k).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    width = np.ptp(x, axis=0)
    s = np.where(width > 0, (x - x.min(axis=0)) / np.where(width > 0, width, 1), 0.0)
    parts = []
    for j in range(anchors):
        diff = np.abs(s - s[j])
        order = np.lexsort((np.arange(n), np.round(diff.sum(axis=1), 9)))
        near = [[i for i in order if i != j and (y[i] == y[j]) == hit][:k] for hit in (True, False)]
        parts.append(diff[near[1]].mean(axis=0) - diff[near[0]].mean(axis=0))
    assert np.allclose([got[f] for f in feats], np.mean(parts, axis=0), atol=1e-12)
    assert sizes == [anchors * 2 * k]


def test_quantiles_of_columns_are_those_of_rows(spark):
    from tessera.operators import selection
    i = F.col("id")
    df = spark.range(60_000).select(F.exp(F.sin(i) * 20).alias("a"), F.when(i % 9 < 6, 5.0).otherwise(F.sin(i) * 10).alias("b"), (i % 7).alias("c"),
                                    F.when(i == 7, 1.5).alias("one"), F.lit(None).cast("double").alias("none"),
                                    F.when(i % 3 == 0, float("nan")).when(i % 3 == 1, i).cast("double").alias("nan"))
    cols, probs = df.columns, [0.0, 0.25, 0.5, 0.75, 1.0]
    table = df.toPandas()
    for finish in (selection.FINISH, 10):
        got = {(r["column"], r["p"]): r["value"] for r in selection.column_quantiles(df, cols, probs, finish=finish).collect()}
        for c in ("a", "b", "c", "one"):
            assert np.allclose([got[c, p] for p in probs], np.quantile(table[c].dropna(), probs), rtol=1e-12, atol=0), c
        assert not [k for k in got if k[0] == "none"] and got["nan", 0.0] == 1.0 and np.isnan(got["nan", 0.75])
        assert got["nan", 0.25] == 1 + 3 * 9999.75  # 20,000 numbers below 20,000 NaN: rank 9,999.75
