"""Kernel densities against a plain sum over the kernel."""

import math
import random

import numpy as np

from tessera.operators import distributions as D


def test_density_is_the_kernel_sum_up_to_the_binning(spark):
    rng = random.Random(11)
    rows = [("a", rng.gauss(10, 2)) for _ in range(500)] + [("b", float(rng.randint(0, 3))) for _ in range(40)]
    rows += [("hot", 4.0)] * 300 + [(None, 1.0), (None, 5.0), ("a", None), ("a", float("nan")), ("empty", None)]
    got = D.kde(spark.createDataFrame(rows, "g string, v double"), "v", by="g", points=64).collect()
    assert {r["g"] for r in got} == {"a", "b", "hot", None}
    for g in ("a", "b", "hot", None):
        v = np.array([x for k, x in rows if k == g and x is not None and x == x])
        mine = sorted((r["i"], r["x"], r["density"]) for r in got if r["g"] == g)
        assert [m[0] for m in mine] == list(range(64))
        q1, q3 = np.quantile(v, [0.25, 0.75])
        sd = v.std(ddof=1)
        spread = min(sd, (q3 - q1) / 1.34)
        bw = 0.9 * (spread if spread > 0 else sd if sd > 0 else 1.0) * len(v) ** -0.2
        grid = np.linspace(v.min() - 3 * bw, v.max() + 3 * bw, 64)
        exact = np.exp(-0.5 * ((grid[:, None] - v) / bw) ** 2).sum(1) / (len(v) * bw * math.sqrt(2 * math.pi))
        assert np.allclose([m[1] for m in mine], grid)
        assert np.allclose([m[2] for m in mine], exact, atol=2e-3 * exact.max())


def test_density_without_groups_and_of_nothing(spark):
    df = spark.createDataFrame([(float(i % 17),) for i in range(200)], "v double")
    whole = D.kde(df, "v", points=50).orderBy("i").collect()
    step = whole[1]["x"] - whole[0]["x"]
    assert len(whole) == 50 and abs(sum(r["density"] for r in whole) * step - 1) < 0.01
    assert D.kde(df.limit(0), "v").count() == 0
    plan = D.kde(df, "v")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
