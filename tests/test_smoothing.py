"""Local regression against plain numpy."""

import random

import numpy as np
import pytest

from tessera.operators import smoothing as SM

SCHEMA = "g string, x double, y double"


def _plain(points, span, vertices):
    """Value and slope at the vertices from all single rows, by numpy's least squares."""
    x, y = np.array([p[0] for p in points]), np.array([p[1] for p in points])
    out = []
    for v in np.linspace(x.min(), x.max(), vertices):
        d = np.abs(x - v)
        h = np.sort(d)[max(1, int(len(x) * span + 1e-5)) - 1]
        w = np.where(d < h, (1 - (d / h if h else d) ** 3) ** 3, 0.0)
        k = len(set(x[w > 0]))
        if k == 0:
            out.append((y[d <= h].mean(), 0.0))
            continue
        terms = np.vander(x - v, min(k, 3), increasing=True) * np.sqrt(w)[:, None]
        beta = np.linalg.lstsq(terms, y * np.sqrt(w), rcond=None)[0]
        out.append((beta[0], beta[1] if k > 1 else 0.0))
    return np.array(out)


def _rows():
    rng = random.Random(5)
    wide = [("wide", x, float(np.sin(x / 3) + rng.gauss(0, 0.2))) for x in (rng.uniform(0, 20) for _ in range(400))]
    ties = [("ties", float(rng.randint(80, 100)), rng.gauss(3, 1)) for _ in range(500)]
    hot = [("hot", 5.0, rng.gauss(0, 1)) for _ in range(300)] + [("hot", float(i), float(i)) for i in range(10)]
    far = [("far", 10.0 ** i, float(i)) for i in range(-8, 9)]
    return wide + ties + hot + far + [(None, 1.0, 2.0), (None, 2.0, 5.0)]


@pytest.mark.parametrize("span", [0.3, 0.75, 1.0])
def test_curve_equals_plain_least_squares(spark, span):
    rows = _rows()
    got = SM.local_regression(spark.createDataFrame(rows, SCHEMA), "x", "y", ["g"], span, 9).collect()
    for g in ("wide", "ties", "hot", None):
        mine = sorted((r["i"], r["fitted"], r["slope"]) for r in got if r["g"] == g)
        assert len(mine) == 9
        want = _plain([(x, y) for k, x, y in rows if k == g], span, 9)
        assert np.allclose([m[1:] for m in mine], want, atol=1e-6)
    assert sum(r["g"] == "far" for r in got) == 9


def test_radius_is_the_exact_order_statistic_over_many_rounds(spark):
    rows = [r for r in _rows() if r[0] in ("far", "wide")]
    points = SM._per_x(spark.createDataFrame(rows, SCHEMA), "x", "y", ["g"]).cache()
    for r in SM._radii(points, ["g"], 0.5, 5).collect():
        d = sorted(abs(x - r["_v"]) for g, x, _ in rows if g == r["g"])
        assert r["_h"] == d[int(len(d) * 0.5 + 1e-5) - 1]


def test_cubics_meet_the_curve_and_odd_rows_have_a_result(spark):
    rows = [("a", float(x), float(x * x)) for x in range(30)] + [("one", 3.0, 7.0), ("a", None, 1.0), ("none", 1.0, None),
                                                               ("a", float("nan"), 2.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    curve = SM.local_regression(df, "x", "y", ["g"])
    got = SM.smoothed(df, curve, "x", ["g"]).collect()
    for r in got:
        if r["g"] == "a" and r["x"] is not None and r["x"] == r["x"]:
            assert abs(r["smooth"] - r["x"] ** 2) < 1e-6  # a parabola is its own local fit
        elif r["g"] == "one":
            assert r["smooth"] == 7.0
        else:
            assert r["smooth"] is None
    assert SM.local_regression(df.limit(0), "x", "y", ["g"]).count() == 0
    whole = SM.smoothed(df.where("g = 'a' AND x < 30"), SM.local_regression(df.where("g = 'a'"), "x", "y"), "x").collect()
    assert len(whole) == 30 and all(abs(r["smooth"] - r["x"] ** 2) < 1e-6 for r in whole)
