"""Registered time-series diagnostics over the many-series fixture."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tessera.catalog.fixture_sql import r_up
from tessera.catalog.registry import register
from tessera.operators import timeseries as TS
from tessera.session import stored
from tessera.sources import bindings as B

LAGS = 20


@register("ts_moments", f"""
WITH s AS (SELECT series_id, count(value) AS n, avg(value) AS m, stddev_samp(value) AS sd FROM series GROUP BY 1),
c AS (SELECT x.series_id, n, m, sd, sum(pow(value - m, 3)) / n AS m3, sum(pow(value - m, 4)) / n AS m4
  FROM series x JOIN s ON x.series_id = s.series_id GROUP BY x.series_id, n, m, sd)
SELECT series_id, n, {r_up('m', 9)} AS mean, {r_up('sd', 9)} AS sd, {r_up('m3 / pow(sd, 3)', 8)} AS skewness,
  {r_up('m4 / pow(sd, 4)', 8)} AS kurtosis FROM c""")
def ts_moments(spark, sf):
    m = TS.moments(B.series(spark, sf))
    return m.select("series_id", "n", F.round("mean", 9).alias("mean"), F.round("sd", 9).alias("sd"),
                    F.round("skewness", 8).alias("skewness"), F.round("kurtosis", 8).alias("kurtosis"))


def _acf_cte(lags: str, series: str = "series") -> str:
    """Autocorrelations of every series for the lags 1 to ``lags``, an SQL expression of its length n."""
    return f"""s AS (SELECT series_id, avg(value) AS m, count(value) AS n FROM {series} GROUP BY 1),
k AS (SELECT series_id, unnest(range(1, CAST({lags} AS BIGINT) + 1)) AS k FROM s),
d AS (SELECT x.series_id, t, value - m AS d FROM {series} x JOIN s ON x.series_id = s.series_id),
den AS (SELECT d.series_id, sum(d * d) AS s0 FROM d GROUP BY 1),
num AS (SELECT a.series_id, k, sum(a.d * b.d) AS sk FROM d a JOIN k ON k.series_id = a.series_id
  JOIN d b ON a.series_id = b.series_id AND b.t = a.t - k GROUP BY 1, 2),
r AS (SELECT num.series_id, s.n, k, sk / s0 AS acf FROM num JOIN den ON num.series_id = den.series_id
  JOIN s ON num.series_id = s.series_id WHERE k < s.n)"""


@register("ts_acf", f"WITH {_acf_cte('floor(round(10 * log10(n), 9))')} "
          f"SELECT series_id, n, CAST(k AS INTEGER) AS lag, {r_up('acf', 9)} AS acf FROM r")
def ts_acf(spark, sf):
    """Autocorrelations of every series up to its own number of lags, floor(10 log10 n)."""
    return TS.acf(B.series(spark, sf)).withColumn("acf", F.round("acf", 9))


@register("ts_ljung_box", f"""
WITH {_acf_cte(LAGS)},
q AS (SELECT series_id, n, n * (n + 2) * sum(acf * acf / (n - k)) AS qs FROM r GROUP BY 1, 2)
SELECT series_id, n, {r_up('qs', 8)} AS statistic, {LAGS} AS df,
  {r_up(f'least(1.0, exp(-qs / 2) * list_sum(list_transform(range({LAGS // 2}), lambda i: pow(qs / 2, i) / factorial(CAST(i AS INTEGER)))))', 8)}
  AS p_value FROM q""")
def ts_ljung_box(spark, sf):
    lb = TS.ljung_box(B.series(spark, sf), LAGS)
    return lb.select("series_id", "n", F.round("statistic", 8).alias("statistic"), "df",
                     F.round("p_value", 8).alias("p_value"))


@register("ts_pacf", f"""
WITH {_acf_cte('floor(round(10 * log10(n), 9))')},
a AS (SELECT series_id, list(acf ORDER BY k) AS r FROM r GROUP BY 1 HAVING count_if(acf IS NULL OR isnan(acf)) = 0)
SELECT series_id, CAST(k AS INTEGER) AS lag, {r_up('phi[k]', 8)} AS pacf FROM (
  WITH RECURSIVE dl AS (
    SELECT series_id, 1 AS k, [r[1]] AS phi, 1 - r[1] * r[1] AS v FROM a
    UNION ALL
    SELECT series_id, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - p * phi[k + 1 - j]), p), v * (1 - p * p)
    FROM (SELECT dl.series_id, k, phi, v, (r[k + 1] - list_inner_product(phi, list_reverse(r[1:k]))) / v AS p
          FROM dl JOIN a ON dl.series_id = a.series_id WHERE k < len(r)))
  SELECT * FROM dl)""")
def ts_pacf(spark, sf):
    """Partial autocorrelations of every series by Durbin-Levinson, lags as ``ts_acf``."""
    return TS.pacf(B.series(spark, sf)).withColumn("pacf", F.round("pacf", 8))


@register("ts_ndiffs_adf")
def ts_ndiffs_adf(spark, sf):
    """Differences needed by the ADF test for the stationary and the random-walk series."""
    noise = stored(B.series(spark, sf))  # positions are numbered once: each test and the walk read them
    a = TS.ndiffs(noise).withColumn("kind", F.lit("noise"))
    b = TS.ndiffs(stored(B.walk_of(noise))).withColumn("kind", F.lit("walk"))
    return a.unionByName(b)


def _poly_sql(coefs, x: str) -> str:
    return "(" + " + ".join(f"({c!r}) * pow({x}, {i})" for i, c in enumerate(coefs)) + ")"


def _normal_sf_sql(z: str) -> str:
    """Upper normal tail: a half less the density times the series of ``z^(2k+1) / (2k+1)!!`` (exact to rounding for |z| <= 8)."""
    term = (f"exp(-0.5 * pow({z}, 2) - 0.5 * ln(2 * pi()) + (2 * j + 1) * ln(abs({z})) - (j + 1) * ln(2.0) "
            f"- lgamma(j + 1.5) + 0.5 * ln(pi()))")
    return (f"CASE WHEN {z} = 0 THEN 0.5 WHEN {z} > 8 THEN 0.0 WHEN {z} < -8 THEN 1.0 "
            f"ELSE 0.5 - sign({z}) * list_sum(list_transform(range(200), lambda j: {term})) END")


def _shapiro_sql() -> str:
    """CTE body: W and p of every series; sizes outside 3 .. 5000 and constant series have nulls."""
    probit = re.sub(r"(\d)D\b", r"\1", TS.probit_sql("(i - 0.375) / (n + 0.25)"))
    rsn = "(1 / sqrt(n))"
    a1 = f"({_poly_sql(TS._SW_C1, rsn)} + mn / sqrt(ss))"
    a2 = f"({_poly_sql(TS._SW_C2, rsn)} + mn1 / sqrt(ss))"
    ln = "ln(n)"
    small = (f"(-ln({_poly_sql(TS._SW_G, 'n')} - ln(1 - w)) - {_poly_sql(TS._SW_C3, 'n')}) / exp({_poly_sql(TS._SW_C4, 'n')})")
    large = f"(ln(1 - w) - {_poly_sql(TS._SW_C5, ln)}) / exp({_poly_sql(TS._SW_C6, ln)})"
    return f"""sw_s AS (SELECT series_id, count(value) AS n, avg(value) AS m FROM series GROUP BY 1),
sw_z AS (SELECT *, {probit} AS z FROM (SELECT n, unnest(range(1, n + 1)) AS i FROM (SELECT DISTINCT n FROM sw_s WHERE n BETWEEN 3 AND 5000))),
sw_n AS (SELECT n, sum(z * z) AS ss, max(CASE WHEN i = n THEN z END) AS mn, max(CASE WHEN i = n - 1 THEN z END) AS mn1 FROM sw_z GROUP BY 1),
sw_c AS (SELECT n, CASE WHEN n = 3 THEN sqrt(0.5) ELSE {a1} END AS a1, CASE WHEN n > 5 THEN {a2} END AS a2,
  CASE WHEN n > 5 THEN sqrt((ss - 2 * mn * mn - 2 * mn1 * mn1) / (1 - 2 * pow({a1}, 2) - 2 * pow({a2}, 2)))
    ELSE sqrt(CASE WHEN n > 3 THEN (ss - 2 * mn * mn) / (1 - 2 * pow({a1}, 2)) END) END AS fac FROM sw_n),
sw_a AS (SELECT sw_z.n, i, CASE WHEN i = sw_z.n THEN a1 WHEN i = 1 THEN -a1 WHEN i = sw_z.n - 1 AND sw_z.n > 5 THEN a2
  WHEN i = 2 AND sw_z.n > 5 THEN -a2 WHEN sw_z.n = 3 THEN 0 ELSE z / fac END AS a FROM sw_z JOIN sw_c ON sw_z.n = sw_c.n),
sw_r AS (SELECT series_id, value, row_number() OVER (PARTITION BY series_id ORDER BY value, t) AS i FROM series WHERE value IS NOT NULL),
sw_w AS (SELECT r.series_id, s.n, least(1.0, pow(sum(a * value), 2) / nullif(sum(pow(value - m, 2)), 0)) AS w0,
  count_if(a IS NULL) AS out FROM sw_r r JOIN sw_s s ON r.series_id = s.series_id LEFT JOIN sw_a c ON c.n = s.n AND c.i = r.i GROUP BY 1, 2),
sw_x AS (SELECT sw_s.series_id, sw_s.n, CASE WHEN out = 0 AND sw_s.n >= 3 THEN w0 END AS w FROM sw_s LEFT JOIN sw_w ON sw_s.series_id = sw_w.series_id),
sw_t AS (SELECT *, CASE WHEN w >= 1 OR n <= 3 THEN NULL WHEN n <= 11 THEN CASE WHEN {_poly_sql(TS._SW_G, 'n')} - ln(1 - w) > 0 THEN {small} ELSE 9.0 END
  ELSE {large} END AS z FROM sw_x),
sw AS (SELECT series_id, n, w, CASE WHEN w IS NULL THEN NULL
  WHEN n = 3 THEN greatest(0.0, least(1.0, 6 / pi() * (asin(sqrt(w)) - asin(sqrt(0.75))))) WHEN w >= 1 THEN 1.0
  ELSE {_normal_sf_sql('z')} END AS p FROM sw_t)"""


@register("ts_shapiro", f"""
WITH {_shapiro_sql()}
SELECT series_id, n, {r_up('w', 8)} AS statistic, {r_up('p', 8)} AS p_value FROM sw""")
def ts_shapiro(spark, sf):
    sw = TS.shapiro(B.series(spark, sf))
    return sw.withColumns({c: F.round(c, 8) for c in ("statistic", "p_value")})


@register("ts_diagnose")
def ts_diagnose(spark, sf):
    return TS.diagnose(B.series(spark, sf), LAGS)


_LB_P = (f"least(1.0, exp(-qs / 2) * list_sum(list_transform(range({LAGS // 2}), "
         f"lambda i: pow(qs / 2, i) / factorial(CAST(i AS INTEGER)))))")


def _lb_sql(series: str) -> str:
    return f"""(WITH {_acf_cte(LAGS, series)},
q AS (SELECT series_id, n, n * (n + 2) * sum(acf * acf / (n - k)) AS qs FROM r GROUP BY 1, 2)
SELECT series_id, {_LB_P} AS p FROM q)"""


@register("ts_strict_white_noise", f"""
WITH {_shapiro_sql()},
lb AS {_lb_sql('series')},
lb2 AS {_lb_sql('(SELECT series_id, t, value * value AS value FROM series)')},
j AS (SELECT lb.series_id, lb.p AS p1, lb2.p AS p2, sw.p AS p3 FROM lb LEFT JOIN lb2 ON lb.series_id = lb2.series_id
  LEFT JOIN sw ON lb.series_id = sw.series_id)
SELECT series_id, {r_up('p1', 8)} AS p_lb, {r_up('p2', 8)} AS p_lb2, {r_up('p3', 8)} AS p_sw,
  CASE WHEN p1 > 0.05 AND p2 > 0.05 AND p3 IS NULL THEN 'normality not tested' WHEN p1 > 0.05 AND p2 > 0.05 AND p3 > 0.05 THEN 'GWN'
    WHEN p1 > 0.05 AND p2 > 0.05 THEN 'SWN' WHEN p1 > 0.05 THEN 'WN' ELSE 'not WN' END AS verdict FROM j""")
def ts_strict_white_noise(spark, sf):
    verdicts = TS.strict_white_noise(B.series(spark, sf), LAGS)
    return verdicts.withColumns({c: F.round(c, 8) for c in ("p_lb", "p_lb2", "p_sw")})
