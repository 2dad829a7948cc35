"""Time-series diagnostics for many series at once.

Series are in long form ``(series_id, t, value)`` with ``t = 1..n`` the
position in the series. Every diagnostic is computed for all series in one
job, and none of them needs a whole series in one task: a series may hold a
third of all rows.

* Positions come with the data, so slices are filters and differences are
  equi-joins on ``(series_id, t)`` (a key that spreads evenly however long
  one series is).
* Lagged products, the core of autocorrelation, Ljung-Box and the
  Dickey-Fuller regression, are computed in blocks of ``block`` consecutive
  positions plus a halo of the ``max_lag`` positions before the block: the
  window that forms ``lag(value, k)`` is partitioned by ``(series_id, block)``
  and so holds at most ``block + max_lag`` rows. The per-block sums are then
  added up per series by an ordinary aggregate with map-side combine.
* What remains per series is a handful of numbers (sums, a K-vector of
  autocorrelations, a small cross-product matrix): only there does Python run
  (``applyInPandas`` over one row per series) for Durbin-Levinson, small
  least-squares solves and normal tail probabilities.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from tessera.session import cut_lineage, ship_package, stored

KEY, T, V = "series_id", "t", "value"
DEFAULT_BLOCK = 4096


# ------------------------------------------------------------ positions ----

def slice_first(series: DataFrame, n: int) -> DataFrame:
    """First ``n`` observations of every series: a filter on the position."""
    return series.where(F.col(T) <= n)


def difference(series: DataFrame) -> DataFrame:
    """First difference ``diff(y)``: ``z_t = y_{t+1} - y_t`` for ``t = 1..n-1``.

    An equi-join of the series with itself shifted by one position; the join
    key ``(series_id, t)`` is unique, so no key is hot.
    """
    nxt = series.select(F.col(KEY).alias("_k"), (F.col(T) - 1).alias("_t"), F.col(V).alias("_next"))
    return (series.join(nxt, (F.col(KEY) == F.col("_k")) & (F.col(T) == F.col("_t")))
            .select(KEY, T, (F.col("_next") - F.col(V)).alias(V)))


def squared(series: DataFrame) -> DataFrame:
    """``y^2``."""
    return series.select(KEY, T, (F.col(V) * F.col(V)).alias(V))


# ------------------------------------------------------------- moments -----

def series_stats(series: DataFrame) -> DataFrame:
    """``(series_id, n, mean)``: partial aggregation, so a hot series is no problem."""
    return series.groupBy(KEY).agg(F.count(V).alias("n"), F.avg(V).alias("mean"))


def moments(series: DataFrame) -> DataFrame:
    """n, mean, sample sd, skewness and kurtosis as R's fBasics defines them (T24).

    fBasics divides the third and fourth central moments by powers of the
    *sample* sd; Spark's ``skewness``/``kurtosis`` use the population sd and
    excess kurtosis, hence the factors.
    """
    n = F.count(V)
    g = series.groupBy(KEY).agg(n.alias("n"), F.avg(V).alias("mean"), F.stddev_samp(V).alias("sd"),
                                F.skewness(V).alias("_sk"), F.kurtosis(V).alias("_ku"))
    f = (F.col("n") - 1) / F.col("n")
    return g.select(KEY, "n", "mean", "sd",
                    (F.col("_sk") * F.pow(f, 1.5)).alias("skewness"),
                    ((F.col("_ku") + 3) * F.pow(f, 2)).alias("kurtosis"))


# -------------------------------------------------------- lag products -----

def _centered(series: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """``value - mean`` of its series. The per-series means are one row per series;
    they are joined on the series key, and AQE splits a hot series' partition
    on the large side (skew join) when the means are not broadcast."""
    stats = stats if stats is not None else series_stats(series)
    return (series.join(stats.select(KEY, "mean"), KEY)
            .select(KEY, T, (F.col(V) - F.col("mean")).alias(V)))


def lagged(series: DataFrame, max_lag: int, block: int = DEFAULT_BLOCK,
           cols: Sequence[str] = (V,)) -> DataFrame:
    """Rows with ``lag_<c>_<k>`` = value of ``c`` ``k`` positions earlier, ``k = 1..max_lag``.

    Windows run over ``(series_id, block)`` partitions of at most
    ``block + max_lag`` rows; halo rows (copies of the last ``max_lag``
    positions of the previous block) only feed the lags and are dropped.
    Rows are dealt by series and block, whatever join they come from, so the
    blocks of a hot series spread over tasks.
    """
    if max_lag >= block:
        raise ValueError("block must exceed max_lag")
    blk = F.floor((F.col(T) - 1) / block)
    in_tail = (F.col(T) - 1) % block >= block - max_lag
    tagged = series.select("*", F.explode(F.array(
        F.struct(blk.alias("_blk"), F.lit(False).alias("_halo")),
        F.when(in_tail, F.struct((blk + 1).alias("_blk"), F.lit(True).alias("_halo"))))).alias("_b")) \
        .where(F.col("_b").isNotNull()).select("*", "_b._blk", "_b._halo").drop("_b").repartition(KEY, "_blk")
    win = f"OVER (PARTITION BY `{KEY}`, _blk ORDER BY `{T}`)"
    lags = [f"lag(`{c}`, {k}) {win} AS `lag_{c}_{k}`" for c in cols for k in range(1, max_lag + 1)]
    return tagged.selectExpr("*", *lags).where(~F.col("_halo")).drop("_blk", "_halo")


def autocovariance_sums(series: DataFrame, max_lag: int, block: int = DEFAULT_BLOCK) -> DataFrame:
    """``(series_id, n, s_0 .. s_K)`` with ``s_k = sum_t d_t d_{t-k}`` of the centred series."""
    c = _centered(series)
    lg = lagged(c, max_lag, block)
    aggs = [F.expr(f"count({V}) AS n"), F.expr(f"sum({V} * {V}) AS s_0")]
    aggs += [F.expr(f"sum({V} * lag_{V}_{k}) AS s_{k}") for k in range(1, max_lag + 1)]
    return lg.groupBy(KEY).agg(*aggs)


def lag_rule(n: Column) -> Column:
    """Lags of a series of ``n`` values: ``floor(10 * log10(n))``, as R's ``acf`` has it."""
    # rounded, so that n = 10**k isn't cut by a logarithm a little below k
    return F.floor(F.round(10 * F.log10(n), 9)).cast("int")


def _longest_lag(series: DataFrame) -> int:
    """The lag rule for the longest series: the width of the sums (one number to the driver)."""
    longest = series.groupBy(KEY).agg(F.count(V).alias("n")).agg(F.max(lag_rule(F.col("n")))).first()[0]
    return max(1, int(longest or 0))


def acf(series: DataFrame, max_lag: int | None = None, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Autocorrelations ``r_k = s_k / s_0`` for ``k = 1..max_lag``, long ``(series_id, n, lag, acf)``.

    Without ``max_lag`` each series has the lags of ``lag_rule``. Lags at or
    beyond the series length are left out; a constant series has no
    autocorrelation (null).
    """
    if max_lag is None:
        return acf(series, _longest_lag(series), block).where(F.col("lag") <= lag_rule(F.col("n")))
    return _acf_rows(autocovariance_sums(series, max_lag, block), max_lag)


def _acf_rows(s: DataFrame, max_lag: int) -> DataFrame:
    """Autocorrelations from the sums of ``autocovariance_sums``."""
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"s_{k}").alias("s"))
                               for k in range(1, max_lag + 1)])).alias("r")
    return (s.select(KEY, "n", "s_0", rows).where(F.col("r.lag") < F.col("n"))
            .select(KEY, "n", F.col("r.lag").alias("lag"), F.try_divide(F.col("r.s"), F.col("s_0")).alias("acf")))


def acf_wide(series: DataFrame, max_lag: int) -> DataFrame:
    """``(series_id, n, acf array[1..max_lag])`` for per-series follow-up work."""
    return _acf_arrays(autocovariance_sums(series, max_lag), max_lag)


def _acf_arrays(s: DataFrame, max_lag: int) -> DataFrame:
    return s.select(KEY, "n", F.array(*[F.try_divide(F.col(f"s_{k}"), F.col("s_0"))
                                        for k in range(1, max_lag + 1)]).alias("acf"))


# ------------------------------------------------------------ Ljung-Box ----

def chi2_sf_even(q: Column, df: int) -> Column:
    """Upper tail of a chi-square with even ``df = 2m``: ``e^{-q/2} sum_{i<m} (q/2)^i / i!``.

    A finite sum, so it stays a Column expression.
    """
    if df % 2:
        raise ValueError("even degrees of freedom only")
    h = q / 2
    terms = F.aggregate(F.sequence(F.lit(0), F.lit(df // 2 - 1)), F.lit(0.0),
                        lambda acc, i: acc + F.pow(h, i) / F.factorial(i))
    return F.least(F.lit(1.0), F.exp(-h) * terms)


def ljung_box(series: DataFrame, lag: int = 20, fitdf: int = 0) -> DataFrame:
    """Ljung-Box portmanteau test, ``Box.test(y, lag, type='Ljung')``.

    ``Q = n(n+2) sum_k r_k^2 / (n-k)``, chi-square with ``lag - fitdf`` degrees
    of freedom. Output ``(series_id, n, statistic, df, p_value)``.
    """
    return _ljung_box_rows(autocovariance_sums(series, lag), lag, fitdf)


def _ljung_box_rows(s: DataFrame, lag: int, fitdf: int = 0) -> DataFrame:
    """The test from the sums of ``autocovariance_sums``, which may hold more lags."""
    terms = " + ".join(f"power(try_divide(s_{k}, s_0), 2) / (n - {k})" for k in range(1, lag + 1))
    q = F.expr(f"n * (n + 2) * ({terms})")
    dof = lag - fitdf
    out = s.select(KEY, "n", q.alias("statistic")).withColumn("df", F.lit(dof))
    if dof % 2 == 0:
        p = chi2_sf_even(F.col("statistic"), dof)
    else:
        p = _chi2_sf_udf(F.col("statistic"), F.col("df"))
    return out.withColumn("p_value", F.when(F.col("statistic").isNotNull(), p))


@pandas_udf(DoubleType())
def _chi2_sf_udf(qs: pd.Series, ds: pd.Series) -> pd.Series:
    """Chi-square upper tail for any integer df, on aggregated rows (one per series)."""
    return pd.Series([chi2_sf(a, int(b)) if pd.notna(a) else None for a, b in zip(qs, ds)], dtype="float64")


def chi2_sf(q: float, dof: int) -> float:
    """Chi-square upper tail probability for integer ``dof`` by the closed forms."""
    if q <= 0:
        return 1.0
    h = q / 2
    if dof % 2 == 0:
        term, total = 1.0, 1.0
        for i in range(1, dof // 2):
            term *= h / i
            total += term
        return min(1.0, math.exp(-h) * total)
    # odd: erfc plus a finite sum
    total = math.erfc(math.sqrt(h))
    term = math.sqrt(h) * math.exp(-h) / math.gamma(1.5)
    for i in range(1, (dof - 1) // 2 + 1):
        total += term
        term *= h / (i + 0.5)
    return min(1.0, total)


# ----------------------------------------------------------------- PACF ----

def pacf(series: DataFrame, max_lag: int | None = None) -> DataFrame:
    """Partial autocorrelations by Durbin-Levinson on the autocorrelations.

    Without ``max_lag`` each series has the lags of ``lag_rule``. The recursion
    is a fold over a series' short array of autocorrelations, in the JVM; its
    plan has one size for any number of lags. A series with a missing
    autocorrelation (constant, or null values) has no rows; after a lag that
    predicts a series perfectly the rest is null. Output ``(series_id, lag, pacf)``.
    """
    return _pacf_rows(acf_wide(series, _longest_lag(series) if max_lag is None else max_lag), max_lag)


def _pacf_rows(wide: DataFrame, max_lag: int | None = None) -> DataFrame:
    """Partial autocorrelations from the arrays of ``acf_wide``."""
    lags = lag_rule(F.col("n")) if max_lag is None else F.lit(max_lag)
    short = wide.withColumn("_k", F.least(lags, F.col("n").cast("int") - 1)).where(F.col("_k") >= 1) \
        .select(KEY, F.slice("acf", F.lit(1), F.col("_k")).alias("_r")) \
        .where(~F.exists("_r", lambda r: r.isNull() | F.isnan(r)))
    return short.select(KEY, F.posexplode(_durbin_levinson(F.col("_r"))).alias("_at", "pacf")) \
        .select(KEY, (F.col("_at") + 1).alias("lag"), "pacf")


def _durbin_levinson(r: Column) -> Column:
    """Partial autocorrelations of the array ``r`` of autocorrelations at the lags 1, 2, ...

    State: the coefficients of the last order, the share of the variance they
    leave, and the results so far.
    """
    none = F.array().cast("array<double>")
    start = F.struct(none.alias("phi"), F.lit(1.0).alias("v"), none.alias("out"))

    def step(state: Column, rho: Column) -> Column:
        phi = state["phi"]
        before = F.reverse(F.slice(r, F.lit(1), F.size(phi)))
        explained = F.aggregate(F.zip_with(phi, before, lambda a, b: a * b), F.lit(0.0), lambda acc, e: acc + e)
        # an array of one value, so that the value is computed once
        return F.transform(F.array(F.try_divide(rho - explained, state["v"])), lambda last: F.struct(
            F.concat(F.zip_with(phi, F.reverse(phi), lambda a, b: a - last * b), F.array(last)).alias("phi"),
            (state["v"] * (1 - last * last)).alias("v"), F.concat(state["out"], F.array(last)).alias("out")))[0]

    return F.aggregate(r, start, step, lambda state: state["out"])


# ------------------------------------------------------ normal quantile ----

# Rational approximation of the standard normal quantile
# (P. J. Acklam), relative error below 1.2e-9.
_PROBIT_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
             1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_PROBIT_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
             6.680131188771972e+01, -1.328068155288572e+01)
_PROBIT_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
             -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_PROBIT_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
             3.754408661907416e+00)
_P_LOW = 0.02425


def _horner_sql(coefs: Sequence[float], x: str) -> str:
    out = f"{coefs[0]!r}D"
    for c in coefs[1:]:
        out = f"({out} * {x} + {c!r}D)"
    return out


def probit(p: str) -> Column:
    """Standard normal quantile of the SQL expression ``p`` in (0, 1), one JVM-side expression."""
    return F.expr(probit_sql(p))


def probit_sql(p: str) -> str:
    """Text of ``probit``."""
    q, r = f"(({p}) - 0.5D)", f"((({p}) - 0.5D) * (({p}) - 0.5D))"
    central = f"({_horner_sql(_PROBIT_A, r)} * {q} / ({_horner_sql(_PROBIT_B, r)} * {r} + 1.0D))"
    ql = f"sqrt(-2.0D * ln({p}))"
    low = f"({_horner_sql(_PROBIT_C, ql)} / ({_horner_sql(_PROBIT_D, ql)} * {ql} + 1.0D))"
    qu = f"sqrt(-2.0D * ln(1.0D - ({p})))"
    high = f"(-{_horner_sql(_PROBIT_C, qu)} / ({_horner_sql(_PROBIT_D, qu)} * {qu} + 1.0D))"
    return f"CASE WHEN ({p}) < {_P_LOW!r}D THEN {low} WHEN ({p}) > {1 - _P_LOW!r}D THEN {high} ELSE {central} END"


def normal_sf(z: float) -> float:
    """Upper tail of the standard normal."""
    return 0.5 * math.erfc(z / math.sqrt(2))


# ---------------------------------------------------------- Shapiro-Wilk ---

# Polynomial coefficients of Royston (1995), algorithm AS R94,
# for the Shapiro-Wilk coefficients and the normalising transformation of W.
_SW_C1 = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
_SW_C2 = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
_SW_C3 = (0.5440, -0.39978, 0.025054, -6.714e-4)
_SW_C4 = (1.3822, -0.77857, 0.062767, -0.0020322)
_SW_C5 = (-1.5861, -0.31082, -0.083751, 0.0038915)
_SW_C6 = (-0.4803, -0.082676, 0.0030302)
_SW_G = (-2.273, 0.459)
SHAPIRO_MAX_N = 5000


def _poly(coefs: Sequence[float], x):
    """``c0 + c1 x + c2 x^2 ..`` for Columns or floats."""
    out = None
    for i, c in enumerate(coefs):
        term = c * (x ** i) if not isinstance(x, Column) else F.lit(c) * F.pow(x, i)
        out = term if out is None else out + term
    return out


def _shapiro_coefficients(sizes: DataFrame) -> DataFrame:
    """``(n, _a1, _a2, _fac)`` for every sample size in ``sizes``: at most ``SHAPIRO_MAX_N - 2`` rows.

    The normal scores come from a generated sequence, once per size: the sum
    of their squares and the two largest give the two outer coefficients (by
    polynomials) and the factor of the others.
    """
    scored = sizes.select("n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("_i")) \
        .withColumn("_m", probit("(_i - 0.375D) / (CAST(n AS DOUBLE) + 0.25D)"))
    sums = scored.groupBy("n").agg(F.sum(F.col("_m") * F.col("_m")).alias("_summ2"),
                                   F.max(F.when(F.col("_i") == F.col("n"), F.col("_m"))).alias("_mn"),
                                   F.max(F.when(F.col("_i") == F.col("n") - 1, F.col("_m"))).alias("_mn1"))
    rsn = 1 / F.sqrt(F.col("n").cast("double"))
    # m_n = -m_1 by symmetry of the normal scores
    a1 = _poly(_SW_C1, rsn) + F.col("_mn") / F.sqrt(F.col("_summ2"))
    a2 = F.col("_mn1") / F.sqrt(F.col("_summ2")) + _poly(_SW_C2, rsn)
    fac_big = F.sqrt((F.col("_summ2") - 2 * F.col("_mn") ** 2 - 2 * F.col("_mn1") ** 2) / (1 - 2 * a1 ** 2 - 2 * a2 ** 2))
    fac_small = F.sqrt((F.col("_summ2") - 2 * F.col("_mn") ** 2) / (1 - 2 * a1 ** 2))
    return sums.select("n", F.when(F.col("n") == 3, F.lit(math.sqrt(0.5))).otherwise(a1).alias("_a1"),
                       F.when(F.col("n") > 5, a2).alias("_a2"),
                       F.when(F.col("n") > 5, fac_big).otherwise(fac_small).alias("_fac"))


def shapiro(series: DataFrame) -> DataFrame:
    """Shapiro-Wilk normality test, Royston's approximation as R's ``shapiro.test``.

    Defined for ``3 <= n <= 5000``; other series, and constant ones, get a
    row with null statistic and p-value. Because of that bound the per-series
    rank window never holds more than 5000 rows, and longer series are left
    out by a join before any window. The coefficients depend on n and the rank
    only, so they are computed once per size that occurs, from generated
    scores; W is one aggregate over the ranked values and its p-value is
    computed on the one aggregated row per series. Nulls have no rank. Output
    ``(series_id, n, statistic, p_value)``.
    """
    from tessera.operators.joins import checked_broadcast

    every = cut_lineage(series_stats(series))
    stats = every.where((F.col("n") >= 3) & (F.col("n") <= SHAPIRO_MAX_N))
    keep = series.where(F.col(V).isNotNull()).join(checked_broadcast(stats), KEY)
    ranked = keep.withColumn("_i", F.row_number().over(Window.partitionBy(KEY).orderBy(V, T))) \
        .withColumn("_m", probit("(_i - 0.375D) / (CAST(n AS DOUBLE) + 0.25D)"))
    j = ranked.join(F.broadcast(_shapiro_coefficients(stats.select("n").distinct())), "n")
    i, nn = F.col("_i"), F.col("n")
    # antisymmetric coefficients: a_{n+1-i} = -a_i; the outer one or two come from the polynomials
    pos = F.when(i == nn, F.col("_a1")).when((i == nn - 1) & (nn > 5), F.col("_a2"))
    neg = F.when(i == 1, -F.col("_a1")).when((i == 2) & (nn > 5), -F.col("_a2"))
    a = F.coalesce(pos, neg, F.when(nn == 3, F.lit(0.0)), F.col("_m") / F.col("_fac"))
    w_stat = j.groupBy(KEY).agg(
        F.try_divide(F.pow(F.sum(a * F.col(V)), 2), F.sum(F.pow(F.col(V) - F.col("mean"), 2))).alias("statistic"))
    # ``least`` skips nulls, so a missing statistic must stay missing
    w_stat = w_stat.withColumn("statistic", F.when(F.col("statistic").isNotNull(),
                                                   F.least(F.col("statistic"), F.lit(1.0))))
    w_stat = every.select(KEY, "n").join(w_stat, KEY, "left")
    return w_stat.withColumn("p_value", _shapiro_p_udf(F.col("statistic"), F.col("n")))


def shapiro_p(w: float, n: int) -> float | None:
    """p-value of W by Royston's normalising transformation."""
    if w is None or n is None or n < 3:
        return None
    if n == 3:
        p = 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))
        return max(0.0, min(1.0, p))
    if w >= 1:
        return 1.0
    if n <= 11:
        gamma = _poly(_SW_G, float(n))
        m = _poly(_SW_C3, float(n))
        s = math.exp(_poly(_SW_C4, float(n)))
        arg = gamma - math.log1p(-w)
        if arg <= 0:
            return 0.0
        z = (-math.log(arg) - m) / s
    else:
        ln = math.log(n)
        m = _poly(_SW_C5, ln)
        s = math.exp(_poly(_SW_C6, ln))
        z = (math.log1p(-w) - m) / s
    return normal_sf(z)


@pandas_udf(DoubleType())
def _shapiro_p_udf(ws: pd.Series, ns: pd.Series) -> pd.Series:
    """Shapiro-Wilk p-values on aggregated rows (one per series)."""
    return pd.Series([shapiro_p(float(a), int(b)) if pd.notna(a) else None for a, b in zip(ws, ns)],
                     dtype="float64")


# ------------------------------------------------------- Dickey-Fuller ----

# Response surface of the Dickey-Fuller tau statistic for a regression with constant and no trend
# (MacKinnon 2010): asymptotic critical value and coefficients of 1/T, 1/T^2, 1/T^3, by level.
TAU_SURFACE = {1: (-3.43035, -6.5393, -16.786, -79.433), 5: (-2.86154, -2.8903, -4.234, -40.040),
               10: (-2.56677, -1.5384, -2.809, 0.0)}
# Polynomials whose normal tail is the p-value of tau (MacKinnon 1994), below and above the switch point,
# and the range they hold for.
TAU_LOW, TAU_HIGH = (2.1659, 1.4412, 0.038269), (1.7339, 0.93202, -0.12745, -0.010368)
TAU_SWITCH, TAU_MIN, TAU_MAX = -1.61, -18.83, 2.74


def tau_critical(rows: Column, percent: int = 5) -> Column:
    """Critical value of the Dickey-Fuller statistic of a regression (constant, no trend) over ``rows`` rows."""
    t = rows.cast("double")
    return _poly(TAU_SURFACE[percent], 1.0 / t)


def tau_p_value(tau: float | None) -> float | None:
    """Approximate p-value of the Dickey-Fuller statistic (constant, no trend)."""
    if tau is None or math.isnan(tau):
        return None
    if tau > TAU_MAX or tau < TAU_MIN:
        return 1.0 if tau > TAU_MAX else 0.0
    return normal_sf(-_poly(TAU_LOW if tau <= TAU_SWITCH else TAU_HIGH, tau))


def _block_products(orders: int):
    """Sums of the Dickey-Fuller regressions of a series and its first ``orders - 1`` differences over blocks of
    positions, added up per series within the task.

    Rows come sorted by series, block and position; a block starts with the
    positions before it that its regressions reach back to. ``sums`` is one
    array: regression rows, levels, squared levels, then for ``j = 0..p`` the
    products of the difference with the one ``j`` earlier, and those of the
    level with it. ``lo`` and ``hi`` are the smallest and largest value that
    isn't null (NaN is the largest).
    """
    def add(entry: list, d: int, y: np.ndarray, none: np.ndarray, t0: int, own: int, last: int, p: int, centre: float) -> None:
        w, end = np.diff(y, d) if d else y, t0 + len(y) - 1
        if t0 == 1:
            entry[1] = w[:p + 1]
        if end == last:
            entry[2] = w[-(p + 1):]
        mine = w[max(own - d - t0, 0):]
        if none.any():
            mine = mine[~np.convolve(none, np.ones(d + 1, int), "valid").astype(bool)[-len(mine):]] if len(mine) else mine
        if len(mine):
            lo, hi = np.fmin.reduce(mine), np.maximum.reduce(mine)
            entry[3], entry[4] = (lo, hi) if entry[3] is None else (np.fmin(entry[3], lo), np.maximum(entry[4], hi))
        a, b = max(own, p + 2 + d) - d - t0, len(w)
        if a < b:
            x, level = np.diff(w)[a - 1 - p:], w[a - 1:b - 1] - centre
            entry[0] += np.concatenate([[b - a, level.sum(), level @ level],
                                        np.correlate(x, x[p:], "valid")[::-1], np.correlate(x, level, "valid")[::-1]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: list[tuple] = []
        total: list[list] = []
        held: list[tuple] = []
        now = n = ps = centres = last = None

        def close() -> None:
            t, y, none = (np.concatenate(c) for c in zip(*held)) if len(held) > 1 else held[0]
            own = int(now[1]) * now[2] + 1
            for d in range(orders):
                add(total[d], d, y, none, int(t[0]), own, last, ps[d], centres[d])

        def finish() -> None:
            done.extend((now[0], d, n, ps[d], *total[d]) for d in range(orders))

        for batch in batches:
            ids, blocks, t = batch[KEY].to_numpy(), batch["_blk"].to_numpy(), batch[T].to_numpy(np.int64)
            y, none = batch[V].to_numpy(float), batch["_none"].to_numpy(bool)
            cut = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (blocks[1:] != blocks[:-1]))) if len(batch) else []
            firsts = batch.iloc[cut]
            facts = zip(firsts["_n"].tolist(), firsts["_last"].tolist(), firsts["_width"].tolist(),
                        zip(*[firsts[f"_p{d}"].tolist() for d in range(orders)]),
                        zip(*[firsts[f"_c{d}"].tolist() for d in range(orders)]))
            for s, e, (count, end, width, lags, means) in zip(cut, [*cut[1:], len(batch)], facts):
                if now is None or (ids[s], blocks[s]) != now[:2]:
                    if held:
                        close()
                        held = []
                    if now is None or ids[s] != now[0]:  # sorted by series: the one before is complete here
                        if now is not None:
                            finish()
                            if len(done) >= 5000:
                                yield _sums_frame(done)
                                done = []
                        total = [[np.zeros(2 * p + 5), None, None, None, None] for p in lags]
                    now, n, ps, centres, last = (ids[s], blocks[s], width), count, lags, means, end
                held.append((t[s:e], y[s:e], none[s:e]))
        if held:
            close()
            finish()
        if done:
            yield _sums_frame(done)

    return run


def _sums_frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[KEY, "d", "n", "p", "sums", "head", "tail", "lo", "hi"])


def _regression(p: int, sums: np.ndarray, head: np.ndarray, tail: np.ndarray) -> float | None:
    """Statistic of the lagged level from a series' sums and its first and last ``p + 1`` levels.

    The products of differences ``i`` and ``j`` earlier follow from those one
    step less by what enters and leaves at the ends, so the whole matrix is
    the array of lag products and its edges.
    """
    m, level, squares = int(sums[0]), sums[1], sums[2]
    products, with_level = sums[3:p + 4], sums[p + 4:]
    dof = m - (p + 2)
    if dof <= 0:
        return None
    first, last = np.diff(head)[::-1], np.diff(tail)[::-1]
    gram = np.empty((p + 1, p + 1))
    gram[0], gram[:, 0] = products, products
    for i in range(p):
        gram[i + 1, 1:] = gram[i, :p] + first[i] * first - last[i] * last
    ends = tail[::-1] - head[::-1]  # sums of the differences j earlier
    full = np.empty((p + 2, p + 2))
    full[0, 0], full[0, 1], full[1, 1] = m, level, squares
    full[0, 2:], full[1, 2:], full[2:, 2:] = ends[1:], with_level[1:], gram[1:, 1:]
    full[1:, 0], full[2:, 1] = full[0, 1:], full[1, 2:]
    right = np.concatenate([[ends[0], with_level[0]], gram[0, 1:]])
    scale = np.sqrt(np.diag(full))  # unit diagonal: levels and differences can be far apart
    if not (scale > 0).all():
        return None
    try:
        inverse = np.linalg.inv(full / np.outer(scale, scale)) / np.outer(scale, scale)
    except np.linalg.LinAlgError:
        return None
    beta = inverse @ right
    variance = (gram[0, 0] - beta @ right) / dof
    return float(beta[1] / math.sqrt(variance * inverse[1, 1])) if variance > 0 and inverse[1, 1] > 0 else None


def _solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Statistics from the sums of the tasks, which come sorted by series and order."""
    now = None

    def row() -> tuple:
        (series, d), n, p, sums, head, tail, lo, hi = now
        tau = _regression(p, sums, head, tail) if head is not None and tail is not None else None
        same = None if lo is None else bool(lo == hi or (math.isnan(lo) and math.isnan(hi)))
        return series, d, n, p, int(sums[0]), tau, tau_p_value(tau), same

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[KEY, "d", "n", "lags", "rows", "statistic", "p_value", "same"]).astype(
            {"statistic": "float64", "p_value": "float64", "same": "object"})

    for b in batches:
        out = []
        for series, d, n, p, sums, head, tail, empty, lo, hi in zip(
                *(b[c].tolist() for c in (KEY, "d", "n", "p", "sums", "head", "tail", "_empty", "lo", "hi"))):
            lo, hi = (None, None) if empty else (lo, hi)
            if now is None or now[0] != (series, d):
                if now is not None:
                    out.append(row())
                now = [(series, d), n, p, np.array(sums), head, tail, lo, hi]
                continue
            now[3] = now[3] + sums
            now[4], now[5] = (head if now[4] is None else now[4]), (tail if now[5] is None else now[5])
            if not empty:
                now[6], now[7] = (lo, hi) if now[6] is None else (np.fmin(now[6], lo), np.maximum(now[7], hi))
        if out:
            yield frame(out)
    if now is not None:
        yield frame([row()])


def _unit_root_tests(series: DataFrame, orders: int, max_p: int | None, block: int) -> DataFrame:
    """Dickey-Fuller tests of every series (``d`` = 0) and its first ``orders - 1`` differences from one reading of it:
    ``(series_id, d, n, lags, rows, statistic, p_value, same)``; ``same``: all values are equal (null: there is none)."""
    at = F.struct(F.col(T).alias("t"), F.col(V).alias("v"))
    even = F.col(T) % 2 == 0
    stats = series.groupBy(KEY).agg(
        F.count(V).alias("_n"), F.avg(V).alias("_c0"), F.max(T).alias("_last"), F.max(F.when(even, at)).alias("_even"),
        F.max(F.when(~even, at)).alias("_odd"), F.max(F.when(F.col(T) == 1, F.col(V))).alias("_y1"),
        F.max(F.when(F.col(T) == 2, F.col(V))).alias("_y2")).where("_n > 0")
    for d in range(orders):
        rule = F.floor(F.pow(F.greatest(F.col("_n") - 1 - d, F.lit(0)), 1.0 / 3))
        stats = stats.withColumn(f"_p{d}", (rule if max_p is None else F.least(rule, F.lit(max_p))).cast("int"))
    # means of the first and second differences follow from the ends; higher ones are about 0
    flip = F.col("_last") % 2 == 0
    end, before = F.when(flip, F.col("_even.v")).otherwise(F.col("_odd.v")), F.when(flip, F.col("_odd.v")).otherwise(F.col("_even.v"))
    means = {1: F.try_divide(end - F.col("_y1"), F.col("_last") - 1),
             2: F.try_divide(end - before - F.col("_y2") + F.col("_y1"), F.col("_last") - 2)}
    for d in range(1, orders):
        stats = stats.withColumn(f"_c{d}", F.coalesce(means.get(d, F.lit(0.0)), F.lit(0.0)))
    facts = ["_n", "_last", *[f"_p{d}" for d in range(orders)], *[f"_c{d}" for d in range(orders)]]
    reach = F.col("_p0") + orders  # positions before a block that its regressions need
    blk = F.floor((F.col(T) - 1) / block)
    in_tail = ((F.col(T) - 1) % block >= block - reach) & ((blk + 1) * block < F.col("_last"))
    placed = (series.join(stats.select(KEY, *facts), KEY).select(
        KEY, T, F.col(V).cast("double").alias(V), F.col(V).isNull().alias("_none"), *facts, F.lit(block).alias("_width"),
        F.explode(F.array_compact(F.array(
            F.struct(F.assert_true(reach < block, "more lags than a block has positions").isNull().alias("_ok"), blk.alias("_blk")),
            F.when(in_tail, F.struct(F.lit(True).alias("_ok"), (blk + 1).alias("_blk")))))).alias("_b"))
        .where("_b._ok").select(KEY, T, V, "_none", *facts, "_width", "_b._blk"))
    ship_package(series.sparkSession)
    parts = placed.repartition(KEY, "_blk").sortWithinPartitions(KEY, "_blk", T).mapInPandas(
        _block_products(orders), f"{KEY} long, d int, n long, p int, sums array<double>, head array<double>, "
        "tail array<double>, lo double, hi double")
    # pandas has one mark for null and NaN
    return parts.withColumn("_empty", F.col("lo").isNull() & F.col("hi").isNull()).repartition(KEY) \
        .sortWithinPartitions(KEY, "d").mapInPandas(
            _solved, f"{KEY} long, d int, n long, lags int, rows long, statistic double, p_value double, same boolean")


def adf(series: DataFrame, max_p: int | None = None, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Augmented Dickey-Fuller test with constant [choice: see README].

    Regression ``dy_t = a + g y_{t-1} + sum_{j<=p} b_j dy_{t-j}`` with
    ``p = floor((n-1)^(1/3))`` (capped at ``max_p`` if given); statistic ``g / se(g)``
    against the 5% critical value of MacKinnon's response surface for the
    regression's number of rows, with its approximate p-value. The regression needs ``2p + 5``
    sums per series, held as one array: numpy adds it up over blocks of
    positions, one array per task is left to add up, so the plan has one size
    for any length and a hot series spreads over tasks by its blocks. Levels
    are taken from the series' mean, which leaves ``g`` as it is.
    Positions run from 1 without a gap. Output ``(series_id, n, lags,
    statistic, p_value, critical_5pct, stationary)``; a series too short for its lags,
    constant, or with a null value has a null statistic.
    """
    out = _unit_root_tests(series, 1, max_p, block)
    cv = F.when(F.col("rows") > 0, tau_critical(F.col("rows")))
    return out.select(KEY, "n", "lags", "statistic", "p_value", cv.alias("critical_5pct"),
                      (F.col("statistic") < cv).alias("stationary"))


def ndiffs(series: DataFrame, max_d: int = 2, max_p: int | None = None) -> DataFrame:
    """Number of differences needed for stationarity by the ADF test.

    The series and its first ``max_d`` differences are tested in one reading
    of the series; ``d`` is the first order whose test rejects a unit root, else
    ``max_d``. A constant series needs no further difference; a series too
    short for a test gets null. Output ``(series_id, ndiffs)``.
    """
    out = _unit_root_tests(series, max_d + 1, max_p, DEFAULT_BLOCK)
    stationary = F.col("statistic") < F.when(F.col("rows") > 0, tau_critical(F.col("rows")))
    test = F.when(F.col("same"), True).otherwise(stationary)
    wide = out.groupBy(KEY).agg(*[F.max(F.when(F.col("d") == d, test)).alias(f"_s{d}") for d in range(max_d + 1)])
    j = series.groupBy(KEY).agg((F.min(V) == F.max(V)).alias("_same")).join(wide, KEY, "left")
    expr = F.when(F.col("_same"), F.lit(0))
    for d in range(max_d + 1):
        expr = expr.when(F.col(f"_s{d}").isNull(), F.lit(None).cast("int")).when(F.col(f"_s{d}"), F.lit(d))
    return j.select(KEY, expr.otherwise(F.lit(max_d)).alias("ndiffs"))


# -------------------------------------------------------------- battery ----

def diagnose(series: DataFrame, lag: int = 20, max_d: int = 2) -> DataFrame:
    """The whole battery of the series study for y, y^2 and z = diff(y).

    Output ``(series_id, transform, test, statistic, p_value)``; tests are
    ``mean`` (y, z), ``sd``, ``skewness`` and ``kurtosis`` (y), ``acf_k`` and
    ``pacf_k`` for the lags k of each series (all three), ``ljung_box`` (all
    three and z^2), ``shapiro`` (y, z) and ``ndiffs`` (y, z; the statistic is
    the number of differences). Only Ljung-Box and Shapiro have a p-value.
    """
    parts = []
    # every test reads the series, its differences, and the lag sums of each: they are written once
    series = cut_lineage(series.select(KEY, T, V))
    z = stored(difference(series))
    longest = max(_longest_lag(series), lag)
    sums = {name: stored(autocovariance_sums(s, longest))
            for name, s in (("y", series), ("y2", squared(series)), ("z", z), ("z2", squared(z)))}

    def plain(rows: DataFrame, name: str, test: Column, value: str) -> DataFrame:
        return rows.select(KEY, F.lit(name).alias("transform"), test.alias("test"), F.col(value).alias("statistic"),
                           F.lit(None).cast("double").alias("p_value"))

    for name, s, which in (("y", series, ("mean", "sd", "skewness", "kurtosis")), ("z", z, ("mean",))):
        wide = moments(s).select(KEY, F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).alias("v"))
                                                          for m in which])).alias("r")).select(KEY, "r.m", "r.v")
        parts.append(plain(wide, name, F.col("m"), "v"))
    for name in ("y", "y2", "z"):
        s = sums[name]
        for kind, rows in (("acf", _acf_rows(s, longest).where(F.col("lag") <= lag_rule(F.col("n")))),
                           ("pacf", _pacf_rows(_acf_arrays(s, longest)))):
            parts.append(plain(rows, name, F.concat(F.lit(f"{kind}_"), F.col("lag")), kind))
    for name in ("y", "y2", "z", "z2"):
        lb = _ljung_box_rows(sums[name], lag)
        parts.append(lb.select(KEY, F.lit(name).alias("transform"), F.lit("ljung_box").alias("test"),
                               "statistic", "p_value"))
    for name, s in (("y", series), ("z", z)):
        sw = shapiro(s)
        parts.append(sw.select(KEY, F.lit(name).alias("transform"), F.lit("shapiro").alias("test"),
                               "statistic", "p_value"))
        nd = ndiffs(s, max_d)
        parts.append(nd.select(KEY, F.lit(name).alias("transform"), F.lit("ndiffs").alias("test"),
                               F.col("ndiffs").cast("double").alias("statistic"),
                               F.lit(None).cast("double").alias("p_value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def strict_white_noise(series: DataFrame, lag: int = 20, alpha: float = 0.05) -> DataFrame:
    """Verdict per series: uncorrelated (Ljung-Box on y), uncorrelated squares
    (Ljung-Box on y^2), normal (Shapiro-Wilk). ``GWN`` when all three hold,
    ``SWN`` when the first two hold, ``WN`` when only the first, else ``not WN``;
    ``normality not tested`` when the first two hold and Shapiro-Wilk is undefined.
    """
    lb = ljung_box(series, lag).select(KEY, F.col("p_value").alias("p_lb"))
    lb2 = ljung_box(squared(series), lag).select(KEY, F.col("p_value").alias("p_lb2"))
    sw = shapiro(series).select(KEY, F.col("p_value").alias("p_sw"))
    j = lb.join(lb2, KEY, "left").join(sw, KEY, "left")
    unc = F.col("p_lb") > alpha
    unc2 = F.col("p_lb2") > alpha
    untested = unc & unc2 & F.col("p_sw").isNull()
    normal = F.col("p_sw") > alpha
    verdict = (F.when(untested, "normality not tested").when(unc & unc2 & normal, "GWN").when(unc & unc2, "SWN").when(unc, "WN").otherwise("not WN"))
    return j.select(KEY, "p_lb", "p_lb2", "p_sw", verdict.alias("verdict"))
