"""The data behind the reference's plots: histograms, box
statistics, kernel densities, normal overlays, trends.

Each one aggregates first and never carries raw rows into a cross join:
histograms count per bin, box statistics keep quartiles per column or group,
kernel densities add bin weights up before one convolution per group.
Per-column or per-group statistics are one row per column or group; one row
per *column* is bounded by the schema and is broadcast, one row per group is
broadcast only after a size check.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tessera.operators.joins import checked_broadcast
from tessera.operators.selection import on_keys, quantile_columns
from tessera.operators.smoothing import local_regression, smoothed
from tessera.session import cut_lineage, ship_package


def _keys(by: str | Sequence[str] | None) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _join_stats(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    if not keys:
        return df.crossJoin(F.broadcast(stats))
    return df.join(checked_broadcast(stats), keys)


def grid(stats: DataFrame, lo: Column, hi: Column, points: int = 100, name: str = "x") -> DataFrame:
    """``seq(lo, hi, length = points)`` for every row of ``stats``: columns ``i, x``."""
    i = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")
    g = stats.select("*", i)
    return g.withColumn(name, lo + F.col("i") * (hi - lo) / (points - 1))


# ------------------------------------------------------------ histograms ---

def histogram_bins(df: DataFrame, col: str, bins: int = 30, by: str | Sequence[str] | None = None) -> DataFrame:
    """Equal-width histogram over ``[min, max]`` with ``bins`` bins.

    Output ``(by.., bin, lo, hi, count)``; the maximum falls in the last bin,
    a constant column in bin 0. Empty bins are left out.
    """
    keys = _keys(by)
    x = F.col(col).cast("double")
    stats = df.where(x.isNotNull()).groupBy(*keys).agg(F.min(x).alias("_min"), F.max(x).alias("_max"))
    w = (F.col("_max") - F.col("_min")) / bins
    b = F.when(w == 0, F.lit(0)).otherwise(
        F.least(F.floor((x - F.col("_min")) / w), F.lit(bins - 1))).cast("int")
    j = _join_stats(df.where(x.isNotNull()).select(*keys, col), stats, keys)
    counted = j.select(*keys, b.alias("bin"), "_min", "_max").groupBy(*keys, "bin", "_min", "_max") \
        .agg(F.count(F.lit(1)).alias("count"))
    return counted.select(*keys, "bin", (F.col("_min") + F.col("bin") * w).alias("lo"),
                          (F.col("_min") + (F.col("bin") + 1) * w).alias("hi"), "count")


def histogram_width(df: DataFrame, col: str, width: float, lo: float | None = None,
                    hi: float | None = None, by: str | Sequence[str] | None = None) -> DataFrame:
    """Fixed-width histogram, bins ``[k w, (k+1) w)``, optionally within limits.

    No statistics pass is needed: the bin follows from the value alone.
    """
    keys = _keys(by)
    x = F.col(col).cast("double")
    src = df.where(x.isNotNull())
    if lo is not None:
        src = src.where(x >= lo)
    if hi is not None:
        src = src.where(x <= hi)
    start = F.floor(x / width) * width
    return src.groupBy(*keys, start.alias("lo")).agg(F.count(F.lit(1)).alias("count")) \
        .select(*keys, "lo", (F.col("lo") + width).alias("hi"), "count")


# Fixed values of the pretty-breaks rule: bias towards larger units (and towards 5), relative tolerance, shrinkage of constants.
UNIT_BIAS, FIVE_BIAS, BREAK_TOLERANCE, CONSTANT_SHRINK = 1.5, 2.75, 1e-7, 0.75


def with_pretty_breaks(stats: DataFrame, lo: str, hi: str, n: str) -> DataFrame:
    """``stats`` with ``_unit, _first, _last``: breaks ``k * _unit`` for whole ``k`` from ``_first`` to ``_last``.

    They cover ``lo..hi`` in about ``n`` intervals of 1, 2 or 5 times a power
    of ten, as R's ``pretty``. A range that is zero beside its values' size
    is given intervals around the value, at least a third of ``n``.
    """
    low, high, wish = F.col(lo), F.col(hi), F.col(n)
    size = F.greatest(F.abs(low), F.abs(high))
    tiny = 1.0 + 1.0 / (1.0 + UNIT_BIAS) if FIVE_BIAS >= 1.5 * UNIT_BIAS + 0.5 else 1.0 + 1.5 / (1.0 + FIVE_BIAS)
    constant = (size == 0) | (high - low < size * (tiny * 3 * 2.0 ** -52) * F.greatest(wish, F.lit(1)))
    least = F.floor(wish / 3).cast("long")
    near = F.when(size == 0, F.lit(1.0)).when(size > 10, 9.0 + size / 10.0).otherwise(size) * CONSTANT_SHRINK
    cell = F.when(constant, near / F.greatest(least, F.lit(1))).otherwise((high - low) / F.greatest(wish, F.lit(1)))
    out = stats.withColumn("_cell", cell).withColumn("_base", F.pow(F.lit(10.0), F.floor(F.log10("_cell")).cast("double")))
    c, unit = F.col("_cell"), F.col("_base")
    for times, bias in ((2.0, UNIT_BIAS), (5.0, FIVE_BIAS), (10.0, UNIT_BIAS)):
        larger = F.col("_base") * times
        unit = F.when(larger - c < bias * (c - unit), larger).otherwise(unit)
    out = out.withColumn("_unit", unit)
    out = out.withColumns({"_first": F.floor(low / F.col("_unit") + BREAK_TOLERANCE).cast("long"),
                           "_last": F.ceil(high / F.col("_unit") - BREAK_TOLERANCE).cast("long")})
    missing = F.greatest(least - (F.col("_last") - F.col("_first")), F.lit(0).cast("long"))
    out = out.withColumn("_more", missing)
    half, rest = F.floor(F.col("_more") / 2).cast("long"), F.col("_more") % 2
    below = F.when((low == 0) & (F.col("_first") == 0) & (high != 0), F.lit(0).cast("long")).when(
        F.col("_first") >= 0, half + rest).otherwise(half)
    return out.withColumns({"_first": F.col("_first") - below, "_last": F.col("_last") + F.col("_more") - below}) \
        .drop("_cell", "_base", "_more")


def histogram_density(df: DataFrame, col: str, by: str | Sequence[str] | None = None,
                      bins: int | None = None) -> DataFrame:
    """Density-scaled histogram (``hist(prob = TRUE)``): ``count / (n * width)``.

    Breaks are the pretty ones for Sturges' ``ceil(log2(n) + 1)`` intervals per
    group, or for ``bins`` if given. Intervals are right-closed, the first one
    holds the lowest break too. Output ``(by.., bin, lo, hi, count, density)``,
    bins counted from 0; empty bins are left out, and nulls and NaN.
    """
    keys = _keys(by)
    x = F.col(col).cast("double")
    src = df.where(x.isNotNull() & ~F.isnan(x))
    stats = src.groupBy(*keys).agg(F.min(x).alias("_min"), F.max(x).alias("_max"), F.count(x).alias("_n"))
    wish = F.lit(bins) if bins else F.ceil(F.log2(F.col("_n")) + 1).cast("int")
    stats = with_pretty_breaks(stats.where(F.col("_n") > 0).withColumn("_bins", wish), "_min", "_max", "_bins")
    j = _join_stats(src.select(*keys, col), stats.select(*keys, "_n", "_unit", "_first", "_last"), keys)
    place = F.ceil(x / F.col("_unit") - BREAK_TOLERANCE).cast("long") - 1 - F.col("_first")
    b = F.greatest(F.lit(0).cast("long"), F.least(place, F.col("_last") - F.col("_first") - 1)).cast("int")
    g = j.groupBy(*keys, b.alias("bin"), "_n", "_unit", "_first").agg(F.count(F.lit(1)).alias("count"))
    left = (F.col("_first") + F.col("bin")).cast("double")
    return g.select(*keys, "bin", (left * F.col("_unit")).alias("lo"), ((left + 1) * F.col("_unit")).alias("hi"), "count",
                    (F.col("count").cast("double") / (F.col("_n") * F.col("_unit"))).alias("density"))


def _long(df: DataFrame, cols: Sequence[str], keys: list[str]) -> DataFrame:
    """``(keys.., column, value)``: one row per non-null value of each column."""
    from tessera.operators.profile import unpivot_values
    return unpivot_values(df, cols, keys)


def histogram_all(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Histograms of many numeric columns in one job: the columns are unpivoted
    and binned by column."""
    return histogram_bins(_long(df, cols, []), "value", bins, by="column")


# ------------------------------------------------------------------ box ----

def box_stats(df: DataFrame, cols: Sequence[str], by: str | Sequence[str] | None = None,
              whisker: float = 1.5, method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Box-plot statistics per column (and group): quartiles (interpolated as
    numpy's default), whiskers at the most extreme values within
    ``whisker * IQR`` of the box, and the number of values beyond.

    Output ``(by.., column, n, q1, median, q3, lower_whisker, upper_whisker,
    n_outliers)``. The fences are joined back as one row per column/group and
    an aggregate finds whiskers and outliers. ``method`` chooses the quartiles
    as in ``profile.describe``; ``'exact'`` keeps no group's values in one task.
    """
    keys = _keys(by)
    lng = _long(df, cols, keys)
    own = [*keys, "column"]
    if method in ("exact", "ranked"):  # the second is an earlier name
        n = lng.groupBy(*own).agg(F.count("value").alias("n"))
        stats = n.join(quantile_columns(lng, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, own), own)
    elif method == "approx":
        stats = lng.groupBy(*own).agg(F.count("value").alias("n"),
                                      F.percentile_approx("value", [0.25, 0.5, 0.75], accuracy).alias("_q"))
        stats = stats.select(*own, "n", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
    else:
        raise ValueError("method is 'exact' or 'approx'")
    iqr = F.col("q3") - F.col("q1")
    stats = stats.withColumns({"_lo": F.col("q1") - whisker * iqr, "_hi": F.col("q3") + whisker * iqr})
    j = lng.join(F.broadcast(stats) if not keys else checked_broadcast(stats), keys + ["column"])
    v = F.col("value")
    out = j.groupBy(*keys, "column", "n", "q1", "median", "q3").agg(
        F.min(F.when(v >= F.col("_lo"), v)).alias("lower_whisker"),
        F.max(F.when(v <= F.col("_hi"), v)).alias("upper_whisker"),
        F.count_if((v < F.col("_lo")) | (v > F.col("_hi"))).alias("n_outliers"))
    return out


# ------------------------------------------------------------------ KDE ----

def bandwidth_nrd0(sd: Column, q1: Column, q3: Column, n: Column) -> Column:
    """Silverman's rule as R's ``bw.nrd0``: ``0.9 min(sd, IQR/1.34) n^-0.2``.

    Falls back as R does when the spread is zero.
    """
    lo = F.least(sd, (q3 - q1) / 1.34)
    lo = F.when(lo > 0, lo).when(sd > 0, sd).otherwise(F.lit(1.0))
    return 0.9 * lo * F.pow(n.cast("double"), -0.2)


#: Bandwidths that the binned range goes beyond the grid's ends, so that the convolution never wraps around (fixed value).
MARGIN = 4.0


def _convolved(points: int, bins: int, cut: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Densities of groups from their bin weights: one FFT convolution and an interpolation per row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        apart = np.concatenate([np.arange(bins), np.arange(bins, 0, -1)])
        for batch in batches:
            xs, ys = [], []
            for n, lo, hi, bw, places, weights in zip(*(batch[c] for c in ("_n", "_min", "_max", "bw", "_bins", "_weights"))):
                start, end = lo - cut * bw, hi + cut * bw
                binned = np.zeros(2 * bins)
                binned[np.asarray(places, dtype=int)] = np.asarray(weights, dtype=float) / n
                step = (end - start + 2 * MARGIN * bw) / (bins - 1)
                kernel = np.exp(-0.5 * (apart * step / bw) ** 2) / (bw * math.sqrt(2 * math.pi))
                smooth = np.fft.irfft(np.fft.rfft(binned) * np.fft.rfft(kernel), 2 * bins)[:bins]
                at = start + np.arange(points) * (end - start) / (points - 1)
                xs.append(at)
                ys.append(np.maximum(np.interp((at - (start - MARGIN * bw)) / step, np.arange(bins), smooth), 0.0))
            out = batch.drop(columns=["_n", "_min", "_max", "bw", "_bins", "_weights"])
            yield out.assign(_xs=xs, _ys=ys)
    return run


def kde(df: DataFrame, col: str, by: str | Sequence[str] | None = None, points: int = 100,
        bins: int = 512, cut: float = 3.0, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Gaussian kernel density on a grid of ``points``, as R's ``density``.

    Each value's weight is split between the two of ``bins`` equally spaced
    places around it (linear binning), the weights are added up per group and
    place, and one FFT convolution per group gives the density at the places;
    the grid is interpolated linearly between them. Bandwidth ``bw.nrd0``; the
    grid spans ``[min - cut bw, max + cut bw]``. ``lo``/``hi`` restrict the data
    first (``xlim``). Nulls and NaN are left out; a group without a value has
    no rows.
    """
    keys = _keys(by)
    x = F.col(col).cast("double")
    src = df.where(x.isNotNull() & ~F.isnan(x))
    if lo is not None:
        src = src.where(x >= lo)
    if hi is not None:
        src = src.where(x <= hi)
    src = src.select(*keys, x.alias("_x"))
    stats = src.groupBy(*keys).agg(F.count("_x").alias("_n"), F.stddev_samp("_x").alias("_sd"),
                                   F.min("_x").alias("_min"), F.max("_x").alias("_max")).where(F.col("_n") > 0)
    quartiles = quantile_columns(src, "_x", {"_q1": 0.25, "_q3": 0.75}, keys)
    stats = on_keys(stats, cut_lineage(quartiles), keys)
    stats = cut_lineage(stats.select(*keys, "_n", "_min", "_max", bandwidth_nrd0(
        F.coalesce(F.col("_sd"), F.lit(0.0)), F.col("_q1"), F.col("_q3"), F.col("_n")).alias("bw")))
    start = F.col("_min") - (cut + MARGIN) * F.col("bw")
    step = (F.col("_max") - F.col("_min") + 2 * (cut + MARGIN) * F.col("bw")) / (bins - 1)
    j = on_keys(src, stats, keys).withColumn("_pos", (F.col("_x") - start) / step) \
        .withColumn("_bin", F.least(F.floor("_pos").cast("int"), F.lit(bins - 2)))
    right = F.col("_pos") - F.col("_bin")
    two = F.explode(F.array(F.struct(F.col("_bin").alias("b"), (1 - right).alias("w")),
                            F.struct((F.col("_bin") + 1).alias("b"), right.alias("w")))).alias("_two")
    group = [*keys, "_n", "_min", "_max", "bw"]
    weights = j.select(*group, two).groupBy(*group, F.col("_two.b").alias("_b")).agg(F.sum("_two.w").alias("_w"))
    packed = weights.groupBy(*group).agg(F.collect_list(F.struct("_b", "_w")).alias("_l")).select(
        *group, F.col("_l._b").alias("_bins"), F.col("_l._w").alias("_weights"))
    kept = StructType([f for f in packed.schema.fields if f.name in keys])
    out = packed.mapInPandas(_convolved(points, bins, cut), StructType(
        [*kept.fields, StructField("_xs", ArrayType(DoubleType())), StructField("_ys", ArrayType(DoubleType()))]))
    ship_package(df.sparkSession)
    return out.select(*keys, F.posexplode(F.arrays_zip("_xs", "_ys")).alias("i", "_p")).select(
        *keys, "i", F.col("_p._xs").alias("x"), F.col("_p._ys").alias("density"))


def normal_overlay(df: DataFrame, col: str, by: str | Sequence[str] | None = None, points: int = 100,
                   spread: float = 3.0) -> DataFrame:
    """Normal curve with the sample mean and sd over ``mean +- spread sd``."""
    from tessera.functions.columns import normal_pdf
    keys = _keys(by)
    x = F.col(col).cast("double")
    stats = df.groupBy(*keys).agg(F.avg(x).alias("mu"), F.stddev_samp(x).alias("sigma"))
    g = grid(stats, F.col("mu") - spread * F.col("sigma"), F.col("mu") + spread * F.col("sigma"), points)
    return g.select(*keys, "i", "x", normal_pdf(F.col("x"), F.col("mu"), F.col("sigma")).alias("density"))


def trend(df: DataFrame, x: str, y: str, by: str | Sequence[str] | None = None, span: float = 0.75,
          vertices: int = 17) -> DataFrame:
    """Mean of ``y`` at each ``x``, the least-squares line and the loess curve through the data, per facet.

    The curve is ``smoothing.local_regression`` with ``span`` and ``vertices``.
    Output ``(by.., x, n, mean_y, fitted, smooth)``.
    """
    keys = _keys(by)
    src = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    line = src.groupBy(*keys).agg(F.regr_slope(y, x).alias("_slope"), F.regr_intercept(y, x).alias("_icpt"))
    means = src.groupBy(*keys, x).agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean_y"))
    j = means.crossJoin(F.broadcast(line)) if not keys else means.join(checked_broadcast(line), keys)
    j = j.select(*keys, x, "n", "mean_y", (F.col("_icpt") + F.col("_slope") * F.col(x)).alias("fitted"))
    return smoothed(j, local_regression(src, x, y, keys, span, vertices), x, keys)
