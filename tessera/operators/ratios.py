"""Shares, rates, co-occurrence, correlation and pivots.

The reference computes a total with a driver-side ``count()`` and writes it
into a second plan as a constant. Here the total is a
window sum over the already aggregated rows (one row per group), so the base
is scanned once and nothing comes back to the driver.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import percent, safe_corr
from tessera.session import cut_lineage


def _round(c: Column, digits: int | None, rounding: str) -> Column:
    if digits is None:
        return c
    return F.bround(c, digits) if rounding == "even" else F.round(c, digits)


def share_by(df: DataFrame, keys: str | Sequence[str], *, where: Column | None = None,
             count_col: str | None = None, denominator: str = "all", name: str = "n",
             pct_name: str = "ratio", digits: int | None = 1, rounding: str = "up",
             total: str = "aggregate") -> DataFrame:
    """Count per group and its percentage of a total.

    ``where`` restricts the counted rows (groups without such rows are left
    out, as a filter before ``groupBy`` would). ``count_col`` counts non-null
    values of that column instead of rows (T15). ``denominator``: ``'all'``
    divides by all rows of ``df`` (T16, the reference's ``count()`` of the
    whole table), ``'counted'`` by the sum of the group counts.

    ``total='aggregate'`` computes the total as a one-row aggregate of the
    group counts, joined back by broadcast; the counts are written first, or
    the total, which needs fewer columns, would count the whole table again. ``total='window'`` sums them with one window over all groups, in
    one task: only for few groups.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cond = where if where is not None else F.lit(True)
    counted = F.col(count_col) if count_col else F.lit(1)
    g = df.groupBy(*keys).agg(
        F.count(F.when(cond, counted)).alias(name),
        F.count_if(cond).alias("_rows"),
        F.count(F.lit(1)).alias("_all"))
    total_src = "_all" if denominator == "all" else name
    if denominator not in ("all", "counted"):
        raise ValueError("denominator is 'all' or 'counted'")
    if total == "window":
        with_total = g.withColumn("_total", F.sum(total_src).over(Window.partitionBy()))
    else:
        g = cut_lineage(g)
        with_total = g.crossJoin(F.broadcast(g.agg(F.sum(total_src).alias("_total"))))
    return (with_total.where(F.col("_rows") > 0)
            .select(*keys, name, _round(percent(name, "_total"), digits, rounding).alias(pct_name)))


def share_of_group(df: DataFrame, keys: Sequence[str], part_key: str, *, where: Column | None = None,
                   name: str = "n", total_name: str = "total", pct_name: str = "ratio",
                   count_col: str | None = None, total_count_col: str | None = None,
                   digits: int | None = 2) -> DataFrame:
    """Count by ``keys + [part_key]`` and its percentage of the ``keys`` group total.

    The numerator counts rows meeting ``where`` (non-null ``count_col`` if
    given); the group total counts all rows of the group (non-null
    ``total_count_col`` if given). The total is a window sum, partitioned by
    the group key, over the fine counts (one row per part), so the base is
    scanned once. Groups with a null key drop out, as the reference's inner
    join does.
    """
    keys = list(keys)
    cond = where if where is not None else F.lit(True)
    counted = F.col(f"`{count_col}`") if count_col else F.lit(1)
    total_counted = F.col(f"`{total_count_col}`") if total_count_col else F.lit(1)
    fine = df.groupBy(*keys, part_key).agg(F.count(F.when(cond, counted)).alias(name),
                                           F.count_if(cond).alias("_rows"),
                                           F.count(total_counted).alias("_grp"))
    with_total = fine.withColumn(total_name, F.sum("_grp").over(Window.partitionBy(*keys)))
    present = F.col("_rows") > 0
    for k in keys:
        present = present & F.col(f"`{k}`").isNotNull()
    return (with_total.where(present)
            .select(*keys, part_key, name, total_name,
                    _round(percent(name, total_name), digits, "up").alias(pct_name)))


def rate_by(df: DataFrame, keys: str | Sequence[str], cond: Column, *, name: str = "rate",
            count_name: str | None = None, total_name: str | None = None,
            digits: int | None = 1, rounding: str = "up") -> DataFrame:
    """Percentage of rows meeting ``cond`` within each group."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    aggs = [_round(F.avg(F.when(cond, 1).otherwise(0)) * 100, digits, rounding).alias(name)]
    if count_name:
        aggs.append(F.count_if(cond).alias(count_name))
    if total_name:
        aggs.append(F.count(F.lit(1)).alias(total_name))
    return df.groupBy(*keys).agg(*aggs)


def cooccurrence(df: DataFrame, cols: Sequence[str], threshold: float = 15,
                 names: Mapping[str, str] | None = None, sep: str = "-") -> DataFrame:
    """One row: for every pair of columns, rows where both reach ``threshold``.

    Pairs follow ``itertools.combinations`` order; one aggregate, one pass.
    """
    names = names or {c: c for c in cols}
    aggs = [F.count_if((F.col(a) >= threshold) & (F.col(b) >= threshold)).alias(f"{names[a]}{sep}{names[b]}")
            for a, b in itertools.combinations(cols, 2)]
    return df.agg(*aggs)


def corr_by(df: DataFrame, keys: str | Sequence[str], pairs: Mapping[str, tuple[str, str]],
            digits: int | None = 2, drop_undefined: bool = True) -> DataFrame:
    """Correlation of column pairs per group, undefined results removed.

    Zero variance or fewer than two pairs give null rather than an ANSI
    division error (T10); with ``drop_undefined`` groups with any null
    correlation are dropped, as the reference's ``!= 'NaN'`` filter does.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    aggs = [_round(safe_corr(x, y), digits, "up").alias(n) for n, (x, y) in pairs.items()]
    out = df.groupBy(*keys).agg(*aggs)
    if drop_undefined:
        for n in pairs:
            out = out.where(F.col(f"`{n}`").isNotNull() & ~F.isnan(F.col(f"`{n}`")))
    return out


def pivot_value(df: DataFrame, key: str | Sequence[str], pivot_col: str, values: Sequence,
                value_col: str, agg: str = "min") -> DataFrame:
    """``groupBy(key).pivot(col, values).<agg>(value)`` with the values given.

    Giving the values saves the extra job that finds them.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).pivot(pivot_col, list(values)).agg(getattr(F, agg)(value_col))


def weighted_totals(df: DataFrame, quantities: Mapping[str, str], price: str,
                    digits: int | None = 0) -> DataFrame:
    """One row: ``round(sum(quantity * price))`` for several quantities.

    Rounding is half to even, as numpy does for the reference's ``round``.
    """
    return df.agg(*[_round(F.sum(F.col(q) * F.col(price)), digits, "even").alias(n)
                    for n, q in quantities.items()])


def extreme_column(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Which column has the largest and which the smallest total, one row.

    The column totals are one aggregate; ``unpivot`` turns them into rows and
    ``min`` over ``struct(total, name)`` picks the names (T30); equal totals
    go to the first name in sort order.
    """
    sums = df.agg(*[F.sum(c).alias(c) for c in cols])
    long = sums.unpivot([], list(cols), "source", "total")
    hi = F.min(F.struct(F.negative("total").alias("k"), F.col("source").alias("s"), F.col("total").alias("t")))
    lo = F.min(F.struct(F.col("total").alias("k"), F.col("source").alias("s"), F.col("total").alias("t")))
    return long.agg(hi.alias("_hi"), lo.alias("_lo")).select(
        F.col("_hi.s").alias("highest_source"), F.col("_hi.t").alias("highest_total"),
        F.col("_lo.s").alias("lowest_source"), F.col("_lo.t").alias("lowest_total"))
