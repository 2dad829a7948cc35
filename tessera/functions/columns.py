"""Scalar column functions.

Everything here returns a ``Column`` (or a DataFrame built with one
``withColumns`` call), so it stays inside whole-stage code generation; no
Python runs per row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- casts ----

def cast_all(df: DataFrame, cols: Iterable[str], to: str | DataType) -> DataFrame:
    """Cast several columns at once; bad text becomes null (``try_cast``), not an error (T1)."""
    return df.withColumns({c: F.col(c).try_cast(to) for c in cols})


def cast_category(df: DataFrame, c: str, code_suffix: str = "_code") -> DataFrame:
    """Category type: keep the text and add a dense integer code in value order.

    The distinct values are numbered by ``sorting.position_within`` (range
    partitioned, so even a high-cardinality column is numbered in parallel)
    and joined back on the value.
    """
    from tessera.operators.sorting import position_within
    values = df.select(c).where(F.col(c).isNotNull()).distinct()
    codes = position_within(values, [], [c], name="_pos").select(
        c, (F.col("_pos") - 1).cast("int").alias(c + code_suffix))
    return df.join(codes, on=c, how="left")


# ---------------------------------------------------------- derived cols ---

def flag_present(df: DataFrame, cols: Sequence[str], threshold: float = 0,
                 suffix: str = "_present") -> DataFrame:
    """``c_present = 1 if c > threshold else 0`` for every column; null gives 0."""
    return df.withColumns({c + suffix: F.when(F.col(c) > threshold, F.lit(1)).otherwise(F.lit(0))
                           for c in cols})


def ratio_columns(df: DataFrame, cols: Sequence[str], total: str, prefix: str = "proportion_of_") -> DataFrame:
    """``prefix + c = c / total`` as double; division by zero gives null."""
    return df.withColumns({prefix + c: F.try_divide(F.col(c).cast("double"), F.col(total).cast("double"))
                           for c in cols})


def percent(num: Column | str, den: Column | str) -> Column:
    """``num / den * 100`` with a zero denominator giving null."""
    return F.try_divide(col_of(num).cast("double"), col_of(den).cast("double")) * F.lit(100.0)


# ------------------------------------------------------------ rounding -----

def round_half_up(c: Column | str, digits: int) -> Column:
    return F.round(col_of(c), digits)


def round_half_even(c: Column | str, digits: int) -> Column:
    return F.bround(col_of(c), digits)


# --------------------------------------------------------- value mapping ---

def map_values(c: Column | str, mapping: Mapping[object, object], default: object = None) -> Column:
    """Value -> class with a default, as one ``CASE``.

    The mapping is a small, fixed dictionary written into the plan; a
    mapping too large for that belongs in a lookup table joined instead.
    """
    c = col_of(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def replace_values(c: Column | str, old: Sequence[object], new: object) -> Column:
    """``np.where(x in old, new, x)``; null stays null."""
    c = col_of(c)
    return F.when(c.isin(*old), F.lit(new)).otherwise(c)


def cut_right(c: Column | str, edges: Sequence[float], labels: Sequence[str],
              include_lowest: bool = False) -> Column:
    """``pd.cut``: right-closed bins ``(e[i], e[i+1]]`` (T20).

    Values at or below the lowest edge, above the highest edge, or null give
    null, unless ``include_lowest`` closes the first bin on the left too.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    c = col_of(c)
    expr = None
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        lower = (c >= lo) if (i == 0 and include_lowest) else (c > lo)
        cond = lower & (c <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def discretize(c: Column | str, bins: Sequence[tuple[float, float]], names: Sequence[str]) -> Column:
    """Named bins given as ``(lo, hi)`` pairs.

    Bins are right-closed, ``(lo, hi]``, and the first bin also takes its low
    edge [choice, see SURVEY 2.9]. Values outside every bin give null.
    """
    if len(bins) != len(names):
        raise ValueError("need one name per bin")
    c = col_of(c)
    expr = None
    for i, ((lo, hi), name) in enumerate(zip(bins, names)):
        cond = ((c >= lo) if i == 0 else (c > lo)) & (c <= hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def ordered_classes(c: Column | str, rules: Sequence[tuple[Column, str]], otherwise: str | None) -> Column:
    """First matching rule wins, like an ``if / else if`` ladder (T21)."""
    expr = None
    for cond, label in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise)) if otherwise is not None else expr


# --------------------------------------------------------------- text -----

def word_count(c: Column | str) -> Column:
    """Words separated by white space, ignoring leading/trailing blanks (T23).

    ``'  a  b '`` has 2 words, ``''`` has 0, null stays null.
    """
    return F.size(F.regexp_extract_all(col_of(c), F.lit(r"\S+"), F.lit(0)))


# --------------------------------------------------------------- time -----

def to_timestamp_utc(c: Column | str, fmt: str | None = None) -> Column:
    """Parse text as a UTC wall-clock time (``pd.to_datetime(utc=True)``).

    The result is a ``timestamp_ntz``: the text is taken as UTC whatever the
    session time zone, so no local daylight-saving gap can shift it. Bad text
    gives null (validated with ``try_to_timestamp`` before the NTZ parse).
    """
    c = col_of(c)
    if not fmt:
        return c.try_cast("timestamp_ntz")
    return F.when(F.try_to_timestamp(c, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(c, F.lit(fmt)))


def calendar(df: DataFrame, ts: str) -> DataFrame:
    """day, month, year, hour, weekday (Monday = 0, T19), as pandas gives them."""
    t = F.col(ts)
    return df.withColumns({
        "day": F.dayofmonth(t), "month": F.month(t), "year": F.year(t),
        "hour": F.hour(t), "weekday": F.weekday(t),
    })


def weekend_flag(weekday_col: Column | str) -> Column:
    """True on Saturday and Sunday for a Monday = 0 weekday."""
    return col_of(weekday_col) > 4


def weekend_label(iso_dow: Column | str) -> Column:
    """6, 7 -> 'Weekend', anything else (null too) -> 'Weekday'."""
    c = col_of(iso_dow)
    return F.when(c.isin(6, 7), F.lit("Weekend")).otherwise(F.lit("Weekday"))


# Month -> season as in the energy study.
SEASON_MONTHS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}
SEASON_DEFAULT = "Fall"


def season(month_col: Column | str) -> Column:
    """Meteorological season of a month number; anything else (and null) is Fall."""
    m = col_of(month_col)
    expr = None
    for name, months in SEASON_MONTHS.items():
        expr = F.when(m.isin(*months), F.lit(name)) if expr is None else expr.when(m.isin(*months), F.lit(name))
    return expr.otherwise(F.lit(SEASON_DEFAULT))


# ---------------------------------------------------------------- math ----

def normal_pdf(x: Column | str, mu: Column | float, sigma: Column | float) -> Column:
    """Gaussian density ``dnorm(x, mu, sigma)``; null where sigma is 0."""
    x = col_of(x)
    mu = mu if isinstance(mu, Column) else F.lit(float(mu))
    sigma = sigma if isinstance(sigma, Column) else F.lit(float(sigma))
    z = F.try_divide(x - mu, sigma)
    return F.try_divide(F.exp(-0.5 * z * z), sigma * F.lit(math.sqrt(2 * math.pi)))


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation as an aggregate that gives null, not an error, on zero variance (T10)."""
    x, y = col_of(x), col_of(y)
    # like ``corr``, use only rows where both values are present
    xs = F.when(y.isNotNull(), x)
    ys = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_samp(xs, ys), F.stddev_samp(xs) * F.stddev_samp(ys))
