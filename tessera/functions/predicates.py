"""Row predicates built from Columns, so Catalyst can push them
into the Parquet scan and fold them."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.columns import col_of

_OPS = {
    ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
    "==": operator.eq, "!=": operator.ne,
}


def compare(c: Column | str, op: str, value) -> Column:
    """``c <op> value``; null compares to null, so the row is dropped by ``where``."""
    return _OPS[op](col_of(c), value)


def any_of(*conds: Column) -> Column:
    return functools.reduce(operator.or_, conds)


def all_of(*conds: Column) -> Column:
    return functools.reduce(operator.and_, conds)


def any_over(thresholds: Mapping[str, tuple[str, float]]) -> Column:
    """OR of per-column comparisons, e.g. ``{'ArrDelay': ('>=', 15), 'DepDelay': ('>', 0)}``."""
    return any_of(*[compare(c, op, v) for c, (op, v) in thresholds.items()])


def in_list(c: Column | str, values: Iterable) -> Column:
    return col_of(c).isin(*list(values))


def not_null(*cols: str) -> Column:
    return all_of(*[F.col(c).isNotNull() for c in cols])


def not_nan(c: Column | str) -> Column:
    """Present and not NaN (T11): ``c != 'NaN'`` in the reference drops both."""
    c = col_of(c)
    return c.isNotNull() & ~F.isnan(c)


def between(c: Column | str, lo, hi) -> Column:
    return col_of(c).between(lo, hi)
