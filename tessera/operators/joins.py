"""Joins.

The reference broadcasts its lookup tables by hand. A broadcast is
only safe for a side whose size is bounded, so the explicit hint here sits
behind a row-count check; a side above the bound is joined by shuffle (sort
merge), and AQE may still turn that into a broadcast at run time when the
shuffled side turns out small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup of one million narrow rows is some tens of MB: fine to ship to
# every executor. Anything above goes through a shuffle join.
DEFAULT_BROADCAST_MAX_ROWS = 1_000_000


_CHECKED: dict[tuple[str, int, int], bool] = {}


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    Runs one small job: ``limit(max_rows + 1)`` stops reading once the bound
    is passed, so a large table is not scanned in full. The answer is kept
    per application and semantic plan, so a lookup used by many queries is
    checked once.
    """
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), max_rows)
    if key not in _CHECKED:
        _CHECKED[key] = df.limit(max_rows + 1).count() <= max_rows
    return _CHECKED[key]


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` when its size is proven below the bound, else ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def lookup_join(fact: DataFrame, lookup: DataFrame, on: str | Sequence[str] | Column,
                how: str = "left", broadcast: str = "checked",
                max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Enrich ``fact`` with a lookup table.

    ``on`` is a shared key name / list (the key is kept once) or a join
    condition (both keys kept). ``broadcast``: ``'checked'`` hints a
    broadcast after the size check, ``'auto'`` leaves it to the planner's size
    estimate and AQE, ``'never'`` forces a shuffle join.
    """
    if broadcast == "checked":
        lookup = checked_broadcast(lookup, max_rows)
    elif broadcast == "never":
        lookup = lookup.hint("merge")
    elif broadcast != "auto":
        raise ValueError(f"unknown broadcast mode {broadcast!r}")
    return fact.join(lookup, on=on, how=how)


def join_aggregates(left: DataFrame, right: DataFrame, keys: str | Sequence[str],
                    how: str = "inner") -> DataFrame:
    """Join two aggregates of the same base on their group keys.

    Both sides are already one row per key, so neither side is skewed.
    """
    return left.join(right, on=keys, how=how)


def with_scalar(df: DataFrame, scalar: DataFrame) -> DataFrame:
    """Attach a one-row aggregate (e.g. a grand total) to every row.

    Replaces the reference's driver-side ``count()`` baked into a later plan
   : the one-row side is broadcast (its size is one row by
    construction) and nothing returns to the driver.
    """
    return df.crossJoin(F.broadcast(scalar))
