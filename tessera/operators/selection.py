"""Exact order statistics of many groups by rounds of narrowing, without sorting or shuffling the rows.

A round estimates quantile cells of each group by a mergeable sketch, counts
exactly how many values lie below, on and inside the few cells around each
wanted rank, and goes on with the values strictly inside. A value that many
rows share ends up on a cell's edge and is settled by its count, so neither a
column of distinct values nor one dominated by a single value puts more than
``finish`` values of a group into one task. The estimate only decides how
fast a round narrows: ranks it misses are looked for on the other side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

CELLS, ACCURACY, FINISH = 512, 5000, 20_000
MAX_BROADCAST_ROWS = 1_000_000


def on_keys(rows: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the columns of their group; null keys are equal. ``groups`` is written, so counting it is cheap."""
    few = groups.count() <= MAX_BROADCAST_ROWS
    named = groups.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                          *[c for c in groups.columns if c not in keys])
    side = F.broadcast(named) if few else named
    if not keys:
        return rows.crossJoin(side)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return rows.join(side, same).drop(*[f"_k{i}" for i in range(len(keys))])


def _cells(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    grid = [i / CELLS for i in range(CELLS + 1)]
    return rows.groupBy(*keys).agg(F.count("_x").alias("_n"), F.percentile_approx("_x", grid, ACCURACY).alias("_cells"))


def _bounds(rank: Column, i: int) -> list[Column]:
    """The cell edges around a rank, one cell further on either side."""
    at = F.floor(rank * CELLS / F.col("_n")).cast("int")
    return [F.col("_cells")[F.greatest(at - 1, F.lit(0))].alias(f"_lo{i}"),
            F.col("_cells")[F.least(at + 2, F.lit(CELLS))].alias(f"_hi{i}")]


def _counted(rows: DataFrame, groups: DataFrame, keys: Sequence[str], m: int) -> DataFrame:
    """``groups`` with the exact number of values below, on and between each of the ``m`` pairs of bounds."""
    x = F.col("_x")
    joined = on_keys(rows, groups, keys)
    aggs = [F.first(c).alias(c) for c in groups.columns if c not in keys]
    for i in range(m):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        aggs += [F.count_if(x < lo).alias(f"_below{i}"), F.count_if(x == lo).alias(f"_at{i}"),
                 F.count_if((x > lo) & (x < hi)).alias(f"_in{i}"), F.count_if((x == hi) & (hi > lo)).alias(f"_top{i}")]
    return cut_lineage(joined.groupBy(*keys).agg(*aggs))


def _settled(rank: Column, i: int) -> list[Column]:
    """The value at ``rank`` if it is a bound; else the open interval that holds it, its size and the rank inside."""
    lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
    a = F.col(f"_below{i}")
    b = a + F.col(f"_at{i}")
    c = b + F.col(f"_in{i}")
    d = c + F.col(f"_top{i}")
    none = F.lit(None).cast("double")
    return [F.when((rank >= a) & (rank < b), lo).when((rank >= c) & (rank < d), hi).alias("_value"),
            F.when(rank < a, none).when(rank < b, none).when(rank < c, lo).otherwise(hi).alias("_lo"),
            F.when(rank < a, lo).when(rank < c, hi).otherwise(none).alias("_hi"),
            F.when(rank < a, rank).when(rank < c, rank - b).otherwise(rank - d).cast("long").alias("_rank"),
            F.when(rank < a, a).when(rank < c, F.col(f"_in{i}")).otherwise(F.col("_n") - d).cast("long").alias("_size")]


def _inside(rows: DataFrame, open_: DataFrame, keys: Sequence[str]) -> DataFrame:
    x, lo, hi = F.col("_x"), F.col("_lo"), F.col("_hi")
    joined = on_keys(rows, open_, keys)
    return joined.where((lo.isNull() | (x > lo)) & (hi.isNull() | (x < hi)))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    finish: int = FINISH) -> DataFrame:
    """Interpolated quantiles (as numpy's default) per group: ``(by.., p, value)``, ``value`` as double.

    Nulls are left out, NaN counts as the largest value, a null key is a
    group of its own, a group without a value gives no rows. ``df`` is read
    three times, and in each further round only what is left of it. The
    driver gets one number a round: the size of the largest open interval.
    """
    keys, m = list(by), len(probs)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_x"))
    place = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    groups = _cells(rows, keys).where(F.col("_n") > 0).select(
        "*", *[b for i, h in enumerate(place) for b in _bounds(F.floor(h), i)]).drop("_cells")
    counted = _counted(rows, cut_lineage(groups), keys, m)
    wanted = []
    for i, (p, h) in enumerate(zip(probs, place)):
        for side, rank in enumerate((F.floor(h), F.least(F.floor(h) + 1, F.col("_n") - 1))):
            wanted.append(F.struct(F.lit(float(p)).alias("p"), (h - F.floor(h)).alias("_frac"), F.lit(side).alias("_side"),
                                   *_settled(rank, i)))
    found = counted.select(*keys, F.explode(F.array(*wanted)).alias("_t")).select(*keys, "_t.*")
    return _finished(rows, found, keys, value, finish)


def _finished(rows: DataFrame, found: DataFrame, keys: list[str], value: str, finish: int) -> DataFrame:
    """The quantiles, from what the first count settled and the ``rows`` that may lie in its open intervals."""
    own = [*keys, "p", "_side"]
    done = found.where(F.col("_value").isNotNull()).select(*own, "_frac", "_value")
    left = found.where(F.col("_value").isNull()).drop("_value")
    inside = _inside(rows, left, keys)
    while (left.agg(F.max("_size")).head()[0] or 0) > finish:
        inside = cut_lineage(inside.select(*own, "_frac", "_rank", "_x"))
        ranked = inside.groupBy(*own).agg(F.first("_frac").alias("_frac"), F.first("_rank").alias("_rank"))
        groups = on_keys(_cells(inside, own), cut_lineage(ranked), own)
        groups = cut_lineage(groups.select("*", *_bounds(F.col("_rank"), 0)).drop("_cells"))
        found = _counted(inside.select(*own, "_x"), groups, own, 1).select(*own, "_frac", *_settled(F.col("_rank"), 0))
        done = done.unionByName(found.where(F.col("_value").isNotNull()).select(*own, "_frac", "_value"))
        left = found.where(F.col("_value").isNull()).drop("_value")
        inside = _inside(inside.select(*own, "_x"), left, own)
    last = inside.groupBy(*own).agg(F.first("_frac").alias("_frac"), F.first("_rank").alias("_rank"),
                                    F.sort_array(F.collect_list("_x")).alias("_xs"))
    done = done.unionByName(last.select(*own, "_frac", F.get("_xs", F.col("_rank").cast("int")).alias("_value")))
    a, b = F.max(F.when(F.col("_side") == 0, F.col("_value"))), F.max(F.when(F.col("_side") == 1, F.col("_value")))
    return done.groupBy(*keys, "p", "_frac").agg(a.alias("_a"), b.alias("_b")).select(
        *keys, "p", F.when((F.col("_a") == F.col("_b")) | (F.col("_frac") == 0), F.col("_a")).otherwise(
            F.col("_a") + F.col("_frac") * (F.col("_b") - F.col("_a"))).alias(value))


STRIDE, CHUNK = 128, 131_072


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], finish: int = FINISH) -> DataFrame:
    """``exact_quantiles`` of several columns, ``(column, p, value)``, without a row per value.

    The cells come from each 128th value of sorted chunks of the columns; one
    aggregate over the columns side by side counts around the ranks. Only the
    values inside open intervals become rows. The driver gets some numbers a
    column.
    """
    m = len(probs)
    rows = df.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)])

    def points(some: list[pa.RecordBatch]) -> pa.RecordBatch:
        values = [np.sort(np.concatenate([b.column(i).drop_null().to_numpy(zero_copy_only=False) for b in some])) for i in range(len(cols))]
        kept = [v[len(v) % STRIDE // 2::STRIDE] for v in values]
        return pa.RecordBatch.from_arrays([pa.array(range(len(cols)), pa.int32()), pa.array([len(v) for v in values], pa.int64()),
                                           pa.array(kept, pa.list_(pa.float64()))], ["_i", "_k", "_points"])

    def sketch(batches):
        some, n = [], 0
        for batch in batches:
            some.append(batch)
            n += batch.num_rows
            if n >= CHUNK:
                yield points(some)
                some, n = [], 0
        if n:
            yield points(some)

    sketched = cut_lineage(rows.mapInArrow(sketch, "_i int, _k long, _points array<double>"))
    sizes = {r["_i"]: r["_n"] for r in sketched.groupBy("_i").agg(F.sum("_k").alias("_n")).collect() if r["_n"]}
    cells = {r["_i"]: r["_cells"] for r in _cells(sketched.select("_i", F.explode("_points").alias("_x")), ["_i"]).collect()}
    bounds = {}
    for i, n in sizes.items():
        for j, p in enumerate(probs):
            at = math.floor(math.floor(p * (n - 1)) * CELLS / n)
            bounds[i, j] = cells[i][max(at - 1, 0)], cells[i][min(at + 2, CELLS)]
    counts = {}
    for few in (list(sizes)[k:k + 4] for k in range(0, len(sizes), 4)):
        aggs = []
        for i, j in ((i, j) for i in few for j in range(m)):
            x, lo, hi = F.col(f"_x{i}"), F.lit(bounds[i, j][0]), F.lit(bounds[i, j][1])
            aggs += [F.count_if(x < lo), F.count_if(x == lo), F.count_if((x > lo) & (x < hi)), F.count_if((x == hi) & (hi > lo))]
        row = rows.agg(*[a.alias(f"_a{k}") for k, a in enumerate(aggs)]).first()
        counts |= {(i, j): row[4 * k:4 * k + 4] for k, (i, j) in enumerate((i, j) for i in few for j in range(m))}
    found = []
    for (i, j), (below, at_lo, inside, at_hi) in counts.items():
        (lo, hi), n, h = bounds[i, j], sizes[i], probs[j] * (sizes[i] - 1)
        b, c, d = below + at_lo, below + at_lo + inside, below + at_lo + inside + at_hi
        for side, rank in enumerate((math.floor(h), min(math.floor(h) + 1, n - 1))):
            settled = lo if below <= rank < b else hi if c <= rank < d else None
            rest = (None, lo, rank, below) if rank < below else (lo, hi, rank - b, inside) if rank < c else (hi, None, rank - d, n - d)
            found.append((cols[i], float(probs[j]), h - math.floor(h), side, settled, *rest))
    left = {}
    for name, _, _, _, settled, lo, hi, _, _ in found:
        if settled is None:
            left.setdefault(name, []).append((lo, hi))
    spark = df.sparkSession
    inside = spark.createDataFrame([], "column string, _x double")
    for name, ranges in left.items():
        x = F.col(f"_x{list(cols).index(name)}")
        some = [(F.lit(True) if lo is None else x > lo) & (F.lit(True) if hi is None else x < hi) for lo, hi in ranges]
        inside = inside.union(rows.where(x.isNotNull() & reduce(lambda a, b: a | b, some)).select(F.lit(name), x))
    found = cut_lineage(spark.createDataFrame(
        found, "column string, p double, _frac double, _side int, _value double, _lo double, _hi double, _rank long, _size long"))
    return _finished(inside, found, ["column"], "value", finish)


def quantile_columns(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """``exact_quantiles`` as one row per group with a column per name of ``probs``."""
    long = exact_quantiles(df, value, list(probs.values()), by)
    return long.groupBy(*by).agg(*[F.max(F.when(F.col("p") == F.lit(float(p)), F.col(value))).alias(name)
                                   for name, p in probs.items()])
