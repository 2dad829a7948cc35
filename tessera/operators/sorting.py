"""Sort, limit and top-k.

A global ``orderBy().limit(k)`` becomes ``TakeOrderedAndProject``: each task
keeps its own k best rows and only those reach the final merge, so the cost
is one scan with no full sort. Every order given by a caller should end in a
unique key (T13); ``order_with_tie_key`` adds one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_with_tie_key(order: Sequence[Column], tie_keys: Sequence[str]) -> list[Column]:
    """Order columns followed by ascending tie keys (nulls last, as SQL engines differ)."""
    return list(order) + [F.col(k).asc_nulls_last() for k in tie_keys]


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows in ``order`` (``show(n)``, ``limit(n)`` in the reference)."""
    return df.orderBy(*order).limit(k)


def head(df: DataFrame, order_key: str, n: int) -> DataFrame:
    """First ``n`` rows by an order key (pandas ``head`` relies on file order)."""
    return df.orderBy(F.col(order_key).asc_nulls_last()).limit(n)


def tail(df: DataFrame, order_key: str, n: int) -> DataFrame:
    """Last ``n`` rows by an order key."""
    return df.orderBy(F.col(order_key).desc_nulls_first()).limit(n)


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                    rank_name: str = "rank", spread: int = 32) -> DataFrame:
    """Best ``k`` rows of every group, with their rank 1..k.

    Two steps so that one large group never lands whole in one task: rows are
    first ranked within ``(keys, hash bucket)`` (a group is spread over
    ``spread`` buckets) and cut to ``k``; the survivors, at most ``k * spread``
    per group, are ranked again within the group. ``order`` should end in a
    unique column so ranks are deterministic.
    """
    keys = list(keys)
    bucket = F.pmod(F.xxhash64(*[c for c in df.columns if c not in keys]), F.lit(spread))
    w1 = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    pre = (df.withColumn("_bucket", bucket)
           .withColumn("_r1", F.row_number().over(w1))
           .where(F.col("_r1") <= k).drop("_r1", "_bucket"))
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return pre.withColumn(rank_name, F.row_number().over(w2)).where(F.col(rank_name) <= k)


def _range_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str], partitions: int | None) -> DataFrame:
    """Range-partition on ``(keys, order)`` and record the partition id.

    The result is checkpointed (reliably, in ``spark.checkpoint.dir``): the
    partition ids come from sampled range bounds, and both branches that use
    them (numbering and offsets) must see the same assignment. The
    checkpoint also cuts the lineage, so a lost executor does not redo the
    sort.
    """
    from tessera.session import cut_lineage
    # without an explicit count AQE may merge adjacent ranges to fit the data
    parted = (df.repartitionByRange(partitions, *keys, *order) if partitions
              else df.repartitionByRange(*keys, *order))
    return cut_lineage(parted.withColumn("_pid", F.spark_partition_id()))


def position_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "pos",
                    partitions: int | None = None, as_type: str = "int") -> DataFrame:
    """1-based position of each row within its key, in ``order`` (a unique order).

    Equivalent to ``row_number() over (partition by keys order by order)``
    without putting a whole key into one task: rows are range-partitioned on
    ``(keys, order)``, so a hot key is spread over several partitions; rows are
    numbered inside each (partition, key) piece, and each piece is offset by
    the row counts of the same key in earlier partitions (a small table of at
    most one row per partition and key).
    """
    keys, order = list(keys), list(order)
    s = _range_parts(df, keys, order, partitions)
    local = F.row_number().over(Window.partitionBy("_pid", *keys).orderBy(*order))
    pieces = s.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("_pid", *keys, F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    return (s.withColumn("_local", local).join(offsets, ["_pid", *keys])
            .withColumn(name, (F.col("_off") + F.col("_local")).cast(as_type)).drop("_pid", "_local", "_off"))


def running_sum_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column | str,
                       name: str = "running_sum", partitions: int | None = None) -> DataFrame:
    """Cumulative sum of ``value`` within each key in ``order``, with the same
    range-partition-and-offset plan as ``position_within``."""
    keys, order = list(keys), list(order)
    v = F.col(value) if isinstance(value, str) else value
    s = _range_parts(df.withColumn("_v", v), keys, order, partitions)
    local = F.sum("_v").over(Window.partitionBy("_pid", *keys).orderBy(*order)
                             .rowsBetween(Window.unboundedPreceding, 0))
    pieces = s.groupBy("_pid", *keys).agg(F.sum("_v").alias("_tot"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("_pid", *keys, F.coalesce(F.sum("_tot").over(before), F.lit(0.0)).alias("_off"))
    return (s.withColumn("_local", local).join(offsets, ["_pid", *keys])
            .withColumn(name, F.col("_off") + F.col("_local")).drop("_pid", "_local", "_off", "_v"))
