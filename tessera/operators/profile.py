"""Column profiling: nulls, distinct values, value counts,
least and most frequent values, extremes, describe, schema report.

Every function is one declarative plan. Several columns are profiled in one
scan: they are unpivoted to ``(column, value)`` and grouped once, instead of
one job per column as in the reference.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.selection import exact_quantiles
from tessera.operators.sorting import top_k_per_group

# ---------------------------------------------------------------- schema ---


def schema_report(df: DataFrame) -> DataFrame:
    """``(column, position, type, rows)``: names and types with the row count.

    The row count is an aggregate joined to the (tiny) list of columns; the
    list itself comes from the schema, not from the data.
    """
    spark = df.sparkSession
    cols = spark.createDataFrame([(name, i, dtype) for i, (name, dtype) in enumerate(df.dtypes)],
                                 "column string, position int, type string")
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    return cols.crossJoin(F.broadcast(rows))


def feature_list(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Names of all columns but ``exclude``."""
    ex = {e.lower() for e in exclude}
    return [c for c in df.columns if c.lower() not in ex]


# ----------------------------------------------------------- null/distinct --

def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row, one column per input column: number of nulls; one pass."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def any_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: does the column hold a null."""
    cols = list(cols or df.columns)
    return df.agg(*[F.bool_or(F.col(c).isNull()).alias(c) for c in cols])


def any_equal(df: DataFrame, c: str, value, name: str | None = None) -> DataFrame:
    """One row: 1 if any value equals ``value`` else 0 (T29)."""
    return df.agg(F.max(F.when(F.col(c) == value, 1).otherwise(0)).alias(name or f"{c}_any_{value}"))


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """One row: distinct non-null values per column.

    ``approx=True`` uses HyperLogLog++ (fixed memory per column) for tables
    where exact distinct counts would shuffle every distinct value.
    """
    cols = list(cols or df.columns)
    if approx:
        return df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in cols])
    return df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in cols])


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    """``unique()``: the distinct values of a column, null included."""
    return df.select(c).distinct()


# ---------------------------------------------------------- value counts ---

def value_counts(df: DataFrame, c: str, name: str = "count", dropna: bool = True) -> DataFrame:
    """Count per value (``value_counts()``, ``table()``); nulls dropped unless ``dropna=False``.

    The result is unordered; callers sort at the end (T17).
    """
    src = df.where(F.col(c).isNotNull()) if dropna else df
    return src.groupBy(c).agg(F.count(F.lit(1)).alias(name))


def group_counts(df: DataFrame, keys: str | Sequence[str], name: str = "Total",
                 count_col: str | None = None) -> DataFrame:
    """``groupBy(keys).agg(count(lit(1)))`` or ``count(col)`` (T15); the null group is kept."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    counted = F.col(count_col) if count_col else F.lit(1)
    return df.groupBy(*keys).agg(F.count(counted).alias(name))


def least_frequent(df: DataFrame, c: str, k: int, name: str = "Total") -> DataFrame:
    """The ``k`` least frequent values with their counts; ties by value (T13)."""
    g = group_counts(df, c, name)
    return g.orderBy(F.col(name).asc(), F.col(c).asc_nulls_last()).limit(k)


def most_frequent(df: DataFrame, c: str, k: int, name: str = "Total") -> DataFrame:
    """The ``k`` most frequent values with their counts; ties by value (T13)."""
    g = group_counts(df, c, name)
    return g.orderBy(F.col(name).desc(), F.col(c).asc_nulls_last()).limit(k)


def extremes(df: DataFrame, cols: Sequence[str], name: str = "Total") -> DataFrame:
    """Least and most frequent value of each column with its count, one row.

    Replaces four ``orderBy().first()`` driver round trips by ``min`` over
    ``struct(count, value)`` per column. Ties go to the smaller value, a
    present value before null.
    """
    out = None
    for c in cols:
        g = df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        v = F.col(c)
        lo = F.struct(F.col("n").alias("n"), v.isNull().alias("isnull"), v.alias("v"))
        hi = F.struct(F.negative(F.col("n")).alias("neg"), v.isNull().alias("isnull"), v.alias("v"),
                      F.col("n").alias("n"))
        r = g.agg(F.min(lo).alias("lo"), F.min(hi).alias("hi")).select(
            F.col("lo.v").alias(f"least_{c}"), F.col("lo.n").alias(f"least_{c}_{name}"),
            F.col("hi.v").alias(f"most_{c}"), F.col("hi.n").alias(f"most_{c}_{name}"))
        out = r if out is None else out.crossJoin(r)
    return out


def profile_columns(df: DataFrame, ks: Mapping[str, int]) -> DataFrame:
    """Nulls, distinct count, k least and k most frequent values for several columns.

    Output ``(column, kind, rank, value, total)``: ``kind`` is ``nulls`` or
    ``distinct`` (``total`` holds the number), ``least`` or ``most`` (``rank``
    1..k, ``value`` as text, ``total`` its count, null value included). One
    scan and one shuffle for all columns: the columns are unpivoted to text
    and grouped by ``(column, value)``; top-k per column is bounded per task.
    """
    cols = list(ks)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("kv")).select("kv.column", "kv.value")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("total"))
    summary = counts.groupBy("column").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("total")).otherwise(F.lit(0))).cast("long").alias("nulls"),
        F.count("value").alias("distinct"))
    scalar = summary.select("column", F.explode(F.array(
        F.struct(F.lit("nulls").alias("kind"), F.col("nulls").alias("total")),
        F.struct(F.lit("distinct").alias("kind"), F.col("distinct").alias("total")))).alias("s")) \
        .select("column", "s.kind", F.lit(None).cast("int").alias("rank"),
                F.lit(None).cast("string").alias("value"), "s.total")
    kcol = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(int(ks[c])))])
    with_k = counts.withColumn("k", kcol[F.col("column")])
    least = top_k_per_group(with_k, ["column"], [F.col("total").asc(), F.col("value").asc_nulls_last()],
                            max(ks.values()), rank_name="rank")
    most = top_k_per_group(with_k, ["column"], [F.col("total").desc(), F.col("value").asc_nulls_last()],
                           max(ks.values()), rank_name="rank")
    least = least.where(F.col("rank") <= F.col("k")).select(
        "column", F.lit("least").alias("kind"), "rank", "value", "total")
    most = most.where(F.col("rank") <= F.col("k")).select(
        "column", F.lit("most").alias("kind"), "rank", "value", "total")
    return scalar.unionByName(least).unionByName(most)


# ---------------------------------------------------------------- describe --

DESCRIBE_STATS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")


def describe(df: DataFrame, cols: Sequence[str], method: str = "exact", accuracy: int = 10000,
             by: str | None = None, digits: int | None = None) -> DataFrame:
    """count, mean, sample sd, min, quartiles, max per column, long ``(column, stat, value)``.

    Quartiles are interpolated as pandas does. ``method``: ``'exact'`` narrows
    to the wanted ranks by counting (``selection.exact_quantiles``; any
    cardinality and group size); ``'approx'`` uses ``percentile_approx`` in
    fixed memory. ``digits`` rounds the values (display precision).
    """
    keys = [by] if by else []
    method = "exact" if method == "ranked" else method  # an earlier name
    if method not in ("exact", "approx"):
        raise ValueError("method is 'exact' or 'approx'")
    # built as SQL text: one call to the JVM per column
    aggs = []
    for i, c in enumerate(cols):
        x = f"CAST(`{c}` AS DOUBLE)"
        fields = [f"CAST(count({x}) AS DOUBLE) AS `count`", f"avg({x}) AS mean", f"stddev_samp({x}) AS std",
                  f"min({x}) AS `min`", f"max({x}) AS `max`"]
        if method == "approx":
            fields.append(f"percentile_approx({x}, array(0.25D, 0.5D, 0.75D), {int(accuracy)}) AS q")
        aggs.append(F.expr(f"struct({', '.join(fields)}) AS `_s{i}`"))
    wide = df.groupBy(*keys).agg(*aggs)
    parts = []
    for i, c in enumerate(cols):
        items = [("count", f"_s{i}.`count`"), ("mean", f"_s{i}.mean"), ("std", f"_s{i}.std"), ("min", f"_s{i}.`min`")]
        if method == "approx":
            items += [("25%", f"_s{i}.q[0]"), ("50%", f"_s{i}.q[1]"), ("75%", f"_s{i}.q[2]")]
        items.append(("max", f"_s{i}.`max`"))
        name = c.replace("'", "\\'")
        for stat, expr in items:
            v = f"CAST({expr} AS DOUBLE)"
            v = f"round({v}, {digits})" if digits is not None else v
            parts.append(f"named_struct('column', '{name}', 'stat', '{stat}', 'value', {v})")
    key_sql = [f"`{k}`" for k in keys]
    out = wide.selectExpr(*key_sql, f"explode(array({', '.join(parts)})) AS d").selectExpr(*key_sql, "d.*")
    if method == "exact":
        q = exact_quantiles(unpivot_values(df, cols, keys), "value", [0.25, 0.5, 0.75], [*keys, "column"])
        v = F.col("value")
        q = q.select(*keys, "column", F.concat((F.col("p") * 100).cast("int").cast("string"), F.lit("%")).alias("stat"),
                     (F.round(v, digits) if digits is not None else v).alias("value"))
        # a column (of a group) without a value has quartiles too: null
        empty = out.where(F.col("stat") == "count").where(F.col("value") == 0).select(
            *keys, "column", F.explode(F.array(*[F.lit(x) for x in ("25%", "50%", "75%")])).alias("stat"),
            F.lit(None).cast("double").alias("value"))
        out = out.unionByName(q).unionByName(empty)
    return out


def unpivot_values(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``(keys.., column, value)``: one row per non-null value of each column, as double."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value"))
                                for c in cols])).alias("kv")
    return df.select(*keys, pairs).select(*keys, "kv.column", "kv.value").where(F.col("value").isNotNull())
