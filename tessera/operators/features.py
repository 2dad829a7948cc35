"""Feature preparation: one-hot, outliers, skewness, scaling,
stable splits, feature importance.

The reference's ``dataset`` helper library is not public, so each algorithm
is one documented definition [choice]. Column statistics are one row, bounded
by the number of columns: that of the fences is broadcast back to the rows, the
ranges go into the expressions as numbers, so these stay short enough to be
compiled however many columns there are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.selection import column_quantiles
from tessera.operators.sorting import top_k_per_group
from tessera.session import cut_lineage

# --------------------------------------------------------------- one-hot ---


def onehot(df: DataFrame, col: str, values: Sequence, prefix: str | None = None,
           drop: bool = True) -> DataFrame:
    """0/1 column ``<col>_<value>`` for every value.

    The values are given: a Spark plan needs its columns before it runs. Use
    ``category_values`` to find them (one small aggregate), or Spark ML's
    ``OneHotEncoder`` for a sparse vector when the category count is large.
    """
    p = prefix or col
    out = df.withColumns({f"{p}_{v}": F.when(F.col(col) == F.lit(v), 1).otherwise(0) for v in values})
    return out.drop(col) if drop else out


def category_values(df: DataFrame, col: str) -> list:
    """Sorted distinct non-null values of a categorical column (bounded by its cardinality)."""
    return [r[0] for r in df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col).collect()]


# --------------------------------------------------- statistics of columns ---

# columns of one aggregate and of one projection: Spark compiles no plans above 100 fields, the JVM no very long methods
AT_ONCE, SCALED_AT_ONCE = 8, 12


def _by_column(df: DataFrame, cols: Sequence[str], *stats: Callable[[Column], Column]) -> DataFrame:
    """One row with an array of the ``stats`` per column. Few columns make an aggregate, so each one is compiled and
    reads just its own columns of a stored table."""
    out = None
    for i in range(0, len(cols), AT_ONCE):
        part = df.agg(*[F.array(*[s(F.col(c).cast("double")) for s in stats]).alias(c) for c in cols[i:i + AT_ONCE]])
        out = part if out is None else out.crossJoin(F.broadcast(part))
    return out


def _ranges(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    """Smallest and largest value of each column, and whether they differ (NaN is above all numbers)."""
    row = _by_column(df, cols, F.min, F.max).select(
        *[F.struct(F.col(c)[0], F.col(c)[1], F.coalesce(F.col(c)[1] > F.col(c)[0], F.lit(False))).alias(c) for c in cols]).first()
    return {c: tuple(row[c]) for c in cols}


def _with_columns(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """``withColumns``, few at a time: the method Spark makes of dozens of expressions is too long for the JVM to compile.
    Between them a coalesce to more partitions than there are, which changes nothing but ends the method."""
    cols = list(exprs)
    for i in range(0, len(cols), SCALED_AT_ONCE):
        df = (df.coalesce(2 ** 30) if i else df).withColumns({c: exprs[c] for c in cols[i:i + SCALED_AT_ONCE]})
    return df


# -------------------------------------------------------------- outliers ---

def _column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: quartiles, min and max of every column."""
    aggs = [agg for c in cols for x in [F.col(c).cast("double")]
            for agg in (F.min(x).alias(f"_min_{c}"), F.max(x).alias(f"_max_{c}"))]
    q = column_quantiles(df, cols, [0.25, 0.75])

    def quartile(c: str, p: float) -> Column:
        return F.max(F.when((F.col("column") == c) & (F.col("p") == p), F.col("value")))

    wide = q.agg(*[F.array(quartile(c, 0.25), quartile(c, 0.75)).alias(f"_q_{c}") for c in cols])
    return df.agg(*aggs).crossJoin(F.broadcast(cut_lineage(wide)))


def outlier_flag(cols: Sequence[str], whisker: float = 1.5) -> Column:
    """True when any column lies beyond ``whisker * IQR`` of its box (needs ``_column_stats``)."""
    conds = []
    for c in cols:
        q1, q3 = F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[1]
        iqr = q3 - q1
        conds.append((F.col(c) < q1 - whisker * iqr) | (F.col(c) > q3 + whisker * iqr))
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return F.coalesce(out, F.lit(False))


def outlier_rows(df: DataFrame, cols: Sequence[str], id_col: str, whisker: float = 1.5) -> DataFrame:
    """Ids of rows with a value beyond the box-plot fences in any column [choice: 1.5 IQR]."""
    stats = _column_stats(df, cols)
    return df.crossJoin(F.broadcast(stats)).where(outlier_flag(cols, whisker)).select(id_col)


def drop_rows(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Remove rows by id: an anti join, by broadcast if the ids are few, else shuffled on the id (unique, so never skewed)."""
    return df.join(ids.select(id_col), on=id_col, how="left_anti")


# -------------------------------------------------------------- skewness ---

def skewness_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, skewness)`` for all columns from one aggregate."""
    wide = _by_column(df, cols, F.skewness)
    return wide.select(*[F.col(c)[0].alias(c) for c in cols]).unpivot([], list(cols), "column", "skewness")


def skewed(df: DataFrame, cols: Sequence[str], threshold: float = 0.75) -> DataFrame:
    """Columns whose absolute skewness exceeds ``threshold`` [choice: 0.75]."""
    return skewness_table(df, cols).where(F.abs(F.col("skewness")) > threshold)


def fix_skewness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``log1p(x - min)`` for the given columns: non-negative, order preserving [choice]."""
    if not cols:
        return df
    ranges = _ranges(df, cols)
    return _with_columns(df, {c: F.log1p(F.col(c).cast("double") - F.lit(ranges[c][0]).cast("double")) for c in cols})


# --------------------------------------------------------------- scaling ---

def minmax(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(x - min) / (max - min)``; a constant column becomes 0."""
    if not cols:
        return df
    scaled = {}
    for c, (lo, hi, varies) in _ranges(df, cols).items():
        x = F.col(c).cast("double")
        scaled[c] = (x - F.lit(lo)) / F.lit(hi - lo) if varies else F.when(F.col(c).isNotNull(), F.lit(0.0))
    return _with_columns(df, scaled)


def drop_constant(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Names of columns with a single value; one small aggregate to the driver."""
    row = constant_flags(df, cols).first()
    return [c for c in cols if row[c]]


def constant_flags(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: does the column hold at most one distinct value (nulls don't count); smallest and largest tell."""
    return df.agg(*[F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(c) for c in cols])


# ----------------------------------------------------------------- split ---

def hash_bucket(id_col: str, buckets: int = 100) -> Column:
    """Stable bucket of an id: first 8 hex digits of ``md5(id)`` modulo ``buckets``."""
    h = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(buckets))


def hash_split(df: DataFrame, id_col: str, test_fraction: float = 0.2, name: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Train/test split that does not move when the data is re-read or partitioned differently
   ; ``randomSplit`` depends on partitioning. ``name``: the column ``with_split`` wrote, so the ids aren't hashed again."""
    if name:
        is_test = F.when(F.col(id_col).isNotNull(), F.col(name) == "test")  # a row without an id is in neither, as by the hash
    else:
        is_test = hash_bucket(id_col) < int(round(test_fraction * 100))
    return df.where(~is_test), df.where(is_test)


def with_split(df: DataFrame, id_col: str, test_fraction: float = 0.2, name: str = "split") -> DataFrame:
    is_test = hash_bucket(id_col) < int(round(test_fraction * 100))
    return df.withColumn(name, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


# ------------------------------------------------------------ importance ---

def relieff(df: DataFrame, features: Sequence[str], label: str, id_col: str, anchors: int = 100,
            k: int = 10, digits: int = 9) -> DataFrame:
    """ReliefF feature weights (the reference imports ReliefF) [choice].

    ``anchors`` rows (the lowest ids: a deterministic sample of fixed size,
    taken with a bounded top-k) are compared with every row; features are
    scaled by their range and the distance is Manhattan, rounded to
    ``digits`` so that ties break the same way everywhere (then by id). For
    each anchor the ``k`` nearest rows of its own class (hits) and of the
    other class (misses) are found without forming all pairs: each task scores
    its rows against the fixed anchors with numpy, keeps its own k best per
    (anchor, hit) and gives them out when its rows are done; a bounded top-k
    over those candidates picks the final neighbours. The weight of a feature is the mean over anchors of
    ``mean |miss diff| - mean |hit diff|``. Cost is linear in the rows.
    Output ``(feature, importance)``.
    """
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    feats = list(features)
    rows = df.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS _id", f"CAST(`{label}` AS INT) AS _y",
                         *[f"CAST(`{f}` AS DOUBLE) AS `{f}`" for f in feats])
    ranges = _ranges(rows, feats)
    varies = [i for i, f in enumerate(feats) if ranges[f][2]]
    lo = np.array([ranges[feats[i]][0] for i in varies])
    width = np.array([ranges[feats[i]][1] for i in varies]) - lo

    def scaled(values: Sequence[np.ndarray], n: int) -> np.ndarray:
        x = np.zeros((n, len(feats)), order="F")
        for i, low, w in zip(varies, lo, width):
            x[:, i] = (values[i] - low) / w
        return x

    # the ids first: the features are then computed for few rows
    ids = [r[0] for r in rows.select("_id").orderBy("_id").limit(anchors).collect()]
    first = rows.where(F.col("_id").isNull() | (F.col("_id") <= F.lit(ids[-1]).cast("long"))) if ids else rows
    anchor_pdf = first.orderBy("_id").limit(anchors).toPandas()
    a_id = anchor_pdf["_id"].to_numpy()
    a_y = anchor_pdf["_y"].to_numpy()
    a_x = scaled([anchor_pdf[f].to_numpy(dtype=float) for f in feats], len(anchor_pdf))
    a_flag = ((a_x == 0) | (a_x == 1)).all(axis=0)
    n_feat = len(feats)

    def distances(x: np.ndarray) -> np.ndarray:
        """Of each row to each anchor. Columns of 0 and 1 on both sides in one matrix product of small whole numbers."""
        flags = a_flag & ((x == 0) | (x == 1)).all(axis=0)
        u, v = x[:, flags].astype(np.float32), a_x[:, flags].astype(np.float32)
        dist = (u.sum(axis=1)[:, None] + v.sum(axis=1)[None, :] - 2 * (u @ v.T)).astype(float)
        others = np.flatnonzero(~flags)
        for i in others:
            dist += np.abs(x[:, i, None] - a_x[None, :, i])
        return np.round(dist, digits) if others.size else dist

    def merged(best: tuple | None, new: tuple) -> tuple:
        d, ids, x = new if best is None else [np.concatenate(p) for p in zip(best, new)]
        first = np.lexsort((ids, d))[:k]
        return d[first], ids[first], x[first]

    def local_best(batches):
        best, last = {}, {}  # of an anchor and side: the nearest rows, the distance and id of the k-th
        for batch in batches:
            if not batch.num_rows:
                continue
            column = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
            ids, ys = column["_id"], column["_y"]
            x = scaled([column[f] for f in feats], batch.num_rows)
            dist = distances(x)
            for y in pd.unique(a_y):
                of = np.flatnonzero(a_y == y) if y == y else np.flatnonzero(a_y != a_y)
                for hit in (True, False):
                    own = np.flatnonzero((ys == y) == hit)
                    if not own.size:
                        continue
                    d, own_ids = dist[own][:, of], ids[own]
                    far, far_id = (np.array(v) for v in zip(*[last.get((j, hit), (np.inf, np.iinfo(np.int64).max)) for j in of]))
                    some, cols = np.nonzero(d <= far)
                    near = (d[some, cols] < far[cols]) | (own_ids[some] < far_id[cols])
                    near &= own_ids[some] != a_id[of][cols]
                    some, cols = some[near], cols[near]
                    order = np.argsort(cols, kind="stable")
                    some, ends = some[order], np.searchsorted(cols[order], np.arange(len(of) + 1))
                    for c, j in enumerate(of):
                        sel = some[ends[c]:ends[c + 1]]
                        if own.size <= k + 1 and (j, hit) not in last:  # rows without a distance come after all others
                            lost = np.flatnonzero(np.isnan(d[:, c]) & (own_ids != a_id[j]))
                            sel = np.concatenate([sel, lost]) if np.count_nonzero(own_ids != a_id[j]) <= k else sel
                        if not sel.size:
                            continue
                        if sel.size > k:
                            sel = sel[d[sel, c] <= np.partition(d[sel, c], k - 1)[k - 1]]
                            sel = sel[np.lexsort((own_ids[sel], d[sel, c]))[:k]]
                        found = merged(best.get((j, hit)), (d[sel, c], own_ids[sel], np.abs(x[own[sel]] - a_x[j])))
                        best[j, hit] = found
                        if len(found[0]) == k and found[0][-1] == found[0][-1]:
                            last[j, hit] = found[0][-1], found[1][-1]
        if best:
            frame = pd.DataFrame(np.vstack([b[2] for b in best.values()]), columns=[f"_d{i}" for i in range(n_feat)])
            sizes = [len(b[0]) for b in best.values()]
            frame.insert(0, "_dist", np.concatenate([b[0] for b in best.values()]))
            frame.insert(0, "_nid", np.concatenate([b[1] for b in best.values()]))
            frame.insert(0, "_hit", np.repeat([hit for _, hit in best], sizes))
            frame.insert(0, "_aid", np.repeat([a_id[j] for j, _ in best], sizes))
            types = [pa.int64(), pa.bool_(), pa.int64()] + [pa.float64()] * (n_feat + 1)
            yield pa.RecordBatch.from_pandas(frame, pa.schema(list(zip(frame.columns, types))), preserve_index=False)

    schema = "_aid long, _hit boolean, _nid long, _dist double, " + ", ".join(
        f"_d{i} double" for i in range(n_feat))
    cand = rows.mapInArrow(local_best, schema)
    near = top_k_per_group(cand, ["_aid", "_hit"], [F.col("_dist").asc(), F.col("_nid").asc()], k,
                           rank_name="_r")
    per_anchor = near.groupBy("_aid").agg(*[
        F.expr(f"avg(CASE WHEN NOT _hit THEN _d{i} END) - avg(CASE WHEN _hit THEN _d{i} END) AS `{f}`")
        for i, f in enumerate(feats)])
    w = per_anchor.agg(*[F.expr(f"avg(`{f}`) AS `{f}`") for f in feats])
    return w.unpivot([], feats, "feature", "importance")


def below_threshold(importance: DataFrame, threshold: float = 0.05) -> list[str]:
    """Features whose importance is below ``threshold``: a short list to the driver."""
    return [r["feature"] for r in importance.where(F.col("importance") < threshold).collect()]
