"""Logistic regression, folds and classification metrics.

The model is Spark ML's ``LogisticRegression`` with the objective of
scikit-learn's default (L2, ``C = 1``, intercept not penalised):
``C * sum(loss) + |w|^2 / 2`` equals Spark's ``mean(loss) + regParam |w|^2 / 2``
with ``regParam = 1 / (C n)`` and no standardisation. Metrics are aggregates
of the confusion counts, so they are SQL-checkable on given predictions.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.features import hash_bucket
from tessera.operators.sorting import position_within
from tessera.session import ship_package, stored


def fit_logistic(train: DataFrame, features: Sequence[str], label: str, C: float = 1.0,
                 max_iter: int = 200, tol: float = 1e-6) -> PipelineModel:
    """Fit L2 logistic regression. Counts the training rows once for ``regParam``."""
    n = train.count()
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")
    lr = LogisticRegression(featuresCol="_features", labelCol="_label", regParam=1.0 / (C * max(n, 1)),
                            elasticNetParam=0.0, standardization=False, fitIntercept=True,
                            maxIter=max_iter, tol=tol, family="binomial")
    data = train.withColumn("_label", F.col(label).cast("double"))
    return Pipeline(stages=[assembler, lr]).fit(data)


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``prediction`` (0/1 int) and ``probability`` of class 1 next to the kept columns."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(df)
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("probability"))


# --------------------------------------------------------------- metrics ---

def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts by (label, prediction)."""
    return pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("count"))


def _counts(pred: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    return pred.groupBy(*by).agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                                 F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))


def _div(a, b):
    """a / b, 0 when b is 0 (scikit-learn's zero_division=0)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _class_metrics(tp, fp, fn):
    prec = _div(tp, tp + fp)
    rec = _div(tp, tp + fn)
    f1 = _div(2 * tp, 2 * tp + fp + fn)
    return prec, rec, f1


def report(pred: DataFrame, label: str = "label", prediction: str = "prediction",
           by: Sequence[str] = ()) -> DataFrame:
    """``classification_report`` for a 0/1 label: per class precision, recall,
    F1 and support, then accuracy, macro and weighted averages.

    Output ``(by.., class, precision, recall, f1_score, support)``.
    """
    c = _counts(pred, label, prediction, by)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    p1, r1, f1_1 = _class_metrics(tp, fp, fn)
    p0, r0, f1_0 = _class_metrics(tn, fn, fp)
    s1, s0 = tp + fn, tn + fp
    total = s0 + s1
    acc = _div(tp + tn, total)

    def w(a, b):
        return _div(a * s0 + b * s1, total)

    rows = [
        ("0", p0, r0, f1_0, s0), ("1", p1, r1, f1_1, s1),
        ("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, total),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, total),
        ("weighted avg", w(p0, p1), w(r0, r1), w(f1_0, f1_1), total),
    ]
    structs = [F.struct(F.lit(k).alias("class"), a.alias("precision"), b.alias("recall"), f.alias("f1_score"),
                        s.cast("long").alias("support")) for k, a, b, f, s in rows]
    return c.select(*by, F.explode(F.array(*structs)).alias("r")).select(*by, "r.*")


def f1_score(pred: DataFrame, label: str = "label", prediction: str = "prediction",
             by: Sequence[str] = ()) -> DataFrame:
    """F1 of class 1."""
    c = _counts(pred, label, prediction, by)
    return c.select(*by, _class_metrics(F.col("tp"), F.col("fp"), F.col("fn"))[2].alias("f1"))


def f1_weighted(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                by: Sequence[str] = ()) -> DataFrame:
    """Support-weighted F1 over both classes."""
    r = report(pred, label, prediction, by)
    return r.where(F.col("class") == "weighted avg").select(*by, F.col("f1_score").alias("f1_weighted"))


def summary_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row from one aggregate: F1 of class 1, accuracy, weighted F1."""
    c = _counts(pred, label, prediction)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    f1_1 = _class_metrics(tp, fp, fn)[2]
    f1_0 = _class_metrics(tn, fn, fp)[2]
    s1, s0 = tp + fn, tn + fp
    return c.select(f1_1.alias("f1"), _div(tp + tn, s0 + s1).alias("accuracy"),
                    _div(f1_0 * s0 + f1_1 * s1, s0 + s1).alias("f1_weighted"))


def accuracy_recall_mcc(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, recall of class 1 and Matthews correlation, one row (imported at )."""
    c = _counts(pred, label, prediction)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return c.select(_div(tp + tn, tp + fp + fn + tn).alias("accuracy"), _div(tp, tp + fn).alias("recall"),
                    F.coalesce(F.try_divide(tp * tn - fp * fn, den), F.lit(0.0)).alias("mcc"))


# ------------------------------------------------------------------ folds ---

def fold_column(id_col: str, folds: int) -> F.Column:
    """Fold of a row from a stable hash of its id: the same rows in the same fold on every
    run, and within each class the folds are equal in expectation [choice]."""
    return hash_bucket(id_col, folds)


def stratified_folds(df: DataFrame, label: str, id_col: str, folds: int, name: str = "fold",
                     features: Sequence[str] | None = None) -> DataFrame:
    """``df`` with a fold 0 .. ``folds`` - 1 per row, exactly stratified.

    Rows are put in the order of label, md5 of the id and id, and dealt to the
    folds in turn: the folds of each label differ by at most one row, and so do
    whole folds. Positions come from range partitions and their offsets, so no
    label stands in one task. Null labels are a class of their own; the id is
    unique (rows that share one are dealt in an order of their own).

    With ``features`` the label and these columns come packed in blocks for
    the fit (``_dealt_blocks``), dealt to the same folds.
    """
    if features is not None:
        return _dealt_blocks(df, features, label, id_col, folds)
    order = ["_label", "_hash", id_col]
    placed = position_within(df.withColumns({"_label": F.col(label), "_hash": F.md5(F.col(id_col).cast("string"))}),
                             [], order, name="_place", as_type="long")
    return placed.withColumn(name, ((F.col("_place") - 1) % folds).cast("int")).drop("_label", "_hash", "_place")


# ----------------------------------------------------------------- blocks ---
# Rows that many passes read are written once as blocks: the features and the label, column by column in the narrowest
# type that holds each value, put in order of their fold. Equal rows of a fold are kept once with their number where
# that at least halves a block.

BLOCK, CELL, CHUNK = 32_768, 100_000, 131_072  # rows of a block, of a sorted cell, of a dealt chunk
_BLOCK = "_rows long, _shift int, _sizes binary, _weights binary, _body binary"
_TYPES = {"b": np.int8, "f": np.float32, "d": np.float64}


def _narrow(v: np.ndarray) -> tuple[str, np.ndarray]:
    with np.errstate(invalid="ignore", over="ignore"):
        for code in "bf":
            w = v.astype(_TYPES[code])
            if (w == v).all():
                return code, w
    return "d", v


def _encode(columns: Sequence[np.ndarray]) -> bytes:
    codes, parts = zip(*[_narrow(v) for v in columns])
    return "".join(codes).encode() + b"".join(w.tobytes() for w in parts)


def _decode(body, n: int, m: int, out: np.ndarray) -> np.ndarray:
    """The ``m`` columns of ``n`` values of ``body`` as rows of ``out``."""
    at = m
    for i, code in enumerate(bytes(body[:m]).decode()):
        t = _TYPES[code]
        out[i] = np.frombuffer(body, t, n, at)
        at += n * t().itemsize
    return out


def _once(columns: list[np.ndarray], group: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Places of the distinct rows, in order of their group, and how often each occurs; none if too few are equal."""
    n = len(group)
    raw = [w.view(np.uint8).reshape(n, -1) for _, w in map(_narrow, columns)]
    width = sum(r.shape[1] for r in raw)
    words = np.zeros((n, -(-width // 8) * 8), np.uint8)
    np.concatenate(raw, axis=1, out=words[:, :width])
    words = words.view(np.uint64)
    some = words[:min(n, int(np.searchsorted(group, group[0], "right")), 2048)]
    if 2 * len(np.unique(some, axis=0)) > len(some):
        return None
    order = np.lexsort((*words.T, group))
    words, group = words[order], group[order]
    first = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]).any(axis=1) | (group[1:] != group[:-1])]))
    return order[first], np.diff(np.append(first, n))


def _packed(columns: list[np.ndarray], group: np.ndarray, folds: int) -> tuple[int, bytes, bytes, bytes]:
    """A block of rows whose fold is ``group``, or none where that is ``folds``: rows, sizes, weights and columns."""
    rows, weights = len(group), b""
    order = np.argsort(group, kind="stable")
    columns, group = [v[order] for v in columns], group[order]
    once = _once(columns, group)
    if once:
        columns, group, weights = [v[once[0]] for v in columns], group[once[0]], once[1].astype(float).tobytes()
    sizes = np.bincount(group, minlength=folds + 1).astype(np.int32)
    return rows, sizes.tobytes(), weights, _encode(columns)


def _columns(batch: pa.RecordBatch, feats: Sequence[str], label: str) -> list[np.ndarray]:
    """The features and the label as doubles, nulls as NaN."""
    return [batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in (*feats, label)]


def _table(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, types[t]) for v, (_, t) in zip(zip(*rows), fields)], [c for c, _ in fields])


def _blocks(data: DataFrame, feats: list[str], label: str, fold: str, folds: int) -> DataFrame:
    """``data``, whose folds are given, as blocks; ``data`` itself if that is what it has."""
    if "_body" in data.columns:
        return data
    ship_package(data.sparkSession)

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                columns = _columns(batch, feats, label)
                group = batch.column(fold).to_numpy(zero_copy_only=False)
                group = np.where((group >= 0) & (group < folds), group, folds).astype(np.int64)
                rows, *rest = _packed(columns, group, folds)
                yield _table(_BLOCK, [(rows, 0, *rest)])

    return stored(data.select(label, *feats, fold).mapInArrow(pack, _BLOCK))


def _dealt_blocks(df: DataFrame, features: Sequence[str], label: str, id_col: str, folds: int) -> DataFrame:
    """The rows of ``df`` as blocks, dealt as ``stratified_folds`` does.

    The md5 of the id, which is spread evenly whatever the ids are, names one
    of many cells; rows go to their cell many at a time, packed, and a cell is
    sorted in one task by numpy. A block holds rows of one label that follow
    each other, so its place is the number of rows in the label's earlier
    cells plus a place in the cell. Rows without an id come first, as a null
    sorts; they are spread by the md5 of their values.
    """
    ship_package(df.sparkSession)
    feats = list(features)
    cells = max(1, -(-df.count() // CELL))
    values = [F.col(label).cast("double").alias("_label"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(feats)]]
    text = F.coalesce(F.col(id_col).cast("string"), F.concat_ws(",", *[v.cast("string") for v in values]))
    rows = df.select(F.unhex(F.md5(text)).alias("_hash"), F.col(id_col).isNotNull().alias("_named"), *values)
    names, m = [f"_x{i}" for i in range(len(feats))], len(feats) + 1

    def hashes(column: pa.Array) -> np.ndarray:
        column = column.cast(pa.binary())
        at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        return np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]].view(">u8").reshape(-1, 2).astype(np.uint64)

    def chunks(batches):
        some, n = [], 0
        for batch in batches:
            if batch.num_rows:
                some.append((hashes(batch.column("_hash")), batch.column("_named").to_numpy(zero_copy_only=False).astype(bool),
                             _columns(batch, names, "_label")))
                n += batch.num_rows
            if n >= CHUNK:
                yield some
                some, n = [], 0
        if some:
            yield some

    def deal(batches):
        for some in chunks(batches):
            words = np.concatenate([s[0] for s in some])
            cell = ((words[:, 0] >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
            cell[np.concatenate([s[1] for s in some])] += cells
            order = np.argsort(cell, kind="stable")
            codes, columns = zip(*[_narrow(np.concatenate(v)[order]) for v in zip(*[s[2] for s in some])])
            columns = [words[order, 0], words[order, 1], *columns]
            cell = cell[order]
            at = np.append(np.flatnonzero(np.diff(cell, prepend=-1)), len(cell))
            head = "".join(codes).encode()
            yield _table("_cell long, _n long, _body binary", [
                (int(cell[a]), int(b - a), b"".join([*[v[a:b].tobytes() for v in columns[:2]], head, *[v[a:b].tobytes() for v in columns[2:]]]))
                for a, b in zip(at[:-1], at[1:])])

    def settle(cell: int, parts: list) -> list[tuple]:
        n = sum(k for k, _ in parts)
        words, x, at = np.empty((2, n), np.uint64), np.empty((m, n)), 0
        for k, body in parts:
            words[:, at:at + k] = np.frombuffer(body, np.uint64, 2 * k).reshape(2, k)
            _decode(body[16 * k:], k, m, x[:, at:at + k])
            at += k
        y = np.where(np.isnan(x[-1]), -np.inf, x[-1])
        order = np.lexsort((words[1], words[0], y))
        ends = words[:, order]
        if ((ends[:, 1:] == ends[:, :-1]).all(axis=0) & (y[order][1:] == y[order][:-1])).any():  # the same id: by value
            order = np.lexsort((*x, words[1], words[0], y))
        y, out = y[order], []
        at = np.append(np.flatnonzero(np.concatenate([[True], y[1:] != y[:-1]])), n)
        for a, b in zip(at[:-1], at[1:]):
            for lo in range(a, b, BLOCK):
                own = order[lo:min(lo + BLOCK, b)]
                kept, *rest = _packed(list(x[:, own]), (lo - a + np.arange(len(own))) % folds, folds)
                out.append((None if y[a] == -np.inf else float(y[a]), cell, kept, *rest))
        return out

    settled = "_label double, _cell long, _rows long, _sizes binary, _weights binary, _body binary"

    def sort(batches):
        cell, parts = None, []
        for batch in batches:
            for c, k, body in zip(*[batch.column(i) for i in range(3)]):
                if c.as_py() != cell and parts:
                    yield _table(settled, settle(cell, parts))
                    parts = []
                cell = c.as_py()
                parts.append((k.as_py(), body.as_py()))
        if parts:
            yield _table(settled, settle(cell, parts))

    dealt = rows.mapInArrow(deal, "_cell long, _n long, _body binary").repartition("_cell").sortWithinPartitions("_cell")
    blocks = stored(dealt.mapInArrow(sort, settled))
    before = Window.orderBy(F.col("_label").asc_nulls_first(), "_cell").rowsBetween(Window.unboundedPreceding, -1)
    shifts = stored(blocks.groupBy("_label", "_cell").agg(F.sum("_rows").alias("_sum")).select(
        F.col("_label").alias("_l"), F.col("_cell").alias("_c"), (F.coalesce(F.sum("_sum").over(before), F.lit(0)) % folds).cast("int").alias("_shift")))
    return blocks.join(shifts, F.col("_cell").eqNullSafe(F.col("_c")) & F.col("_label").eqNullSafe(F.col("_l"))).select(
        "_rows", "_shift", "_sizes", "_weights", "_body")


def _opened(batches, dim: int, folds: int):
    """Of each block: ones and the features (rows of an array), label, weights, and start and end of each fold's rows;
    the rows of no fold are the last."""
    for batch in batches:
        for shift, sizes, weights, body in zip(*[batch.column(c) for c in ("_shift", "_sizes", "_weights", "_body")]):
            sizes = np.frombuffer(sizes.as_buffer(), np.int32)
            n = int(sizes.sum())
            columns = np.ones((dim + 1, n))
            _decode(memoryview(body.as_buffer()), n, dim, columns[1:])
            at = np.concatenate([[0], np.cumsum(sizes)])
            own = [(int(at[g]), int(at[g + 1])) for g in (np.arange(folds) - shift.as_py()) % folds]
            yield columns[:-1], columns[-1], np.frombuffer(weights.as_buffer()) if len(weights.as_buffer()) else np.ones(n), own


def fit_logistic_folds(data: DataFrame, features: Sequence[str], label: str, fold: str, folds: int,
                       C: float = 1.0, max_iter: int = 50, tol: float = 1e-9,
                       init: np.ndarray | None = None) -> np.ndarray:
    """Coefficients of all fold models at once: model ``k`` is fitted on the rows whose
    fold is not ``k``, with the same objective as ``fit_logistic``.

    Newton's method from one starting point for all models: ``init`` (one
    coefficient vector), else the fit on all rows, which the fold models are
    close to. There all models have the same weights, so each row adds to one
    Hessian, of all rows, and to that of its own fold; a model's Hessian is
    their difference. Further passes take every model's exact gradient and
    keep its Hessian while steps shrink at least tenfold; otherwise all
    Hessians are taken anew before the next step. Each task adds up its rows with numpy
    (``mapInPandas``), Spark sums by position, the driver solves ``folds``
    small systems of size ``features + 1`` and sends the new coefficients
    with the next pass. Returns an array ``(folds, 1 + features)``, intercept
    first.
    """
    feats = list(features)
    data = _blocks(data, feats, label, fold, folds)
    if init is None and folds > 1:
        init = _newton(data, feats, label, fold, folds, C, max_iter, tol, np.zeros((1, len(feats) + 1)), True)[0]
    start = np.zeros(len(feats) + 1) if init is None else np.asarray(init, dtype=float)
    return _newton(data, feats, label, fold, folds, C, max_iter, tol, np.tile(start, (folds, 1)), False)


SLOWEST = 0.1  # a step above this share of the one before: the Hessians are taken anew


def _newton(data: DataFrame, feats: list[str], label: str, fold: str, folds: int, C: float, max_iter: int,
            tol: float, w: np.ndarray, whole: bool) -> np.ndarray:
    """``whole``: one model of all rows; else one model per fold."""
    models, dim = w.shape
    reg = np.eye(dim)
    reg[0, 0] = 0.0
    h, last, anew = None, np.inf, True
    for _ in range(max_iter if models == 1 else 2 * max_iter):
        shared = bool((w == w[0]).all())
        total = _pass(data, feats, label, fold, w, "shared" if shared and anew else "own" if anew else None, folds, whole)
        if not np.isfinite(total).all():
            raise ValueError("no model fits rows with a null, NaN or infinite feature or label")
        g = C * total[:models * dim].reshape(models, dim) + w @ reg
        if anew:
            sums = total[models * dim:].reshape(-1, dim, dim)
            h = C * (sums[0] - sums[1:] if shared and not whole else sums) + reg
        step = np.stack([np.linalg.solve(h[k], g[k]) for k in range(models)])
        size = np.max(np.abs(step))
        if not anew and not size <= SLOWEST * last:  # the Hessians are of too far away: no step with them
            anew = True
            continue
        w = w - step
        if size * (min(1.0, size / last) if last < np.inf else 1.0) < tol:  # the next step, if steps shrink as before
            break
        anew, last = models == 1, size  # one model's Hessian costs little more than its gradient
    return w


def _pass(data: DataFrame, feats: list[str], label: str, fold: str, coef: np.ndarray, hessians: str | None, folds: int,
          whole: bool) -> np.ndarray:
    """Gradients of all models at ``coef``, then Hessians: ``own``, one per model; ``shared`` (all models have the
    same coefficients), that of all rows and those of each fold's own rows, or of all rows if there is one model of the
    ``whole`` data; none."""
    models, dim = coef.shape
    kept = models + (hessians == "shared" and not whole) if hessians else 0

    def partial(batches):
        g, h, seen = np.zeros((models, dim)), np.zeros((kept, dim, dim)), False
        for x, y, weights, own in _opened(batches, dim, folds):
            seen = True
            if hessians == "shared":
                p = 1.0 / (1.0 + np.exp(-(coef[0] @ x)))
                rest, scaled = (p - y) * weights, x * (p * (1 - p) * weights)
                g += x @ rest
                h[0] += scaled @ x.T
                for k, (a, b) in enumerate(own if not whole else []):
                    g[k] -= x[:, a:b] @ rest[a:b]
                    h[k + 1] += scaled[:, a:b] @ x[:, a:b].T
                continue
            train = np.broadcast_to(weights, (models, len(y))).copy()
            for k, (a, b) in enumerate(own if not whole else []):
                train[k, a:b] = 0.0
            for lo in range(0, len(y), 4096):  # what the processor's cache holds
                part, some = x[:, lo:lo + 4096], train[:, lo:lo + 4096]
                p = 1.0 / (1.0 + np.exp(-(coef @ part)))
                g += ((p - y[lo:lo + 4096]) * some) @ part.T
                if hessians == "own":
                    wt = p * (1 - p) * some
                    for k in range(models):
                        h[k] += (part * wt[k]) @ part.T
        if seen:
            yield _table("v array<double>", [(np.concatenate([g.ravel(), h.ravel()]),)])

    parts = data.mapInArrow(partial, "v array<double>")
    # one vector aggregate with map-side combine: the driver receives one vector
    total = parts.agg(Summarizer.sum(array_to_vector("v")).alias("s")).first()["s"]
    return total.toArray() if total is not None else np.zeros(models * dim + kept * dim * dim)


def fit_logistic_newton(train: DataFrame, features: Sequence[str], label: str, C: float = 1.0,
                        blocks: DataFrame | None = None, folds: int = 1) -> np.ndarray:
    """One model with the objective of ``fit_logistic``, by the Newton passes of
    ``fit_logistic_folds`` (every row is in the training set). Converges in a
    few passes where L-BFGS on the unstandardised objective needs many.
    ``blocks``: the same rows as ``stratified_folds`` packs them for ``folds``
    folds. Returns ``[intercept, coefficients..]``."""
    feats = list(features)
    if blocks is not None:
        return _newton(blocks, feats, label, "_fold", folds, C, 50, 1e-9, np.zeros((1, len(feats) + 1)), True)[0]
    data = train.select(F.col(label).cast("double").alias(label),
                        *[F.col(c).cast("double").alias(c) for c in feats]).withColumn("_fold", F.lit(-1))
    return fit_logistic_folds(data, feats, label, "_fold", 1, C)[0]


def _margin_sql(coef: np.ndarray, features: Sequence[str]) -> str:
    """``intercept + sum(w_j x_j)`` as SQL text with exact double literals."""
    terms = [f"({float(coef[0])!r}D)"]
    terms += [f"({float(w)!r}D) * CAST(`{c}` AS DOUBLE)" for w, c in zip(coef[1:], features)]
    return " + ".join(terms)


def linear_margin(coef: np.ndarray, features: Sequence[str]) -> F.Column:
    """``intercept + sum(w_j x_j)`` as one Column expression (JVM-side, built in one call)."""
    return F.expr(_margin_sql(coef, features))


def predict_linear(coef: np.ndarray, df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """0/1 prediction of a fitted logistic model given by its coefficients (JVM-side)."""
    return df.select(*keep, F.when(linear_margin(coef, features) > 0, 1).otherwise(0).alias("prediction"))


def cross_validate(df: DataFrame, features: Sequence[str], label: str, id_col: str, folds: int = 30,
                   C: float = 1.0, init: np.ndarray | None = None, blocks: DataFrame | None = None) -> DataFrame:
    """K-fold scores of the logistic model on exactly stratified folds: ``(fold, f1, f1_weighted)``.

    The prepared rows are dealt and written once as blocks (``blocks``, if the
    caller has them: every Newton pass reads them, and a lost executor does
    not recompute the feature pipeline); all fold models are fitted together
    by ``fit_logistic_folds``; each row is then scored by the model of its own
    fold and the metrics are one aggregate by fold.
    """
    feats = list(features)
    data = stratified_folds(df, label, id_col, folds, "_fold", features=feats) if blocks is None else blocks
    w = fit_logistic_folds(data, feats, label, "_fold", folds, C, init=init)
    # each row meets its fold's coefficients; both scores read the predictions, written once
    pred = stored(_predicted(data, w, label))
    return f1_score(pred, label, "prediction", ["fold"]).join(f1_weighted(pred, label, "prediction", ["fold"]), "fold")


def _predicted(blocks: DataFrame, w: np.ndarray, label: str) -> DataFrame:
    """``(fold, label, prediction)`` of every row by the model of its own fold."""
    folds, dim = w.shape

    def predict(batches):
        for x, y, weights, own in _opened(batches, dim, folds):
            margin, fold = np.empty(len(y)), np.full(len(y), -1, np.int32)
            for k, (a, b) in enumerate(own):
                margin[a:b], fold[a:b] = w[k, 0], k
                for c, v in zip(w[k, 1:], x[1:]):
                    margin[a:b] += c * v[a:b]
            times = np.where(fold >= 0, weights, 0).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(v.astype(np.int32), times)) for v in (fold, y, margin > 0)],
                                             ["fold", label, "prediction"])

    return blocks.mapInArrow(predict, f"fold int, `{label}` int, prediction int")


def cv_summary(scores: DataFrame) -> DataFrame:
    """Median and (population) standard deviation of the fold scores, as the reference prints."""
    return scores.agg(F.median("f1").alias("f1_median"), F.stddev_pop("f1").alias("f1_std"),
                      F.median("f1_weighted").alias("f1_weighted_median"),
                      F.stddev_pop("f1_weighted").alias("f1_weighted_std"))
