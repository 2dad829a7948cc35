"""Employee attrition study: profile, feature preparation, logistic
regression baseline and two feature-engineering attempts.

Input: ``id``, the numeric features, ``sales`` (department), ``salary`` and
the 0/1 label ``left``. The reference mutates one ``dataset`` object step by
step (T28); here each step is a function from DataFrame to DataFrame and the
attempts are written out as sequences.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators import features as FE
from tessera.operators import profile
from tessera.session import stored

LABEL = "left"
ID = "id"
SPLIT = "_split"
TEST = 0.2
NUMERIC = ("satisfaction_level", "last_evaluation", "number_project", "average_montly_hours",
           "time_spend_company", "Work_accident", "promotion_last_5years")
CATEGORICAL = ("department", "salary")

# Bins and names of the second attempt.
DISCRETIZE = {
    "last_evaluation": ([(0.36, 0.56), (0.56, 0.72), (0.72, 0.87), (0.87, 1)],
                        ["low", "medium", "high", "excelent"]),
    "number_project": ([(2, 3), (3, 5), (5, 7), (7, 10)], ["low", "medium", "high", "very_high"]),
    "satisfaction_level": ([(0.09, 0.44), (0.44, 0.61), (0.61, 0.82), (0.82, 1)],
                           ["low", "medium", "high", "very_high"]),
    "time_spend_company": ([(2, 3), (3, 5), (5, 10)], ["low", "medium", "high"]),
    "average_montly_hours": ([(96, 156), (156, 201), (201, 245), (245, 310)],
                             ["low", "medium", "high", "very_high"]),
}
# Values of the categorical columns, in the order of the one-hot columns.
DEPARTMENTS = ("IT", "RandD", "accounting", "hr", "management", "marketing", "product_mng", "sales",
               "support", "technical")
SALARIES = ("high", "low", "medium")
# Columns the reference drops by hand in the first attempt.
ATTEMPT1_DROP = ("department_hr", "department_RandD", "department_marketing", "department_accounting",
                 "department_product_mng", "department_management", "promotion_last_5years")
IMPORTANCE_THRESHOLD = 0.05


def prepare(hr: DataFrame, merge_departments: bool = True) -> DataFrame:
    """Rename ``sales`` to ``department`` and merge support and IT into technical."""
    df = hr.withColumnRenamed("sales", "department")
    if merge_departments:
        df = df.withColumn("department", C.replace_values("department", ["support", "IT"], "technical"))
    return df


def profile_table(hr: DataFrame) -> DataFrame:
    """Shape, describe, distinct values and nulls of every column, long form
    ``(column, stat, value)``."""
    df = prepare(hr, merge_departments=False)
    num = [c for c, t in df.dtypes if t in ("int", "bigint", "double") and c != ID]
    desc = profile.describe(df, num, digits=6)
    cols = [c for c in df.columns if c != ID]
    extra = df.agg(F.expr("count(1) AS _rows"),
                   *[F.expr(f"count(DISTINCT `{c}`) AS `d_{i}`") for i, c in enumerate(cols)],
                   *[F.expr(f"count_if(`{c}` IS NULL) AS `n_{i}`") for i, c in enumerate(cols)])
    parts = ["named_struct('column', '*', 'stat', 'rows', 'value', CAST(_rows AS DOUBLE))"]
    for i, c in enumerate(cols):
        parts.append(f"named_struct('column', '{c}', 'stat', 'distinct', 'value', CAST(`d_{i}` AS DOUBLE))")
        parts.append(f"named_struct('column', '{c}', 'stat', 'nulls', 'value', CAST(`n_{i}` AS DOUBLE))")
    return desc.unionByName(extra.selectExpr(f"explode(array({', '.join(parts)})) AS s").selectExpr("s.*"))


def encoded(hr: DataFrame) -> DataFrame:
    """Baseline features: department and salary one-hot encoded."""
    df = prepare(hr)
    df = FE.onehot(df, "salary", SALARIES)
    return FE.onehot(df, "department", [d for d in DEPARTMENTS if d not in ("support", "IT")])


def discretized(hr: DataFrame) -> DataFrame:
    """Second attempt: one-hot categories, discretised and one-hot numeric columns."""
    df = prepare(hr, merge_departments=False)
    df = FE.onehot(df, "department", DEPARTMENTS)
    df = FE.onehot(df, "salary", SALARIES)
    for c, (bins, names) in DISCRETIZE.items():
        df = df.withColumn(c, C.discretize(c, bins, names))
        df = FE.onehot(df, c, names)
    return df


def feature_columns(df: DataFrame, exclude: Sequence[str] = (ID, LABEL, SPLIT)) -> list[str]:
    return [c for c in df.columns if c not in exclude]


# ------------------------------------------------------------- pipeline ---

def _evaluate(name: str, df: DataFrame, feats: list[str], folds: int) -> DataFrame:
    from tessera.operators import ml
    # every Newton pass of both fits reads the training rows as blocks, which are dealt to folds and written once
    split = SPLIT if SPLIT in df.columns else None
    train, test = FE.hash_split(df, ID, TEST, split)
    blocks = ml.stratified_folds(train, LABEL, ID, folds, features=feats)
    coef = ml.fit_logistic_newton(train, feats, LABEL, blocks=blocks, folds=folds)
    held_out = ml.summary_metrics(ml.predict_linear(coef, test, feats, keep=[LABEL]), LABEL, "prediction")
    cv = ml.cv_summary(ml.cross_validate(train, feats, LABEL, ID, folds, init=coef, blocks=blocks))
    return (held_out.crossJoin(cv)
            .select(F.lit(name).alias("variant"), F.lit(len(feats)).alias("n_features"), "*"))


def attrition_pipeline(hr: DataFrame, folds: int = 30) -> DataFrame:
    """Baseline and the two attempts of the study, one comparison row each.

    * baseline: one-hot department and salary, fit, report, cross-validate;
    * attempt 1: remove outlier rows, drop the columns the study drops,
      fix skewed columns, min-max scale;
    * attempt 2: discretise and one-hot the numeric columns, drop constant
      columns, fix skewness, scale, drop features below the importance
      threshold (if all are, the intercept alone is fitted), remove outlier rows.
    """
    # the study table is written once, and so is what a join leaves; what single rows give (one-hot columns, bins,
    # scaling) is computed again where it is read, which takes less than writing and reading dozens of columns
    hr = stored(FE.with_split(hr, ID, TEST, SPLIT))
    base = encoded(hr)
    outliers = stored(FE.outlier_rows(base, list(NUMERIC[:5]), ID))
    out = [_evaluate("baseline", base, feature_columns(base), folds)]

    a1 = FE.drop_rows(base, outliers, ID)
    a1 = stored(a1.drop(*[c for c in ATTEMPT1_DROP if c in a1.columns]))
    feats1 = feature_columns(a1)
    skewed1 = [r["column"] for r in FE.skewed(a1, feats1).collect()]
    a1 = FE.minmax(FE.fix_skewness(a1, skewed1), feats1)
    out.append(_evaluate("attempt1", a1, feats1, folds))

    a2 = discretized(hr)
    feats2 = feature_columns(a2)
    constant = FE.drop_constant(a2, feats2)
    a2 = a2.drop(*constant)
    feats2 = [c for c in feats2 if c not in constant]
    skewed2 = [r["column"] for r in FE.skewed(a2, feats2).collect()]
    a2 = FE.minmax(FE.fix_skewness(a2, skewed2), feats2)
    low = FE.below_threshold(FE.relieff(a2, feats2, LABEL, ID), IMPORTANCE_THRESHOLD)
    keep = [c for c in feats2 if c not in low]
    # by the numeric columns as in attempt 1: beyond the fences of a one-hot column lies each row of a rarer value
    a2 = stored(FE.drop_rows(a2.select(ID, LABEL, SPLIT, *keep), outliers, ID))
    out.append(_evaluate("attempt2", a2, keep, folds))

    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res
