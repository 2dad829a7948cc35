"""Registered model, metric and HR-study queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.c_flights import describe_sql
from tessera.catalog.fixture_sql import r_up
from tessera.catalog.registry import register
from tessera.operators import features as FE
from tessera.operators import ml
from tessera.plans import hr as HRP
from tessera.sources import bindings as B

D = 9
_C = """SELECT count_if(label = 1 AND prediction = 1) AS tp, count_if(label = 0 AND prediction = 1) AS fp,
  count_if(label = 1 AND prediction = 0) AS fn, count_if(label = 0 AND prediction = 0) AS tn FROM hr_predictions"""


def _z(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


def _pred(spark, sf):
    return B.hr_predictions(spark, sf)


def _round_cols(df, cols):
    return df.withColumns({c: F.round(c, D) for c in cols})


@register("ml_confusion", 'SELECT label, prediction, count(*) AS "count" FROM hr_predictions GROUP BY 1, 2')
def ml_confusion(spark, sf):
    return ml.confusion(_pred(spark, sf))


_P1, _R1, _F1 = _z("tp", "tp + fp"), _z("tp", "tp + fn"), _z("2 * tp", "2 * tp + fp + fn")
_P0, _R0, _F0 = _z("tn", "tn + fn"), _z("tn", "tn + fp"), _z("2 * tn", "2 * tn + fn + fp")


def _w(a: str, b: str) -> str:
    return _z(f"({a}) * (tn + fp) + ({b}) * (tp + fn)", "tp + fp + fn + tn")


@register("ml_classification_report", f"""
WITH c AS ({_C})
SELECT '0' AS class, {r_up(_P0, D)} AS precision, {r_up(_R0, D)} AS recall, {r_up(_F0, D)} AS f1_score, tn + fp AS support FROM c
UNION ALL SELECT '1', {r_up(_P1, D)}, {r_up(_R1, D)}, {r_up(_F1, D)}, tp + fn FROM c
UNION ALL SELECT 'accuracy', NULL, NULL, {r_up(_z('tp + tn', 'tp + fp + fn + tn'), D)}, tp + fp + fn + tn FROM c
UNION ALL SELECT 'macro avg', {r_up(f'({_P0} + {_P1}) / 2', D)}, {r_up(f'({_R0} + {_R1}) / 2', D)},
  {r_up(f'({_F0} + {_F1}) / 2', D)}, tp + fp + fn + tn FROM c
UNION ALL SELECT 'weighted avg', {r_up(_w(_P0, _P1), D)}, {r_up(_w(_R0, _R1), D)}, {r_up(_w(_F0, _F1), D)},
  tp + fp + fn + tn FROM c""")
def ml_classification_report(spark, sf):
    return _round_cols(ml.report(_pred(spark, sf)), ["precision", "recall", "f1_score"])


@register("ml_f1", f"WITH c AS ({_C}) SELECT {r_up(_F1, D)} AS f1 FROM c")
def ml_f1(spark, sf):
    return _round_cols(ml.f1_score(_pred(spark, sf)), ["f1"])


@register("ml_accuracy_recall_mcc", f"""
WITH c AS ({_C})
SELECT {r_up(_z('tp + tn', 'tp + fp + fn + tn'), D)} AS accuracy, {r_up(_R1, D)} AS recall,
  {r_up("coalesce((CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn) / nullif(sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0.0)", D)} AS mcc
FROM c""")
def ml_accuracy_recall_mcc(spark, sf):
    return _round_cols(ml.accuracy_recall_mcc(_pred(spark, sf)), ["accuracy", "recall", "mcc"])


@register("ml_logreg_fit_predict")
def ml_logreg_fit_predict(spark, sf):
    """Baseline model: fit on the 80% hash split, predict the 20%."""
    e = HRP.encoded(B.hr(spark, sf))
    feats = HRP.feature_columns(e)
    train, test = FE.hash_split(e, HRP.ID, 0.2)
    model = ml.fit_logistic(train, feats, HRP.LABEL)
    return ml.predict(model, test, keep=[HRP.ID, HRP.LABEL])


@register("ml_folds", """
SELECT id, "left", CAST((row_number() OVER (ORDER BY "left" NULLS FIRST, md5(CAST(id AS VARCHAR)), id) - 1) % 30 AS INTEGER) AS fold
FROM hr""")
def ml_folds(spark, sf):
    """The stratified fold of every row of the study table, as the cross validation deals them."""
    return ml.stratified_folds(B.hr(spark, sf).select("id", "left"), "left", "id", 30)


@register("ml_cross_val")
def ml_cross_val(spark, sf):
    """30-fold F1 and weighted F1 of the baseline model on the training split."""
    e = HRP.encoded(B.hr(spark, sf))
    train, _ = FE.hash_split(e, HRP.ID, 0.2)
    return ml.cross_validate(train, HRP.feature_columns(e), HRP.LABEL, HRP.ID, folds=30)


@register("ml_attrition_pipeline")
def ml_attrition_pipeline(spark, sf):
    return HRP.attrition_pipeline(B.hr(spark, sf), folds=30)


_HR_NUM = ("satisfaction_level", "last_evaluation", "number_project", "average_montly_hours",
           "time_spend_company", "Work_accident", "promotion_last_5years", "left")
_HR_ALL = _HR_NUM[:-1] + ("department", "salary", "left")
_HR_SRC = "(SELECT * RENAME (sales AS department) FROM hr)"


@register("q_hr_profile", "\nUNION ALL ".join(describe_sql(_HR_SRC, c, None) for c in _HR_NUM)
          + "\nUNION ALL SELECT '*' AS \"column\", 'rows' AS stat, CAST(count(*) AS DOUBLE) AS value FROM hr"
          + "".join(f"\nUNION ALL SELECT '{c}', 'distinct', CAST(count(DISTINCT \"{c}\") AS DOUBLE) FROM {_HR_SRC}"
                    f"\nUNION ALL SELECT '{c}', 'nulls', CAST(count_if(\"{c}\" IS NULL) AS DOUBLE) FROM {_HR_SRC}"
                    for c in _HR_ALL))
def q_hr_profile(spark, sf):
    return HRP.profile_table(B.hr(spark, sf))
