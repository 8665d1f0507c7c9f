"""Queries for metric operators (inventory 17-19, 53-57)."""

from __future__ import annotations

from pyspark.sql import functions as F

from curlew.operators import metrics as M
from curlew.plans.catalog import FOLD_RESULTS, METRIC_NAMES, SCORED, metrics10_sql, query
from curlew.sources import tables as T

_M10 = "WITH " + SCORED + "," + metrics10_sql("scored", ["grp"])


@query("confusion", _M10 + " SELECT grp, tp, fp, tn, fn FROM m_scored")
def q_confusion(spark, sf):
    s = T.scored_lineitem(spark, sf).withColumn("pred", M.threshold_predict(F.col("score")))
    return M.confusion(s, ["grp"], "y", "pred")


@query("threshold_metrics", _M10 + """
SELECT grp, Accuracy, Sensitivity, Specificity, GMean, Precision, F1, MCC, Kappa FROM m_scored""")
def q_threshold_metrics(spark, sf):
    s = T.scored_lineitem(spark, sf).withColumn("pred", M.threshold_predict(F.col("score")))
    return M.threshold_metrics(M.confusion(s, ["grp"], "y", "pred")).drop("tp", "fp", "tn", "fn")


@query("roc_auc", _M10 + " SELECT grp, ROC_AUC FROM m_scored")
def q_roc_auc(spark, sf):
    return M.ranking_metrics(T.scored_lineitem(spark, sf), ["grp"]).select("grp", "ROC_AUC")


@query("pr_auc", _M10 + " SELECT grp, PR_AUC FROM m_scored")
def q_pr_auc(spark, sf):
    return M.ranking_metrics(T.scored_lineitem(spark, sf), ["grp"]).select("grp", "PR_AUC")


@query("roc_auc_global", "WITH " + SCORED + ", one AS (SELECT 0 AS g, y, score FROM scored),"
       + metrics10_sql("one", ["g"]) + " SELECT ROC_AUC, PR_AUC FROM m_one")
def q_roc_auc_global(spark, sf):
    return M.ranking_metrics(T.scored_lineitem(spark, sf), [])


@query("metrics10", _M10 + " SELECT * FROM m_scored")
def q_metrics10(spark, sf):
    return M.metrics10(T.scored_lineitem(spark, sf), ["grp"])


@query("fold_results", "WITH " + FOLD_RESULTS + " SELECT * FROM results")
def q_fold_results(spark, sf):
    return fold_results(spark, sf)


def fold_results(spark, sf):
    fp = T.fold_predictions(spark, sf)
    return M.metrics10(fp, ["Descriptor", "Model", "Repeat", "Fold"]).drop("tp", "fp", "tn", "fn")


@query("cv_summary", "WITH " + FOLD_RESULTS + " SELECT Descriptor, Model, "
       + ", ".join(f"round_even(avg({m}), 3) AS {m}" for m in METRIC_NAMES)
       + " FROM results GROUP BY Descriptor, Model")
def q_cv_summary(spark, sf):
    return M.cv_summary(fold_results(spark, sf))


@query("threshold_predict", """
SELECT l_orderkey, l_linenumber, CAST(l_discount * 10 >= 0.5 AS INTEGER) AS pred,
  CASE WHEN CAST(l_discount * 10 >= 0.5 AS INTEGER) = 1 THEN 'Toxic' ELSE 'Non-toxic' END AS Prediction
FROM lineitem""")
def q_threshold_predict(spark, sf):
    li = T.table(spark, sf, "lineitem")
    pred = M.threshold_predict(F.col("l_discount") * 10, 0.5)
    return li.select("l_orderkey", "l_linenumber", pred.alias("pred"),
                     M.label_name(pred).alias("Prediction"))


@query("round_metrics", """
SELECT l_orderkey, l_linenumber, round_even(l_extendedprice / 7, 3) AS r3 FROM lineitem""")
def q_round_metrics(spark, sf):
    li = T.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.bround(F.col("l_extendedprice") / 7, 3).alias("r3"))
