"""Queries for ranking and reshaping operators (inventory 15, 20, 58-59, 64-67, 71, 73-75, 81)."""

from __future__ import annotations

from pyspark.sql import functions as F

from curlew.operators import metrics as M
from curlew.operators import reshape as R
from curlew.plans.catalog import FOLD_PRED, FOLD_RESULTS, METRIC_NAMES, query
from curlew.plans.q_metrics import fold_results
from curlew.sources import tables as T

SUMMARY = "WITH " + FOLD_RESULTS + ", summary AS (SELECT Descriptor, Model, " + ", ".join(
    f"round_even(avg({m}), 3) AS {m}" for m in METRIC_NAMES) + " FROM results GROUP BY Descriptor, Model)"

DESC_ORDER = ["R", "N", "A", "X"]


def summary(spark, sf):
    return M.cv_summary(fold_results(spark, sf))


@query("best_pair", SUMMARY + " SELECT * FROM summary ORDER BY ROC_AUC DESC, Descriptor, Model LIMIT 1")
def q_best_pair(spark, sf):
    return R.best_pair(summary(spark, sf))


@query("top_k_pairs", SUMMARY + """
SELECT *, CAST(row_number() OVER (ORDER BY MCC DESC, Descriptor, Model) AS INTEGER) AS rank
FROM summary ORDER BY MCC DESC, Descriptor, Model LIMIT 3""")
def q_top_k_pairs(spark, sf):
    return R.top_k_pairs(summary(spark, sf), 3, "MCC").withColumn("rank", F.col("rank").cast("int"))


@query("top10_by_metric", SUMMARY + """,
t AS (SELECT * FROM (SELECT 'ROC_AUC' AS Metric, Model || ' (' || Descriptor || ')' AS label, ROC_AUC AS value
        FROM summary ORDER BY ROC_AUC DESC, Descriptor, Model LIMIT 10)
      UNION ALL SELECT * FROM (SELECT 'MCC', Model || ' (' || Descriptor || ')', MCC
        FROM summary ORDER BY MCC DESC, Descriptor, Model LIMIT 10))
SELECT *, CAST(row_number() OVER (PARTITION BY Metric ORDER BY value DESC, label) AS INTEGER) AS rank FROM t""")
def q_top10_by_metric(spark, sf):
    return R.top10_by_metric(summary(spark, sf)).withColumn("rank", F.col("rank").cast("int"))


@query("metric_matrix", SUMMARY + """
SELECT Model, max(CASE WHEN Descriptor = 'R' THEN ROC_AUC END) AS R,
  max(CASE WHEN Descriptor = 'N' THEN ROC_AUC END) AS N,
  max(CASE WHEN Descriptor = 'A' THEN ROC_AUC END) AS A,
  max(CASE WHEN Descriptor = 'X' THEN ROC_AUC END) AS X
FROM summary GROUP BY Model""")
def q_metric_matrix(spark, sf):
    return R.metric_matrix(summary(spark, sf), "ROC_AUC", DESC_ORDER)


@query("grouped_minmax", SUMMARY + """,
lg AS (UNPIVOT summary ON ROC_AUC, MCC, F1 INTO NAME Metric VALUE value)
SELECT Descriptor, Model, Metric, value,
  (value - min(value) OVER (PARTITION BY Metric)) /
  CASE WHEN max(value) OVER (PARTITION BY Metric) = min(value) OVER (PARTITION BY Metric) THEN 1.0
       ELSE max(value) OVER (PARTITION BY Metric) - min(value) OVER (PARTITION BY Metric) END AS scaled
FROM lg""")
def q_grouped_minmax(spark, sf):
    return R.grouped_minmax(summary(spark, sf), ["ROC_AUC", "MCC", "F1"])


@query("overall_means", SUMMARY + " SELECT " + ", ".join(f"avg({m}) AS {m}" for m in METRIC_NAMES)
       + " FROM summary")
def q_overall_means(spark, sf):
    return R.overall_means(summary(spark, sf), M.METRICS)


@query("boxplot_stats", "WITH " + FOLD_RESULTS + """,
q AS (SELECT Descriptor, Model, quantile_cont(ROC_AUC, 0.25) AS q1, quantile_cont(ROC_AUC, 0.5) AS median,
        quantile_cont(ROC_AUC, 0.75) AS q3 FROM results GROUP BY 1, 2)
SELECT r.Descriptor, r.Model, q1, median, q3,
  min(CASE WHEN ROC_AUC >= q1 - 1.5 * (q3 - q1) THEN ROC_AUC END) AS whisker_lo,
  max(CASE WHEN ROC_AUC <= q3 + 1.5 * (q3 - q1) THEN ROC_AUC END) AS whisker_hi,
  count_if(ROC_AUC < q1 - 1.5 * (q3 - q1) OR ROC_AUC > q3 + 1.5 * (q3 - q1)) AS n_outliers,
  count(ROC_AUC) AS n
FROM results r JOIN q USING (Descriptor, Model) GROUP BY ALL""")
def q_boxplot_stats(spark, sf):
    return R.boxplot_stats(fold_results(spark, sf), ["Descriptor", "Model"], "ROC_AUC")


@query("boxplot_outliers", """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
SELECT e.event_type, event_id, value, q1 - 1.5 * (q3 - q1) AS fence_lo, q3 + 1.5 * (q3 - q1) AS fence_hi
FROM events e JOIN q ON e.event_type = q.event_type
WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def q_boxplot_outliers(spark, sf):
    ev = T.table(spark, sf, "events").select("event_type", "event_id", "value")
    return R.boxplot_outliers(ev, ["event_type"], "value")


@query("descriptor_slice", "WITH " + FOLD_RESULTS + " SELECT * FROM results WHERE Descriptor = 'R'")
def q_descriptor_slice(spark, sf):
    return fold_results(spark, sf).filter(F.col("Descriptor") == "R")


@query("custom_order_sort", SUMMARY + """,
o AS (SELECT * FROM (VALUES ('R', 0), ('N', 1), ('A', 2), ('X', 3)) t(Descriptor, pos))
SELECT o.Descriptor, CAST(o.pos AS INTEGER) AS pos, s.Model, s.ROC_AUC
FROM o LEFT JOIN summary s USING (Descriptor)""")
def q_custom_order_sort(spark, sf):
    return R.custom_order(summary(spark, sf), "Descriptor", DESC_ORDER) \
        .select("Descriptor", "pos", "Model", "ROC_AUC")


@query("strip_suffix", SUMMARY + """
SELECT Descriptor, Model, ROC_AUC, MCC FROM summary""")
def q_strip_suffix(spark, sf):
    s = summary(spark, sf).select("Descriptor", "Model", F.col("ROC_AUC").alias("ROC_AUC_mean"),
                                  F.col("MCC").alias("MCC_mean"))
    return R.strip_suffix(s)


@query("pvalue_bins", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount < 0.001 THEN 0 WHEN l_discount < 0.01 THEN 1
  WHEN l_discount < 0.05 THEN 2 ELSE 3 END AS p_bin FROM lineitem""")
def q_pvalue_bins(spark, sf):
    li = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return R.pvalue_bins(li, "l_discount").select("l_orderkey", "l_linenumber", "p_bin")


@query("minmax_scale", "WITH " + FOLD_PRED + """,
fm AS (SELECT Repeat, Fold, min(score) AS lo, max(score) AS hi FROM foldpred GROUP BY 1, 2),
tr AS (SELECT a.Repeat, a.Fold, min(b.lo) AS lo, max(b.hi) AS hi FROM fm a JOIN fm b
       ON a.Repeat = b.Repeat AND a.Fold <> b.Fold GROUP BY 1, 2),
v AS (SELECT p.Descriptor, p.Model, p.Repeat, p.Fold,
        (p.score - tr.lo) / CASE WHEN tr.hi = tr.lo THEN 1.0 ELSE tr.hi - tr.lo END AS scaled
      FROM foldpred p JOIN tr USING (Repeat, Fold))
SELECT Descriptor, Model, Repeat, Fold, count(*) AS n, sum(scaled) AS sum_scaled,
  min(scaled) AS min_scaled, max(scaled) AS max_scaled FROM v GROUP BY ALL""")
def q_minmax_scale(spark, sf):
    from curlew.operators.models import fold_minmax_scale
    fp = T.fold_predictions(spark, sf)
    v = fold_minmax_scale(fp, ["Repeat"], "Fold", ["score"])
    return v.groupBy("Descriptor", "Model", "Repeat", "Fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum("score").alias("sum_scaled"),
        F.min("score").alias("min_scaled"), F.max("score").alias("max_scaled"))
