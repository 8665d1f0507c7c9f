"""Queries for statistical comparison (inventory 16, 28, 60, 72, 76-79)."""

from __future__ import annotations

from pyspark.sql import functions as F

from curlew.operators import metrics as M
from curlew.operators import stats as ST
from curlew.plans.catalog import FOLD_RESULTS, METRIC_NAMES, SUBJECTS, query
from curlew.plans.q_metrics import fold_results
from curlew.sources import tables as T

KEYS = ["Descriptor", "Metric"]


def results_long(spark, sf):
    r = ST.subject_key(fold_results(spark, sf))
    return ST.metrics_long(r, ["Descriptor", "Model", "Subject"], M.METRICS, "Metric", "value") \
        .dropna(subset=["value"])


_LONG = "WITH " + FOLD_RESULTS + f""",
lg AS (UNPIVOT results ON {", ".join(METRIC_NAMES)} INTO NAME Metric VALUE value),
l2 AS (SELECT Descriptor, Metric, Model,
          CAST(Repeat AS VARCHAR) || '_F' || CAST(Fold AS VARCHAR) AS Subject, value FROM lg)"""


@query("subject_key", "WITH " + FOLD_RESULTS + """
SELECT Descriptor, Model, Repeat, Fold, CAST(Repeat AS VARCHAR) || '_F' || CAST(Fold AS VARCHAR) AS Subject
FROM results""")
def q_subject_key(spark, sf):
    return ST.subject_key(fold_results(spark, sf)).select("Descriptor", "Model", "Repeat", "Fold", "Subject")


@query("metrics_long", _LONG + " SELECT * FROM l2")
def q_metrics_long(spark, sf):
    return results_long(spark, sf).select("Descriptor", "Metric", "Model", "Subject", "value")


@query("rm_anova", "WITH " + SUBJECTS + """,
cells AS (SELECT 'events' AS grp, Subject, Model, avg(value) AS x FROM subj GROUP BY ALL),
g AS (SELECT grp, avg(x) AS gm, count(DISTINCT Subject) AS n, count(DISTINCT Model) AS k,
        count(*) AS cells FROM cells GROUP BY grp),
lv AS (SELECT grp, sum(d) AS sl FROM (SELECT c.grp, (avg(x) - any_value(g.gm)) ^ 2 AS d
        FROM cells c JOIN g USING (grp) GROUP BY c.grp, c.Model) GROUP BY grp),
sj AS (SELECT grp, sum(d) AS ss FROM (SELECT c.grp, (avg(x) - any_value(g.gm)) ^ 2 AS d
        FROM cells c JOIN g USING (grp) GROUP BY c.grp, c.Subject) GROUP BY grp),
st AS (SELECT c.grp, sum((x - g.gm) ^ 2) AS sst FROM cells c JOIN g USING (grp) GROUP BY c.grp),
a AS (SELECT g.grp, k, n, cells, n * sl AS ssf, k * ss AS sss, sst - n * sl - k * ss AS sse,
        CAST(k - 1 AS DOUBLE) AS df1, CAST((k - 1) * (n - 1) AS DOUBLE) AS df2
      FROM g JOIN lv USING (grp) JOIN sj USING (grp) JOIN st USING (grp))
SELECT grp, k, n AS n_subjects, ssf AS ss_factor, sss AS ss_subject, sse AS ss_error, df1, df2,
  CASE WHEN cells = n * k AND df1 > 0 AND df2 > 0 AND sse > 0 THEN (ssf / df1) / (sse / df2) END AS F,
  CAST(cells = n * k AS INTEGER) AS balanced
FROM a""")
def q_rm_anova(spark, sf):
    s = T.subject_values(spark, sf).withColumn("grp", F.lit("events"))
    return ST.rm_anova(s, ["grp"], "Subject", "Model", "value", with_p=False)


_TUKEY = _LONG + """,
cells AS (SELECT Descriptor, Metric, Subject, Model, avg(value) AS x FROM l2 GROUP BY ALL),
sm AS (SELECT Descriptor, Metric, Subject, avg(value) AS sm FROM l2 GROUP BY ALL),
res AS (SELECT c.Descriptor, c.Metric, coalesce(var_samp(x - sm), 0.0) AS mse,
          count(DISTINCT c.Subject) AS n, count(DISTINCT Model) AS k
        FROM cells c JOIN sm USING (Descriptor, Metric, Subject) GROUP BY 1, 2),
means AS (SELECT Descriptor, Metric, Model, avg(value) AS m FROM l2 GROUP BY ALL),
tk AS (SELECT a.Descriptor, a.Metric, a.Model AS Group1, b.Model AS Group2, abs(a.m - b.m) AS MeanDiff,
    CASE WHEN sqrt(mse / n) > 0 THEN abs(a.m - b.m) / sqrt(mse / n) ELSE 0.0 END AS q_stat,
    CAST((n - 1) * (k - 1) AS DOUBLE) AS df
  FROM means a JOIN means b ON a.Descriptor = b.Descriptor AND a.Metric = b.Metric AND a.Model < b.Model
  JOIN res r ON r.Descriptor = a.Descriptor AND r.Metric = a.Metric)"""


@query("tukey_hsd", _TUKEY + " SELECT * FROM tk")
def q_tukey_hsd(spark, sf):
    return ST.tukey_hsd(results_long(spark, sf), KEYS, with_p=False)


@query("pairwise_matrix", _TUKEY + """
SELECT Descriptor, Metric, Group1 AS g1, Group2 AS g2, MeanDiff AS p FROM tk
UNION ALL SELECT Descriptor, Metric, Group2, Group1, MeanDiff FROM tk
UNION ALL SELECT DISTINCT Descriptor, Metric, Model, Model, 1.0 FROM means""")
def q_pairwise_matrix(spark, sf):
    return ST.pairwise_matrix(ST.tukey_hsd(results_long(spark, sf), KEYS, with_p=False), KEYS, "MeanDiff")


@query("distinct_counts", "WITH " + FOLD_RESULTS + """
SELECT count(DISTINCT CAST(Repeat AS VARCHAR) || '_F' || CAST(Fold AS VARCHAR)) AS n_subjects,
  count(DISTINCT Model) AS n_models, count(DISTINCT Descriptor) AS n_descriptors FROM results""")
def q_distinct_counts(spark, sf):
    r = ST.subject_key(fold_results(spark, sf))
    return r.agg(F.count_distinct("Subject").alias("n_subjects"),
                 F.count_distinct("Model").alias("n_models"),
                 F.count_distinct("Descriptor").alias("n_descriptors"))


@query("anova_pvalues")
def q_anova_pvalues(spark, sf):
    """RM-ANOVA with p-values for every (Descriptor, Metric) (rows-only)."""
    return ST.rm_anova(results_long(spark, sf), KEYS)


@query("tukey_pvalues")
def q_tukey_pvalues(spark, sf):
    """Tukey table with studentized-range p-values (rows-only)."""
    return ST.tukey_hsd(results_long(spark, sf), KEYS)


@query("compare_models")
def q_compare_models(spark, sf):
    """Compact letters per (Descriptor, Metric, model) (rows-only)."""
    return ST.compare_models(results_long(spark, sf), KEYS)["cld"]


@query("compare_models_events")
def q_compare_models_events(spark, sf):
    """Letters for the events repeated-measures table (rows-only)."""
    s = T.subject_values(spark, sf).withColumn("grp", F.lit("events"))
    return ST.compare_models(s, ["grp"])["cld"]
