"""Queries for cross-validation and tuning of the families whose folds and trials share
their passes (inventory 27, 82, 84, 85, 88-91, 93)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.operators import evaluation as EV
from curlew.operators import features as FE
from curlew.operators import metrics as M
from curlew.operators import models as MD
from curlew.operators import split as SP
from curlew.operators.kernels import KERNELS
from curlew.plans.catalog import METRIC_NAMES, metrics10_sql, query
from curlew.plans.q_models import _CUR_FP, FOLDS, REPEATS, curated_split_fp
from curlew.session import cut_lineage, scratch_path

TRIALS = 50
FAMILIES = list(MD.BATCHED)


def train_bits(spark, sf) -> DataFrame:
    return curated_split_fp(spark, sf).filter("split = 'train'").select("id", "label", "bits")


def train_folds(train: DataFrame) -> DataFrame:
    return cut_lineage(SP.stratified_folds(train.select("id", "label"), "label", "id", k=FOLDS, repeats=REPEATS).select("id", "Repeat", "Fold"))


#: Train rows, their five times five folds, and their bits.
_FOLDS = _CUR_FP + f""",
fh AS (SELECT id, label, r AS Repeat, ('0x' || substr(md5(CAST(41 + r AS VARCHAR) || '|' || CAST(id AS VARCHAR)), 1, 15))::UBIGINT AS h
       FROM tr, range(1, {REPEATS + 1}) t(r)),
fc AS (SELECT label, count(*) AS c FROM tr GROUP BY label),
fo AS (SELECT label, coalesce(sum(c) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM fc),
folds AS (SELECT id, label, CAST(Repeat AS INTEGER) AS Repeat,
    CAST((o + row_number() OVER (PARTITION BY Repeat, label ORDER BY h, id) - 1) % {FOLDS} + 1 AS INTEGER) AS Fold
  FROM fh JOIN fo USING (label)),
trb AS (SELECT b.id, b.bit FROM b JOIN tr ON tr.id = b.id)"""


def _trials_sql(model: str, param: str, value: str) -> str:
    return f"""
trials AS (SELECT CAST(t AS INTEGER) AS trial, {value} AS {param} FROM (
  SELECT t, ('0x' || substr(md5('42|{model}|' || CAST(t AS VARCHAR) || '|{param}'), 1, 15))::UBIGINT / 1152921504606846976.0::DOUBLE AS u
  FROM range(1, {TRIALS + 1}) x(t)))"""


#: Scores of naive Bayes: train counts are taken from the rows of the other folds directly.
_NB = """,
cell AS (SELECT DISTINCT Repeat, Fold FROM folds),
ncl AS (SELECT c.Repeat, c.Fold, f.label, count(*) AS n FROM cell c JOIN folds f ON f.Repeat = c.Repeat AND f.Fold <> c.Fold GROUP BY ALL),
cnt AS (SELECT c.Repeat, c.Fold, f.label, trb.bit, count(*) AS k
        FROM cell c JOIN folds f ON f.Repeat = c.Repeat AND f.Fold <> c.Fold JOIN trb ON trb.id = f.id GROUP BY ALL),
rate AS (SELECT n.Repeat, n.Fold, n.label, g.bit, t.trial, (coalesce(k, 0) + t.alpha) / (n.n + 2 * t.alpha) AS p
         FROM ncl n CROSS JOIN range(2048) g(bit) CROSS JOIN trials t
         LEFT JOIN cnt ON cnt.Repeat = n.Repeat AND cnt.Fold = n.Fold AND cnt.label = n.label AND cnt.bit = g.bit),
odds AS (SELECT Repeat, Fold, bit, trial,
           sum(CASE WHEN label = 1 THEN ln(p) ELSE -ln(p) END) AS present, sum(CASE WHEN label = 1 THEN ln(1 - p) ELSE -ln(1 - p) END) AS clear
         FROM rate GROUP BY ALL),
base AS (SELECT Repeat, Fold, trial, sum(clear) AS s FROM odds GROUP BY ALL),
prior AS (SELECT Repeat, Fold, ln(sum(CASE WHEN label = 1 THEN n END) / CAST(sum(CASE WHEN label = 0 THEN n END) AS DOUBLE)) AS lp FROM ncl GROUP BY ALL),
hit AS (SELECT f.id, f.Repeat, f.Fold, o.trial, sum(present - clear) AS s
        FROM folds f JOIN trb ON trb.id = f.id JOIN odds o ON o.Repeat = f.Repeat AND o.Fold = f.Fold AND o.bit = trb.bit GROUP BY ALL),
scored AS (SELECT f.id, f.Repeat, f.Fold, b.trial, f.label AS y, 1.0 / (1.0 + exp(-round(b.s + lp + coalesce(h.s, 0), 9))) AS score
           FROM folds f JOIN base b ON b.Repeat = f.Repeat AND b.Fold = f.Fold JOIN prior p ON p.Repeat = f.Repeat AND p.Fold = f.Fold
           LEFT JOIN hit h ON h.id = f.id AND h.Repeat = f.Repeat AND h.Fold = f.Fold AND h.trial = b.trial)"""

#: Scores of k-NN: every train row against every other.
_KNN = """,
meet AS (SELECT x.id AS a, y.id AS b, count(*) AS n FROM trb x JOIN trb y ON y.bit = x.bit AND y.id <> x.id GROUP BY ALL),
dist AS (SELECT x.id AS a, y.id AS b, nx.n + ny.n - 2 * coalesce(m.n, 0) AS d
         FROM tr x JOIN tr y ON y.id <> x.id JOIN nb nx ON nx.id = x.id JOIN nb ny ON ny.id = y.id LEFT JOIN meet m ON m.a = x.id AND m.b = y.id),
near AS (SELECT f.id, f.Repeat, f.Fold, f.label AS y, o.label AS near_y, row_number() OVER (PARTITION BY f.id, f.Repeat ORDER BY d, b) AS nth
         FROM folds f JOIN dist ON dist.a = f.id JOIN folds o ON o.id = dist.b AND o.Repeat = f.Repeat AND o.Fold <> f.Fold),
scored AS (SELECT n.id, n.Repeat, n.Fold, t.trial, any_value(n.y) AS y, avg(n.near_y) AS score
           FROM near n JOIN trials t ON n.nth <= t.n_neighbors GROUP BY n.id, n.Repeat, n.Fold, t.trial HAVING count(*) = any_value(t.n_neighbors))"""

_CV_METRICS = "," + metrics10_sql("scored", ["Repeat", "Fold"]) + """
SELECT 'WordShingle2' AS Descriptor, '{model}' AS Model, Repeat, Fold, 'ok' AS status, CAST(NULL AS VARCHAR) AS error,
  tp, fp, tn, fn, """ + ", ".join(METRIC_NAMES) + " FROM m_scored"

#: Mean area of each trial, by mid-ranks.
_TUNE = """,
mr AS (SELECT trial, Repeat, Fold, y, rank() OVER (PARTITION BY trial, Repeat, Fold ORDER BY score)
         + (count(*) OVER (PARTITION BY trial, Repeat, Fold, score) - 1) / CAST(2 AS DOUBLE) AS r FROM scored),
auc AS (SELECT trial, Repeat, Fold, CAST(count_if(y = 1) AS DOUBLE) AS P, CAST(count_if(y = 0) AS DOUBLE) AS N, sum(CASE WHEN y = 1 THEN r ELSE 0 END) AS s FROM mr GROUP BY ALL)
SELECT '{model}' AS Model, trial, any_value({param}) AS value, avg(CASE WHEN P > 0 AND N > 0 THEN (s - P * (P + 1) / 2) / (P * N) ELSE 0 END) AS score
FROM auc JOIN trials USING (trial) GROUP BY trial"""

_ONE_ALPHA = ", trials AS (SELECT 1 AS trial, CAST(1.0 AS DOUBLE) AS alpha)"
_ONE_K = ", trials AS (SELECT 1 AS trial, 5 AS n_neighbors)"
_ALPHAS = "," + _trials_sql("Bayesian", "alpha", "exp(ln(1e-3::DOUBLE) + u * (ln(10.0::DOUBLE) - ln(1e-3::DOUBLE)))")
_KS = "," + _trials_sql("KNN", "n_neighbors", "1 + least(floor(u * 30), 29)")


def _cv(spark, sf, model):
    train = train_bits(spark, sf)
    return MD.repeated_cv(train, train_folds(train), model, descriptor="WordShingle2")[1]


def _tune(spark, sf, model):
    train = train_bits(spark, sf)
    _, scores = MD.tune(train, train_folds(train), model, n_trials=TRIALS)
    values = MD.trial_table(spark, [model], TRIALS).where(F.col("param") == MD.BATCHED[model])
    return scores.join(values.select("trial", "value"), "trial").select(F.lit(model).alias("Model"), "trial", "value", "score")


@query("bayes_cv", _FOLDS + _ONE_ALPHA + _NB + _CV_METRICS.format(model="Bayesian"))
def q_bayes_cv(spark, sf):
    """Naive Bayes over 5 x 5 folds of all train rows: per-fold metrics."""
    return _cv(spark, sf, "Bayesian")


@query("knn_cv", _FOLDS + _ONE_K + _KNN + _CV_METRICS.format(model="KNN"))
def q_knn_cv(spark, sf):
    """Five nearest neighbours over 5 x 5 folds of all train rows: per-fold metrics."""
    return _cv(spark, sf, "KNN")


@query("logistic_cv")
def q_logistic_cv(spark, sf):
    """Logistic regression over 5 x 5 folds of all train rows: per-fold metrics."""
    return _cv(spark, sf, "LogisticRegression")


@query("bayes_tune", _FOLDS + _ALPHAS + _NB + _TUNE.format(model="Bayesian", param="alpha"))
def q_bayes_tune(spark, sf):
    """50 smoothings of naive Bayes over 5 x 5 folds: mean area of each."""
    return _tune(spark, sf, "Bayesian")


@query("knn_tune", _FOLDS + _KS + _KNN + _TUNE.format(model="KNN", param="n_neighbors"))
def q_knn_tune(spark, sf):
    """50 trials of the number of neighbours over 5 x 5 folds: mean area of each."""
    return _tune(spark, sf, "KNN")


@query("logistic_tune")
def q_logistic_tune(spark, sf):
    """50 values of C over 5 x 5 folds, 1,250 fits in one optimiser: mean area of each."""
    return _tune(spark, sf, "LogisticRegression")


@query("oof_keys", _FOLDS + ", m AS (SELECT unnest(" + str(FAMILIES) + """) AS Model)
SELECT id, Repeat, Fold, label AS y, Model FROM folds CROSS JOIN m""")
def q_oof_keys(spark, sf):
    """Rows with an out-of-fold probability, for each family of the shared optimiser."""
    train = train_bits(spark, sf)
    folds = train_folds(train)
    preds = reduce(DataFrame.unionByName, [MD.repeated_cv(train, folds, m)[0] for m in FAMILIES])
    return preds.where(F.col("score").between(0, 1)).select("id", "Repeat", "Fold", "y", "Model")


def _two_families(spark, sf):
    """Train rows with word shingles, and with character shingles of the same rows."""
    train = train_bits(spark, sf)
    from curlew.operators import clean as C
    from curlew.sources import tables as T
    cur = C.curated_entities(T.labelled_documents(spark, sf)).select("id", "key")
    path = FE.path_fingerprint(cur.join(train.select("id", "label"), "id"), min_k=3, max_k=3).select("id", "label", "bits")
    return {"WordShingle2": train, "CharShingle3": cut_lineage(path)}


@query("evaluation_grid", _FOLDS + ", d AS (SELECT unnest(['CharShingle3', 'WordShingle2']) AS Descriptor), m AS (SELECT unnest(" + str(FAMILIES) + """) AS Model)
SELECT Descriptor, Model, Repeat, Fold, 'ok' AS status, count(*) AS n, CAST(count_if(label = 1) AS BIGINT) AS positives
FROM folds CROSS JOIN d CROSS JOIN m GROUP BY ALL""")
def q_evaluation_grid(spark, sf):
    """Two feature families under the models of the shared optimiser: the cells and sizes
    of the result table. The families and models that are asked for and not available
    (here one each) are left out."""
    families = _two_families(spark, sf)
    folds = train_folds(families["WordShingle2"])
    path = scratch_path(spark, "evaluation-grid")
    got = EV.evaluation_grid(families, [*FAMILIES, "TabPFN"], folds, path, descriptors=[*families, "Mordred"])
    bounded = reduce(lambda a, b: a & b, [F.coalesce(F.col(c), F.lit(0.0)).between(-1, 1) for c in M.METRICS])
    return got.where(bounded).select(*EV.CELL, "status", (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("n"), (F.col("tp") + F.col("fn")).alias("positives"))


@query("svm_scores", _CUR_FP + """, k AS (SELECT unnest(['rbf', 'linear', 'poly']) AS Kernel)
SELECT id, Kernel, CAST(label AS INTEGER) AS True_Label FROM te CROSS JOIN k""")
def q_svm_scores(spark, sf):
    """Machines of all three kernels, fitted on the train rows: the test rows that have a
    probability and the label that it calls for."""
    d = cut_lineage(MD.bits_to_vector(curated_split_fp(spark, sf)))
    train, test = d.filter("split = 'train'"), d.filter("split = 'test'")
    # side by side: a fit is one task, or a chain of jobs that leave cores idle between them
    with ThreadPoolExecutor(len(KERNELS)) as ex:
        scored = list(ex.map(lambda k: MD.final_fit_score(train, test, "SVM", {"kernel": k}).withColumn("Kernel", F.lit(k)), KERNELS))
    p = F.col("Predicted_Probability")
    right = p.between(0, 1) & (F.col("Predicted_Label") == M.threshold_predict(p, 0.5))
    return reduce(DataFrame.unionByName, scored).where(right).select("id", "Kernel", F.col("True_Label").cast("int").alias("True_Label"))
