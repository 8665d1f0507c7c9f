"""Queries for model operators (inventory 24, 26, 31-32, 80, 82, 84-95)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.operators import clean as C
from curlew.operators import features as FE
from curlew.operators import metrics as M
from curlew.operators import models as MD
from curlew.operators import split as SP
from curlew.plans.catalog import CURATED_DOCS, LABELLED_DOCS, METRIC_NAMES, query, strat_split_sql, word_bits_sql
from curlew.plans.q_reshape import SUMMARY, summary
from curlew.sources import tables as T


@query("class_weights", "WITH " + LABELLED_DOCS + """,
c AS (SELECT CAST(label AS INTEGER) AS label, count(*) AS n_c FROM labelled
      WHERE entity IS NOT NULL AND label IS NOT NULL GROUP BY 1)
SELECT label, n_c, sum(n_c) OVER () / (count(*) OVER () * n_c) AS weight FROM c""")
def q_class_weights(spark, sf):
    d = C.drop_missing(T.labelled_documents(spark, sf), ["entity", "label"])
    w = MD.class_weights(d, "label")
    return w.groupBy("label", "weight").agg(F.count(F.lit(1)).alias("n_c")).select("label", "n_c", "weight")


def curated_split_fp(spark, sf):
    """Curated labelled documents, stratified 80/20 split, 2-word-shingle
    fingerprints: (id, label, split, bits)."""
    from curlew.session import cut_lineage
    cur = cut_lineage(C.curated_entities(T.labelled_documents(spark, sf)).select("id", "key", "label"))
    sp = SP.stratified_split(cur, "label", "id")
    return cut_lineage(FE.hashed_fingerprint(sp, min_n=2, max_n=2).select("id", "label", "split", "bits"))


_CUR_FP = "WITH " + CURATED_DOCS + "," + strat_split_sql("(SELECT id, label FROM curated)", "sp") + "," \
    + word_bits_sql("curated", "b", 2, 2) + """,
nb AS (SELECT c.id, coalesce(x.n, 0) AS n FROM curated c
       LEFT JOIN (SELECT id, count(*) AS n FROM b GROUP BY id) x ON c.id = x.id),
tr AS (SELECT id, label FROM sp WHERE split = 'train'),
te AS (SELECT id, label FROM sp WHERE split = 'test')"""


@query("bernoulli_nb", _CUR_FP + """,
ncl AS (SELECT label, count(*) AS n_c FROM tr GROUP BY label),
cnt AS (SELECT tr.label, b.bit, count(*) AS c FROM tr JOIN b ON b.id = tr.id GROUP BY 1, 2),
grid AS (SELECT ncl.label, ncl.n_c, g.bit FROM ncl, range(2048) g(bit)),
fp AS (SELECT grid.label, grid.bit, (coalesce(cnt.c, 0) + 1.0) / (grid.n_c + 2.0) AS p
       FROM grid LEFT JOIN cnt ON cnt.label = grid.label AND cnt.bit = grid.bit),
jl AS (SELECT te.id, fp.label,
         sum(CASE WHEN b.bit IS NOT NULL THEN ln(fp.p) ELSE ln(1 - fp.p) END) AS ll
       FROM te CROSS JOIN fp LEFT JOIN b ON b.id = te.id AND b.bit = fp.bit GROUP BY 1, 2),
pr AS (SELECT label, ln(n_c / (SELECT CAST(sum(n_c) AS DOUBLE) FROM ncl)) AS lp FROM ncl),
j2 AS (SELECT id, sum(CASE WHEN jl.label = 1 THEN ll + lp END) AS j1,
         sum(CASE WHEN jl.label = 0 THEN ll + lp END) AS j0 FROM jl JOIN pr USING (label) GROUP BY id)
SELECT id, 1.0 / (1.0 + exp(j0 - j1)) AS prob FROM j2""")
def q_bernoulli_nb(spark, sf):
    d = curated_split_fp(spark, sf)
    model = MD.bernoulli_nb_fit(d.filter("split = 'train'"), "bits", "label", 1.0, 2048)
    return MD.bernoulli_nb_predict(model, d.filter("split = 'test'"), "id", "bits", "label")


@query("knn_vote", _CUR_FP + """,
x AS (SELECT te.id AS qid, tr.id AS tid, count(*) AS inter FROM te JOIN b b1 ON b1.id = te.id
      JOIN b b2 ON b2.bit = b1.bit JOIN tr ON tr.id = b2.id GROUP BY 1, 2),
d AS (SELECT te.id AS qid, tr.id AS tid, tr.label AS y,
        nq.n + nt.n - 2 * coalesce(x.inter, 0) AS dist
      FROM te CROSS JOIN tr JOIN nb nq ON nq.id = te.id JOIN nb nt ON nt.id = tr.id
      LEFT JOIN x ON x.qid = te.id AND x.tid = tr.id),
k AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY qid ORDER BY dist, tid) <= 5)
SELECT qid AS id, avg(y) AS prob, CAST(avg(y) > 0.5 AS INTEGER) AS pred FROM k GROUP BY qid""")
def q_knn_vote(spark, sf):
    d = curated_split_fp(spark, sf)
    return MD.knn_vote(d.filter("split = 'train'"), d.filter("split = 'test'"), 5)


#: As in the source configuration (N_FOLDS, N_REPEATS).
FOLDS, REPEATS = 5, 5
#: Every model of the catalogue, with its default parameters. With the one descriptor
#: of these queries they are the pairs of the summary: fewer than the five that
#: ``select_top_k`` keeps, so all of them are bases of the ensemble.
BASES = list(MD.DEFAULTS)


def _cv_inputs(spark, sf, repeats=REPEATS):
    d = curated_split_fp(spark, sf).filter("split = 'train'")
    data = MD.bits_to_vector(d).select("id", "label", "bits", "features")
    folds = SP.stratified_folds(d.select("id", "label"), "label", "id", k=FOLDS, repeats=repeats)
    return data, folds.select("id", "Repeat", "Fold")


@query("repeated_cv")
def q_repeated_cv(spark, sf):
    """Per-fold metric table of every model of the catalogue, 5 repeats x 5 folds
    (rows-only check; fits are not SQL)."""
    data, folds = _cv_inputs(spark, sf)
    tables = [MD.repeated_cv(data, folds, m, descriptor="WordShingle2")[1] for m in BASES]
    return reduce(DataFrame.unionByName, tables)


@query("tune")
def q_tune(spark, sf):
    """Seeded random search of every model of the catalogue: score per (model,
    trial), 50 trials over all folds of all repeats."""
    data, folds = _cv_inputs(spark, sf)
    tables = [MD.tune(data, folds, m, n_trials=50)[1].select(F.lit(m).alias("Model"), "trial", "score") for m in BASES]
    return reduce(DataFrame.unionByName, tables)


@query("final_fit_score")
def q_final_fit_score(spark, sf):
    """Fit on all train rows, score the test split (prediction table)."""
    d = MD.bits_to_vector(curated_split_fp(spark, sf))
    return MD.final_fit_score(d.filter("split = 'train'"), d.filter("split = 'test'"), "LogisticRegression")


@query("stacking")
def q_stacking(spark, sf):
    """Stacking of all base models on out-of-fold probabilities of 5 folds."""
    d = MD.bits_to_vector(curated_split_fp(spark, sf))
    tr, te = d.filter("split = 'train'"), d.filter("split = 'test'")
    folds = SP.stratified_folds(tr.select("id", "label"), "label", "id", k=FOLDS, repeats=1) \
        .select("id", "Repeat", "Fold")
    pred, _ = MD.stacking(tr.select("id", "label", "bits", "features"), te.select("id", "label", "bits", "features"), BASES, folds)
    return pred


@query("oof_predictions")
def q_oof_predictions(spark, sf):
    """Out-of-fold probability per (id, repeat, base model), wide by base."""
    data, folds = _cv_inputs(spark, sf)
    tables = [MD.repeated_cv(data, folds, m)[0] for m in BASES]
    return reduce(DataFrame.unionByName, tables).groupBy("id", "Repeat").pivot("Model", BASES).agg(F.first("score"))


@query("ensemble_vs_best", SUMMARY + """,
r AS (SELECT *, row_number() OVER (ORDER BY ROC_AUC DESC, Descriptor, Model) AS rk FROM summary),
lg AS (UNPIVOT r ON """ + ", ".join(METRIC_NAMES) + """ INTO NAME Metric VALUE value)
SELECT a.Metric, a.value AS first, b.value AS second, a.value - b.value AS Difference
FROM lg a JOIN lg b ON a.Metric = b.Metric AND a.rk = 1 AND b.rk = 2""")
def q_ensemble_vs_best(spark, sf):
    s = summary(spark, sf)
    top = MD.select_top_k(s, 2)
    def pick(i):
        d, m = top[i]
        row = s.filter((F.col("Descriptor") == d) & (F.col("Model") == m))
        return row.unpivot(["Descriptor", "Model"], M.METRICS, "Metric", "value").select("Metric", "value")
    a = pick(0).withColumnRenamed("value", "first")
    b = pick(1).withColumnRenamed("value", "second")
    return a.join(b, "Metric").withColumn("Difference", F.col("first") - F.col("second"))
