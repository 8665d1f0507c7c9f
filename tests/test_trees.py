import numpy as np
import pytest
from pyspark.sql import functions as F

from curlew.operators import models as MD
from curlew.operators import trees as TR


def packed_rows(x):
    return np.packbits(x, axis=1, bitorder="little")


def made(rng, n=160, nbits=16):
    x = (rng.random((n, nbits)) < rng.uniform(0.2, 0.8, nbits)).astype(np.uint8)
    y = ((x[:, 1] ^ x[:, 4]) | (rng.random(n) < 0.2)).astype(float)
    return x, y


def gini(y, w):
    p = (w * y).sum() / w.sum()
    return 2 * p * (1 - p)


def variance(t, w):
    m = (w * t).sum() / w.sum()
    return (w * (t - m) ** 2).sum() / w.sum()


def grown(x, t, w, n, impurity, depth, least):
    """The same tree by recursion: a function of a row."""
    value = (w * t).sum() / w.sum()
    best, at = 1e-12, None
    for j in range(x.shape[1] if depth else 0):
        a = x[:, j] == 1
        if n[a].sum() < least or n[~a].sum() < least:
            continue
        gain = impurity(t, w) - sum(w[s].sum() / w.sum() * impurity(t[s], w[s]) for s in (a, ~a))
        if gain > best + 1e-9:
            best, at = gain, j
    if at is None:
        return lambda r: value
    yes, no = (grown(x[s], t[s], w[s], n[s], impurity, depth - 1, least) for s in (x[:, at] == 1, x[:, at] == 0))
    return lambda r: yes(r) if r[at] else no(r)


@pytest.mark.parametrize("depth, least", [(0, 1), (1, 1), (3, 1), (3, 12), (12, 1)])
def test_forest_tree_equals_recursion(depth, least):
    rng = np.random.default_rng(depth + least)
    x, y = made(rng)
    train, held, weight = np.arange(20, 160), np.arange(20), np.array([0.7, 1.6])
    got = TR.forest_tree(packed_rows(x), y, train, held, weight, np.random.default_rng(5), depth, least, 16, 16)
    n = np.random.default_rng(5).poisson(1.0, 140)
    w = n * np.where(y[train] == 1, weight[1], weight[0])
    some = n > 0
    tree = grown(x[train][some], y[train][some], w[some], n[some], gini, depth, least)
    if depth <= 3:  # below, equal gains may be split otherwise
        assert got == pytest.approx([tree(r) for r in x[held]])
    assert ((got >= 0) & (got <= 1)).all()


@pytest.mark.parametrize("depth, least, some", [(1, 1, 16), (2, 1, 16), (3, 9, 16), (4, 1, 5)])
def test_boosting_equals_recursion(depth, least, some):
    rng = np.random.default_rng(7)
    x, y = made(rng)
    train, held, weight = np.arange(20, 160), np.arange(20), np.array([0.6, 2.0])
    got = TR.boosted_scores(packed_rows(x), y, train, held, weight, rng, 4, 0.3, depth, 1.0, least, some, 16)
    sign, w = 2 * y[train] - 1, np.where(y[train] == 1, 2.0, 0.6)
    f, out = np.zeros(140), np.zeros(20)
    for k in range(4):
        tree = grown(x[train], sign if k == 0 else 4 * sign / (1 + np.exp(2 * sign * f)), w, np.ones(140), variance, depth, least)
        f += (0.3 if k else 1.0) * np.array([tree(r) for r in x[train]])
        out += (0.3 if k else 1.0) * np.array([tree(r) for r in x[held]])
    if some == 16:
        assert got == pytest.approx(1 / (1 + np.exp(-2 * out)), abs=1e-5)
    assert ((got >= 0) & (got <= 1)).all()


def test_features_of_a_node_differ():
    for some in (1, 46, 300, 2048):
        f = TR.draw_features(np.random.default_rng(1), 700, some, 2048)
        assert f.shape == (700, some) and all(len(set(r)) == some for r in f.tolist()) and f.min() >= 0 and f.max() < 2048
    assert [TR.subset_size(s, 2048) for s in ("sqrt", "log2", "all", "onethird", "7", "0.5", "1.0")] == [46, 11, 2048, 683, 7, 1024, 2048]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    x, y = made(rng, 120, 64)
    rows = [(i, int(v), np.flatnonzero(r).tolist()) for i, (r, v) in enumerate(zip(x, y))]
    data = MD.bits_to_vector(spark.createDataFrame(rows, "id long, label int, bits array<int>"), nbits=2048).cache()
    folds = spark.createDataFrame([(i, 1, 1 + i % 2) for i in range(120)], "id long, Repeat int, Fold int")
    return data, folds


def test_boosting_equals_spark_without_its_jobs(spark, table):
    """Whole boosted trees for all folds, in a few jobs (F3, F4, F5)."""
    data, folds = table
    params = {"maxIter": 3, "maxDepth": 2, "subsamplingRate": 1.0}
    here, found = MD.repeated_cv(data, folds, "GradientBoosting", params)
    there, _ = MD.repeated_cv(data.drop("bits"), folds, "GradientBoosting", params)
    a, b = ({r.id: r.score for r in d.collect()} for d in (here, there))
    assert len(a) == 120 and a == pytest.approx(b, abs=1e-5)
    assert [(r.Repeat, r.Fold, r.status, r.tp + r.fp + r.tn + r.fn) for r in found.orderBy("Fold").collect()] == [(1, 1, "ok", 60), (1, 2, "ok", 60)]


def test_forest_has_all_its_trees(spark, table, monkeypatch):
    """A forest is dealt to tasks and whole again; its scores do not depend on the shares (F3, F4, F5)."""
    data, folds = table
    data = data.withColumn("label", F.array_contains("bits", 1).cast("int"))
    params = {"numTrees": 30}
    one = {r.id: r.score for r in MD.repeated_cv(data, folds, "RandomForest", params)[0].collect()}
    monkeypatch.setattr(TR, "TREES", 7)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("forest", "forest")
    pred, found = MD.repeated_cv(data, folds, "RandomForest", params)
    assert {r.id: r.score for r in pred.collect()} == pytest.approx(one)
    assert len(jobs.getJobIdsForGroup("forest")) < 30
    assert found.where("ROC_AUC > 0.8").count() == 2
    last = MD.final_fit_score(data.where("id < 80"), data.where("id >= 80"), "RandomForest", params)
    assert last.count() == 40 and last.where("Predicted_Probability between 0 and 1").count() == 40


def test_linear_machines_of_all_folds_equal_spark(spark, table):
    """All folds of the linear machine in one optimiser, near Spark's own fits (F3, F4, F5)."""
    data, folds = table
    data = data.withColumn("label", (F.array_contains("bits", 1) | (F.col("id") % 7 == 0)).cast("int"))
    here, found = MD.repeated_cv(data, folds, "LinearSVC", {"C": "0.01"})
    there, _ = MD.repeated_cv(data.drop("bits"), folds, "LinearSVC", {"C": "0.01"})
    a, b = ({r.id: r.score for r in d.collect()} for d in (here, there))
    assert found.where("status = 'ok'").count() == 2 and len(a) == len(b) == 120
    x, y = (np.array([s[i] for i in sorted(a)]) for s in (a, b))
    assert np.corrcoef(x, y)[0, 1] > 0.99 and np.abs(x - y).max() < 0.05
