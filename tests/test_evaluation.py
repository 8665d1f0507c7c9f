"""The evaluation run: cells, availability, and going on after a stop."""

import pytest
from pyspark.sql import functions as F

from curlew.operators import evaluation as EV
from curlew.operators import models as MD
from curlew.operators import split as SP
from curlew.session import scratch_path


@pytest.fixture(scope="module")
def run(spark):
    rows = [(i, int(i % 3 == 0), [i % 7, 10 + i % 4] + ([20] if i % 3 == 0 and i % 2 else [])) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, label int, bits array<int>").cache()
    folds = SP.stratified_folds(df.select("id", "label"), "label", "id", k=3, repeats=2).select("id", "Repeat", "Fold").cache()
    return {"a": df, "b": df.withColumn("bits", F.slice("bits", 1, 1))}, folds


def cells(df):
    return sorted(tuple(r) for r in df.select(*EV.CELL).collect())


def test_a_stopped_run_goes_on_where_it_was(spark, run, monkeypatch):
    families, folds = run
    path = scratch_path(spark, "t-grid")
    fits, real = [], MD.repeated_cv

    def stopping(data, folds_, model, params, descriptor, *args):
        if len(fits) == 2:
            raise KeyboardInterrupt
        fits.append((descriptor, model))
        return real(data, folds_, model, params, descriptor, *args)

    monkeypatch.setattr(MD, "repeated_cv", stopping)
    with pytest.raises(KeyboardInterrupt):
        EV.evaluation_grid(families, ["KNN", "Bayesian"], folds, path)
    assert len(cells(EV.finished(spark, path))) == 2 * 6
    before = list(fits)
    monkeypatch.setattr(MD, "repeated_cv", lambda *a: fits.append((a[4], a[2])) or real(*a))
    done = EV.evaluation_grid(families, ["KNN", "Bayesian"], folds, path)
    want = sorted((d, m, r, f) for d in "ab" for m in ("KNN", "Bayesian") for r in (1, 2) for f in (1, 2, 3))
    assert cells(done) == want and sorted(fits) == sorted({(d, m) for d, m, _, _ in want}) and fits[:2] == before
    fits.clear()
    assert cells(EV.evaluation_grid(families, ["KNN", "Bayesian"], folds, path)) == want and fits == []


def test_missing_folds_alone_are_added(spark, run):
    families, folds = run
    path = scratch_path(spark, "t-grid")
    one = {"a": families["a"]}
    whole = EV.evaluation_grid(one, ["Bayesian"], folds, path)
    other = scratch_path(spark, "t-grid")
    whole.where("Fold <> 2").write.parquet(other)
    again = EV.evaluation_grid(one, ["Bayesian"], folds, other)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, whole.collect()))


def test_unavailable_names_are_left_out(spark, run):
    families, folds = run
    path = scratch_path(spark, "t-grid")
    got = EV.evaluation_grid({"a": families["a"]}, ["Bayesian", "TabPFN"], folds, path, descriptors=["a", "none"])
    assert {(r["Descriptor"], r["Model"]) for r in got.collect()} == {("a", "Bayesian")}
    assert cells(EV.evaluation_grid({}, ["KNN"], folds, scratch_path(spark, "t-grid"))) == []


def test_every_family_fits_once(spark):
    """Each model of the catalogue, fitted with few rounds, scores 80 rows better than chance."""
    rows = [(i, i % 2, [i % 5] + ([8, 9] if i % 2 else [6, 7]), "train" if i % 4 else "test") for i in range(80)]
    df = MD.bits_to_vector(spark.createDataFrame(rows, "id long, label int, bits array<int>, split string"), nbits=16).cache()
    few = {"RandomForest": {"numTrees": 5, "maxDepth": 4}, "GradientBoosting": {"maxIter": 3, "maxDepth": 2}, "LinearSVC": {"maxIter": 20}, "SVM": {"components": 32, "maxIter": 20}}
    for model in MD.DEFAULTS:
        got = MD.final_fit_score(df.where("split = 'train'"), df.where("split = 'test'"), model, few.get(model), nbits=16).collect()
        assert len(got) == 20 and all(0 <= r["Predicted_Probability"] <= 1 for r in got), model
        assert all(r["True_Label"] == r["Predicted_Label"] for r in got), model


def test_knn_with_more_neighbours_than_trials(spark, run):
    families, folds = run
    best, scores = MD.tune(families["a"], folds, "KNN", n_trials=4)
    trials = {r["trial"]: r["value"] for r in MD.trial_table(spark, ["KNN"], 4).collect()}
    top = max(scores.collect(), key=lambda r: (r["score"], -r["trial"]))
    assert best == {"n_neighbors": trials[top["trial"]]} and scores.count() == 4
