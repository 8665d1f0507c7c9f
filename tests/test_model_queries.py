"""The registered model queries run the whole job: what reaches the operators."""

import pytest
from pyspark.sql import functions as F

from curlew.operators import models as MD
from curlew.plans import catalog, q_models

catalog.load_all()
MODELS = sorted(MD.DEFAULTS)


class Stop(Exception):
    pass


@pytest.fixture
def calls(spark, monkeypatch):
    """Fits are recorded instead of made, and give empty tables."""
    seen = []
    rows = [(i, i % 2, "test" if i % 5 == 4 else "train", [i % 7]) for i in range(80)]
    small = spark.createDataFrame(rows, "id long, label int, split string, bits array<int>")
    monkeypatch.setattr(q_models, "curated_split_fp", lambda spark, sf: small)

    def cv(data, folds, model, params=None, **kw):
        seen.append((model, params or {}, folds))
        pred = spark.createDataFrame([], "id long, y int, score double, Repeat int, Fold int, Descriptor string, Model string")
        return pred, spark.createDataFrame([], "Descriptor string, Model string, Repeat int, Fold int")

    def tune(data, folds, model, n_trials=50, **kw):
        seen.append((model, n_trials, folds))
        return {}, spark.createDataFrame([(t, 0.5) for t in range(1, n_trials + 1)], "trial int, score double")

    def stacking(train, test, bases, folds, **kw):
        seen.append((sorted(bases), folds))
        raise Stop

    def final(train, test, model, params=None, **kw):
        seen.append((model, params or {}))
        raise Stop

    for name, fn in (("repeated_cv", cv), ("tune", tune), ("stacking", stacking), ("final_fit_score", final)):
        monkeypatch.setattr(MD, name, fn)
    return seen


def tags(folds):
    return sorted(tuple(r) for r in folds.select("Repeat", "Fold").distinct().collect())


ALL = [(r, f) for r in range(1, 6) for f in range(1, 6)]


@pytest.mark.parametrize("name", ["repeated_cv", "oof_predictions"])
def test_cv_queries_have_all_models_and_folds(spark, calls, name):
    catalog.QUERIES[name](spark, "")
    assert sorted(c[0] for c in calls) == MODELS and all(c[1] == {} for c in calls)
    assert tags(calls[0][2]) == ALL


def test_tune_has_all_trials_and_folds(spark, calls):
    got = catalog.QUERIES["tune"](spark, "")
    assert sorted(c[0] for c in calls) == MODELS and {c[1] for c in calls} == {50}
    assert tags(calls[0][2]) == ALL
    assert got.select("Model", "trial").distinct().count() == 50 * len(MODELS)


def test_stacking_and_final_fit(spark, calls):
    with pytest.raises(Stop):
        catalog.QUERIES["stacking"](spark, "")
    assert calls[0][0] == MODELS and tags(calls[0][1]) == ALL[:5]
    with pytest.raises(Stop):
        catalog.QUERIES["final_fit_score"](spark, "")
    assert calls[1] == ("LogisticRegression", {})


def test_trials_share_one_table_of_folds(spark, monkeypatch):
    made = []
    whole = MD.fold_tagged
    monkeypatch.setattr(MD, "fold_tagged", lambda *a: made.append(1) or whole(*a))
    rows = [(i, i % 2, [i % 2, 3 + i % 5, 8 + i % 3]) for i in range(40)]
    data = MD.bits_to_vector(spark.createDataFrame(rows, "id long, label int, bits array<int>"), nbits=16)
    folds = spark.createDataFrame([(i, 1, 1 + i % 4 // 2) for i in range(40)], "id long, Repeat int, Fold int")
    best, scores = MD.tune(data.select("id", "label", "features"), folds, "LogisticRegression", n_trials=2)
    got = {r["trial"]: r["score"] for r in scores.collect()}
    assert len(made) == 1 and set(got) == {1, 2} and set(best) == {"C"}
    params = {r["trial"]: {r["param"]: r["value"]} for r in MD.trial_table(spark, ["LogisticRegression"], 2).collect()}
    for t, p in params.items():
        _, res = MD.repeated_cv(data.select("id", "label", "features"), folds, "LogisticRegression", p)
        assert got[t] == pytest.approx(sum(r["ROC_AUC"] for r in res.collect()) / 2)


def test_svm_kernels_are_fitted_side_by_side(spark, monkeypatch):
    """All three kernels are under way at a time (F1)."""
    from threading import Barrier

    from curlew.plans import q_batched

    rows = [(i, i % 2, "test" if i % 5 == 4 else "train", [i % 7]) for i in range(20)]
    small = spark.createDataFrame(rows, "id long, label int, split string, bits array<int>")
    monkeypatch.setattr(q_batched, "curated_split_fp", lambda spark, sf: small)
    met = Barrier(3, timeout=30)

    def final(train, test, model, params=None, **kw):
        met.wait()
        return test.select("id", F.col("label").alias("True_Label"), F.lit(1).alias("Predicted_Label"), F.lit(0.7).alias("Predicted_Probability"), F.lit("Positive").alias("Prediction"))

    monkeypatch.setattr(MD, "final_fit_score", final)
    got = catalog.QUERIES["svm_scores"](spark, "").collect()
    assert sorted((r.id, r.Kernel) for r in got) == sorted((i, k) for i in range(4, 20, 5) for k in ("rbf", "linear", "poly"))
