"""No operator loses rows, fails in silence or changes its formula at a size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from curlew.functions.tails import studentized_range_sf
from curlew.operators import clean as C
from curlew.operators import models as MD
from curlew.operators import similarity as S
from curlew.operators import split as SP
from curlew.operators import stats as ST
from curlew.session import scratch_path
from curlew.sources import io as IO


def test_null_labels_stay_in_splits_and_folds(spark):
    rows = [(i, None if i % 5 == 0 else i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, label int")
    split = SP.stratified_split(df).collect()
    assert sorted(r.id for r in split) == list(range(20))
    assert sum(r.split == "test" for r in split) == 4
    folds = SP.stratified_folds(df, k=4, repeats=2).collect()
    assert len(folds) == 40 and {r.Fold for r in folds if r.label is None} == {1, 2, 3, 4}


def test_fold_scaling_keeps_a_group_of_one_fold(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 2, 4.0), (2, 1, 3.0), (2, 1, 9.0)], "Repeat int, Fold int, x double")
    got = sorted((r.Repeat, r.x) for r in MD.fold_minmax_scale(df, ["Repeat"], "Fold", ["x"]).collect())
    assert len(got) == 4 and [x for rep, x in got if rep == 2] == [3.0, 9.0]


def test_unknown_model_and_depth_raise(spark):
    data = spark.createDataFrame([(1, 0)], "id long, label int")
    folds = spark.createDataFrame([(1, 1, 1)], "id long, Repeat int, Fold int")
    with pytest.raises(ValueError, match="NoSuchModel"):
        MD.repeated_cv(data, folds, "NoSuchModel")
    with pytest.raises(ValueError, match="maxDepth"):
        MD.build_estimator("RandomForest", {"maxDepth": 31}, 10)


def test_cv_has_a_status_for_each_fold(spark):
    rng = np.random.default_rng(0)
    rows = [(i, i % 2, [int(b) for b in np.flatnonzero(rng.random(16) < 0.3 + 0.3 * (i % 2))]) for i in range(40)]
    data = MD.bits_to_vector(spark.createDataFrame(rows, "id long, label int, bits array<int>"), nbits=16)
    tag = [(i, 1, 1 + i % 4 // 2) for i in range(40)] + [(i, 2, 1) for i in range(40)]
    folds = spark.createDataFrame(tag, "id long, Repeat int, Fold int")
    pred, res = MD.repeated_cv(data.select("id", "label", "features"), folds, "LogisticRegression", {"maxIter": 20})
    got = {(r.Repeat, r.Fold): (r.status, r.ROC_AUC) for r in res.collect()}
    assert pred.count() == 40 and set(got) == {(1, 1), (1, 2), (2, 1)}
    assert got[2, 1] == ("failed", None)                   # its train folds are empty
    assert all(got[1, f][0] == "ok" and got[1, f][1] is not None for f in (1, 2))


def test_parameters_without_session_settings(spark):
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
    try:
        tuned = spark.createDataFrame([("d", "LogisticRegression", {"C": "0.5"})], "descriptor string, model string, params map<string,string>")
        row = MD.resolve_params(spark, tuned.select("descriptor", "model"), tuned).first()
        assert row.params == {"C": "0.5", "maxIter": "2000"}
    finally:
        spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")


def test_tail_has_one_formula():
    p = [studentized_range_sf(3.3145, 3, df) for df in (4999, 5000, 5001, 50_000, 5e6)]
    assert abs(p[1] - p[2]) < 1e-6 and abs(p[0] - p[1]) < 1e-6 and abs(p[3] - p[4]) < 1e-4


def test_letters_beyond_the_alphabet_differ_by_group(spark):
    names = [f"m{i:02d}" for i in range(27)]
    rows = [("g", a, b, 1.0 if a == b else 0.0) for a in names for b in names]
    got = ST.compact_letters(spark.createDataFrame(rows, "grp string, g1 string, g2 string, p double"), ["grp"]).collect()
    assert len({r.letter_group for r in got}) == 27 and got[0].letter != got[1].letter


def test_tukey_takes_the_first_value_of_a_cell(spark):
    rows = [(1, s, m, float(v), 0) for s, m, v in [(1, "a", 1), (1, "b", 3), (2, "a", 2), (2, "b", 7)]]
    again = [(1, 1, "a", 5.0, 1)]
    df = spark.createDataFrame(rows + again, "k int, Subject int, Model string, value double, at int")
    x = {(s, m): v for _, s, m, v, _ in rows}
    mean = {1: (1 + 3 + 5) / 3, 2: 4.5}
    res = [x[s, m] - mean[s] for s in (1, 2) for m in "ab"]
    diff = abs((1 + 2 + 5) / 3 - 5)
    got = ST.tukey_hsd(df, ["k"], with_p=False, order="at").first()
    assert got.q_stat == pytest.approx(diff / np.sqrt(np.var(res, ddof=1) / 2))


def test_cluster_split_without_any_order_falls_back(spark):
    df = spark.createDataFrame([(c, i) for c in (1, 2) for i in range(50)], "cluster_id long, r int")
    out, info = SP.cluster_split(df, "cluster_id", 0.2, 0.05)
    assert info["fallback"] and out.count() == 100


def test_funnel_with_switches_off(spark):
    rows = [(i, "x" if i % 4 else "a longer text of some words", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, entity string, label int")
    got = {r.stage: r.value for r in C.curation_funnel(df, validate=False, standardize=False).collect()}
    assert got["after_validation"] == got["after_standardization"] == 40


def test_null_fingerprints_are_empty(spark):
    fp = spark.createDataFrame([(1, [1, 2]), (2, None), (3, [1, 2])], "id long, bits array<int>")
    assert [(r.id_a, r.id_b) for r in S.tanimoto_pairs(fp, 0.5).collect()] == [(1, 3)]
    assert S.similarity_topn(fp, fp, 2).count() == 6


def test_second_upsert_featurises_nothing(spark):
    store, seen = scratch_path(spark, "t-store"), []

    def build(new):
        seen.append(new.count())
        return new.withColumn("bits", F.array(F.length("key")))
    keys = spark.createDataFrame([("a",), ("bb",), ("a",)], "key string")
    assert IO.feature_store_upsert(spark, store, keys, "d", {}, build=build) == 2
    assert IO.feature_store_upsert(spark, store, keys, "d", {}, build=build) == 0
    assert seen == [2, 0]
    IO.feature_store_clear(spark, store)
    assert not IO.path_exists(spark, store)


def test_a_fold_is_scored_before_the_next_is_fitted(spark, monkeypatch):
    """No plan holds a fitted model once its fold is done (F14)."""
    rows = [(i, i % 2, [i % 3, 3 + i % 2]) for i in range(40)]
    data = MD.bits_to_vector(spark.createDataFrame(rows, "id long, label int, bits array<int>"), nbits=8).select("id", "label", "features")
    folds = spark.createDataFrame([(i, 1, 1 + i // 10) for i in range(40)], "id long, Repeat int, Fold int")
    order, build, cut = [], MD.build_estimator, MD.cut_lineage
    monkeypatch.setattr(MD, "build_estimator", lambda *a: order.append("fit") or build(*a))
    monkeypatch.setattr(MD, "cut_lineage", lambda df: order.append("cut") or cut(df))
    pred, _ = MD.repeated_cv(data, folds, "RandomForest", {"numTrees": 2, "maxDepth": 2}, max_workers=1)
    assert order == ["fit", "cut"] + ["fit", "cut"] * 4  # a check of the parameters and the rows with their folds come first
    assert pred.count() == 40
