import math

import pytest

from curlew.operators import models as MD


def test_trial_table_ranges(spark):
    t = MD.trial_table(spark, ["LogisticRegression", "RandomForest"], 20).collect()
    c = [r.value for r in t if r.param == "C"]
    assert len(c) == 20 and all(1e-3 <= v <= 100.0 for v in c)
    trees = [r.value for r in t if r.param == "numTrees"]
    assert all(100 <= v <= 1000 and v % 100 == 0 for v in trees)
    again = MD.trial_table(spark, ["LogisticRegression", "RandomForest"], 20).collect()
    assert sorted(map(tuple, t)) == sorted(map(tuple, again))        # seeded


def test_resolve_params_tuned_wins_and_unknown(spark):
    req = spark.createDataFrame([("d", "LogisticRegression"), ("d", "Nope")], "descriptor string, model string")
    tuned = spark.createDataFrame([("d", "LogisticRegression", {"C": "0.5"})],
                                  "descriptor string, model string, params map<string,string>")
    r = {x.model: x for x in MD.resolve_params(spark, req, tuned).collect()}
    assert r["LogisticRegression"].params["C"] == "0.5" and r["LogisticRegression"].known == 1
    assert r["Nope"].known == 0 and r["Nope"].params is None


def test_class_weights_and_fold_scaling(spark):
    df = spark.createDataFrame([(i, int(i < 3)) for i in range(12)], "id long, label int")
    w = {r.label: r.weight for r in MD.class_weights(df).select("label", "weight").distinct().collect()}
    assert w[1] == pytest.approx(12 / (2 * 3)) and w[0] == pytest.approx(12 / (2 * 9))
    rows = [(1, f, float(x)) for f, x in [(1, 0), (1, 10), (2, 5), (2, 20), (3, 4)]]
    d = spark.createDataFrame(rows, "Repeat int, Fold int, x double")
    s = MD.fold_minmax_scale(d, ["Repeat"], "Fold", ["x"]).collect()
    got = sorted((r.Fold, r.x) for r in s)
    # fold 1 scaled by folds 2,3: min 4, max 20
    assert got[0] == (1, pytest.approx((0 - 4) / 16)) and got[1] == (1, pytest.approx((10 - 4) / 16))
    assert not any(math.isnan(x) for _, x in got)
