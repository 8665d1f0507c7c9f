import numpy as np
import pytest

from curlew.operators import metrics as M


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    if len(pos) == 0 or len(neg) == 0:
        return None
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


def brute_ap(y, s):
    P = (y == 1).sum()
    if P == 0:
        return None
    ap = 0.0
    for t in np.unique(s):
        sel = s >= t
        tp, fp = (sel & (y == 1)).sum(), (sel & (y == 0)).sum()
        ap += ((s == t) & (y == 1)).sum() / P * tp / (tp + fp)
    return ap


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_auc_ap_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    n = 300
    g = rng.integers(0, 3, n)
    y = rng.integers(0, 2, n)
    s = np.round(rng.random(n) * 10) / 10 + 0.1 * y
    df = spark.createDataFrame([(int(a), int(b), float(c)) for a, b, c in zip(g, y, s)], "g int, y int, score double")
    for nb in (1, 4, 64):
        got = {r.g: (r.ROC_AUC, r.PR_AUC) for r in M.ranking_metrics(df, ["g"], n_buckets=nb).collect()}
        for k in range(3):
            m = g == k
            assert got[k][0] == pytest.approx(brute_auc(y[m], s[m]), abs=1e-12)
            assert got[k][1] == pytest.approx(brute_ap(y[m], s[m]), abs=1e-12)


def test_reversed_tied_one_class(spark):
    rows = [(0, 1, 0.9), (0, 0, 0.1), (0, 1, 0.4), (0, 0, 0.4), (1, 1, 0.5), (1, 0, 0.5), (2, 1, 0.3)]
    df = spark.createDataFrame(rows, "g int, y int, score double")
    r = {x.g: x for x in M.ranking_metrics(df, ["g"]).collect()}
    rev = {x.g: x for x in M.ranking_metrics(df.selectExpr("g", "y", "-score AS score"), ["g"]).collect()}
    assert r[0].ROC_AUC == pytest.approx(1 - rev[0].ROC_AUC)
    assert r[1].ROC_AUC == 0.5          # all scores tied
    assert r[2].ROC_AUC is None         # one class only


def test_threshold_metrics_zero_division(spark):
    rows = [(0, 0, 0), (0, 0, 0), (0, 1, 0)]   # never predicts positive
    df = spark.createDataFrame(rows, "g int, y int, pred int")
    t = M.threshold_metrics(M.confusion(df, ["g"], "y", "pred")).first()
    assert t.Precision == 0.0 and t.F1 == 0.0 and t.MCC == 0.0 and t.Sensitivity == 0.0
    assert t.Specificity == 1.0 and t.Accuracy == pytest.approx(2 / 3)
