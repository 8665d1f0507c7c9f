import numpy as np
import pytest

from curlew.functions.tails import f_sf, studentized_range_sf
from curlew.operators import stats as ST


def test_tails_against_tables():
    assert f_sf(3.35, 2, 27) == pytest.approx(0.05, abs=1e-3)
    assert studentized_range_sf(3.877, 3, 10) == pytest.approx(0.05, abs=1e-3)
    assert studentized_range_sf(5.910, 3, 3) == pytest.approx(0.05, abs=1e-3)
    assert studentized_range_sf(4.232, 5, 20) == pytest.approx(0.05, abs=1e-3)


def test_rm_anova_and_tukey(spark):
    rng = np.random.default_rng(1)
    n, k = 6, 3
    x = rng.normal(size=(n, k)) + np.array([0, 0.5, 1.0])
    rows = [("g", f"s{i}", f"m{j}", float(x[i, j])) for i in range(n) for j in range(k)]
    df = spark.createDataFrame(rows, "grp string, Subject string, Model string, value double")
    a = ST.rm_anova(df, ["grp"]).first()
    gm = x.mean()
    ssf = n * ((x.mean(0) - gm) ** 2).sum()
    sss = k * ((x.mean(1) - gm) ** 2).sum()
    sse = ((x - gm) ** 2).sum() - ssf - sss
    F = (ssf / (k - 1)) / (sse / ((k - 1) * (n - 1)))
    assert a.F == pytest.approx(F) and a.p_value == pytest.approx(f_sf(F, k - 1, (k - 1) * (n - 1)))
    t = {(r.Group1, r.Group2): r for r in ST.tukey_hsd(df, ["grp"]).collect()}
    resid = (x - x.mean(1, keepdims=True)).ravel()
    se = np.sqrt(resid.var(ddof=1) / n)
    assert t[("m0", "m2")].q_stat == pytest.approx(abs(x[:, 0].mean() - x[:, 2].mean()) / se)


def test_one_model_gives_empty_tukey(spark):
    df = spark.createDataFrame([("g", "s1", "m", 1.0), ("g", "s2", "m", 2.0)],
                               "grp string, Subject string, Model string, value double")
    assert ST.tukey_hsd(df, ["grp"]).count() == 0
    assert ST.pairwise_matrix(ST.tukey_hsd(df, ["grp"]), ["grp"]).count() == 0


def test_compact_letters_first_fit(spark):
    p = [("A", "B", 0.5), ("A", "C", 0.01), ("B", "C", 0.2)]
    rows = [(a, b, v) for a, b, v in p] + [(b, a, v) for a, b, v in p] + [(m, m, 1.0) for m in "ABC"]
    pm = spark.createDataFrame([("g", *r) for r in rows], "grp string, g1 string, g2 string, p double")
    got = {r.model: r.letter for r in ST.compact_letters(pm, ["grp"]).collect()}
    assert got == {"A": "a", "B": "a", "C": "b"}
