import numpy as np
import pandas as pd
import pytest

from curlew.operators import features as FE
from curlew.operators import ranks as R


def table(n=400, seed=1):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=n)
    return pd.DataFrame({
        "a": a, "cubed": a ** 3, "ties": np.floor(a * 2), "third": np.where(np.arange(n) % 3 == 0, 7.0, rng.normal(size=n)),
        "free": rng.uniform(size=n), "zeros": np.where(np.arange(n) % 2 == 0, -0.0, 0.0) + (np.arange(n) % 5 == 0)})


@pytest.mark.parametrize("hot", [100_000, 40, 1])
def test_matrix_equals_plain_ranks(spark, monkeypatch, hot):
    """With every value, some values and none by broadcast."""
    monkeypatch.setattr(R, "HOT", hot)
    t = table()
    got = R.spearman_matrix(spark.createDataFrame(t).repartition(5), list(t.columns))
    assert np.allclose(got, t.rank().corr().to_numpy(), atol=1e-12)


def test_value_ranks_cross_ranges(spark):
    cells = spark.createDataFrame([(j, float(v)) for j in (0, 1) for v in [3, 1, 1, 2, 2, 2, 9]], "j int, v double")
    got = {(r.j, r.v): (r.n, r.r) for r in R.value_ranks(cells).collect()}
    assert got == {(j, v): x for j in (0, 1) for v, x in {1.0: (2, 1.5), 2.0: (3, 4.0), 3.0: (1, 6.0), 9.0: (1, 7.0)}.items()}


def test_empty_and_constant(spark):
    none = spark.createDataFrame([], "a double, b double")
    assert np.isnan(R.spearman_matrix(none, ["a", "b"])).all()
    same = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    got = R.spearman_matrix(same, ["a", "b"])
    assert np.isnan(got[0]).all() and got[1, 1] == pytest.approx(1.0)


def test_clean_numeric_decisions(spark):
    t = table()
    t["flat"] = 1.0
    t["hole"] = np.where(np.arange(len(t)) == 5, np.inf, t["free"])
    kept, decided = FE.clean_numeric(spark.createDataFrame(t), list(t.columns))
    why = {r.feature: r.reason for r in decided.collect()}
    rho = t.drop(columns=["flat", "hole"]).corr(method="spearman").abs().to_numpy()
    names = [c for c in t.columns if c not in ("flat", "hole")]
    gone = {names[j] for j in range(1, len(names)) if (rho[:j, j] > 0.95).any()}
    assert why["flat"] == "low_variance" and why["hole"] == "has_null"
    assert {c for c, r in why.items() if r == "correlated"} == gone and "cubed" in gone
    assert kept == [c for c in names if c not in gone]
