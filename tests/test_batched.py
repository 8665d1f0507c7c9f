"""Batched cross-validation against one fit, or one search, for each fold and trial."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from curlew.operators import batched as B
from curlew.operators import models as MD
from curlew.operators import split as SP

NBITS = 32


def table(spark, n=90, seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.35)
        bits = sorted({int(b) for b in rng.integers(0, NBITS, int(rng.integers(0, 12)))} | ({3, 9} if y and rng.random() < 0.7 else set()))
        rows.append((i * 7 + 1, y, bits, [float(x) for x in rng.normal(y, 2, 4) * [1, 100, 0.01, 0]]))
    return rows, spark.createDataFrame(rows, "id long, label int, bits array<int>, x array<double>")


@pytest.fixture(scope="module")
def case(spark):
    rows, df = table(spark)
    folds = SP.stratified_folds(df.select("id", "label"), "label", "id", k=4, repeats=2).select("id", "Repeat", "Fold").cache()
    tags = {(r["Repeat"], r["id"]): r["Fold"] for r in folds.collect()}
    return rows, df, folds, tags


def held_out(rows, tags):
    for rep in (1, 2):
        for fold in range(1, 5):
            test = [r for r in rows if tags[rep, r[0]] == fold]
            yield rep, fold, [r for r in rows if tags[rep, r[0]] != fold], test


def got(scores):
    return {(r["trial"], r["Repeat"], r["Fold"], r["id"]): (r["score"], r["pred"], r["y"]) for r in scores.collect()}


def test_naive_bayes_scores_of_every_fold_and_smoothing(case):
    rows, df, folds, tags = case
    alphas = [1.0, 0.01, 7.5]
    found = got(B.nb_scores(df, folds, alphas, NBITS))
    assert len(found) == 3 * 2 * len(rows)
    for rep, fold, train, test in held_out(rows, tags):
        x = np.zeros((len(train), NBITS))
        for k, r in enumerate(train):
            x[k, r[2]] = 1
        y = np.array([r[1] for r in train])
        for t, a in enumerate(alphas, 1):
            p = np.array([(x[y == c].sum(axis=0) + a) / ((y == c).sum() + 2 * a) for c in (0, 1)])
            for r in test:
                v = np.zeros(NBITS)
                v[r[2]] = 1
                log = [np.log((y == c).mean()) + (v * np.log(p[c]) + (1 - v) * np.log(1 - p[c])).sum() for c in (0, 1)]
                want = 1 / (1 + np.exp(log[0] - log[1]))
                assert found[t, rep, fold, r[0]] == (pytest.approx(want, abs=1e-9), int(want >= 0.5), r[1])


def test_neighbours_of_every_fold_and_k(case, monkeypatch):
    rows, df, folds, tags = case
    ks = [1, 5, 30, 4]
    found = got(B.knn_scores(df, folds, ks, NBITS))
    assert len(found) == 4 * 2 * len(rows)
    for rep, fold, train, test in held_out(rows, tags):
        for r in test:
            near = sorted(train, key=lambda o: (len(set(o[2]) ^ set(r[2])), o[0]))
            for t, k in enumerate(ks, 1):
                share = np.mean([o[1] for o in near[:k]])
                assert found[t, rep, fold, r[0]] == (pytest.approx(share), int(share > 0.5), r[1])


def test_neighbour_lists_deepen_where_a_fold_holds_the_near_rows(spark):
    """Sixty equal rows in one fold: their first lists hold no row of another fold."""
    rows = [(i, i % 2, [1], 1 if i < 60 else 2 + i % 3) for i in range(60)] + [(60 + i, i % 2, [i % 30, 31], 2 + i % 3) for i in range(60)]
    df = spark.createDataFrame([r[:3] for r in rows], "id long, label int, bits array<int>")
    folds = spark.createDataFrame([(r[0], 1, r[3]) for r in rows], "id long, Repeat int, Fold int")
    found = {}
    for r in B.fold_neighbours(df, folds, 10, NBITS).collect():
        found.setdefault(r["id"], {})[r["nth"]] = r["near_y"]
    for r in rows:
        near = sorted((o for o in rows if o[3] != r[3]), key=lambda o: (len(set(o[2]) ^ set(r[2])), o[0]))[:10]
        assert [found[r[0]][k] for k in range(1, 11)] == [o[1] for o in near]


def test_too_few_rows_for_k_and_one_class_are_failed_folds(spark):
    df = spark.createDataFrame([(i, int(i == 0), [i % 3]) for i in range(8)], "id long, label int, bits array<int>")
    folds = spark.createDataFrame([(i, 1, 1 + i % 2) for i in range(8)], "id long, Repeat int, Fold int")
    knn = B.cv_metrics(B.knn_scores(df, folds, [4, 5], NBITS), folds, 2, "d", "KNN").collect()
    assert {(r["trial"], r["status"]) for r in knn} == {(1, "ok"), (2, "failed")} and len(knn) == 4
    for scores in (B.nb_scores(df, folds, [1.0], NBITS), B.logistic_scores(df, folds, [1.0], NBITS)[0]):
        rows = {r["Fold"]: r["status"] for r in B.cv_metrics(scores, folds, 1, "d", "m").collect()}
        assert rows == {1: "failed", 2: "ok"}  # the only positive row is in fold 1


def test_empty_tables(spark):
    df = spark.createDataFrame([], "id long, label int, bits array<int>")
    folds = spark.createDataFrame([], "id long, Repeat int, Fold int")
    assert B.nb_scores(df, folds, [1.0]).collect() == [] and B.knn_scores(df, folds, [3]).collect() == []
    assert B.logistic_scores(df, folds, [1.0])[0].collect() == []


def test_logistic_columns_equal_single_fits(spark, case):
    """Coefficients of each column against Newton's method on its own rows, and the
    scores of one fold against Spark ML."""
    rows, df, folds, tags = case
    cs = [1.0, 0.01, 50.0]
    scores, coef = B.logistic_scores(df, folds, cs, NBITS)
    assert len(coef) == 3 * 8
    for rep, fold, train, test in held_out(rows, tags):
        x = np.zeros((len(train), NBITS + 1))
        for k, r in enumerate(train):
            x[k, r[2]] = 1
        x[:, -1] = 1
        y = np.array([r[1] for r in train])
        w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
        ridge = np.append(np.ones(NBITS), 0.0)
        for t, c in enumerate(cs, 1):
            b = np.zeros(NBITS + 1)
            for _ in range(60):
                p = 1 / (1 + np.exp(-x @ b))
                b -= np.linalg.solve((x.T * (c * w * p * (1 - p))) @ x + np.diag(ridge) + 1e-14 * np.eye(NBITS + 1), c * x.T @ (w * (p - y)) + ridge * b)
            assert np.abs(coef[t, rep, fold] - b).max() < 1e-6
    spread, other = B.logistic_scores(df, folds, cs[:2], NBITS, local_bytes=0)
    assert max(np.abs(other[k] - coef[k]).max() for k in other) < 1e-6
    a, b = got(scores), got(spread)
    assert all(abs(a[k][0] - b[k][0]) < 1e-6 for k in b) and len(b) == 2 * 2 * len(rows)
    ml = MD.bits_to_vector(df, "bits", NBITS).select("id", "label", "features")
    est = MD.build_estimator("LogisticRegression", {}, sum(tags[1, r[0]] != 1 for r in rows)).setLabelCol("label").setFeaturesCol("features").setTol(1e-10)
    first = [r[0] for r in rows if tags[1, r[0]] == 1]
    model = est.fit(MD.class_weights(ml.where(~F.col("id").isin(first)), "label"))
    for r in model.transform(ml.where(F.col("id").isin(first))).collect():
        assert a[1, 1, 1, r["id"]][0] == pytest.approx(r["probability"][1], abs=1e-4)


def test_logistic_scales_on_the_train_rows_of_each_fold(case):
    rows, df, folds, tags = case
    _, coef = B.logistic_scores(df, folds, [2.0], features="x", scale=True)
    scores = got(B.logistic_scores(df, folds, [2.0], features="x", scale=True)[0])
    for rep, fold, train, test in held_out(rows, tags):
        x = np.array([r[3] for r in train])
        lo, span = x.min(axis=0), np.ptp(x, axis=0)
        span[span == 0] = 1
        b = coef[1, rep, fold]
        for r in test:
            z = ((np.array(r[3]) - lo) / span) @ b[:-1] + b[-1]
            assert scores[1, rep, fold, r[0]][0] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)
        # the gradient of the objective on scaled features vanishes
        s = np.hstack([(x - lo) / span, np.ones((len(x), 1))])
        y = np.array([r[1] for r in train])
        w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
        g = 2.0 * s.T @ (w * (1 / (1 + np.exp(-s @ b)) - y)) + np.append(b[:-1], 0)
        assert np.abs(g).max() < 1e-5


def test_bits_are_local_by_the_bytes_sent():
    # 13,000 rows of 200 positions: 213 MB unfolded, 11 MB as sent
    assert B.is_local(13_000, 2048, 13_000 * 200, 1250, 8, B.LOCAL_BYTES)
    assert not B.is_local(13_000, 2048, None, 1250, 8, B.LOCAL_BYTES)
    assert not B.is_local(60_000, 2048, 60_000 * 200, 25, 8, B.LOCAL_BYTES)  # few columns, many rows
    assert not B.is_local(10_000_000, 2048, 10_000_000 * 200, 1250, 8, B.LOCAL_BYTES)
    assert not B.is_local(10, 64, 100, 25, 8, 0)


def test_naive_bayes_sends_each_row_once(case):
    """The scoring plan meets no row with its bits again; repeated ids count as often as they come."""
    rows, df, folds, tags = case
    plan = B.nb_scores(df, folds, [1.0], NBITS)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "MapInArrow" in plan
    twice = got(B.nb_scores(df.unionByName(df), folds, [1.0], NBITS))
    assert B.nb_scores(df.unionByName(df), folds, [1.0], NBITS).count() == 2 * 2 * len(rows) and len(twice) == 2 * len(rows)
    for rep, fold, train, test in held_out(rows, tags):
        x = np.zeros((len(train), NBITS))
        for k, r in enumerate(train):
            x[k, r[2]] = 1
        y = np.array([r[1] for r in train])
        p = np.array([(2 * x[y == c].sum(axis=0) + 1) / (2 * (y == c).sum() + 2) for c in (0, 1)])
        for r in test:
            v = np.zeros(NBITS)
            v[r[2]] = 1
            log = [np.log((y == c).mean()) + (v * np.log(p[c]) + (1 - v) * np.log(1 - p[c])).sum() for c in (0, 1)]
            assert twice[1, rep, fold, r[0]][0] == pytest.approx(1 / (1 + np.exp(log[0] - log[1])), abs=1e-9)


def test_curvature_saves_passes_and_keeps_the_optimum(spark, monkeypatch):
    """Few passes over the rows reach the coefficients that many reach without it (F19)."""
    rng = np.random.default_rng(8)
    n, width = 400, 60
    x = rng.random((n, width)) < rng.uniform(0.02, 0.9, width)
    y = (x[:, :8].sum(axis=1) + rng.normal(0, 1, n) > np.median(x[:, :8].sum(axis=1))).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), np.flatnonzero(x[i]).tolist()) for i in range(n)], "id long, label int, bits array<int>").repartition(3)
    folds = df.select("id", F.lit(1).alias("Repeat"), (F.col("id") % 3).cast("int").alias("Fold"))
    passes, plain = [], B.minimise

    def counted(evaluate, *a, **k):
        passes.append(0)

        def one(*p):
            passes[-1] += 1
            return evaluate(*p)
        return plain(one, *a, **k)

    monkeypatch.setattr(B, "minimise", counted)
    _, curved = B.logistic_scores(df, folds, [1.0], width, local_bytes=0)
    monkeypatch.setattr(B, "curvature", lambda *a: None)
    _, other = B.logistic_scores(df, folds, [1.0], width, local_bytes=0)
    assert passes[0] * 2 < passes[1]
    assert all(np.abs(curved[k] - other[k]).max() < 1e-5 for k in other) and len(other) == 3
