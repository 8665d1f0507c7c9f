"""Models, cross-validation, tuning and stacking on Spark ML.

Two models are written as aggregations (and so are SQL-checkable and scale
with the data): Bernoulli naive Bayes (per (class, bit) counts) and k-NN
vote (exact top-k by Hamming distance from the blocked similarity search).
The others are Spark ML estimators, fitted per (pair, repeat, fold) from a
bounded thread pool on the driver; every fit is itself a distributed job,
and all scored rows go into one prediction table whose metrics are one
grouped aggregation.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import IllegalArgumentException
from pyspark.ml import Pipeline
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curlew.operators import batched as B
from curlew.operators import metrics as M
from curlew.operators import similarity as S
from curlew.operators import trees as TR
from curlew.operators.kernels import KernelSVC
from curlew.operators.split import seeded_hash
from curlew.session import cut_lineage


# ---------------------------------------------------------------------------
# weights and scaling
# ---------------------------------------------------------------------------

def class_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Balanced weights n / (n_classes * n_c) as a column (``weightCol``)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    # one row per class: the unpartitioned window runs over a tiny table
    wt = counts.withColumn("__n", F.sum("__nc").over(Window.partitionBy())) \
        .withColumn("__k", F.count(F.lit(1)).over(Window.partitionBy())) \
        .select(label, (F.col("__n") / (F.col("__k") * F.col("__nc"))).alias(out))
    return df.join(F.broadcast(wt), label)


def fold_minmax_scale(df: DataFrame, group_cols: list[str], fold: str, cols: list[str]) -> DataFrame:
    """Scale each column of the validation fold by the min/max of the other
    folds of its group (fit on train only, applied to validation; not
    clipped; a zero range scales by 1; a group of one fold stays unscaled).
    Per-fold min/max is a small table;
    train statistics are a join of that table with itself."""
    aggs = [f(c).alias(f"__{n}_{c}") for c in cols for f, n in ((F.min, "lo"), (F.max, "hi"))]
    fm = df.groupBy(*group_cols, fold).agg(*aggs)
    a = fm.select(*group_cols, F.col(fold).alias("__f"))
    b = fm.withColumnRenamed(fold, "__g")
    tr = a.join(b, group_cols).filter(F.col("__f") != F.col("__g")).groupBy(*group_cols, "__f").agg(
        *[F.min(f"__lo_{c}").alias(f"__lo_{c}") for c in cols],
        *[F.max(f"__hi_{c}").alias(f"__hi_{c}") for c in cols]).withColumnRenamed("__f", fold)
    j = df.join(tr, [*group_cols, fold], "left")
    for c in cols:
        # a group of one fold has no train rows: its values stay as they are
        lo, hi = F.coalesce(F.col(f"__lo_{c}"), F.lit(0.0)), F.coalesce(F.col(f"__hi_{c}"), F.lit(1.0))
        j = j.withColumn(c, (F.col(c) - lo) / F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo))
    return j.drop(*[f"__{n}_{c}" for c in cols for n in ("lo", "hi")])


# ---------------------------------------------------------------------------
# Bernoulli naive Bayes as aggregations
# ---------------------------------------------------------------------------

def bernoulli_nb_fit(train: DataFrame, bits: str = "bits", label: str = "label",
                     alpha: float = 1.0, nbits: int = 2048) -> tuple[DataFrame, DataFrame]:
    """Returns (per (class, seen bit) table, per class constants). Feature
    probability p = (count + alpha) / (n_c + 2 alpha), p0 for a bit never
    seen in the class; prior log(n_c / n) (no smoothing). The (class, bit)
    table has at most n_classes * nbits rows, so broadcasting it is safe.

    log P(x, c) = prior + sum_j log(1 - p_j) + sum_{j in x} log(p_j / (1 - p_j)),
    written as base_c + |x| * odds0_c + sum_{j in x, seen} (odds_j - odds0_c)."""
    nc = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    cnt = train.select(label, F.explode(bits).alias("bit")).groupBy(label, "bit") \
        .agg(F.count(F.lit(1)).alias("c"))
    t = cnt.join(F.broadcast(nc), label)
    p = (F.col("c") + alpha) / (F.col("n_c") + 2 * alpha)
    p0 = F.lit(alpha) / (F.col("n_c") + 2 * alpha)
    odds0 = F.log(p0) - F.log1p(-p0)
    table = t.select(label, "bit", (F.log(p) - F.log1p(-p) - odds0).alias("delta"),
                     (F.log1p(-p) - F.log1p(-p0)).alias("adj"))
    adj = table.groupBy(label).agg(F.sum("adj").alias("__adj"))
    const = nc.join(adj, label, "left").withColumn("__n", F.sum("n_c").over(Window.partitionBy())) \
        .select(label, (F.log(F.col("n_c") / F.col("__n")) + nbits * F.log1p(-p0)
                        + F.coalesce("__adj", F.lit(0.0))).alias("base"), odds0.alias("odds0"))
    return table.select(label, "bit", "delta"), const


def bernoulli_nb_predict(model: tuple[DataFrame, DataFrame], test: DataFrame, id_col: str = "id",
                         bits: str = "bits", label: str = "label") -> DataFrame:
    """Binary classes 0/1: (id, prob) = P(class 1 | bits)."""
    table, const = model
    c = {r[label]: (r["base"], r["odds0"]) for r in const.collect()}   # one row per class
    ex = test.select(id_col, F.explode(bits).alias("bit"))
    s = ex.join(F.broadcast(table), "bit").groupBy(id_col).agg(
        F.sum(F.when(F.col(label) == 1, F.col("delta")).otherwise(0.0)).alias("__s1"),
        F.sum(F.when(F.col(label) == 0, F.col("delta")).otherwise(0.0)).alias("__s0"))
    j = test.select(id_col, F.size(bits).alias("__nx")).join(s, id_col, "left")
    b1, o1 = c.get(1, (float("-inf"), 0.0))
    b0, o0 = c.get(0, (float("-inf"), 0.0))
    jll1 = F.lit(b1) + F.col("__nx") * F.lit(o1) + F.coalesce("__s1", F.lit(0.0))
    jll0 = F.lit(b0) + F.col("__nx") * F.lit(o0) + F.coalesce("__s0", F.lit(0.0))
    return j.select(id_col, (1.0 / (1.0 + F.exp(jll0 - jll1))).alias("prob"))


# ---------------------------------------------------------------------------
# k-NN vote on bit sets
# ---------------------------------------------------------------------------

def knn_vote(train: DataFrame, test: DataFrame, k: int = 5, id_col: str = "id", bits: str = "bits",
             label: str = "label", nbits: int = 2048) -> DataFrame:
    """Exact k nearest train rows by squared Euclidean distance on 0/1
    vectors (|A| + |B| - 2|A n B|), ties by smaller train id; prob = share
    of positive neighbours; pred = 1 only on a strict majority."""
    nn = S.similarity_topn(test, train, k, id_col, bits, nbits, metric="hamming")
    lab = train.select(F.col(id_col).alias("tid"), F.col(label).alias("__y"))
    v = nn.join(lab, "tid").groupBy("qid").agg(F.avg("__y").alias("prob"))
    return v.select(F.col("qid").alias(id_col), "prob",
                    (F.col("prob") > 0.5).cast("int").alias("pred"))


# ---------------------------------------------------------------------------
# Spark ML catalog, trial table, CV, tuning, stacking
# ---------------------------------------------------------------------------

# Default parameters of each model family (as in the source
# configuration, mapped to Spark ML names).
DEFAULTS = {
    "LogisticRegression": {"maxIter": "2000", "C": "1.0"},
    "RandomForest": {"numTrees": "500", "maxDepth": "30", "minInstancesPerNode": "1", "featureSubsetStrategy": "sqrt"},
    "GradientBoosting": {"maxIter": "500", "stepSize": "0.1", "maxDepth": "6", "subsamplingRate": "0.8",
                         "featureSubsetStrategy": "all", "minInstancesPerNode": "1"},
    "LinearSVC": {"maxIter": "100", "C": "1.0"},
    "SVM": {"kernel": "rbf", "C": "1.0", "gamma": "scale", "coef0": "0.0", "degree": "3", "components": "1024", "maxIter": "100"},
    "KNN": {"n_neighbors": "5"},
    "Bayesian": {"alpha": "1.0"},
}

# Search spaces (kind, low, high[, step]) or ("cat", choices) per family.
SEARCH_SPACE = {
    "LogisticRegression": {"C": ("log", 1e-3, 100.0)},
    "RandomForest": {"numTrees": ("int", 100, 1000, 100), "maxDepth": ("int", 3, 30, 1),
                     "minInstancesPerNode": ("int", 1, 10, 1), "featureSubsetStrategy": ("cat", ["sqrt", "log2"])},
    "GradientBoosting": {"maxIter": ("int", 100, 1000, 100), "stepSize": ("log", 1e-3, 0.3),
                         "maxDepth": ("int", 3, 12, 1), "subsamplingRate": ("float", 0.5, 1.0),
                         "featureSubsetStrategy": ("float", 0.5, 1.0), "minInstancesPerNode": ("int", 1, 10, 1)},
    "LinearSVC": {"C": ("log", 1e-3, 100.0)},
    "SVM": {"kernel": ("cat", ["rbf", "linear", "poly"]), "C": ("log", 1e-3, 100.0)},
    "KNN": {"n_neighbors": ("int", 1, 30, 1)},
    "Bayesian": {"alpha": ("log", 1e-3, 10.0)},
}

#: Families whose folds and trials share their passes over the rows (``operators.batched``),
#: each with the parameter that its trials vary. k-NN and naive Bayes need a column ``bits``.
BATCHED = {"KNN": "n_neighbors", "Bayesian": "alpha", "LogisticRegression": "C"}

#: The families that are batched over bits, with the linear machine (which has a Spark ML form too).
SHARED = BATCHED | {"LinearSVC": "C"}

#: Families of trees: over bits, all their folds and trials are grown side by side
#: (``operators.trees``) where the packed rows can be broadcast.
TREES = ("RandomForest", "GradientBoosting")

#: Spark's trees stop there.
MAX_DEPTH = 30


def catalog_table(spark) -> DataFrame:
    return spark.createDataFrame([(m, p) for m, p in DEFAULTS.items()],
                                 "model string, defaults map<string,string>")


def resolve_params(spark, requested: DataFrame, tuned: DataFrame | None = None) -> DataFrame:
    """requested(descriptor, model) -> (descriptor, model, params): defaults
    overridden by tuned values (tuned wins); unknown models are reported
    with null params and ``known`` = 0 before any fit."""
    cat = catalog_table(spark)
    r = requested.join(cat, "model", "left")
    if tuned is not None:
        r = r.join(tuned, ["descriptor", "model"], "left")
    else:
        r = r.withColumn("params", F.lit(None).cast("map<string,string>"))
    given = F.coalesce("params", F.create_map().cast("map<string,string>"))
    # only the defaults that are not given, so no key stands twice on any session
    kept = F.map_filter("defaults", lambda k, _: ~F.array_contains(F.map_keys(given), k))
    merged = F.when(F.col("defaults").isNull(), F.lit(None)).otherwise(F.map_concat(kept, given))
    return r.select("descriptor", "model", merged.alias("params"),
                    F.col("defaults").isNotNull().cast("int").alias("known"))


def trial_table(spark, models: list[str], n_trials: int, seed: int = 42) -> DataFrame:
    """(model, trial, param, value, choice) sampled from the search space by a
    seeded hash uniform u: log-uniform exp(ln lo + u (ln hi - ln lo)),
    uniform float, stepped int lo + step * floor(u * (n_steps + 1)); of a list of
    choices the one at floor(u * choices), whose position is the value and whose
    name is in ``choice`` (null for numbers)."""
    rows = []
    for m in models:
        for p, spec in SEARCH_SPACE.get(m, {}).items():
            if spec[0] == "cat":
                rows.append((m, p, "cat", 0.0, float(len(spec[1]) - 1), 1.0, list(spec[1])))
            else:
                rows.append((m, p, spec[0], *[float(x) for x in spec[1:]], *([None] * (4 - len(spec))), None))
    sp = spark.createDataFrame(rows, "model string, param string, kind string, lo double, hi double, step double, names array<string>")
    t = sp.withColumn("trial", F.explode(F.sequence(F.lit(1), F.lit(n_trials))))
    u = (seeded_hash(seed, "model", "trial", "param") / F.lit(float(2 ** 60)))
    nsteps = F.floor((F.col("hi") - F.col("lo")) / F.col("step"))
    val = F.when(F.col("kind") == "log", F.exp(F.log("lo") + u * (F.log("hi") - F.log("lo")))) \
        .when(F.col("kind") == "float", F.col("lo") + u * (F.col("hi") - F.col("lo"))) \
        .otherwise(F.col("lo") + F.col("step") * F.least(F.floor(u * (nsteps + 1)), nsteps))
    return t.withColumn("value", val).select("model", F.col("trial").cast("int"), "param", "value",
                                             F.get("names", F.col("value").cast("int")).alias("choice"))


def bits_to_vector(df: DataFrame, bits: str = "bits", nbits: int = 2048, out: str = "features") -> DataFrame:
    """Exact sparse 0/1 vector from a bit-position array (fixed vocabulary
    0..nbits-1, no fitting pass)."""
    vocab = [str(i) for i in range(nbits)]
    cv = CountVectorizerModel.from_vocabulary(vocab, inputCol="__tok", outputCol=out, binary=True)
    d = df.withColumn("__tok", F.transform(bits, lambda b: b.cast("string")))
    return cv.transform(d).drop("__tok")


def build_estimator(model: str, params: dict, n_rows: float, seed: int = 42):
    p = dict(DEFAULTS.get(model, {}))
    p.update({k: str(v) for k, v in (params or {}).items()})
    if model == "LogisticRegression":
        c = float(p["C"])
        return LogisticRegression(maxIter=int(float(p["maxIter"])), regParam=1.0 / (c * n_rows),
                                  elasticNetParam=0.0, standardization=False, weightCol="weight")
    if model == "RandomForest":
        depth = int(float(p["maxDepth"]))
        if depth > MAX_DEPTH:
            raise ValueError(f"maxDepth {depth}: Spark's trees have at most {MAX_DEPTH} levels")
        return RandomForestClassifier(numTrees=int(float(p["numTrees"])), maxDepth=depth,
                                      minInstancesPerNode=int(float(p["minInstancesPerNode"])),
                                      featureSubsetStrategy=p["featureSubsetStrategy"],
                                      weightCol="weight", seed=seed)
    if model == "GradientBoosting":
        return GBTClassifier(maxIter=int(float(p["maxIter"])), stepSize=float(p["stepSize"]),
                             maxDepth=int(float(p["maxDepth"])),
                             subsamplingRate=float(p["subsamplingRate"]), featureSubsetStrategy=p["featureSubsetStrategy"],
                             minInstancesPerNode=int(float(p["minInstancesPerNode"])), seed=seed, weightCol="weight")
    if model == "LinearSVC":
        return LinearSVC(maxIter=int(float(p["maxIter"])), regParam=1.0 / (float(p["C"]) * n_rows),
                         weightCol="weight")
    if model == "SVM":
        gamma = p["gamma"] if p["gamma"] == "scale" else float(p["gamma"])
        return KernelSVC(p["kernel"], float(p["C"]), gamma, float(p["coef0"]), int(float(p["degree"])),
                         int(float(p["components"])), int(float(p["maxIter"])), seed)
    if model in BATCHED:
        raise ValueError(f"{model} has no Spark ML estimator: it needs a column of bits")
    raise ValueError(f"unknown model {model!r}")


def is_batched(model: str, data: DataFrame) -> bool:
    return model in SHARED and "bits" in data.columns


def batched_scores(data: DataFrame, folds: DataFrame, model: str, trials: list[dict], id_col: str = "id",
                   label: str = "label", nbits: int = 2048) -> DataFrame:
    """Held-out scores (trial, id, Repeat, Fold, y, score, pred) of all trials at once."""
    full = [DEFAULTS[model] | {k: str(v) for k, v in (t or {}).items()} for t in trials]
    values = [float(p[SHARED[model]]) for p in full]
    if model == "KNN":
        # equal numbers of neighbours are voted on once
        ks = sorted({int(v) for v in values})
        scores = B.knn_scores(data, folds, ks, nbits, id_col, label).withColumnRenamed("trial", "__k")
        which = data.sparkSession.createDataFrame([(ks.index(int(v)) + 1, t + 1) for t, v in enumerate(values)], "__k int, trial int")
        return scores.join(F.broadcast(which), "__k").drop("__k")
    if model == "Bayesian":
        return B.nb_scores(data, folds, values, nbits, id_col, label)
    return B.logistic_scores(data, folds, values, nbits, id_col, label, max_iter=max(int(float(p["maxIter"])) for p in full), hinge=model == "LinearSVC")[0]


def are_local_trees(model: str, data: DataFrame, folds: DataFrame | None = None, nbits: int = 2048) -> bool:
    if model not in TREES or "bits" not in data.columns:
        return False
    repeats = 1 if folds is None else folds.select("Repeat").distinct().count()
    return TR.fits(data, nbits, repeats)


def _tree_cv(data: DataFrame, folds: DataFrame, model: str, trials: list[dict], descriptor: str,
             id_col: str, label: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """Scores and per-fold metrics, each with its trial."""
    full = [DEFAULTS[model] | {k: str(v) for k, v in (t or {}).items()} for t in trials]
    scores = cut_lineage(TR.tree_scores(data, folds, model, full, id_col=id_col, label=label, seed=seed))
    return scores, B.cv_metrics(scores, folds, len(trials), descriptor, model)


def _batched_cv(data: DataFrame, folds: DataFrame, model: str, trials: list[dict], descriptor: str,
                id_col: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Scores and per-fold metrics, each with its trial."""
    scores = cut_lineage(batched_scores(data, folds, model, trials, id_col, label))
    return scores, B.cv_metrics(scores, folds, len(trials), descriptor, model)


def _score(fitted, df: DataFrame) -> DataFrame:
    out = fitted.transform(df)
    if "probability" in out.columns:
        prob = vector_to_array("probability")[1]
    else:  # margin models: logistic link on the raw margin
        prob = 1.0 / (1.0 + F.exp(-vector_to_array("rawPrediction")[1]))
    return out.withColumn("score", prob)


def repeated_cv(data: DataFrame, folds: DataFrame, model: str, params: dict | None = None,
                descriptor: str = "features", id_col: str = "id", label: str = "label",
                max_workers: int = 4, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Fit ``model`` once per (Repeat, Fold) on the other folds, score the
    held-out fold. ``data`` has (id, label, features); ``folds`` has
    (id, Repeat, Fold). Returns (predictions, per-fold metrics). Class weights
    and the regularisation come from the train folds alone. The metric table
    has a row per (Repeat, Fold): ``status`` is ``ok``, or ``failed`` with the
    ``error`` and null metrics where the estimator refuses the fold's rows (one
    class only, say). Unknown models and parameters, and failing Spark jobs, raise.
    Families of ``SHARED`` are fitted for all folds at once where ``data`` has ``bits``,
    and those of ``TREES`` where the table can be broadcast too."""
    if is_batched(model, data):
        scores, found = _batched_cv(data, folds, model, [params or {}], descriptor, id_col, label)
        pred = scores.select(F.col("id").alias(id_col), "y", "score", "Repeat", "Fold", F.lit(descriptor).alias("Descriptor"), F.lit(model).alias("Model"))
        return pred, found.drop("trial")
    build_estimator(model, params or {}, 1, seed)
    if are_local_trees(model, data, folds):
        scores, found = _tree_cv(data, folds, model, [params or {}], descriptor, id_col, label, seed)
        pred = scores.select(F.col("id").alias(id_col), "y", "score", "Repeat", "Fold", F.lit(descriptor).alias("Descriptor"), F.lit(model).alias("Model"))
        return pred, found.drop("trial")
    return _cv(fold_tagged(data, folds, id_col), model, params, descriptor, id_col, label, max_workers, seed)


def fold_tagged(data: DataFrame, folds: DataFrame, id_col: str = "id") -> DataFrame:
    """One reliable checkpoint of (features x fold tags): every fit reads it
    instead of recomputing the upstream lineage, and it survives executor loss."""
    return cut_lineage(data.join(folds.select(id_col, "Repeat", "Fold"), id_col))


def _cv(tagged: DataFrame, model: str, params: dict | None, descriptor: str, id_col: str, label: str,
        max_workers: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """``repeated_cv`` on rows that carry their folds."""
    spark = tagged.sparkSession
    sizes = tagged.groupBy("Repeat", "Fold").count().collect()     # one row per fold
    total: dict = {}
    for r in sizes:
        total[r["Repeat"]] = total.get(r["Repeat"], 0) + r["count"]
    keys = sorted((r["Repeat"], r["Fold"], total[r["Repeat"]] - r["count"]) for r in sizes)

    def one(key):
        rep, fold, n = key
        if n == 0:
            return rep, fold, None, "no train rows"
        d = tagged.filter(F.col("Repeat") == rep)
        tr = class_weights(d.filter(F.col("Fold") != fold), label)
        est = build_estimator(model, params or {}, n, seed + rep - 1).setLabelCol(label).setFeaturesCol("features")
        try:
            fitted = est.fit(tr)
        except IllegalArgumentException as e:
            return rep, fold, None, str(e)[:500]
        s = _score(fitted, d.filter(F.col("Fold") == fold)).select(id_col, F.col(label).alias("y"), "score")
        # scored now: a plan would hold its forest until all folds are fitted
        return rep, fold, cut_lineage(s.withColumn("Repeat", F.lit(rep)).withColumn("Fold", F.lit(fold))), None

    with ThreadPoolExecutor(max_workers=max_workers) as ex:
        done = list(ex.map(one, keys))
    parts = [p for _, _, p, _ in done if p is not None]
    pred = spark.createDataFrame([], T.StructType([
        T.StructField(id_col, tagged.schema[id_col].dataType), T.StructField("y", tagged.schema[label].dataType),
        T.StructField("score", T.DoubleType()), T.StructField("Repeat", T.IntegerType()), T.StructField("Fold", T.IntegerType())]))
    for p in parts:
        pred = pred.unionByName(p)
    pred = pred.withColumn("Descriptor", F.lit(descriptor)).withColumn("Model", F.lit(model))
    status = spark.createDataFrame([(descriptor, model, rep, fold, "ok" if e is None else "failed", e) for rep, fold, _, e in done],
                                   "Descriptor string, Model string, Repeat int, Fold int, status string, error string")
    per = ["Descriptor", "Model", "Repeat", "Fold"]
    return pred, status.join(M.metrics10(pred, per), per, "left")


def tune(data: DataFrame, folds: DataFrame, model: str, n_trials: int = 50, metric: str = "ROC_AUC",
         seed: int = 42, descriptor: str = "features", id_col: str = "id", label: str = "label",
         max_workers: int = 4) -> tuple[dict, DataFrame]:
    """Seeded random search: mean metric over all folds per trial (a failed
    fold scores 0.0); best = argmax (ties: smaller trial). The features meet
    their folds once for all trials; trials of ``BATCHED`` families also share
    their passes over the rows."""
    spark = data.sparkSession
    trials = trial_table(spark, [model], n_trials, seed).collect()   # n_trials x params rows
    by_trial: dict[int, dict] = {}
    for r in trials:
        by_trial.setdefault(r["trial"], {})[r["param"]] = r["value"] if r["choice"] is None else r["choice"]
    batched = is_batched(model, data)
    if batched or are_local_trees(model, data, folds):
        some = [by_trial[t] for t in sorted(by_trial)]
        _, found = _batched_cv(data, folds, model, some, descriptor, id_col, label) if batched else _tree_cv(data, folds, model, some, descriptor, id_col, label, seed)
        sdf = cut_lineage(found.groupBy("trial").agg(F.avg(F.coalesce(F.col(metric), F.lit(0.0))).alias("score")))
        best = sdf.orderBy(F.col("score").desc(), "trial").first()
        return (by_trial[best["trial"]] if best else {}), sdf
    tagged = fold_tagged(data, folds, id_col)
    scores = []
    for t, params in sorted(by_trial.items()):
        build_estimator(model, params, 1, seed)
        _, res = _cv(tagged, model, params, descriptor, id_col, label, max_workers, seed)
        row = res.agg(F.avg(F.coalesce(F.col(metric), F.lit(0.0)))).first()[0]
        scores.append((t, float(row) if row is not None else 0.0))
    sdf = spark.createDataFrame(scores, "trial int, score double")
    best = sdf.orderBy(F.col("score").desc(), "trial").first()
    return by_trial.get(best["trial"], {}), sdf


def final_fit_score(train: DataFrame, test: DataFrame, model: str, params: dict | None = None,
                    id_col: str = "id", label: str = "label", threshold: float = 0.5,
                    seed: int = 42, nbits: int = 2048) -> DataFrame:
    """Fit on all train rows, score test rows: (id, True_Label,
    Predicted_Label, Predicted_Probability, Prediction)."""
    if model in ("KNN", "Bayesian"):
        p = DEFAULTS[model] | {k: str(v) for k, v in (params or {}).items()}
        if model == "KNN":
            s = knn_vote(train, test, int(float(p["n_neighbors"])), id_col, "bits", label, nbits)
        else:
            s = bernoulli_nb_predict(bernoulli_nb_fit(train, "bits", label, float(p["alpha"]), nbits), test, id_col, "bits", label)
            s = s.withColumn("pred", M.threshold_predict(F.col("prob"), threshold))
        s = s.join(test.select(id_col, label), id_col)
        return s.select(id_col, F.col(label).alias("True_Label"), F.col("pred").alias("Predicted_Label"),
                        F.col("prob").alias("Predicted_Probability"), M.label_name(F.col("pred")).alias("Prediction"))
    if are_local_trees(model, train) and are_local_trees(model, test):
        build_estimator(model, params or {}, 1, seed)
        # train and test rows as two folds, under a number of their own
        both = train.select(id_col, label, "bits", F.lit(2).alias("Fold")).unionByName(test.select(id_col, label, "bits", F.lit(1).alias("Fold")))
        both = cut_lineage(both.withColumn("__row", F.monotonically_increasing_id()).withColumn("Repeat", F.lit(1)))
        full = DEFAULTS[model] | {k: str(v) for k, v in (params or {}).items()}
        s = TR.tree_scores(both, both, model, [full], nbits, "__row", label, seed=seed, cells=[(1, 1)])
        s = s.select(F.col("id").alias("__row"), "score").join(both.select("__row", id_col, label), "__row")
    else:
        tr = cut_lineage(class_weights(train, label))
        est = build_estimator(model, params or {}, tr.count(), seed).setLabelCol(label)
        fitted = est.fit(tr)
        s = _score(fitted, test.withColumn("weight", F.lit(1.0)))
    pred = M.threshold_predict(F.col("score"), threshold)
    return s.select(id_col, F.col(label).alias("True_Label"), pred.alias("Predicted_Label"),
                    F.col("score").alias("Predicted_Probability"),
                    M.label_name(pred).alias("Prediction"))


def stacking(train: DataFrame, test: DataFrame, bases: list[str], folds: DataFrame,
             id_col: str = "id", label: str = "label", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Out-of-fold probabilities of each base model (5 folds, one repeat),
    pivoted wide by base; meta logistic regression (no class weights) on
    them; base models refitted on all train rows score the test rows for the
    meta model. Returns (test predictions, OOF table)."""
    oofs = None
    for b in bases:
        pred, _ = repeated_cv(train, folds, b, seed=seed, id_col=id_col, label=label)
        p = pred.select(id_col, F.lit(b).alias("base"), "score")
        oofs = p if oofs is None else oofs.unionByName(p)
    wide = oofs.groupBy(id_col).pivot("base", bases).agg(F.first("score"))
    meta_train = wide.join(train.select(id_col, label), id_col)
    va = VectorAssembler(inputCols=bases, outputCol="meta_features")
    meta = Pipeline(stages=[va, LogisticRegression(featuresCol="meta_features", labelCol=label,
                                                   maxIter=2000)]).fit(meta_train)
    tests = None
    for b in bases:
        s = final_fit_score(train, test, b, id_col=id_col, label=label, seed=seed) \
            .select(id_col, F.lit(b).alias("base"), F.col("Predicted_Probability").alias("score"))
        tests = s if tests is None else tests.unionByName(s)
    twide = tests.groupBy(id_col).pivot("base", bases).agg(F.first("score")) \
        .join(test.select(id_col, label), id_col)
    out = meta.transform(twide).withColumn("prob", vector_to_array("probability")[1])
    return out.select(id_col, label, "prob", *bases), wide


def select_top_k(summary: DataFrame, k: int = 5, metric: str = "ROC_AUC") -> list[tuple[str, str]]:
    rows = summary.orderBy(F.col(metric).desc_nulls_last(), "Descriptor", "Model").limit(k).collect()
    return [(r["Descriptor"], r["Model"]) for r in rows]
