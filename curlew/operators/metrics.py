"""Exact classification metrics as grouped aggregations.

Threshold metrics (confusion counts and the eight ratios) are one
``HashAggregate`` per group. ROC-AUC and average precision need, for each
distinct score, the number of positives and negatives strictly below it; that
is a prefix sum over the distinct scores of a group. A single group can hold
a third of all rows (one big test set), so the prefix sum is two-level: each
group's distinct scores are cut into ``n_buckets`` score ranges (boundaries
from ``percentile_approx``, which only balances work and never changes the
result), bucket totals give each bucket's offset, and the window inside a
bucket is partitioned by (group, bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METRICS = ["ROC_AUC", "PR_AUC", "Accuracy", "Sensitivity", "Specificity", "GMean",
           "Precision", "F1", "MCC", "Kappa"]


def sized_broadcast(df: DataFrame, max_rows: int = 2_000_000) -> DataFrame:
    """Broadcast ``df`` only after checking its row count (a cheap job on a
    small aggregate); otherwise leave the join strategy to the planner."""
    return F.broadcast(df) if df.count() <= max_rows else df


def threshold_predict(prob: Column, threshold: float = 0.5) -> Column:
    return (prob >= F.lit(threshold)).cast("int")


def label_name(label: Column, positive: str = "Toxic", negative: str = "Non-toxic") -> Column:
    return F.when(label == 1, F.lit(positive)).otherwise(F.lit(negative))


def _div(a: Column, b: Column) -> Column:
    """a / b, 0.0 when b = 0 (zero-division rule of the metric library)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def confusion(df: DataFrame, group_cols: list[str], y: str = "y", pred: str = "pred") -> DataFrame:
    return df.groupBy(*group_cols).agg(
        F.count_if((F.col(y) == 1) & (F.col(pred) == 1)).alias("tp"),
        F.count_if((F.col(y) == 0) & (F.col(pred) == 1)).alias("fp"),
        F.count_if((F.col(y) == 0) & (F.col(pred) == 0)).alias("tn"),
        F.count_if((F.col(y) == 1) & (F.col(pred) == 0)).alias("fn"))


def threshold_metrics(conf: DataFrame) -> DataFrame:
    """Add Accuracy, Sensitivity, Specificity, GMean, Precision, F1, MCC and
    Kappa to a table with tp/fp/tn/fn. Zero divisions give 0.0, as the metric
    library does; Kappa is null when expected agreement is 1."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    sens = _div(tp, tp + fn)
    spec = _div(tn, tn + fp)
    prec = _div(tp, tp + fp)
    mcc_den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    pe = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n)
    acc = (tp + tn) / n
    return conf.select(
        "*",
        acc.alias("Accuracy"), sens.alias("Sensitivity"), spec.alias("Specificity"),
        F.sqrt(sens * spec).alias("GMean"), prec.alias("Precision"),
        _div(2 * tp, 2 * tp + fp + fn).alias("F1"),
        _div(tp * tn - fp * fn, mcc_den).alias("MCC"),
        F.when(pe != 1, (acc - pe) / (1 - pe)).alias("Kappa"))


def score_counts(df: DataFrame, group_cols: list[str], y: str, score: str) -> DataFrame:
    """(group, score) -> pos, neg. Partial aggregation collapses ties map-side."""
    return df.groupBy(*group_cols, F.col(score).alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))


def below_counts(st: DataFrame, group_cols: list[str], n_buckets: int = 64) -> DataFrame:
    """For each distinct (group, score): pos_below / neg_below = positives /
    negatives with a strictly smaller score in the group (two-level prefix
    sum), plus the group totals P and N carried from the bucket table, so no
    later step has to shuffle a whole group onto one task."""
    g = list(group_cols)
    if not g:
        raise ValueError("below_counts needs at least one group column")
    if n_buckets > 1:
        qs = [k / n_buckets for k in range(1, n_buckets)]
        pa = F.percentile_approx("score", qs, 10000).alias("__b")
        bounds = sized_broadcast(st.groupBy(*g).agg(pa))
        st = st.join(bounds, g) \
            .withColumn("__bk", F.size(F.filter("__b", lambda b: b < F.col("score")))) \
            .drop("__b")
    else:
        st = st.withColumn("__bk", F.lit(0))
    tot = st.groupBy(*g, "__bk").agg(F.sum("pos").alias("__bp"), F.sum("neg").alias("__bn"))
    wb = Window.partitionBy(*g).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    wall = Window.partitionBy(*g)
    off = tot.select(*g, "__bk",
                     F.coalesce(F.sum("__bp").over(wb), F.lit(0)).alias("__op"),
                     F.coalesce(F.sum("__bn").over(wb), F.lit(0)).alias("__on"),
                     F.sum("__bp").over(wall).alias("P"), F.sum("__bn").over(wall).alias("N"))
    ws = Window.partitionBy(*g, "__bk").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    return (st.join(off, [*g, "__bk"])
              .select(*g, "score", "pos", "neg", "P", "N",
                      (F.col("__op") + F.coalesce(F.sum("pos").over(ws), F.lit(0))).alias("pos_below"),
                      (F.col("__on") + F.coalesce(F.sum("neg").over(ws), F.lit(0))).alias("neg_below")))


def ranking_metrics(df: DataFrame, group_cols: list[str], y: str = "y", score: str = "score",
                    n_buckets: int = 64) -> DataFrame:
    """Exact ROC_AUC (ties count half) and PR_AUC (average precision, step
    sum over distinct thresholds) per group. Null when a class is absent."""
    if not group_cols:
        return ranking_metrics(df.withColumn("__all", F.lit(0)), ["__all"], y, score,
                               n_buckets).drop("__all")
    b = below_counts(score_counts(df, group_cols, y, score), group_cols, n_buckets)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    tp_ge = (F.col("P") - F.col("pos_below")).cast("double")
    fp_ge = (F.col("N") - F.col("neg_below")).cast("double")
    agg = b.groupBy(*group_cols).agg(
        F.first("P").cast("double").alias("__P"), F.first("N").cast("double").alias("__N"),
        F.sum(pos * (F.col("neg_below") + neg / 2.0)).alias("__auc"),
        F.sum(pos * tp_ge / (tp_ge + fp_ge)).alias("__ap"))
    return agg.select(
        *group_cols,
        F.when((F.col("__P") > 0) & (F.col("__N") > 0),
               F.col("__auc") / (F.col("__P") * F.col("__N"))).alias("ROC_AUC"),
        F.when(F.col("__P") > 0, F.col("__ap") / F.col("__P")).alias("PR_AUC"))


def metrics10(df: DataFrame, group_cols: list[str], y: str = "y", score: str = "score",
              pred: str | None = None, threshold: float = 0.5, n_buckets: int = 64) -> DataFrame:
    """All ten metrics per group from (y, score[, pred]) rows."""
    if not group_cols:
        return metrics10(df.withColumn("__all", F.lit(0)), ["__all"], y, score, pred,
                         threshold, n_buckets).drop("__all")
    if pred is None:
        df = df.withColumn("__pred", threshold_predict(F.col(score), threshold))
        pred = "__pred"
    thr = threshold_metrics(confusion(df, group_cols, y, pred))
    rk = ranking_metrics(df, group_cols, y, score, n_buckets)
    out = thr.join(rk, group_cols, "left")
    return out.select(*group_cols, "tp", "fp", "tn", "fn", *METRICS)


def cv_summary(results: DataFrame, keys: list[str] = ("Descriptor", "Model"),
               metrics: list[str] = METRICS, decimals: int = 3) -> DataFrame:
    """Mean of each metric by (Descriptor, Model), rounded half-to-even."""
    return results.groupBy(*keys).agg(
        *[F.bround(F.avg(m), decimals).alias(m) for m in metrics])
