"""Ranking and reshaping of result tables: best pair, top-k, top-10 lists,
metric matrices (pivot with an explicit order), min-max normalisation per
metric, box-plot statistics, p-value bins, custom orders, overall means."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def best_pair(summary: DataFrame, metric: str = "ROC_AUC",
              keys: tuple[str, ...] = ("Descriptor", "Model")) -> DataFrame:
    """Row with the largest metric; ties go to the smallest keys."""
    return summary.orderBy(F.col(metric).desc_nulls_last(), *keys).limit(1)


def top_k_pairs(summary: DataFrame, k: int = 5, metric: str = "ROC_AUC",
                keys: tuple[str, ...] = ("Descriptor", "Model")) -> DataFrame:
    """The k best rows (TakeOrderedAndProject: a bounded top-k per task),
    numbered 1..k."""
    top = summary.orderBy(F.col(metric).desc_nulls_last(), *keys).limit(k)
    return top.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col(metric).desc_nulls_last(), *keys)))


def top10_by_metric(summary: DataFrame, metrics: list[str] = ("ROC_AUC", "MCC"), n: int = 10) -> DataFrame:
    """For each metric, the n best rows labelled 'Model (Descriptor)'."""
    out = None
    for m in metrics:
        t = summary.orderBy(F.col(m).desc_nulls_last(), "Descriptor", "Model").limit(n).select(
            F.lit(m).alias("Metric"),
            F.concat(F.col("Model"), F.lit(" ("), F.col("Descriptor"), F.lit(")")).alias("label"),
            F.col(m).alias("value"))
        out = t if out is None else out.unionByName(t)
    w = Window.partitionBy("Metric").orderBy(F.col("value").desc_nulls_last(), "label")
    return out.withColumn("rank", F.row_number().over(w))


def metric_matrix(summary: DataFrame, metric: str, descriptor_order: list[str],
                  row: str = "Model", col: str = "Descriptor") -> DataFrame:
    """Pivot rows x descriptors of one metric with an explicit column order
    (a configured name without data becomes an all-null column). A
    ``<metric>_mean`` column is preferred when present."""
    value = f"{metric}_mean" if f"{metric}_mean" in summary.columns else metric
    return summary.groupBy(row).pivot(col, descriptor_order).agg(F.first(value))


def grouped_minmax(summary: DataFrame, metrics: list[str],
                   keys: tuple[str, ...] = ("Descriptor", "Model")) -> DataFrame:
    """Long (keys, Metric, value, scaled): per-metric min-max over all rows;
    a zero range scales by 1."""
    lg = summary.unpivot(list(keys), metrics, "Metric", "value")
    w = Window.partitionBy("Metric")
    lo, hi = F.min("value").over(w), F.max("value").over(w)
    return lg.withColumn("scaled", (F.col("value") - lo) /
                         F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo))


def overall_means(summary: DataFrame, metrics: list[str]) -> DataFrame:
    return summary.agg(*[F.avg(m).alias(m) for m in metrics])


def boxplot_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Quartiles (linear interpolation), whiskers at 1.5 IQR clipped to the
    data, and outlier count per group."""
    q = df.groupBy(*keys).agg(F.percentile(value, [0.25, 0.5, 0.75]).alias("__q"))
    q = q.select(*keys, F.col("__q")[0].alias("q1"), F.col("__q")[1].alias("median"),
                 F.col("__q")[2].alias("q3"))
    j = df.join(q, keys)
    lo_f = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi_f = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    return j.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(F.col(value) >= lo_f, F.col(value))).alias("whisker_lo"),
        F.max(F.when(F.col(value) <= hi_f, F.col(value))).alias("whisker_hi"),
        F.count_if((F.col(value) < lo_f) | (F.col(value) > hi_f)).alias("n_outliers"),
        F.count(value).alias("n"))


def boxplot_outliers(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The rows of ``df`` whose value lies beyond 1.5 IQR of the quartiles of their group, with
    both fences. Null values are no outliers."""
    q = df.groupBy(*keys).agg(F.percentile(value, [0.25, 0.75]).alias("__q"))
    iqr = F.col("__q")[1] - F.col("__q")[0]
    q = q.select(*keys, (F.col("__q")[0] - 1.5 * iqr).alias("fence_lo"), (F.col("__q")[1] + 1.5 * iqr).alias("fence_hi"))
    return df.join(q, keys).filter((F.col(value) < F.col("fence_lo")) | (F.col(value) > F.col("fence_hi")))


P_BINS = [0.0, 0.001, 0.01, 0.05, 1.0]


def pvalue_bins(df: DataFrame, p: str, out: str = "p_bin") -> DataFrame:
    """Bin index 0..3 for [0,.001), [.001,.01), [.01,.05), [.05,1]; a
    non-numeric or null p counts as 1.0."""
    v = F.coalesce(F.expr(f"try_cast(`{p}` AS double)"), F.lit(1.0))
    return df.withColumn(out, F.when(v < 0.001, 0).when(v < 0.01, 1).when(v < 0.05, 2).otherwise(3))


def custom_order(df: DataFrame, col: str, order: list[str], keep_missing: bool = True) -> DataFrame:
    """Rows ordered by a configured list; names with no data give an empty
    row (keep_missing) and names outside the list are dropped."""
    spark = df.sparkSession
    o = spark.createDataFrame([(v, i) for i, v in enumerate(order)], f"{col} string, pos int")
    return o.join(df, col, "left" if keep_missing else "inner").orderBy("pos")


def strip_suffix(df: DataFrame, suffix: str = "_mean") -> DataFrame:
    return df.withColumnsRenamed({c: c[: -len(suffix)] for c in df.columns if c.endswith(suffix)})
