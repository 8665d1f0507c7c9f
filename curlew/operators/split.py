"""Splits and folds: stratified train/test split, repeated stratified K-fold
assignment, cluster-intact split (greedy skip walk) and its size-ordered
fallback.

Seeded shuffles are orders by a seeded md5 hash, so any engine (and the SQL
oracle) can reproduce them. Ranks inside a class use a two-level plan: the
first 16 bits of the hash pick one of 65,536 buckets, bucket totals give each
bucket's offset (a small aggregate), and ``row_number`` runs inside
(class, bucket) only. A class holding a third of all rows is thus spread
over 65,536 tasks-worth of partitions instead of one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curlew.operators.metrics import sized_broadcast

HASH_HEX = 15          # 60-bit order key from the md5 hex prefix
BUCKET_SHIFT = 44      # top 16 of the 60 bits -> bucket


def seeded_hash(seed: int | Column, *cols: str | Column) -> Column:
    """60-bit unsigned order key: md5 of 'seed|c1|c2...' (hex prefix)."""
    parts = [F.lit(str(seed)) if not isinstance(seed, Column) else seed.cast("string")]
    parts += [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, HASH_HEX), 16, 10).cast("long")


def exact_rank(df: DataFrame, part_cols: list[str], order: str, tie: str) -> DataFrame:
    """Add ``__rank`` (1-based) = position of the row in its partition when
    ordered by (order, tie); ``order`` must be a 60-bit non-negative long."""
    d = df.withColumn("__bk", F.shiftright(F.col(order), BUCKET_SHIFT))
    tot = d.groupBy(*part_cols, "__bk").agg(F.count(F.lit(1)).alias("__c"))
    wb = Window.partitionBy(*part_cols).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*part_cols, "__bk", F.coalesce(F.sum("__c").over(wb), F.lit(0)).alias("__off"))
    wr = Window.partitionBy(*part_cols, "__bk").orderBy(order, tie)
    return null_safe_join(d, off, [*part_cols, "__bk"]) \
        .withColumn("__rank", F.col("__off") + F.row_number().over(wr)).drop("__bk", "__off")


def null_safe_join(df: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """Inner join on ``on`` in which null meets null, so rows without a label stay."""
    right = small.select(*[F.col(c).alias(f"__r_{c}") for c in on], *[c for c in small.columns if c not in on])
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return df.join(right, cond).drop(*[f"__r_{c}" for c in on])


def class_quotas(counts: list[tuple], test_size: float) -> dict:
    """Per-class test quota: n_test = ceil(test_size * n); floor of the
    proportional share n_c * n_test / n, then the remaining rows to the
    largest remainders (ties: smaller class value first)."""
    n = sum(c for _, c in counts)
    n_test = math.ceil(test_size * n)
    cont = {k: c * n_test / n for k, c in counts} if n else {}
    fl = {k: math.floor(v) for k, v in cont.items()}
    need = n_test - sum(fl.values())
    order = sorted(cont, key=lambda k: (-(cont[k] - fl[k]), k is None, k))
    for k in order[:need]:
        fl[k] += 1
    return fl


def stratified_split(df: DataFrame, label: str = "label", id_col: str = "id",
                     test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split`` ('train' / 'test'): per class, the first quota rows in
    seeded-hash order go to test. Exact class counts (unlike ``sampleBy``)."""
    counts = [(r[0], r[1]) for r in df.groupBy(label).count().collect()]
    quotas = class_quotas(counts, test_size)
    spark = df.sparkSession
    qdf = spark.createDataFrame([(k, int(v)) for k, v in quotas.items()],
                                f"{label} {df.schema[label].dataType.simpleString()}, __q long")
    r = exact_rank(df.withColumn("__h", seeded_hash(seed, id_col)), [label], "__h", id_col)
    return null_safe_join(r, F.broadcast(qdf), [label]) \
        .withColumn("split", F.when(F.col("__rank") <= F.col("__q"), "test").otherwise("train")) \
        .drop("__h", "__rank", "__q")


def stratified_folds(df: DataFrame, label: str = "label", id_col: str = "id", k: int = 5,
                     repeats: int = 1, base_seed: int = 42) -> DataFrame:
    """Repeated stratified K-fold: one row per (row, repeat) with ``Repeat``
    (1-based) and ``Fold`` (1-based). Within a class, rows in seeded-hash
    order (seed = base_seed + repeat - 1) are dealt round-robin starting at
    the fold after the rows of the smaller classes, so per-fold class counts
    differ by at most one and fold sizes are balanced."""
    spark = df.sparkSession
    counts = sorted(((r[0], r[1]) for r in df.groupBy(label).count().collect()), key=lambda t: (t[0] is None, t[0]))
    offs, acc = [], 0
    for cls, c in counts:
        offs.append((cls, acc))
        acc += c
    odf = spark.createDataFrame(offs, f"{label} {df.schema[label].dataType.simpleString()}, __o long")
    rep = df.withColumn("Repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    rep = rep.withColumn("__h", seeded_hash(F.lit(base_seed) + F.col("Repeat") - 1, id_col))
    r = exact_rank(rep, ["Repeat", label], "__h", id_col)
    return null_safe_join(r, F.broadcast(odf), [label]) \
        .withColumn("Fold", ((F.col("__o") + F.col("__rank") - 1) % k + 1).cast("int")) \
        .drop("__h", "__rank", "__o")


def cluster_sizes(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))


def two_level_cumsum(df: DataFrame, bucket_cols: list[Column], order_cols: list[str],
                     value: str, out: str = "__cum") -> DataFrame:
    """Global inclusive running sum of ``value`` in (bucket_cols, order_cols)
    order without a single-partition window: bucket totals (a small table)
    give offsets; the row window is partitioned by bucket."""
    names = [f"__b{i}" for i in range(len(bucket_cols))]
    d = df.select("*", *[c.alias(n) for c, n in zip(bucket_cols, names)])
    tot = d.groupBy(*names).agg(F.sum(value).alias("__t"))
    wb = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*names, F.coalesce(F.sum("__t").over(wb), F.lit(0)).alias("__off"))
    wr = Window.partitionBy(*names).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    return d.join(off, names).withColumn(out, F.col("__off") + F.sum(value).over(wr)) \
        .drop(*names, "__off")


def cluster_split(df: DataFrame, cluster: str = "cluster_id", test_size: float = 0.2,
                  tolerance: float = 0.05, max_attempts: int = 10_000,
                  seed: int = 42) -> tuple[DataFrame, dict]:
    """Cluster-intact train/test split. target = int(n * test_size),
    tol = int(n * tolerance). Per attempt, clusters are walked in seeded-hash
    order; a cluster is skipped when adding it would pass target + tol, and the
    walk stops once |size - target| <= tol. A walk equals: take the prefix of
    clusters whose running sum stays <= target + tol, skip the first cluster
    that would overshoot, repeat; each pass is one running sum over the
    cluster table (one row per cluster) and one small aggregate. When no
    attempt succeeds, the size-ordered fallback is used (flagged in info); it is
    used at once where the clusters that fit at all hold too few rows for any order.
    Returns (rows with ``split``, info)."""
    sizes = cluster_sizes(df, cluster).cache()
    n = sizes.agg(F.sum("size")).first()[0] or 0
    target, tol = int(n * test_size), int(n * tolerance)
    info = {"n": n, "target": target, "tol": tol, "attempt": None, "fallback": False,
            "skips": 0}
    chosen = None
    able = sizes.filter(F.col("size") <= target + tol).agg(F.sum("size")).first()[0] or 0
    for attempt in range(max_attempts if able >= target - tol else 0):
        cand = sizes.withColumn("__h", seeded_hash(seed, F.lit(attempt), cluster))
        chosen = _skip_walk(cand, cluster, target, tol, info)
        if chosen is not None:
            info["attempt"] = attempt + 1
            break
    if chosen is None:
        info["fallback"] = True
        chosen = fallback_selection(sizes, cluster, target)
    sel = sized_broadcast(chosen.select(cluster).withColumn("__t", F.lit(1)), 5_000_000)
    out = df.join(sel, cluster, "left").withColumn(
        "split", F.when(F.col("__t") == 1, "test").otherwise("train")).drop("__t")
    return out, info


def _skip_walk(cand: DataFrame, cluster: str, target: int, tol: int, info: dict):
    """Greedy walk with skips over (cluster, size, __h). Returns the selected
    clusters (DataFrame) or None when this order fails. Clusters that are too
    large by themselves go first; each pass then removes one more, so the loop ends."""
    cur = cand.filter(F.col("size") <= target + tol)
    while True:
        run = two_level_cumsum(cur, [F.shiftright("__h", BUCKET_SHIFT)], ["__h", cluster], "size")
        key = F.struct("__h", cluster)
        r = run.agg(
            F.min(F.when(F.col("__cum") > target + tol, key)).alias("over"),
            F.min(F.when((F.col("__cum") >= target - tol) & (F.col("__cum") <= target + tol),
                         key)).alias("ok")).first()
        over, ok = r["over"], r["ok"]
        if ok is not None and (over is None or tuple(ok) < tuple(over)):
            h, c = ok[0], ok[1]
            return cur.filter((F.col("__h") < h) | ((F.col("__h") == h) & (F.col(cluster) <= c))) \
                .select(cluster)
        if over is None:
            return None
        h, c = over[0], over[1]
        cur = cur.filter(~((F.col("__h") == h) & (F.col(cluster) == c)))
        info["skips"] += 1


def fallback_selection(sizes: DataFrame, cluster: str, target: int) -> DataFrame:
    """Clusters by size descending (ties by seeded hash of the cluster id,
    then id); take a cluster while the rows taken before it are fewer than
    target (may overshoot)."""
    d = sizes.withColumn("__ns", -F.col("size")).withColumn("__hh", seeded_hash(0, cluster))
    run = two_level_cumsum(d, [F.col("__ns"), F.shiftright("__hh", 48)],
                           ["__hh", cluster], "size")
    return run.filter(F.col("__cum") - F.col("size") < target).select(cluster)
