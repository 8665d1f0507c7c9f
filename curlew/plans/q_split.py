"""Queries for split and fold operators (inventory 25, 38-41, 50, 63, 68-70)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from curlew.operators import clean as C
from curlew.operators import split as SP
from curlew.plans.catalog import CURATED_DOCS, DOCS_KEYED, LABELLED_DOCS, query, strat_split_sql
from curlew.plans.q_features import docs_keyed
from curlew.session import cut_lineage
from curlew.sources import tables as T


@query("stratified_split", "WITH " + DOCS_KEYED + ","
       + strat_split_sql("(SELECT id, lang AS label FROM dk)", "sp") + " SELECT id, split FROM sp")
def q_stratified_split(spark, sf):
    d = docs_keyed(spark, sf).select("id", F.col("lang").alias("label"))
    return SP.stratified_split(d, "label", "id").select("id", "split")


def _curated_split(spark, sf):
    """The texts are curated once, and once split; what follows reads rows."""
    cur = cut_lineage(C.curated_entities(T.labelled_documents(spark, sf)).select("id", "key", "label"))
    return cut_lineage(SP.stratified_split(cur, "label", "id"))


@query("class_distribution", "WITH " + CURATED_DOCS + ","
       + strat_split_sql("(SELECT id, label FROM curated)", "sp") + """,
c AS (SELECT split, CAST(label AS INTEGER) AS label, count(*) AS n FROM sp GROUP BY 1, 2)
SELECT split, label, n, 100.0 * n / sum(n) OVER (PARTITION BY split) AS pct FROM c""")
def q_class_distribution(spark, sf):
    s = _curated_split(spark, sf)
    c = s.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("split")))


@query("union_splits", "WITH " + CURATED_DOCS + ","
       + strat_split_sql("(SELECT id, label FROM curated)", "sp") + """
SELECT s.id, c.key, s.split FROM sp s JOIN curated c ON c.id = s.id""")
def q_union_splits(spark, sf):
    s = _curated_split(spark, sf)
    train = s.filter("split = 'train'").drop("split")
    test = s.filter("split = 'test'").drop("split")
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.select("id", "key", "split")


@query("stratified_folds", "WITH " + LABELLED_DOCS + """,
src AS (SELECT id, label FROM labelled WHERE entity IS NOT NULL AND label IS NOT NULL),
rep AS (SELECT id, label, r AS Repeat FROM src, range(1, 6) t(r)),
h AS (SELECT *, ('0x' || substr(md5(CAST(41 + Repeat AS VARCHAR) || '|' || CAST(id AS VARCHAR)), 1, 15))::UBIGINT AS h
      FROM rep),
cnt AS (SELECT label, count(*) AS c FROM src GROUP BY label),
off AS (SELECT label, coalesce(sum(c) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o
        FROM cnt),
rk AS (SELECT id, label, Repeat, row_number() OVER (PARTITION BY Repeat, label ORDER BY h, id) AS rn FROM h)
SELECT id, CAST(Repeat AS INTEGER) AS Repeat, CAST((o + rn - 1) % 5 + 1 AS INTEGER) AS Fold
FROM rk JOIN off USING (label)""")
def q_stratified_folds(spark, sf):
    d = C.drop_missing(T.labelled_documents(spark, sf), ["entity", "label"]).select("id", "label")
    return SP.stratified_folds(d, "label", "id", k=5, repeats=5).select(
        "id", F.col("Repeat").cast("int"), "Fold")


@query("cluster_sizes", """
SELECT l_orderkey, count(*) AS size FROM lineitem GROUP BY l_orderkey""")
def q_cluster_sizes(spark, sf):
    return SP.cluster_sizes(T.table(spark, sf, "lineitem"), "l_orderkey")


@query("cluster_split", """
WITH s AS (SELECT l_orderkey, count(*) AS size FROM lineitem GROUP BY 1),
t AS (SELECT sum(size) AS n, CAST(floor(sum(size) * CAST(0.2 AS DOUBLE)) AS BIGINT) AS target,
             CAST(floor(sum(size) * CAST(0.05 AS DOUBLE)) AS BIGINT) AS tol FROM s),
h AS (SELECT *, ('0x' || substr(md5('42|0|' || CAST(l_orderkey AS VARCHAR)), 1, 15))::UBIGINT AS h FROM s),
c AS (SELECT *, sum(size) OVER (ORDER BY h, l_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
      FROM h),
sel AS (SELECT l_orderkey FROM c, t WHERE cum - size < target - tol)
SELECT l.l_orderkey, l.l_linenumber,
  CASE WHEN l.l_orderkey IN (SELECT l_orderkey FROM sel) THEN 'test' ELSE 'train' END AS split
FROM lineitem l""")
def q_cluster_split(spark, sf):
    li = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    out, _ = SP.cluster_split(li, "l_orderkey")
    return out.select("l_orderkey", "l_linenumber", "split")


@query("cluster_split_fallback", """
WITH s AS (SELECT l_orderkey, count(*) AS size FROM lineitem GROUP BY 1),
t AS (SELECT CAST(floor(sum(size) * CAST(0.2 AS DOUBLE)) AS BIGINT) AS target FROM s),
h AS (SELECT *, ('0x' || substr(md5('0|' || CAST(l_orderkey AS VARCHAR)), 1, 15))::UBIGINT AS h FROM s),
c AS (SELECT *, sum(size) OVER (ORDER BY size DESC, h, l_orderkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM h)
SELECT l_orderkey FROM c, t WHERE cum - size < target""")
def q_cluster_split_fallback(spark, sf):
    sizes = SP.cluster_sizes(T.table(spark, sf, "lineitem"), "l_orderkey")
    n = sizes.agg(F.sum("size")).first()[0]
    return SP.fallback_selection(sizes, "l_orderkey", int(n * 0.2))
