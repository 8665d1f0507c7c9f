"""Queries for curation operators (inventory 1, 11-14, 34-36, 42, 49)."""

from __future__ import annotations

from pyspark.sql import functions as F

from curlew.operators import clean as C
from curlew.plans.catalog import CLEAN_DOCS, CURATED_DOCS, LABELLED_DOCS, REASONS, TEXT_KEY, query
from curlew.sources import tables as T


@query("load_labelled", f"""
WITH {LABELLED_DOCS}
SELECT id, entity, CAST(label AS INTEGER) AS label, lang, source FROM labelled""")
def q_load_labelled(spark, sf):
    return T.labelled_documents(spark, sf).select("id", "entity", "label", "lang", "source")


@query("drop_missing", f"""
WITH {LABELLED_DOCS}
SELECT id, CAST(label AS INTEGER) AS label FROM labelled
WHERE entity IS NOT NULL AND label IS NOT NULL""")
def q_drop_missing(spark, sf):
    return C.drop_missing(T.labelled_documents(spark, sf), ["entity", "label"]) \
        .select("id", "label")


@query("validate_entities", f"""
WITH {LABELLED_DOCS}, v AS (SELECT id, {REASONS} AS reasons FROM labelled)
SELECT id, CAST(len(reasons) = 0 AS INTEGER) AS is_valid,
       array_to_string(reasons, ',') AS reject_reasons FROM v""")
def q_validate_entities(spark, sf):
    v = C.validate_entities(T.labelled_documents(spark, sf), "entity")
    return v.select("id", F.col("is_valid").cast("int").alias("is_valid"),
                    F.concat_ws(",", "reject_reasons").alias("reject_reasons"))


@query("invalid_count", f"""
WITH {LABELLED_DOCS}, v AS (SELECT id, {REASONS} AS reasons FROM labelled)
SELECT count(*) AS total, count_if(len(reasons) = 0) AS valid,
       count_if(len(reasons) > 0) AS invalid FROM v""")
def q_invalid_count(spark, sf):
    return C.invalid_count(C.validate_entities(T.labelled_documents(spark, sf), "entity"))


@query("standardize_key", f"""
WITH {LABELLED_DOCS}
SELECT id, {TEXT_KEY} AS key FROM labelled""")
def q_standardize_key(spark, sf):
    return C.standardize_key(T.labelled_documents(spark, sf), "entity").select("id", "key")


@query("standardize_fragments", """
SELECT p_partkey AS id,
  (SELECT f FROM (SELECT unnest(list_filter(string_split(trim(replace(p_name, ' ', '.')), '.'),
                                             lambda f: length(f) > 0)) AS f)
   ORDER BY length(f) DESC, f ASC LIMIT 1) AS key
FROM part""")
def q_standardize_fragments(spark, sf):
    part = T.table(spark, sf, "part")
    df = part.select(F.col("p_partkey").alias("id"),
                     F.replace("p_name", F.lit(" "), F.lit(".")).alias("entity"))
    k = C.standardize_key(df, "entity", mode="fragments")
    return k.select("id", "key")


@query("dedup_same_label", "WITH " + CLEAN_DOCS + """
SELECT key, CAST(label AS INTEGER) AS label, min(id) AS id FROM clean GROUP BY key, label""")
def q_dedup_same_label(spark, sf):
    df = C.drop_missing(T.labelled_documents(spark, sf), ["entity", "label"])
    df = C.validate_entities(df).filter("is_valid")
    df = C.standardize_key(df).filter(F.col("key").isNotNull())
    return C.dedup_same_label(df.select("id", "key", "label")).select("key", "label", "id")


@query("drop_conflicts", """
SELECT l_orderkey, min(l_linestatus) AS l_linestatus, min(l_linenumber) AS l_linenumber
FROM lineitem GROUP BY l_orderkey HAVING min(l_linestatus) = max(l_linestatus)""")
def q_drop_conflicts(spark, sf):
    li = T.lineitem_entities(spark, sf)
    return C.drop_conflicts(li, "l_orderkey", "l_linestatus", "l_linenumber")


@query("conflict_report", """
WITH k AS (SELECT l_orderkey, count(DISTINCT l_linestatus) AS nl FROM lineitem GROUP BY 1)
SELECT count(*) AS entities, count_if(nl > 1) AS conflicting, count_if(nl = 1) AS kept FROM k""")
def q_conflict_report(spark, sf):
    li = T.lineitem_entities(spark, sf).withColumn("key", F.col("l_orderkey").cast("string"))
    s = C.key_label_stats(li, "key", "l_linestatus")
    return s.agg(F.count(F.lit(1)).alias("entities"),
                 F.count_if(F.col("n_labels") > 1).alias("conflicting"),
                 F.count_if(F.col("n_labels") == 1).alias("kept"))


@query("curation_funnel", "WITH " + LABELLED_DOCS + f""",
v AS (SELECT *, {REASONS} AS reasons, {TEXT_KEY} AS key FROM labelled),
p AS (SELECT * FROM v WHERE entity IS NOT NULL AND label IS NOT NULL),
c AS (SELECT * FROM p WHERE len(reasons) = 0 AND key IS NOT NULL),
k AS (SELECT key, count(DISTINCT label) AS nl FROM c GROUP BY key)
SELECT 'original' AS stage, CAST((SELECT count(*) FROM v) AS DOUBLE) AS value
UNION ALL SELECT 'after_missing', (SELECT count(*) FROM p)
UNION ALL SELECT 'after_validation', (SELECT count(*) FROM p WHERE len(reasons) = 0)
UNION ALL SELECT 'after_standardization', (SELECT count(*) FROM c)
UNION ALL SELECT 'after_dedup', (SELECT coalesce(sum(nl), 0) FROM k)
UNION ALL SELECT 'after_conflicts', (SELECT count_if(nl = 1) FROM k)""")
def q_curation_funnel(spark, sf):
    return C.curation_funnel(T.labelled_documents(spark, sf))


@query("curated_entities", "WITH " + CURATED_DOCS + """
SELECT id, key, CAST(label AS INTEGER) AS label FROM curated""")
def q_curated_entities(spark, sf):
    return C.curated_entities(T.labelled_documents(spark, sf)).select("id", "key", "label")
