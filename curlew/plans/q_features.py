"""Queries for feature operators (inventory 21, 43-48)."""

from __future__ import annotations

from pyspark.sql import functions as F

from curlew.operators import clean as C
from curlew.operators import features as FE
from curlew.plans.catalog import DOCS_KEYED, char_bits_sql, query, word_bits_sql
from curlew.sources import tables as T

WS = r"[\t\n\x0B\f\r ]+"


def docs_keyed(spark, sf):
    d = T.table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("entity"), "lang", "source")
    return C.standardize_key(d, "entity")


def explode_bits(df):
    # explode_outer + filter: a plain explode makes the optimizer infer
    # size(bits) > 0 and push it below the projection, which inlines (and
    # recomputes) the whole fingerprint expression inside the filter
    return df.select("id", F.explode_outer("bits").alias("bit")).filter(F.col("bit").isNotNull())


@query("hashed_fingerprint", "WITH " + DOCS_KEYED + "," + word_bits_sql("dk", "b", 1, 3)
       + " SELECT id, bit FROM b")
def q_hashed_fingerprint(spark, sf):
    return explode_bits(FE.hashed_fingerprint(docs_keyed(spark, sf)))


@query("path_fingerprint", "WITH " + DOCS_KEYED + "," + char_bits_sql("dk", "b", 3, 4)
       + " SELECT id, bit FROM b")
def q_path_fingerprint(spark, sf):
    return explode_bits(FE.path_fingerprint(docs_keyed(spark, sf)))


def _keyed_sql() -> str:
    parts = []
    for b, c, t in FE.keyed_patterns(166):
        lit = c.replace("'", "''")
        parts.append(f"CASE WHEN length(key) - length(replace(key, '{lit}', '')) >= {t} "
                     f"THEN {b} END")
    return ("WITH " + DOCS_KEYED + ", kb AS (SELECT id, list_filter([" + ", ".join(parts)
            + "], lambda x: x IS NOT NULL) AS bits FROM dk WHERE key IS NOT NULL) "
            "SELECT id, CAST(unnest(bits) AS INTEGER) AS bit FROM kb")


@query("keyed_fingerprint", _keyed_sql())
def q_keyed_fingerprint(spark, sf):
    return explode_bits(FE.keyed_fingerprint(docs_keyed(spark, sf)))


@query("numeric_descriptors", "WITH " + DOCS_KEYED + f""",
w AS (SELECT *, list_filter(string_split(key, ' '), lambda x: length(x) > 0) AS words FROM dk)
SELECT id,
  CAST(length(entity) AS DOUBLE) AS n_chars,
  CAST(len(words) AS DOUBLE) AS n_words,
  CAST(len(list_distinct(words)) AS DOUBLE) AS n_distinct_words,
  CAST(length(regexp_replace(entity, '[^\\p{{L}}]', '', 'g')) AS DOUBLE) AS n_letters,
  CAST(length(regexp_replace(entity, '[^\\p{{Lu}}]', '', 'g')) AS DOUBLE) AS n_upper,
  CAST(length(regexp_replace(entity, '[^0-9]', '', 'g')) AS DOUBLE) AS n_digits,
  CAST(length(regexp_replace(entity, '[^.,;:!?]', '', 'g')) AS DOUBLE) AS n_punct,
  CAST(length(entity) - length(replace(entity, chr(10), '')) + 1 AS DOUBLE) AS n_lines,
  CASE WHEN len(words) > 0 THEN length(replace(key, ' ', '')) / len(words) END AS mean_word_len,
  CASE WHEN len(words) > 0 THEN len(list_distinct(words)) / len(words) END AS distinct_word_ratio
FROM w""")
def q_numeric_descriptors(spark, sf):
    return FE.numeric_descriptors(docs_keyed(spark, sf)).select("id", *FE.PROFILE)


def numeric_block(spark, sf):
    """lineitem numeric block plus a monotone copy, a constant, a column with
    nulls and one with infinities."""
    li = T.table(spark, sf, "lineitem")
    return li.select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (F.col("l_quantity") * 2 + 1).alias("q_monotone"),
        F.lit(1.0).alias("constant"),
        F.when(F.col("l_linenumber") != 1, F.col("l_tax")).alias("with_nulls"),
        F.when(F.col("l_linenumber") == 1, F.lit(float("inf")))
         .otherwise(F.col("l_quantity") / F.col("l_linenumber")).alias("with_inf"),
        "l_returnflag")


NUM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "q_monotone", "constant",
            "with_nulls", "with_inf", "l_returnflag"]


@query("clean_numeric", """
WITH nb AS (
  SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_quantity * 2 + 1 AS q_monotone,
    CAST(1.0 AS DOUBLE) AS constant,
    CASE WHEN l_linenumber <> 1 THEN l_tax END AS with_nulls,
    CASE WHEN l_linenumber = 1 THEN CAST('inf' AS DOUBLE) ELSE l_quantity / l_linenumber END AS with_inf
  FROM lineitem),
lng AS (SELECT row_number() OVER () AS rid, * FROM nb),
u AS (UNPIVOT lng ON l_quantity, l_extendedprice, l_discount, l_tax, q_monotone, constant,
      with_nulls, with_inf INTO NAME feature VALUE v),
stat AS (
  SELECT feature, (SELECT count(*) FROM nb) - count(CASE WHEN NOT isinf(v) THEN v END) AS nnull,
         var_samp(v) AS var
  FROM u GROUP BY feature),
pos AS (SELECT * FROM (VALUES ('l_quantity', 1), ('l_extendedprice', 2), ('l_discount', 3),
   ('l_tax', 4), ('q_monotone', 5), ('constant', 6), ('with_nulls', 7), ('with_inf', 8),
   ('l_returnflag', 9)) t(feature, p)),
surv AS (SELECT s.feature, p.p FROM stat s JOIN pos p USING (feature) WHERE nnull = 0 AND var > 0.01),
rk AS (SELECT u.rid, u.feature, rank() OVER (PARTITION BY u.feature ORDER BY v)
          + (count(*) OVER (PARTITION BY u.feature, v) - 1) / CAST(2 AS DOUBLE) AS r
       FROM u JOIN surv USING (feature)),
pairs AS (SELECT a.feature AS fi, b.feature AS fj, abs(corr(a.r, b.r)) AS rho
          FROM rk a JOIN rk b ON a.rid = b.rid JOIN surv sa ON sa.feature = a.feature
          JOIN surv sb ON sb.feature = b.feature WHERE sa.p < sb.p GROUP BY 1, 2),
corrd AS (SELECT DISTINCT fj AS feature FROM pairs WHERE rho > 0.95)
SELECT p.feature,
  CAST(CASE WHEN p.feature = 'l_returnflag' THEN 0 WHEN s.nnull > 0 THEN 0
       WHEN NOT s.var > 0.01 OR s.var IS NULL THEN 0
       WHEN p.feature IN (SELECT feature FROM corrd) THEN 0 ELSE 1 END AS INTEGER) AS kept,
  CASE WHEN p.feature = 'l_returnflag' THEN 'not_numeric' WHEN s.nnull > 0 THEN 'has_null'
       WHEN NOT s.var > 0.01 OR s.var IS NULL THEN 'low_variance'
       WHEN p.feature IN (SELECT feature FROM corrd) THEN 'correlated' ELSE 'kept' END AS reason
FROM pos p LEFT JOIN stat s USING (feature)""")
def q_clean_numeric(spark, sf):
    _, table = FE.clean_numeric(numeric_block(spark, sf), NUM_COLS)
    return table


@query("inf_to_null", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity / l_linenumber END AS with_inf
FROM lineitem""")
def q_inf_to_null(spark, sf):
    li = T.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 1, F.lit(float("inf")))
         .otherwise(F.col("l_quantity") / F.col("l_linenumber")).alias("with_inf"))
    return FE.inf_to_null(li, ["with_inf"])


@query("embedding_features", """
SELECT d.doc_id AS id, CAST(len(e.embedding) AS INTEGER) AS dim,
  sqrt(list_sum(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS norm,
  e.label, CAST(e.embedding IS NOT NULL AS INTEGER) AS has_embedding
FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id""")
def q_embedding_features(spark, sf):
    from pyspark.ml.functions import vector_to_array
    docs = T.table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    emb = T.table(spark, sf, "embeddings")
    j = FE.embedding_features(docs, emb).join(
        emb.select(F.col("vec_id").alias("id"), "label"), "id", "left")
    arr = F.when(F.col("has_embedding") == 1, vector_to_array("features"))
    return j.select("id", F.size(arr).alias("dim"),
                    F.sqrt(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x * x)).alias("norm"),
                    "label", "has_embedding")
