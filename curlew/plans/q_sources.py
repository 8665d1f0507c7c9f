"""Queries for sources and sinks (inventory 2-10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from curlew.operators import features as FE
from curlew.sources import io as IO
from curlew.plans.catalog import CURATED_DOCS, DOCS_KEYED, query, strat_split_sql, word_bits_sql
from curlew.plans.q_features import docs_keyed
from curlew.plans.q_reshape import SUMMARY, summary
from curlew.session import scratch_path

_STORE_SQL = "WITH " + DOCS_KEYED + "," + word_bits_sql("dk", "b", 2, 2) + """,
k AS (SELECT DISTINCT key FROM dk WHERE key IS NOT NULL),
nb AS (SELECT dk.key, count(DISTINCT b.bit) AS n FROM dk LEFT JOIN b ON b.id = dk.id
       WHERE dk.key IS NOT NULL GROUP BY dk.key)"""


def _store(spark, sf):
    store = scratch_path(spark, "feature-store")
    keys = docs_keyed(spark, sf).select("key").filter(F.col("key").isNotNull())
    params = {"min_n": 2, "max_n": 2, "nbits": 2048}
    def build(new):
        return FE.hashed_fingerprint(new, min_n=2, max_n=2)
    IO.feature_store_upsert(spark, store, keys, "word2", params, build=build)
    IO.feature_store_upsert(spark, store, keys, "word2", params, build=build)   # idempotent: featurises and appends nothing
    return store, params


@query("feature_store_upsert", _STORE_SQL + """
SELECT 'word2' AS descriptor, md5(key) AS entity_hash, CAST(n AS INTEGER) AS n_bits FROM nb""")
def q_feature_store_upsert(spark, sf):
    store, params = _store(spark, sf)
    r = IO.feature_store_read(spark, store, "word2", params)
    return r.select("descriptor", "entity_hash", F.size("value").alias("n_bits"))


@query("feature_store_info", _STORE_SQL + """
SELECT 'word2' AS descriptor, count(*) AS n_rows, CAST(max(n) AS INTEGER) AS max_width FROM nb""")
def q_feature_store_info(spark, sf):
    store, _ = _store(spark, sf)
    return IO.feature_store_info(spark, store)


@query("load_external_metrics", SUMMARY + """
SELECT Descriptor || '_' || Model AS name, ROC_AUC, MCC, GMean, PR_AUC, 0.0 AS Brier
FROM summary ORDER BY (Descriptor || '_' || Model = 'R_F') DESC, Descriptor, Model LIMIT 1""")
def q_load_external_metrics(spark, sf):
    return IO.load_external_metrics(summary(spark, sf), "R_F", ["ROC_AUC", "MCC", "GMean", "PR_AUC", "Brier"])


@query("write_split_roundtrip", "WITH " + CURATED_DOCS + "," + strat_split_sql("(SELECT id, label FROM curated)", "sp") + """
SELECT id, label, split FROM sp""")
def q_write_split_roundtrip(spark, sf):
    """Curated split written partitioned by split and read back."""
    from curlew.plans.q_models import curated_split_fp
    path = scratch_path(spark, "split")
    IO.write_split(curated_split_fp(spark, sf).select("id", "label", "split"), path)
    return spark.read.parquet(path)


@query("write_results_roundtrip")
def q_write_results_roundtrip(spark, sf):
    """Summary table written and read back with its column check (rows-only)."""
    base = scratch_path(spark, "results")
    IO.write_results({"results_summary": summary(spark, sf)}, base)
    return IO.read_results(spark, f"{base}/results_summary", "ROC_AUC")


@query("params_roundtrip", SUMMARY + """
SELECT Descriptor AS descriptor, 'LogisticRegression' AS model, max(ROC_AUC) AS c, 2000 AS max_iter, 1 AS known
FROM summary GROUP BY Descriptor""")
def q_params_roundtrip(spark, sf):
    """One parameter row per (descriptor, model), C being the descriptor's best
    ROC-AUC in the summary, written as JSON, read back, and merged over the
    catalog defaults."""
    from curlew.operators.models import resolve_params
    path = scratch_path(spark, "params")
    best = summary(spark, sf).groupBy(F.col("Descriptor").alias("descriptor")).agg(F.max("ROC_AUC").alias("c"))
    tuned = best.select("descriptor", F.lit("LogisticRegression").alias("model"),
                        F.create_map(F.lit("C"), F.col("c").cast("string")).alias("params"))
    IO.write_params(tuned, path)
    back = IO.read_params(spark, path)
    got = resolve_params(spark, back.select("descriptor", "model"), back)
    return got.select("descriptor", "model", F.col("params")["C"].cast("double").alias("c"),
                      F.col("params")["maxIter"].cast("int").alias("max_iter"), "known")
