"""Stateless curation projections on a streaming source.

Validation, standardisation and fingerprints are per-row expressions (Catalyst
and Arrow), so the batch operators apply unchanged to a streaming
DataFrame; nothing here keeps state. Deduplication across a stream would
need state and is done in batch (the source has no streaming)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.operators import clean as C
from curlew.operators import features as FE


def read_documents_stream(spark: SparkSession, sf_dir: str, max_files: int = 1) -> DataFrame:
    """documents parquet as a file stream (schema taken from the batch table)."""
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    # a file stream watches a folder; keep only the documents file in it
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files) \
        .option("pathGlobFilter", "documents*.parquet").parquet(sf_dir)


def curate_stream(stream: DataFrame, entity: str = "text", nbits: int = 2048) -> DataFrame:
    """validate -> standardise -> fingerprint, row by row."""
    v = C.validate_entities(stream, entity)
    k = C.standardize_key(v, entity)
    fp = FE.hashed_fingerprint(k, "key", nbits, 2, 2)
    return fp.select("doc_id", "is_valid", "key", F.size("bits").alias("n_bits"), "bits")
