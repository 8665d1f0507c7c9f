"""The corpus pipeline: documents through the operators of ``curlew.llm``, one after
the other. Each stage is written as Parquet and read again as the next one's docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curlew.llm import decontaminate, mixing, near_dup, quality, queries, tokens
from curlew.llm.common import stored, table
from curlew.session import scratch_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling keeps."""
    return quality.keep_good(docs, queries.good_labels(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate class."""
    return near_dup.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.sample(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus as token ids, read back: doc_id, start, n_tokens, ids_crc32."""
    path = scratch_path(spark, "pipeline-tokens")
    tokens.write_tokens(docs, path, queries.tokenizer_path(), queries.END_ID, kept_words=50_000, slice_bytes=1 << 20, keep_cache=False)
    return tokens.read_tokens(spark, path, with_ids=False)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: The stages are fitted models, signatures and a coder, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
