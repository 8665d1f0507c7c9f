"""The registered queries of this subpackage, with production parameters, and
their DuckDB oracles where SQL can express them. Each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.llm import ann, decontaminate, licenses, merkle, mixing, near_dup, phrases, quality, secret_scan, sharding, tokens, url_reputation, warc
from curlew.llm.common import table
from curlew.llm.oracles import ORACLES as ORACLES
from curlew.session import scratch_path

END_ID = 2
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def good_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label is good if its text is of quality and not toxic."""
    return table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int").alias("good"))


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "op1-tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path(), END_ID, kept_words=600_000)
    return tokens.read_tokens(spark, path, with_ids=False)


def op2_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "op3-warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    read = warc.records(warc.read_archives(spark, path))
    return read.select(F.col("row").cast("long").alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), F.col("refers").cast("long").alias("refers_to"))


def op4_decontaminate_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_ann_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op6_secret_lexer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op7_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), good_labels(spark, sf_dir))


def op8_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: the labels of the documents that the urls name by number; a page is
    bad if its document is of no quality or toxic."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(url_reputation.path_of(F.col("url")), r"/([0-9]{1,18})(?:\.html|/)?$", 1)
    named = pages.select(url_reputation.host_of(F.col("url")).alias("host"), F.when(number != "", number).cast("long").alias("doc_id"))
    labels = table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    return url_reputation.judge(pages, named.join(labels, "doc_id", "left").select("host", "bad"), RULES)


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id has a crc32 that 7 divides are tampered with: n_chars is one more."""
    changed = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    change = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    return merkle.verify(merkle.build(table(spark, sf_dir, "documents"), changed, change))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.assign(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_token_output, op2_license_digest, op3_warc_chunks, op4_decontaminate_bm25, op5_ann_kmeans_tree,
    op6_secret_lexer, op7_quality_resampling, op8_bagminhash, op9_url_reputation, op10_mix_sources, op11_phrases, op12_merkle_manifest, op13_sharding)}
