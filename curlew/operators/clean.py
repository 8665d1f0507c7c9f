"""Curation operators: missing values, validation, key standardisation,
deduplication and label-conflict removal, and the curation funnel.

Dedup and conflict removal group on a 16-byte md5 digest of the key rather
than the key text, and carry the surviving row as a ``min_by`` struct: a
``HashAggregate`` with map-side partial aggregation, so a key that holds a
third of all rows collapses to one row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curlew.functions import text as tx


def key_digest(c: Column) -> Column:
    """Binary md5 of the key: fixed-width grouping key (collision-free in
    practice at 1e12 rows, unlike a 64-bit hash)."""
    return F.unhex(F.md5(c.cast("string")))


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def validate_entities(df: DataFrame, entity: str = "entity", rules: str = "text",
                      **params) -> DataFrame:
    """Add ``reject_reasons array<string>`` and ``is_valid`` (empty reasons)."""
    rule_list = tx.text_rules(**params) if rules == "text" else tx.line_notation_rules()
    out = df.withColumn("__e", F.col(entity))
    out = out.withColumn("reject_reasons", tx.reject_reasons(F.col("__e"), rule_list))
    return out.drop("__e").withColumn("is_valid", F.size("reject_reasons") == 0)


def invalid_count(df: DataFrame) -> DataFrame:
    """total / valid / invalid in one pass over a validated table."""
    return df.agg(F.count(F.lit(1)).alias("total"),
                  F.count_if(F.col("is_valid")).alias("valid"),
                  F.count_if(~F.col("is_valid")).alias("invalid"))


def standardize_key(df: DataFrame, entity: str = "entity", mode: str = "text",
                    out: str = "key") -> DataFrame:
    """Canonical key column; null when standardisation fails. ``mode`` is
    ``text`` (whitespace/case) or ``fragments`` (largest dot fragment)."""
    if mode == "text":
        k = tx.text_key(F.col(entity))
    elif mode == "fragments":
        k = tx.fragment_key(F.col(entity))
    else:
        raise ValueError(f"unknown standardisation mode {mode!r}")
    return df.withColumn(out, k)


def _row_struct(df: DataFrame, exclude: tuple[str, ...] = ()) -> Column:
    return F.struct(*[F.col(c) for c in df.columns if c not in exclude])


def dedup_same_label(df: DataFrame, key: str = "key", label: str = "label",
                     order: str = "id") -> DataFrame:
    """Keep the first row (smallest ``order``) per (key, label)."""
    cols = df.columns
    g = (df.withColumn("__h", key_digest(F.col(key)))
           .groupBy("__h", label)
           .agg(F.min_by(_row_struct(df), F.col(order)).alias("__r")))
    return g.select(*[F.col("__r").getField(c).alias(c) for c in cols])


def drop_conflicts(df: DataFrame, key: str = "key", label: str = "label",
                   order: str = "id") -> DataFrame:
    """Dedup on (key, label), then drop every row of a key that still has more
    than one row, i.e. a key seen with two different labels. Done as one
    aggregation on the key: a key survives iff min(label) = max(label), and
    its surviving row is its first row. Output order of columns is kept."""
    cols = df.columns
    g = (df.withColumn("__h", key_digest(F.col(key)))
           .groupBy("__h")
           .agg(F.min(label).alias("__lo"), F.max(label).alias("__hi"),
                F.min_by(_row_struct(df), F.col(order)).alias("__r")))
    kept = g.filter(F.col("__lo") == F.col("__hi"))
    return kept.select(*[F.col("__r").getField(c).alias(c) for c in cols])


def key_label_stats(df: DataFrame, key: str = "key", label: str = "label") -> DataFrame:
    """Per key: rows, distinct labels. Input to the funnel and the conflict
    report; one shuffle on the key digest (single distinct aggregate)."""
    return (df.withColumn("__h", key_digest(F.col(key)))
              .groupBy("__h")
              .agg(F.count(F.lit(1)).alias("n_rows"),
                   F.count_distinct(label).alias("n_labels")))


def curation_funnel(labelled: DataFrame, entity: str = "entity", label: str = "label",
                    rules: str = "text", mode: str = "text", validate: bool = True,
                    standardize: bool = True, **rule_params) -> DataFrame:
    """Long ``(stage, value)`` table: original, after_missing, after_validation,
    after_standardization, after_dedup, after_conflicts (conflicting keys
    dropped). A stage that is switched off keeps all rows. One scan: rows are
    grouped by key digest (rows without a key form one group, collapsed map-side
    by partial aggregation) with conditional counts, then the per-key table is summed."""
    v = validate_entities(labelled, entity, rules, **rule_params) if validate \
        else labelled.withColumn("is_valid", F.lit(True))
    v = standardize_key(v, entity, mode) if standardize else v.withColumn("key", F.col(entity))
    present = F.col(label).isNotNull() & F.col(entity).isNotNull()
    clean = present & F.col("is_valid") & F.col("key").isNotNull()
    per_key = v.withColumn("__h", key_digest(F.col("key"))).groupBy("__h").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(present).alias("p"),
        F.count_if(present & F.col("is_valid")).alias("va"), F.count_if(clean).alias("c"),
        F.count_distinct(F.when(clean, F.col(label))).alias("nl"))
    stages = ["original", "after_missing", "after_validation", "after_standardization",
              "after_dedup", "after_conflicts"]
    tot = per_key.agg(
        F.sum("n").cast("double").alias("original"), F.sum("p").cast("double").alias("after_missing"),
        F.sum("va").cast("double").alias("after_validation"),
        F.sum("c").cast("double").alias("after_standardization"),
        F.coalesce(F.sum("nl"), F.lit(0)).cast("double").alias("after_dedup"),
        F.count_if(F.col("nl") == 1).cast("double").alias("after_conflicts"))
    return tot.unpivot([], stages, "stage", "value")


def curated_entities(labelled: DataFrame, entity: str = "entity", label: str = "label",
                     rules: str = "text", mode: str = "text", validate: bool = True,
                     standardize: bool = True, **rule_params) -> DataFrame:
    """drop_missing -> validate -> standardise -> dedup -> drop conflicts.
    Output keeps the input columns plus ``key``; one shuffle in total."""
    df = drop_missing(labelled, [entity, label])
    if validate:
        df = validate_entities(df, entity, rules, **rule_params).filter("is_valid") \
            .drop("reject_reasons", "is_valid")
    if standardize:
        df = standardize_key(df, entity, mode).filter(F.col("key").isNotNull())
    else:
        df = df.withColumn("key", F.col(entity))
    return drop_conflicts(df, "key", label, "id")
