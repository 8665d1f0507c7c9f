"""Feature operators: hashed fingerprints (sets of bit positions), a keyed
pattern fingerprint, a numeric profile per entity, numeric-block cleaning,
and embedding features. Fingerprints are Arrow functions over the keys; the
numeric cleaning runs one aggregation pass plus ``operators.ranks``."""

from __future__ import annotations

from functools import partial

import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curlew.functions import hashing as H
from curlew.functions import text as tx
from curlew.operators.ranks import spearman_matrix


def hashed_fingerprint(df: DataFrame, key: str = "key", nbits: int = 2048, min_n: int = 1,
                       max_n: int = 3, out: str = "bits") -> DataFrame:
    """Circular-fingerprint analogue: token n-grams of widths min_n..max_n of a
    standardised key (single-space separated), folded to ``nbits``. The
    default widths 1..3 match radius 2 (radius r -> widths 1..r+1)."""
    return df.withColumn(out, H.bitset(F.col(key), partial(H.word_shingles, min_n=min_n, max_n=max_n), nbits))


def path_fingerprint(df: DataFrame, key: str = "key", nbits: int = 2048, min_k: int = 3,
                     max_k: int = 4, out: str = "bits") -> DataFrame:
    """Path-fingerprint analogue: character k-grams (k in min_k..max_k) of the
    whole key, folded to ``nbits``."""
    return df.withColumn(out, H.bitset(F.col(key), partial(H.char_shingles, min_k=min_k, max_k=max_k), nbits, H.KEPT_SHINGLES))


# The character alphabet and count thresholds that generate the
# keyed pattern table (bit b = "character c occurs at least t times").
KEYED_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789.,;:!?'\"()-|/&%$#@*+="
KEYED_THRESHOLDS = (1, 8, 64)


def keyed_patterns(n_bits: int = 166) -> list[tuple[int, str, int]]:
    """(bit, character, min count) for bits 1..n_bits, generated by rule:
    thresholds outer, alphabet inner."""
    pats = [(c, t) for t in KEYED_THRESHOLDS for c in KEYED_ALPHABET]
    if n_bits > len(pats):
        raise ValueError(f"at most {len(pats)} keyed bits")
    return [(i + 1, c, t) for i, (c, t) in enumerate(pats[:n_bits])]


def keyed_fingerprint(df: DataFrame, key: str = "key", n_bits: int = 166,
                      out: str = "bits") -> DataFrame:
    """Keyed (dictionary) fingerprint: one bit per pattern of the table."""
    pats = keyed_patterns(n_bits)
    chars = sorted({c for _, c, _ in pats})

    def bits(keys: pa.Array) -> pa.Array:
        def of(text: str) -> list[int]:
            counts = {c: text.count(c) for c in chars}
            return [b for b, c, t in pats if counts[c] >= t]

        return H.int_lists(keys, of)

    return df.withColumn(out, F.arrow_udf(bits, "array<int>")(F.col(key)))


PROFILE = ["n_chars", "n_words", "n_distinct_words", "n_letters", "n_upper", "n_digits",
           "n_punct", "n_lines", "mean_word_len", "distinct_word_ratio"]


def numeric_descriptors(df: DataFrame, entity: str = "entity", key: str = "key") -> DataFrame:
    """Numeric profile per entity (wide block of doubles)."""
    e, k = F.col(entity), F.col(key)
    words = F.filter(F.split(k, " "), lambda w: F.length(w) > 0)
    nw = F.size(words)

    def nmatch(cls: str) -> Column:
        return F.length(F.regexp_replace(e, cls, ""))
    return df.select(
        "*",
        F.length(e).cast("double").alias("n_chars"),
        nw.cast("double").alias("n_words"),
        F.size(F.array_distinct(words)).cast("double").alias("n_distinct_words"),
        nmatch(r"[^\p{L}]").cast("double").alias("n_letters"),
        nmatch(r"[^\p{Lu}]").cast("double").alias("n_upper"),
        nmatch(r"[^0-9]").cast("double").alias("n_digits"),
        nmatch(r"[^.,;:!?]").cast("double").alias("n_punct"),
        (tx.count_char(e, "\n") + 1).cast("double").alias("n_lines"),
        F.when(nw > 0, F.length(F.replace(k, F.lit(" "), F.lit(""))) / nw).alias("mean_word_len"),
        F.when(nw > 0, F.size(F.array_distinct(words)) / nw).alias("distinct_word_ratio"))


def inf_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """+-inf and NaN -> null in the given double columns."""
    return df.withColumns({c: F.when(~F.isnan(c) & ~F.col(c).isin(float("inf"), float("-inf")),
                                     F.col(c)) for c in cols})


def clean_numeric(df: DataFrame, cols: list[str], var_min: float = 0.01,
                  corr_max: float = 0.95) -> tuple[list[str], DataFrame]:
    """Numeric-block cleaning, in order: +-inf -> null; drop columns with any
    null; keep numeric columns; keep var_samp > var_min (strict); drop column
    j when any earlier surviving column i < j has |Spearman| > corr_max (even
    an i that is itself dropped by this rule).

    Returns (kept columns, decision table ``feature, kept, reason``). One
    aggregation pass for nulls and variances; Spearman from ``operators.ranks``.
    Only the k x k correlation matrix reaches the driver.
    """
    numeric = {f.name for f in df.schema.fields
               if f.dataType.typeName() in ("double", "float", "integer", "long", "short",
                                            "byte", "decimal")}
    spark = df.sparkSession
    reasons: dict[str, str] = {}
    num_cols = [c for c in cols if c in numeric]
    for c in cols:
        if c not in numeric:
            reasons[c] = "not_numeric"
    d = inf_to_null(df.select(*[F.col(c).cast("double").alias(c) for c in num_cols]), num_cols)
    stats = d.agg(*[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(num_cols)],
                  *[F.var_samp(c).alias(f"v_{i}") for i, c in enumerate(num_cols)]).first()
    survivors = []
    for i, c in enumerate(num_cols):
        v = stats[f"v_{i}"]
        if stats[f"n_{i}"] > 0:
            reasons[c] = "has_null"
        elif v is None or not v > var_min:
            reasons[c] = "low_variance"
        else:
            survivors.append(c)
    if len(survivors) > 1:
        m = spearman_matrix(d, survivors)
        for j in range(1, len(survivors)):
            if any(abs(m[i, j]) > corr_max for i in range(j)):
                reasons[survivors[j]] = "correlated"
    kept = [c for c in survivors if c not in reasons]
    table = spark.createDataFrame(
        [(c, int(c in kept), reasons.get(c, "kept")) for c in cols],
        "feature string, kept int, reason string")
    return kept, table


def embedding_features(df: DataFrame, emb: DataFrame, id_col: str = "id",
                       emb_id: str = "vec_id", emb_col: str = "embedding") -> DataFrame:
    """Join a precomputed embedding table on the entity id (never by
    position) and expose it as an ML vector column ``features``. Rows without
    an embedding stay, with null features and ``has_embedding`` 0."""
    e = emb.filter(F.col(emb_col).isNotNull()).select(
        F.col(emb_id).alias(id_col), array_to_vector(emb_col).alias("features"), F.lit(1).alias("has_embedding"))
    return df.join(e, id_col, "left").withColumn("has_embedding", F.coalesce("has_embedding", F.lit(0)))
