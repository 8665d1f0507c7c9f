"""Registry of named queries (one per operator of the inventory) with their
DuckDB oracle SQL. Each query is ``fn(spark, sf_dir) -> DataFrame`` over the
whole shared test tables; the oracle is an independent SQL statement of the
same semantics (never the engine's own shortcut).

Modules register into ``QUERIES`` / ``ORACLES`` at import time; importing
``curlew.plans.queries_*`` fills the registry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    from curlew.plans import (  # noqa: F401
        q_curation, q_features, q_similarity, q_split, q_metrics, q_reshape,
        q_stats, q_models, q_batched, q_sources,
    )


# ---------------------------------------------------------------------------
# Shared SQL fragments (DuckDB dialect)
# ---------------------------------------------------------------------------

WS = r"[\t\n\x0B\f\r ]+"

LABELLED_DOCS = """
labelled AS (
  SELECT d.doc_id AS id, d.text AS entity, l.toxic AS label, d.lang, d.source
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

# validation reasons for text entities (same rule table as functions.text)
REASONS = f"""
list_filter([
  CASE WHEN entity IS NULL THEN 'null' END,
  CASE WHEN length(trim(regexp_replace(entity, '{WS}', ' ', 'g'))) = 0 THEN 'blank' END,
  CASE WHEN length(trim(regexp_replace(entity, '{WS}', ' ', 'g'))) < 20 THEN 'too_short' END,
  CASE WHEN regexp_matches(entity, '[\\x00-\\x08\\x0E-\\x1F]') THEN 'control_chars' END,
  CASE WHEN length(regexp_replace(entity, '[^\\p{{L}}]', '', 'g'))
            < 0.5 * length(regexp_replace(entity, '{WS}', '', 'g')) THEN 'low_letter_share' END
], lambda x: x IS NOT NULL)"""

TEXT_KEY = f"nullif(lower(trim(regexp_replace(entity, '{WS}', ' ', 'g'))), '')"

# labelled, present, valid, standardised rows
CLEAN_DOCS = LABELLED_DOCS + f""",
validated AS (SELECT *, {REASONS} AS reasons FROM labelled),
clean AS (
  SELECT id, entity, label, lang, source, {TEXT_KEY} AS key
  FROM validated
  WHERE entity IS NOT NULL AND label IS NOT NULL AND len(reasons) = 0
    AND {TEXT_KEY} IS NOT NULL
)"""

# curated: dedup + conflicts dropped (first row per key)
CURATED_DOCS = CLEAN_DOCS + """,
curated AS (
  SELECT c.* FROM clean c
  JOIN (SELECT key, min(id) AS id FROM clean GROUP BY key
        HAVING min(label) = max(label)) k ON c.id = k.id
)"""


def metrics10_sql(src: str, groups: list[str], threshold: float = 0.5) -> str:
    """Oracle SQL for the ten metrics per group over CTE ``src`` with columns
    ``groups + [y, score]``. AUC by the Mann-Whitney mid-rank sum, AP by a
    descending running sum; both differ in form from the engine's plan."""
    g = ", ".join(groups)
    pg = f"PARTITION BY {g}"
    t = float(threshold)
    return f"""
c_{src} AS (
  SELECT {g},
    CAST(count_if(y = 1 AND score >= {t}) AS DOUBLE) AS tp,
    CAST(count_if(y = 0 AND score >= {t}) AS DOUBLE) AS fp,
    CAST(count_if(y = 0 AND score < {t}) AS DOUBLE) AS tn,
    CAST(count_if(y = 1 AND score < {t}) AS DOUBLE) AS fn
  FROM {src} GROUP BY {g}
),
r_{src} AS (
  SELECT {g}, y,
    rank() OVER ({pg} ORDER BY score)
      + (count(*) OVER ({pg}, score) - 1) / CAST(2 AS DOUBLE) AS mr
  FROM {src}
),
auc_{src} AS (
  SELECT {g},
    CAST(count_if(y = 1) AS DOUBLE) AS P, CAST(count_if(y = 0) AS DOUBLE) AS N,
    sum(CASE WHEN y = 1 THEN mr ELSE 0 END) AS rs
  FROM r_{src} GROUP BY {g}
),
t_{src} AS (
  SELECT {g}, score, count_if(y = 1) AS pos, count_if(y = 0) AS neg
  FROM {src} GROUP BY {g}, score
),
u_{src} AS (
  SELECT {g}, pos,
    sum(pos) OVER ({pg} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp_ge,
    sum(neg) OVER ({pg} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp_ge
  FROM t_{src}
),
ap_{src} AS (
  SELECT {g}, sum(pos * CAST(tp_ge AS DOUBLE) / (tp_ge + fp_ge)) AS apn FROM u_{src} GROUP BY {g}
),
m_{src} AS (
  SELECT {", ".join("c." + x for x in groups)},
    CAST(c.tp AS BIGINT) AS tp, CAST(c.fp AS BIGINT) AS fp,
    CAST(c.tn AS BIGINT) AS tn, CAST(c.fn AS BIGINT) AS fn,
    CASE WHEN a.P > 0 AND a.N > 0 THEN (a.rs - a.P * (a.P + 1) / 2) / (a.P * a.N) END AS ROC_AUC,
    CASE WHEN a.P > 0 THEN p.apn / a.P END AS PR_AUC,
    (c.tp + c.tn) / (c.tp + c.fp + c.tn + c.fn) AS Accuracy,
    CASE WHEN c.tp + c.fn = 0 THEN 0.0 ELSE c.tp / (c.tp + c.fn) END AS Sensitivity,
    CASE WHEN c.tn + c.fp = 0 THEN 0.0 ELSE c.tn / (c.tn + c.fp) END AS Specificity,
    sqrt((CASE WHEN c.tp + c.fn = 0 THEN 0.0 ELSE c.tp / (c.tp + c.fn) END)
       * (CASE WHEN c.tn + c.fp = 0 THEN 0.0 ELSE c.tn / (c.tn + c.fp) END)) AS GMean,
    CASE WHEN c.tp + c.fp = 0 THEN 0.0 ELSE c.tp / (c.tp + c.fp) END AS Precision,
    CASE WHEN 2 * c.tp + c.fp + c.fn = 0 THEN 0.0 ELSE 2 * c.tp / (2 * c.tp + c.fp + c.fn) END AS F1,
    CASE WHEN (c.tp + c.fp) * (c.tp + c.fn) * (c.tn + c.fp) * (c.tn + c.fn) = 0 THEN 0.0
         ELSE (c.tp * c.tn - c.fp * c.fn)
              / sqrt((c.tp + c.fp) * (c.tp + c.fn) * (c.tn + c.fp) * (c.tn + c.fn)) END AS MCC,
    CASE WHEN ((c.tp + c.fp) * (c.tp + c.fn) + (c.fn + c.tn) * (c.fp + c.tn))
              = (c.tp + c.fp + c.tn + c.fn) * (c.tp + c.fp + c.tn + c.fn) THEN NULL
         ELSE ((c.tp + c.tn) / (c.tp + c.fp + c.tn + c.fn)
               - ((c.tp + c.fp) * (c.tp + c.fn) + (c.fn + c.tn) * (c.fp + c.tn))
                 / ((c.tp + c.fp + c.tn + c.fn) * (c.tp + c.fp + c.tn + c.fn)))
            / (1 - ((c.tp + c.fp) * (c.tp + c.fn) + (c.fn + c.tn) * (c.fp + c.tn))
                 / ((c.tp + c.fp + c.tn + c.fn) * (c.tp + c.fp + c.tn + c.fn))) END AS Kappa
  FROM c_{src} c JOIN auc_{src} a USING ({g}) JOIN ap_{src} p USING ({g})
)"""


SCORED = """
scored AS (
  SELECT l_linestatus AS grp, CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount * 10 AS score
  FROM lineitem
)"""

FOLD_PRED = """
foldpred AS (
  SELECT l_returnflag AS Descriptor, l_linestatus AS Model,
    CAST(1 + l_orderkey % 2 AS INTEGER) AS Repeat, CAST(1 + l_linenumber % 5 AS INTEGER) AS Fold,
    CAST(l_quantity > 25 AS INTEGER) AS y, (l_discount * 10 + l_quantity / 50) / 2 AS score
  FROM lineitem
)"""

FOLD_RESULTS = FOLD_PRED + "," + metrics10_sql("foldpred", ["Descriptor", "Model", "Repeat", "Fold"]) + """,
results AS (SELECT * EXCLUDE (tp, fp, tn, fn) FROM m_foldpred)"""

METRIC_NAMES = ["ROC_AUC", "PR_AUC", "Accuracy", "Sensitivity", "Specificity", "GMean",
                "Precision", "F1", "MCC", "Kappa"]

SUBJECTS = """
subj AS (
  SELECT CAST(user_id % 25 AS INTEGER) AS Subject, event_type AS Model, avg(value) AS value
  FROM events GROUP BY 1, 2
)"""


DOCS_KEYED = f"""
dk AS (
  SELECT *, {TEXT_KEY} AS key
  FROM (SELECT doc_id AS id, text AS entity, lang, source FROM documents)
)"""


def md5_bit_sql(s: str, nbits: int) -> str:
    return f"CAST(('0x' || substr(md5({s}), 1, 8))::UBIGINT % {nbits} AS INTEGER)"


def word_bits_sql(src: str, name: str, n_lo: int, n_hi: int, nbits: int = 2048) -> str:
    """CTE ``name``(id, bit): distinct bits of word n-grams of ``src.key``."""
    parts = []
    for n in range(n_lo, n_hi + 1):
        parts.append(f"""SELECT id, array_to_string(words[i:i+{n - 1}], ' ') AS s
      FROM (SELECT id, words, unnest(range(1, len(words) - {n} + 2)) AS i FROM {name}_w)""")
    return f"""
{name}_w AS (SELECT id, list_filter(string_split(key, ' '), lambda x: length(x) > 0) AS words
             FROM {src} WHERE key IS NOT NULL),
{name}_s AS ({" UNION ALL ".join(parts)}),
{name} AS (SELECT DISTINCT id, {md5_bit_sql("s", nbits)} AS bit FROM {name}_s)"""


def char_bits_sql(src: str, name: str, k_lo: int, k_hi: int, nbits: int = 2048) -> str:
    parts = []
    for k in range(k_lo, k_hi + 1):
        parts.append(f"""SELECT id, substr(key, i, {k}) AS s
      FROM (SELECT id, key, unnest(range(1, length(key) - {k} + 2)) AS i FROM {src}
            WHERE key IS NOT NULL)""")
    return f"""
{name}_s AS ({" UNION ALL ".join(parts)}),
{name} AS (SELECT DISTINCT id, {md5_bit_sql("s", nbits)} AS bit FROM {name}_s)"""


def strat_split_sql(src: str, name: str, test_size: float = 0.2, seed: int = 42) -> str:
    """CTE ``name``(id, split) over ``src``(id, label): per-class quota by
    largest remainder; first rows in seeded md5 order go to test."""
    return f"""
{name}_h AS (SELECT id, label,
   ('0x' || substr(md5('{seed}|' || CAST(id AS VARCHAR)), 1, 15))::UBIGINT AS h FROM {src}),
{name}_c AS (SELECT label, count(*) AS n_c FROM {src} GROUP BY label),
{name}_t AS (SELECT CAST(sum(n_c) AS DOUBLE) AS n,
   CAST(ceil(CAST({test_size} AS DOUBLE) * sum(n_c)) AS BIGINT) AS nt FROM {name}_c),
{name}_q0 AS (SELECT label, CAST(n_c * nt AS DOUBLE) / n AS cont FROM {name}_c, {name}_t),
{name}_q1 AS (SELECT label, floor(cont) AS fl, cont - floor(cont) AS rem FROM {name}_q0),
{name}_q AS (SELECT label, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, label)
      <= (SELECT nt FROM {name}_t) - sum(fl) OVER () THEN 1 ELSE 0 END AS quota FROM {name}_q1),
{name}_r AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY h, id) AS rn
   FROM {name}_h),
{name} AS (SELECT r.id, r.label, CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS split
   FROM {name}_r r JOIN {name}_q USING (label))"""
