"""Table access: schema-checked loaders for labelled entity tables, and the
stand-in tables built from the shared parquet test data.

Loaders are lazy: the column check reads only the parquet footer, and the
returned DataFrame carries an explicit projection so Catalyst prunes every
other column at the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class SchemaError(ValueError):
    pass


def require_columns(df: DataFrame, cols: list[str], what: str = "input") -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise SchemaError(f"{what}: missing required column(s) {missing}; has {df.columns}")
    return df


ENTITY_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("entity", T.StringType(), True),
    T.StructField("label", T.IntegerType(), True),
])


def load_labelled(spark: SparkSession, path: str, entity_col: str = "SMILES",
                  label_col: str = "CLASS", fmt: str = "csv",
                  id_col: str | None = None) -> DataFrame:
    """Read a labelled entity table (CSV with header, or parquet), check the
    two required columns by exact name before any job, and return
    ``(id, entity, label, <other columns>)``. The label is ``try_cast`` to int
    (unparseable -> null, later removed by ``drop_missing``). ``id`` is the
    given id column or a stable ``monotonically_increasing_id`` (file order)."""
    reader = spark.read
    if fmt == "csv":
        df = reader.option("header", True).option("inferSchema", False).csv(path)
    else:
        df = reader.format(fmt).load(path)
    require_columns(df, [entity_col, label_col], f"labelled table {path}")
    others = [c for c in df.columns if c not in (entity_col, label_col, id_col)]
    idc = F.col(id_col).cast("long") if id_col else F.monotonically_increasing_id()
    return df.select(idc.alias("id"), F.col(entity_col).cast("string").alias("entity"),
                     F.expr(f"try_cast(`{label_col}` as int)").alias("label"), *others)


# ---------------------------------------------------------------------------
# Stand-in tables over the shared test data (FIXTURES.md section 3)
# ---------------------------------------------------------------------------

def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents LEFT JOIN labels: (id, entity, label, lang, source).
    Unlabelled documents keep a null label (exercises ``drop_missing``)."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("entity"), "lang", "source")
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("label"))
    return docs.join(labels, "id", "left")


def lineitem_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a labelled table with conflicts: entity = l_orderkey,
    label = l_linestatus, row order = l_linenumber."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus")


def scored_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored predictions with ties: y = (l_returnflag = 'R'),
    score = l_discount * 10, group = l_linestatus."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_linestatus").alias("grp"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_discount") * 10).alias("score"))


def fold_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows standing for cross-validation predictions: Descriptor =
    l_returnflag, Model = l_linestatus, Repeat = 1 + l_orderkey % 2,
    Fold = 1 + l_linenumber % 5, y = (l_quantity > 25),
    score = (l_discount * 10 + l_quantity / 50) / 2."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("Descriptor"), F.col("l_linestatus").alias("Model"),
        (1 + F.col("l_orderkey") % 2).cast("int").alias("Repeat"),
        (1 + F.col("l_linenumber") % 5).cast("int").alias("Fold"),
        (F.col("l_quantity") > 25).cast("int").alias("y"),
        ((F.col("l_discount") * 10 + F.col("l_quantity") / 50) / 2).alias("score"))


def subject_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced repeated-measures table: Subject = user_id % 25,
    Model = event_type, value = avg(value) per cell (25 x 5 cells)."""
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy((F.col("user_id") % 25).cast("int").alias("Subject"),
                       F.col("event_type").alias("Model"))
              .agg(F.avg("value").alias("value")))
