"""Sinks and sources: split and result tables, result readers with column
checks, hyperparameter tables, a row-granular feature store, model saving,
and external metric tables. Paths may be any Hadoop-compatible URI."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.sources.tables import SchemaError, require_columns


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the path's Hadoop file system; its failures raise."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def write_split(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Train and test rows in one table partitioned by ``split``."""
    df.write.mode("overwrite").partitionBy("split").format(fmt).save(path)


def write_results(tables: dict[str, DataFrame], base: str, fmt: str = "parquet") -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").format(fmt).save(f"{base.rstrip('/')}/{name}")


def read_results(spark: SparkSession, path: str, metric: str | None = None,
                 fmt: str = "parquet") -> DataFrame:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"results table not found: {path}")
    df = spark.read.format(fmt).load(path)
    need = ["Descriptor", "Model"] + ([metric] if metric else [])
    return require_columns(df, need, f"results {path}")


PARAMS_SCHEMA = "descriptor string, model string, params map<string,string>"


def write_params(df: DataFrame, path: str) -> None:
    df.select("descriptor", "model", "params").write.mode("overwrite").json(path)


def read_params(spark: SparkSession, path: str) -> DataFrame:
    """Missing table -> empty table (defaults are used)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], PARAMS_SCHEMA)
    return spark.read.schema(PARAMS_SCHEMA).json(path)


def params_key(params: dict) -> str:
    return json.dumps({k: params[k] for k in sorted(params)}, separators=(",", ":"))


def feature_store_upsert(spark: SparkSession, store: str, df: DataFrame, descriptor: str,
                         params: dict, key: str = "key", feature: str = "bits", build=None) -> int:
    """Append features of entities not yet stored for (descriptor, params).
    Row key = md5(entity key); new rows are found by a left-anti join. With
    ``build`` (DataFrame -> DataFrame with ``feature``) ``df`` needs the key
    alone, and only the entities that are not stored are featurised; without it
    ``df`` has the feature already. Returns rows appended."""
    ph = params_key(params)
    new = df.withColumn("entity_hash", F.md5(F.col(key))).dropDuplicates(["entity_hash"])
    if path_exists(spark, store):
        have = spark.read.parquet(store).filter(
            (F.col("descriptor") == descriptor) & (F.col("param_key") == ph)).select("entity_hash")
        new = new.join(have, "entity_hash", "left_anti")
    if build is not None:
        new = build(new)
    new = new.select("entity_hash", F.col(feature).alias("value")) \
        .withColumn("param_key", F.lit(ph)).withColumn("descriptor", F.lit(descriptor))
    new = new.cache()
    n = new.count()
    if n:
        new.write.mode("append").partitionBy("descriptor").parquet(store)
    new.unpersist()
    return n


def feature_store_read(spark: SparkSession, store: str, descriptor: str, params: dict) -> DataFrame:
    return spark.read.parquet(store).filter(
        (F.col("descriptor") == descriptor) & (F.col("param_key") == params_key(params)))


def feature_store_info(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(store).groupBy("descriptor").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.size("value")).alias("max_width"))


def feature_store_clear(spark: SparkSession, store: str, descriptor: str | None = None) -> None:
    """Delete the whole store or one descriptor partition."""
    jvm = spark._jvm
    target = store if descriptor is None else f"{store.rstrip('/')}/descriptor={descriptor}"
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


def save_model(model, path: str, metadata: dict) -> None:
    """Fitted Spark ML model + one-row metadata table (JSON)."""
    model.write().overwrite().save(f"{path.rstrip('/')}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(metadata, sort_keys=True),)], "metadata string") \
        .write.mode("overwrite").json(f"{path.rstrip('/')}/metadata")


def load_external_metrics(df: DataFrame, name: str, metrics: list[str]) -> DataFrame:
    """One row of an external metric table: the row whose ``Method`` equals
    ``name``, else whose ``Descriptor_Model`` equals it, else the first row
    (by Descriptor, Model / Method order). Missing metric columns -> 0.0."""
    if "Method" in df.columns:
        label, order = F.col("Method"), [F.col("Method")]
    elif "Descriptor" in df.columns and "Model" in df.columns:
        label = F.concat_ws("_", "Descriptor", "Model")
        order = [F.col("Descriptor"), F.col("Model")]
    else:
        raise SchemaError("external metrics need Method or Descriptor and Model")
    cols = [F.coalesce(F.col(m).cast("double"), F.lit(0.0)).alias(m) if m in df.columns
            else F.lit(0.0).alias(m) for m in metrics]
    ranked = df.select(label.alias("name"), *order, *cols) \
        .withColumn("__hit", (F.col("name") == name).cast("int"))
    return ranked.orderBy(F.col("__hit").desc(), *order).limit(1).select("name", *metrics)
