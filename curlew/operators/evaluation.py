"""The evaluation run: every feature family under every model, fold by fold.

The run is a table of cells (Descriptor, Model, Repeat, Fold). Requested cells of families
and models that are not available are left out (semi joins). Finished cells stand in a
result table on shared storage; a run takes the cells that are not in it (left anti join),
works pair by pair, and appends a pair's folds when they are done. A run that was stopped
therefore goes on where it was when it is started again with the same table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.operators import metrics as M
from curlew.operators import models as MD
from curlew.sources.io import path_exists

CELL = ["Descriptor", "Model", "Repeat", "Fold"]
RESULT = CELL + ["status", "error", "tp", "fp", "tn", "fn"] + M.METRICS


def requested_cells(spark: SparkSession, descriptors: list[str], models: list[str], folds: DataFrame) -> DataFrame:
    """Descriptor, Model, Repeat, Fold: all combinations (names x names x folds)."""
    names = spark.createDataFrame([(d, m) for d in descriptors for m in models], "Descriptor string, Model string")
    tags = folds.select(F.col("Repeat").cast("int").alias("Repeat"), F.col("Fold").cast("int").alias("Fold")).distinct()
    return names.crossJoin(F.broadcast(tags))  # repeats x folds rows


def available(cells: DataFrame, families: dict[str, DataFrame], models: list[str]) -> DataFrame:
    spark = cells.sparkSession
    have = spark.createDataFrame([(d,) for d in families], "Descriptor string")
    known = spark.createDataFrame([(m,) for m in models if m in MD.DEFAULTS], "Model string")
    return cells.join(F.broadcast(have), "Descriptor", "left_semi").join(F.broadcast(known), "Model", "left_semi")


def finished(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{c} {'string' if c in ('Descriptor', 'Model', 'status', 'error') else 'int' if c in ('Repeat', 'Fold') else 'long' if c in ('tp', 'fp', 'tn', 'fn') else 'double'}" for c in RESULT)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def evaluation_grid(families: dict[str, DataFrame], models: list[str], folds: DataFrame, path: str,
                    descriptors: list[str] | None = None, tuned: dict[tuple[str, str], dict] | None = None,
                    id_col: str = "id", label: str = "label") -> DataFrame:
    """The result table (a row for each cell) after every missing cell of the run is done.
    ``families`` gives (id, label, bits or features) for each family; ``descriptors`` are the
    families asked for (all, if null); ``tuned`` overrides the default parameters of a
    (family, model). Folds are (id, Repeat, Fold); a fold that cannot be fitted is finished
    too, with status ``failed``."""
    spark = folds.sparkSession
    cells = available(requested_cells(spark, descriptors or sorted(families), models, folds), families, models)
    missing = cells.join(finished(spark, path).select(*CELL), CELL, "left_anti")
    todo = missing.groupBy("Descriptor", "Model").agg(F.count(F.lit(1)).alias("n")).orderBy("Descriptor", "Model").collect()
    for r in todo:  # families x models rows
        d, m = r["Descriptor"], r["Model"]
        _, found = MD.repeated_cv(families[d], folds, m, (tuned or {}).get((d, m)), d, id_col, label)
        mine = missing.where((F.col("Descriptor") == d) & (F.col("Model") == m)).select(*CELL)
        found.join(F.broadcast(mine), CELL, "left_semi").select(*RESULT).coalesce(1).write.mode("append").parquet(path)
    return finished(spark, path).join(cells, CELL, "left_semi")
