"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curlew.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage, survives lost executors, and gives Spark the real
    size of what follows."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few(batch, column: int, limit: int = 1 << 20):
    """Slices of an Arrow batch whose texts are at most ``limit`` bytes together (or one text)."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size.astype(np.int64) + 64)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def releasing(task):
    """A task over Arrow batches that gives its memory back at its end: Python workers live
    on, and idle beside the stages that follow."""
    @functools.wraps(task)
    def run(batches, *args):
        yield from task(batches, *args)
        gc.collect()
        pa.default_memory_pool().release_unused()
        libc = ctypes.CDLL(None)
        if hasattr(libc, "malloc_trim"):
            libc.malloc_trim(0)
    return run


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores appended until no column of ``df`` has it
    (columns are matched without regard to case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def seeded_hash(seed: int, *cols: Column) -> Column:
    """60 bits of md5 over the seed and the columns (nulls as a mark), the same
    in every SQL engine that has md5."""
    parts = [F.lit(str(seed))] + [F.coalesce(c.cast("string"), F.lit("~")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")


def ordered_position(df: DataFrame, order: list[Column], out: str, name: str) -> DataFrame:
    """0-based position of each row in the global order, without a one-task
    window: range partitions, a row number inside each, and the running count of
    the partitions before it (one row a partition)."""
    pid = fresh(df, "_pid")
    ranged = stored(df.repartitionByRange(*order).withColumn(pid, F.spark_partition_id()), name)
    starts = ranged.groupBy(pid).agg(F.count(F.lit(1)).alias("_n")).select(
        pid, (F.sum("_n").over(Window.orderBy(pid)) - F.col("_n")).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(pid).orderBy(*order)) - 1
    return (ranged.withColumn(out, inside).join(starts, pid)
            .withColumn(out, (F.col(out) + F.col("_start")).cast("long")).drop(pid, "_start"))


def placed(df: DataFrame, group: str, order: list[Column], pos: str, total: str, name: str) -> DataFrame:
    """``df`` with the 0-based position of each row in the order of its group (column
    ``pos``) and the number of the group's rows (column ``total``). Rows are dealt to
    ranges by group, order and a salt, so a group, or a run of equal rows, may lie in
    many ranges; per range and group one count meets the others."""
    pid, salt = fresh(df, "_pid"), fresh(df, "_salt")
    keys = [F.col(group), *order, F.col(salt)]
    ranged = stored(df.withColumn(salt, F.rand(17)).repartitionByRange(*keys).withColumn(pid, F.spark_partition_id()), name)
    per = ranged.groupBy(group, pid).agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy(group)
    per = per.select(F.col(group).alias("_g"), F.col(pid).alias("_p"), (F.sum("_c").over(whole.orderBy(pid)) - F.col("_c")).alias("_before"), F.sum("_c").over(whole).alias("_all"))
    inside = ranged.withColumn(pos, F.row_number().over(Window.partitionBy(pid, group).orderBy(*order, salt)) - 1)
    joined = inside.join(per, (F.col(pid) == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    return joined.withColumn(pos, (F.col(pos) + F.col("_before")).cast("long")).withColumn(total, F.col("_all").cast("long")).select(*df.columns, pos, total)
