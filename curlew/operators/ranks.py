"""Mid-ranks of many columns at once, and the rank correlation of all pairs of them.

Values are counted per column first, so the ranks are prefix sums over distinct values: range
partitions of (column, value), a running count inside each, and the running total of the
partitions before it. No column is sorted by one task. Ranks go back to the cells by value: the
values that hold a large share of all cells by broadcast (at most ``HOT`` of them, by their
count), the others by a shuffle whose keys are then all small. The products of all pairs are
summed by each task over its own rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curlew.session import cut_lineage

#: Values with more cells than (all cells / HOT) are hot, so fewer than HOT values are.
HOT = 100_000
#: Rows whose cells lie together in a shuffle.
ROW_BLOCK = 1024

_PRODUCTS = pa.schema([("i", pa.int32()), ("g", pa.list_(pa.float64()))])


def value_ranks(cells: DataFrame) -> DataFrame:
    """(j, v, n, r): the mid-rank of each value v of each column j of ``cells`` (j, v), and its count."""
    counts = cells.groupBy("j", "v").agg(F.count(F.lit(1)).alias("n"))
    ranged = cut_lineage(counts.repartitionByRange("j", "v").withColumn("p", F.spark_partition_id()))
    per = ranged.groupBy("j", "p").agg(F.sum("n").alias("c"))
    # at most a row for each range and one more for each column
    before = per.select("j", "p", (F.sum("c").over(Window.partitionBy("j").orderBy("p")) - F.col("c")).alias("before"))
    upto = F.sum("n").over(Window.partitionBy("j", "p").orderBy("v"))
    return ranged.withColumn("upto", upto).join(F.broadcast(before), ["j", "p"]).select(
        "j", "v", "n", (F.col("before") + F.col("upto") - (F.col("n") - 1) / 2).alias("r"))


def mid_ranks(cells: DataFrame, total: int) -> DataFrame:
    """(rid, j, r): the mid-rank of each of the ``total`` cells (rid, j, v) in its column."""
    ranks = cut_lineage(value_ranks(cells))
    limit = total // HOT
    hot = ranks.filter(F.col("n") > limit).select("j", "v", "r")
    met = cells.join(F.broadcast(hot), ["j", "v"], "left")
    rest = met.filter(F.col("r").isNull()).drop("r").join(ranks.filter(F.col("n") <= limit), ["j", "v"])
    return met.filter(F.col("r").isNotNull()).select("rid", "j", "r").unionByName(rest.select("rid", "j", "r"))


def _products(width: int, centre: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of products over whole rows; cells come in order of row and column."""
        gram = np.zeros((width, width))
        held = np.empty(0)
        for batch in batches:
            held = np.concatenate([held, batch.column(0).to_numpy() - centre])
            whole = len(held) // width * width
            x = held[:whole].reshape(-1, width)
            gram += x.T @ x
            held = held[whole:]
        if len(held):
            raise ValueError("a row has a null cell")
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(list(gram), _PRODUCTS.field("g").type)], schema=_PRODUCTS)
    return run


def spearman_matrix(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Spearman correlations (columns x columns) of double columns without nulls; NaN for a
    constant column or an empty table. Only this matrix reaches the driver."""
    k = len(cols)
    rows = cut_lineage(df.select(F.monotonically_increasing_id().alias("rid"), F.array(*[F.col(c).cast("double") for c in cols]).alias("x")))
    n = rows.count()
    if n == 0:
        return np.full((k, k), np.nan)
    cells = rows.select("rid", F.posexplode("x").alias("j", "v"))
    ranked = mid_ranks(cells, n * k)
    # all cells of a row meet in one partition, in order
    placed = ranked.withColumn("b", F.floor(F.col("rid") / ROW_BLOCK)).repartition("b").sortWithinPartitions("rid", "j").select("r")
    parts = placed.mapInArrow(_products(k, (n + 1) / 2), "i int, g array<double>")
    total = parts.select("i", F.posexplode("g").alias("j", "g")).groupBy("i", "j").agg(F.sum("g").alias("g")).collect()
    gram = np.zeros((k, k))
    for r in total:
        gram[r["i"], r["j"]] = r["g"]
    spread = np.sqrt(np.diag(gram))
    with np.errstate(divide="ignore", invalid="ignore"):
        return gram / np.outer(spread, spread)
