"""Sharding by Karmarkar-Karp differencing: shards of near-equal bytes out of groups that
must not be cut.

A partial partition is a list of ``shards`` lanes, each a set of groups with its bytes.
At first every group is a partial partition of its own. The two with the largest spread
(largest lane less smallest) are combined, the one's largest lane with the other's
smallest, again and again, until one is left: its lanes are the shards.

Differencing is sequential, so it runs in rounds of bounded tasks. While more than
``TASK_ITEMS`` items are left, they are dealt by hash to tasks of at most about that
many; each task differences its own, and each of its lanes goes on as one item. Two
kinds of items skip the round: those that are large against a shard, which the lanes of
later rounds must be laid around, and a share of the small ones, which level the last
differences. The last round is one task of at most ``TASK_ITEMS`` items. An item's shard
follows by joins from the last round back to the first.

Defined results: rows of equal texts are one group; null and empty texts have no bytes
and are equal; every row counts one byte more than its text; rows that repeat an id, or
have none, are rows of their own; slots run from 0 in each shard by id (nulls first), then
by text digest; a group larger than a shard's share fills its shard alone; an empty table
gives an empty result. Extra columns are ignored by ``assign`` and kept by ``write_shards``.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curlew.llm.common import fresh, placed, stored

SHARDS = 16
#: Items that one task differences.
TASK_ITEMS = 20_000
#: Items above a shard's share divided by this skip the rounds: at most SHARDS * LARGE, and a quarter of a task.
LARGE = 64
#: Groups of more than this share of all rows (so at most 1,024 of them) get their shard by broadcast.
HOT = 1024


def differenced(sizes: list[int], shards: int) -> list[int]:
    """The lane of each item; lane 0 is the largest. Items are taken in the order of
    size, equal ones in the order given."""
    n = len(sizes)
    after, lane = [-1] * n, [0] * n
    # a lane is (bytes, first item, last item); items of a lane are chained; empty lanes are left out
    heap = [(-size, i, [(size, i, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        one, other = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        first = shards - len(other)  # the lane of ``one`` that meets the largest lane of ``other`` that has a partner
        lanes = one[:first] if first < len(one) else list(one)
        met = len(one) - first
        for k in range(max(0, met)):
            a, b = one[first + k], other[len(other) - 1 - k]
            after[a[2]] = b[1]
            lanes.append((a[0] + b[0], a[1], b[2]))
        lanes += other[:len(other) - max(0, met)]
        lanes.sort(key=lambda x: -x[0])
        low = lanes[-1][0] if len(lanes) == shards else 0
        heapq.heappush(heap, (low - lanes[0][0], made, lanes))
        made += 1
    for k, (_, at, _) in enumerate(heap[0][2] if heap else []):
        while at >= 0:
            lane[at] = k
            at = after[at]
    return lane


def _lanes(shards: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("item", "ascending")])
        lane = differenced(table["size"].to_pylist(), shards)
        return pa.table([table["item"], table["size"], table["bucket"], pa.array(lane, pa.int32())], ["item", "size", "bucket", "lane"])
    return run


_LANES = "item string, size long, bucket long, lane int"


def deal(groups: DataFrame, shards: int = SHARDS, task_items: int = TASK_ITEMS) -> DataFrame:
    """item, shard of the groups (item string, size long)."""
    if task_items < 8 * shards:
        raise ValueError("a task must hold at least eight items for each shard")
    items, rounds = stored(groups.select("item", "size"), "shard-items"), []
    while (n := items.count()) > task_items:
        total = items.agg(F.sum("size")).first()[0]
        buckets = -(-n // task_items)
        slot = F.pmod(F.xxhash64("item", F.lit(len(rounds))), F.lit(2 * buckets))
        large = max(total // (shards * LARGE), 4 * total // task_items)
        skips = (F.col("size") > F.lit(large)) | (slot == 0)
        some = items.where(~skips).withColumn("bucket", F.floor(slot / 2).cast("long"))
        held = stored(some.groupBy("bucket").applyInArrow(_lanes(shards), _LANES).withColumn("lane", F.concat_ws("/", F.lit(f"r{len(rounds)}"), "bucket", "lane")).select("item", "size", "lane"), "shard-lanes")
        rounds.append(held)
        merged = held.groupBy("lane").agg(F.sum("size").alias("size")).select(F.col("lane").alias("item"), "size")
        items = stored(items.where(skips).unionByName(merged), "shard-items")
    last = items.withColumn("bucket", F.lit(0).cast("long")).groupBy("bucket").applyInArrow(_lanes(shards), _LANES)
    dealt = stored(last.select("item", F.col("lane").alias("shard")), "shard-dealt")
    for held in reversed(rounds):
        inner = held.select("item", "lane").join(dealt.select(F.col("item").alias("lane"), "shard"), "lane").select("item", "shard")
        names = dealt.join(held.select(F.col("lane").alias("item")).distinct(), "item", "left_anti")
        dealt = stored(names.unionByName(inner), "shard-dealt")
    return dealt


def _bytes(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def group_key(text: Column) -> Column:
    """Equal texts have equal keys: length and 128-bit digest."""
    return F.concat_ws(":", F.octet_length(_bytes(text)), F.md5(_bytes(text)))


def _with_shard(rows: DataFrame, item: str, shards: int, task_items: int) -> DataFrame:
    """``rows`` (with column ``item`` and a column ``size``) and their shard."""
    groups = stored(rows.groupBy(F.col(item).alias("item")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("c")), "shard-groups")
    total = groups.agg(F.sum("c")).first()[0] or 0
    dealt = deal(groups, shards, task_items).withColumnRenamed("item", "_item")
    hot = groups.where(F.col("c") > max(1, total // HOT)).select(F.col("item").alias("_item"))
    hot = stored(dealt.join(hot, "_item"), "shard-hot")
    # the rows of a hot group stay where they are; the others meet their shards by key
    marked = rows.join(F.broadcast(hot.withColumnRenamed("shard", "_hot")), F.col(item) == F.col("_item"), "left").drop("_item")
    of_hot = marked.where(F.col("_hot").isNotNull()).withColumnRenamed("_hot", "shard")
    of_rest = marked.where(F.col("_hot").isNull()).drop("_hot").join(dealt, F.col(item) == F.col("_item")).drop("_item")
    return of_hot.unionByName(of_rest)


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", task_items: int = TASK_ITEMS) -> DataFrame:
    """id, size, text_crc32, group, shard, slot: a row for each row of ``docs``."""
    text = F.col(text_col)
    rows = stored(docs.select(F.col(id_col), (F.octet_length(_bytes(text)) + F.lit(1)).cast("long").alias("size"), F.crc32(_bytes(text)).alias("text_crc32"), group_key(text).alias("group")), "shard-rows")
    found = _with_shard(rows, "group", shards, task_items)
    return placed(found, "shard", [F.col(id_col).asc_nulls_first(), F.col("group")], "slot", "shard_rows", "shard-slots")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, text_col: str = "text", task_items: int = TASK_ITEMS) -> None:
    """Write ``docs`` as Parquet, a folder for each shard (column ``shard``)."""
    item, size = fresh(docs, "shard_item"), fresh(docs, "size")
    rows = docs.withColumn(item, group_key(F.col(text_col)))
    keyed = rows.withColumn(size, (F.octet_length(_bytes(F.col(text_col))) + 1).cast("long"))
    shard = fresh(docs, "shard")
    small = stored(keyed.select(F.col(item).alias("item"), F.col(size).alias("size")).groupBy("item").agg(F.sum("size").alias("size")), "shard-groups")
    dealt = deal(small, shards, task_items).select(F.col("item").alias(item), F.col("shard").alias(shard))
    rows.join(dealt, item).drop(item).write.partitionBy(shard).parquet(path)
