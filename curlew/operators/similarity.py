"""Tanimoto similarity over bit-set fingerprints: thresholded self-join and
top-N bipartite search, both exact.

Plan: fingerprints are packed (a bit each) and equal ones meet as one class. Classes
are cut into blocks by range of bit count. Each left block goes to one task with a copy
of the right rows that it may meet, which stream past it: tiles of 0/1 float32 rows are
multiplied (counts are exact below 2**24, so a product carries those of two right rows),
and only what counts is kept. A
task holds one packed block and one tile whatever the key distribution, and rows move as
often as there are left blocks. For the thresholded self-join, right rows are those in
whose range the size bound min(|A|, |B|) >= t * max(|A|, |B|) can hold; copies within a
class are joined by their class, never multiplied. For top-N, rows come nearest in bit
count first, and tiles whose counts rule out a better row are skipped. Only block
metadata (one row per block) reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curlew.session import cut_lineage

#: Left blocks that a search is dealt to, where they hold at least ``block_rows`` rows.
BLOCKS = 24
#: Rows of a left block at most (packed: 256 bytes each at 2,048 bits).
MOST_ROWS = 65_536
#: Rows of a tile.
TILE = 2048
#: Rows narrower than this share a lane of a product in twos: float32 holds both counts.
LANE = 4096
#: Stands for a null id within a search: it sorts last.
NO_ID = (1 << 63) - 1


def _width(nbits: int) -> int:
    return -(-nbits // 8)


def _pack(bits: Column, nbits: int) -> Column:
    """Bit positions, as bytes."""

    def pack(lists: pa.Array) -> pa.Array:
        lens = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        m = np.zeros((len(lists), 8 * _width(nbits)), np.uint8)
        m[np.repeat(np.arange(len(lists)), lens), lists.flatten().to_numpy(zero_copy_only=False)] = 1
        return pa.array([r.tobytes() for r in np.packbits(m, axis=1, bitorder="little")], pa.binary())

    return F.arrow_udf(pack, "binary")(bits)


def _rows(fp: DataFrame, id_col: str, bits_col: str, nbits: int) -> DataFrame:
    """(__id, __sig, __n), packed; a null fingerprint counts as empty."""
    none = F.array().cast(fp.schema[bits_col].dataType)
    bits = F.coalesce(F.col(bits_col), none)
    return cut_lineage(fp.select(F.col(id_col).cast("long").alias("__id"), bits.alias("__bits"))
                       .select("__id", _pack(F.col("__bits"), nbits).alias("__sig"), F.size("__bits").alias("__n")))


def _classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with equal fingerprints meet as a class: (__cls, __sig, __n) and (__id, __cls)."""
    classes = rows.select("__sig", "__n").distinct().withColumn("__cls", F.monotonically_increasing_id())
    classes = cut_lineage(classes)
    return classes, cut_lineage(rows.join(classes, ["__sig", "__n"]).select("__id", "__cls"))


def size_blocks(rows: DataFrame, key: str, block_rows: int) -> tuple[DataFrame, list]:
    """Assign ``__blk`` by range of bit count ``__n`` (bands from approximate quantiles),
    splitting crowded bands by hash of ``key``. Returns the rows and the block metadata
    [(blk, lo, hi, rows)] sorted by (lo, blk). The rows are read several times."""
    n = rows.count()
    nb = max(1, math.ceil(n / min(MOST_ROWS, max(block_rows, math.ceil(n / BLOCKS)))))
    each = math.ceil(n / nb)
    if nb == 1:
        df = rows.withColumn("__band", F.lit(0))
    else:
        qs = [k / nb for k in range(1, nb)]
        bounds = sorted(set(rows.agg(F.percentile_approx("__n", qs, 10000)).first()[0]))
        df = rows.withColumn("__band", F.size(F.filter(
            F.array(*[F.lit(int(b)) for b in bounds]), lambda b: b < F.col("__n"))))
    bands = {r[0]: r[1] for r in df.groupBy("__band").count().collect()}
    sub = {b: max(1, round(c / each)) for b, c in bands.items()}
    # block id = offset of the band + hash sub-block (dense numbering)
    offsets, acc = {}, 0
    for b in sorted(sub):
        offsets[b], acc = acc, acc + sub[b]
    off_map = F.create_map(*[x for b in sorted(sub) for x in (F.lit(b), F.lit(offsets[b]))]) if sub else F.create_map().cast("map<int,int>")
    sub_map = F.create_map(*[x for b in sorted(sub) for x in (F.lit(b), F.lit(sub[b]))]) if sub else F.create_map().cast("map<int,int>")
    df = df.withColumn("__blk", (off_map[F.col("__band")] +
                                 F.pmod(F.xxhash64(key), sub_map[F.col("__band")])).cast("int")).drop("__band")
    meta = df.groupBy("__blk").agg(F.min("__n"), F.max("__n"), F.count(F.lit(1))).collect()
    return df, sorted(((r[0], r[1], r[2], r[3]) for r in meta), key=lambda t: (t[1], t[0]))


def _met(left: DataFrame, right: DataFrame, blocks: int, search, schema: str) -> DataFrame:
    """Each left block in one task, followed by its right rows in their order ``__at``:
    both (__blk, __key, __sig, __n), the right ones with ``__at``."""
    both = left.select("__blk", F.lit(0).alias("__side"), F.lit(0.0).alias("__at"), "__key", "__n", "__sig") \
        .unionByName(right.select("__blk", F.lit(1).alias("__side"), F.col("__at").cast("double").alias("__at"), "__key", "__n", "__sig"))
    dealt = both.repartitionById(max(1, blocks), F.col("__blk")).sortWithinPartitions("__blk", "__side", "__at", "__key")
    return dealt.select("__blk", "__side", "__key", "__n", "__sig").mapInArrow(search, schema)


def _runs(batches: Iterator[pa.RecordBatch], width: int):
    """(block, side, keys, sizes, packed rows) of each run of rows of a block and side."""
    for batch in batches:
        if not batch.num_rows:
            continue
        blk, side, key, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        sig = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(-1, width)
        cuts = np.flatnonzero((blk[1:] != blk[:-1]) | (side[1:] != side[:-1])) + 1
        for a, z in zip([0, *cuts], [*cuts, len(blk)]):
            yield int(blk[a]), int(side[a]), key[a:z], n[a:z].astype(np.float32), sig[a:z]


def _dense(sig: np.ndarray) -> np.ndarray:
    return np.unpackbits(sig, axis=1, bitorder="little").astype(np.float32)


def _lanes(dense: np.ndarray) -> np.ndarray:
    """Rows in twos: one of the first half and, LANE times, one of the second."""
    if dense.shape[1] >= LANE:
        return dense
    half = -(-len(dense) // 2)
    out = dense[:half].copy()
    out[:len(dense) - half] += LANE * dense[half:]
    return out


def _inter(left: np.ndarray, lanes: np.ndarray, rows: int) -> np.ndarray:
    """Intersections of dense rows with the ``rows`` of the lanes. Sums stay below LANE
    squared, where float32 holds every integer, so both counts of a lane are exact."""
    both = left @ lanes.T
    if left.shape[1] >= LANE:
        return both
    out = np.empty((len(left), rows), np.float32)
    half = len(lanes)
    second = np.floor(both * np.float32(1 / LANE))
    np.subtract(both, second * np.float32(LANE), out=out[:, :half])
    out[:, half:] = second[:, :rows - half]
    return out


def _tanimoto(inter: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    inter = inter.astype(np.float64)
    return inter / np.maximum(na.astype(np.float64) + nb - inter, 1)


class Block:
    """The rows of a left block, tile by tile."""

    def __init__(self):
        self.blk, self.key, self.n, self.sig = None, [], [], []

    def start(self, blk: int) -> None:
        self.__init__()
        self.blk = blk

    def add(self, key, n, sig) -> None:
        self.key.append(key)
        self.n.append(n)
        self.sig.append(sig)

    def close(self) -> None:
        self.key, self.n, self.sig = (np.concatenate(x) for x in (self.key, self.n, self.sig))

    def tiles(self):
        return [slice(a, a + TILE) for a in range(0, len(self.key), TILE)]


def _pair_search(t: float, nbits: int):
    c = t / (1 + t)  # sim >= t is inter >= c * (|A| + |B|)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, open_ = Block(), False
        for blk, side, key, n, sig in _runs(batches, _width(nbits)):
            if side == 0:
                if blk != block.blk:
                    block.start(blk)
                    open_ = True
                block.add(key, n, sig)
                continue
            if open_:
                order = np.argsort(np.concatenate(block.n), kind="stable")
                block.close()
                block.key, block.n, block.sig = block.key[order], block.n[order], block.sig[order]
                open_ = False
            for a in range(0, len(key), TILE):
                kb, nb, sb = key[a:a + TILE], n[a:a + TILE], sig[a:a + TILE]
                db = None
                for at in block.tiles():
                    ka, na = block.key[at], block.n[at]
                    if t > 0 and (nb.max() < t * na.min() - 1e-3 or na.max() < t * nb.min() - 1e-3):
                        continue
                    db = _lanes(_dense(sb)) if db is None else db
                    inter = _inter(_dense(block.sig[at]), db, len(kb))
                    i, j = np.nonzero(inter >= c * na[:, None] + (c * nb - 1e-2)[None, :])
                    # each pair once: its right row is the later one in (size, key)
                    later = (nb[j] > na[i]) | ((nb[j] == na[i]) & (kb[j] > ka[i]))
                    i, j = i[later], j[later]
                    inter = np.rint(inter[i, j])
                    sim = _tanimoto(inter, na[i], nb[j])
                    keep = sim >= t
                    if keep.any():
                        yield pa.RecordBatch.from_arrays([pa.array(ka[i[keep]]), pa.array(kb[j[keep]]), pa.array(inter[keep].astype(np.int32)), pa.array(sim[keep])], ["cls_a", "cls_b", "inter", "sim"])

    return search


def tanimoto_classes(fp: DataFrame, threshold: float, id_col: str = "id", bits_col: str = "bits",
                     nbits: int = 2048, block_rows: int = 2048) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The pairs between classes of equal fingerprints, each once: (classes, members, pairs)
    of (cls, n), (id, cls) and (cls_a, cls_b, inter, sim). Copies are in the membership
    alone: rows of a class have similarity 1.0, or 0.0 where it is empty (n = 0)."""
    t = float(threshold)
    classes, members = _classes(_rows(fp.where(F.col(id_col).isNotNull()), id_col, bits_col, nbits))
    rows, meta = size_blocks(classes.withColumnRenamed("__cls", "__key"), "__key", block_rows)
    rows = rows.select("__blk", "__key", "__sig", "__n")
    # a right row is of the same size or larger, within the size bound of a block
    spans = fp.sparkSession.createDataFrame([(m[0], m[1], math.floor(m[2] / t + 1e-9) if t > 0 else (1 << 31) - 1) for m in meta], "blk int, lo int, hi int")
    right = rows.drop("__blk").join(F.broadcast(spans), (F.col("__n") >= F.col("lo")) & (F.col("__n") <= F.col("hi"))) \
        .select(F.col("blk").alias("__blk"), "__key", "__sig", "__n", F.col("__n").alias("__at"))
    pairs = _met(rows, right, len(meta), _pair_search(t, nbits), "cls_a long, cls_b long, inter int, sim double")
    return (classes.select(F.col("__cls").alias("cls"), F.col("__n").alias("n")),
            members.select(F.col("__id").alias("id"), F.col("__cls").alias("cls")), pairs)


def tanimoto_pairs(fp: DataFrame, threshold: float, id_col: str = "id", bits_col: str = "bits",
                   nbits: int = 2048, block_rows: int = 2048) -> DataFrame:
    """All pairs (id_a < id_b) with Tanimoto(bits_a, bits_b) >= threshold.
    Two empty fingerprints have similarity 0.0."""
    classes, members, pairs = tanimoto_classes(fp, threshold, id_col, bits_col, nbits, block_rows)
    a, b = members.select(F.col("id").alias("x"), F.col("cls").alias("cls_a")), members.select(F.col("id").alias("y"), F.col("cls").alias("cls_b"))
    ids = [F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "inter", "sim"]
    between = pairs.join(a, "cls_a").join(b, "cls_b").where("x <> y").select(*ids)
    same = classes.select(F.col("cls").alias("cls_a"), F.col("n").alias("inter"), F.when(F.col("n") > 0, 1.0).otherwise(0.0).alias("sim")).where(F.col("sim") >= float(threshold))
    copies = a.join(same, "cls_a").join(b.withColumnRenamed("cls_b", "cls_a"), "cls_a").where("x < y").select(*ids)
    return between.unionByName(copies)


class Nearest:
    """The ``n`` best rows so far for each row of a block, in order of (key, id)."""

    def __init__(self, rows: int, n: int):
        self.n = n
        self.key = np.full((rows, n), np.inf)
        self.id = np.full((rows, n), NO_ID)
        self.inter = np.zeros((rows, n), np.int32)

    def offer(self, i, key, ids, inter) -> None:
        """Candidates of rows ``i``, which ascend."""
        at = np.unique(i)
        r = np.concatenate([np.repeat(at, self.n), i])
        key = np.concatenate([self.key[at].ravel(), key])
        ids = np.concatenate([self.id[at].ravel(), ids])
        inter = np.concatenate([self.inter[at].ravel(), inter])
        order = np.lexsort((ids, key, r))
        r = r[order]
        nth = np.arange(len(r)) - np.searchsorted(r, r)
        order = order[nth < self.n]
        self.key[at], self.id[at], self.inter[at] = (x[order].reshape(len(at), self.n) for x in (key, ids, inter))


def _best_key(na: np.ndarray, nb: np.ndarray, hamming: bool) -> np.ndarray:
    """The least key that a row of ``na`` bits can have with any of ``nb``."""
    sizes = np.unique(nb)
    at = np.searchsorted(sizes, na)
    lower, upper = sizes[np.maximum(at - 1, 0)], sizes[np.minimum(at, len(sizes) - 1)]
    ends = [np.abs(na - x) if hamming else -np.minimum(na, x) / np.maximum(np.maximum(na, x), 1) for x in (lower, upper)]
    return np.minimum(*ends) - (0 if hamming else 1e-6)


def _near_search(n: int, nbits: int, hamming: bool):
    def meet(block: Block, best: Nearest, at: np.ndarray, ids, nb, db) -> None:
        na = block.n[at]
        inter = _inter(_dense(block.sig[at]), db, len(ids))
        last, last_id = best.key[at, -1], best.id[at, -1]
        if hamming:
            near = na[:, None] + nb[None, :] - 2 * inter <= last[:, None].astype(np.float32)
        else:
            # sim >= s is inter >= s / (1 + s) * (|A| + |B|), within rounding; any row is, at s <= 0
            s = np.where(np.isinf(last), -1.0, -last)
            c = (np.maximum(s, 0) / (1 + np.maximum(s, 0))).astype(np.float32)
            near = inter >= c[:, None] * (na[:, None] + nb[None, :]) - np.where(s > 0, 1e-2, 1.0)[:, None].astype(np.float32)
        i, j = np.nonzero(near)
        inter = np.rint(inter[i, j])
        key = (na[i] + nb[j] - 2 * inter).astype(np.float64) if hamming else -_tanimoto(inter, na[i], nb[j])
        better = (key < last[i]) | ((key == last[i]) & (ids[j] < last_id[i]))
        if better.any():
            best.offer(at[i[better]], key[better], ids[j[better]], inter[better].astype(np.int32))

    def found(block: Block, best: Nearest) -> pa.RecordBatch:
        i, r = np.nonzero(np.isfinite(best.key))
        ids, sim = best.id[i, r], best.key[i, r] if hamming else -best.key[i, r] + 0.0
        return pa.RecordBatch.from_arrays([pa.array(block.key[i]), pa.array(ids), pa.array(best.inter[i, r]), pa.array(sim)], ["cls", "tid", "inter", "sim"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best = Block(), None
        for blk, side, ids, nb, sig in _runs(batches, _width(nbits)):
            if side == 0:
                if blk != block.blk:
                    if best is not None:
                        yield found(block, best)
                    block.start(blk)
                    best = None
                block.add(ids, nb, sig)
                continue
            a = 0
            if best is None:
                block.close()
                best, step = Nearest(len(block.key), n), max(64, 2 * n)
            while a < len(ids):
                at_b = slice(a, a + step)
                db = None
                for at in block.tiles():
                    rows = np.arange(*at.indices(len(block.key)))
                    rows = rows[_best_key(block.n[rows], nb[at_b], hamming) <= best.key[rows, -1]]
                    if len(rows):
                        db = _lanes(_dense(sig[at_b])) if db is None else db
                        meet(block, best, rows, ids[at_b], nb[at_b], db)
                a += step
                step = min(TILE, 2 * step)
        if best is not None:
            yield found(block, best)

    return search


def similarity_topn(query: DataFrame, target: DataFrame, n: int = 5, id_col: str = "id",
                    bits_col: str = "bits", nbits: int = 2048, block_rows: int = 2048,
                    metric: str = "tanimoto") -> DataFrame:
    """For each query row, the ``n`` most similar target rows (ties broken by
    smaller target id); fewer when the target has fewer rows. Of targets with equal
    fingerprints, the ``n`` of smallest id take part; equal queries are searched once.
    ``metric="hamming"`` ranks by smallest |A| + |B| - 2|A n B| instead, and
    the ``sim`` column then holds that distance."""
    hamming = metric == "hamming"
    classes, members = _classes(_rows(query, id_col, bits_col, nbits))
    blocks, meta = size_blocks(classes.withColumnRenamed("__cls", "__key"), "__key", block_rows)
    same = Window.partitionBy("__sig", "__n").orderBy("__key")
    rows = _rows(target, id_col, bits_col, nbits).withColumn("__key", F.coalesce("__id", F.lit(NO_ID)))
    rows = cut_lineage(rows.withColumn("__r", F.row_number().over(same)).where(F.col("__r") <= n).select("__key", "__sig", "__n"))
    mid = query.sparkSession.createDataFrame([(m[0], (m[1] + m[2]) / 2) for m in meta], "blk int, mid double")
    right = rows.crossJoin(F.broadcast(mid)).select(F.col("blk").alias("__blk"), "__key", "__sig", "__n", F.abs(F.col("__n") - F.col("mid")).alias("__at"))
    near = _met(blocks, right, len(meta), _near_search(n, nbits, hamming), "cls long, tid long, inter int, sim double")
    found = members.join(near, members["__cls"] == near["cls"]).select(
        F.col("__id").alias("qid"), F.when(F.col("tid") != NO_ID, F.col("tid")).alias("tid"), "inter", "sim")
    first = F.col("sim").asc() if hamming else F.col("sim").desc()
    w = Window.partitionBy("qid").orderBy(first, F.col("tid"))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def similarity_stats(sims: DataFrame, col: str = "sim") -> DataFrame:
    """mean, median (exact; Tanimoto over nbits-wide sets takes at most
    nbits**2 distinct values, so the exact percentile's value map is bounded)
    and max."""
    return sims.agg(F.avg(col).alias("mean_similarity"),
                     F.median(col).alias("median_similarity"),
                     F.max(col).alias("max_similarity"),
                     F.count(col).alias("n"))


def similarity_histogram(sims: DataFrame, col: str = "sim", bins: int = 40) -> DataFrame:
    """Equal-width histogram over the data range: (bin, lo, hi, count).
    Bins with no value are included (count 0)."""
    # values are counted before they are read twice: the search behind them runs once
    counted = cut_lineage(sims.groupBy(col).agg(F.count(F.lit(1)).alias("__n")))
    lohi = counted.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = lohi["lo"], lohi["hi"]
    spark = sims.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, lo double, hi double, count long")
    w = (hi - lo) / bins if hi > lo else 1.0
    idx = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(w)), F.lit(bins - 1)).cast("int")
    counts = counted.groupBy(idx.alias("bin")).agg(F.sum("__n").alias("count"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(w)).alias("lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(w)).alias("hi"),
        F.coalesce("count", F.lit(0)).alias("count"))


def density_curve(values: DataFrame, col: str = "sim", bins: int = 40, points: int = 200,
                  per_bandwidth: int | None = None) -> DataFrame:
    """The curve over a histogram of ``bins`` bins: (point, x, height), a Gaussian kernel sum at
    ``points`` even points from the least to the largest value, in the histogram's counts
    (density x values x bin width). Its bandwidth is the sample deviation times n^(-1/5).

    Values are counted first, so a kernel is taken for a distinct value and not for a row:
    Tanimoto similarities of sets within nbits bits have at most nbits^2 of them. Where values
    may all differ, ``per_bandwidth`` gives the number of grid cells in a bandwidth: each
    value is dealt to the two ends of its cell in linear shares, which moves the curve by at
    most 1 / (8 per_bandwidth^2) of its largest curvature (in bandwidths). A kernel reaches
    nine bandwidths (beyond, it is under 3e-18 of its peak). Nulls are left out; fewer than
    two values, or equal ones, have no curve."""
    spark = values.sparkSession
    counted = cut_lineage(values.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("w")))
    r = counted.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("w").alias("n"), F.sum(F.col("v") * F.col("w")).alias("s")).first()
    if not r["n"] or not r["hi"] > r["lo"]:
        return spark.createDataFrame([], "point int, x double, height double")
    lo, hi, n, mean = r["lo"], r["hi"], r["n"], r["s"] / r["n"]
    squares = counted.agg(F.sum((F.col("v") - mean) * (F.col("v") - mean) * F.col("w"))).first()[0]
    h = math.sqrt(squares / (n - 1)) * n ** -0.2
    if per_bandwidth:
        cell = h / per_bandwidth
        at = (F.col("v") - lo) / cell
        share = at - F.floor(at)
        ends = F.array(F.struct(F.floor(at).alias("c"), ((1 - share) * F.col("w")).alias("w")),
                       F.struct((F.floor(at) + 1).alias("c"), (share * F.col("w")).alias("w")))
        counted = counted.select(F.explode(ends).alias("e")).groupBy("e.c").agg(F.sum("e.w").alias("w")) \
            .select((lo + F.col("c") * cell).alias("v"), "w")
    step = (hi - lo) / (points - 1)
    # a value meets the points within its reach alone
    first = F.greatest(F.lit(0), F.ceil((F.col("v") - 9 * h - lo) / step)).cast("int")
    last = F.least(F.lit(points - 1), F.floor((F.col("v") + 9 * h - lo) / step)).cast("int")
    reached = counted.withColumn("first", first).withColumn("last", last).filter("first <= last") \
        .select("v", "w", F.explode(F.sequence("first", "last")).alias("point"))
    z = (lo + F.col("point") * step - F.col("v")) / h
    scale = (hi - lo) / bins / (h * math.sqrt(2 * math.pi))
    sums = reached.groupBy("point").agg((F.sum(F.col("w") * F.exp(-0.5 * z * z)) * scale).alias("height"))
    grid = spark.range(points).select(F.col("id").cast("int").alias("point"))
    return grid.join(F.broadcast(sums), "point", "left").select(
        "point", (lo + F.col("point") * step).alias("x"), F.coalesce("height", F.lit(0.0)).alias("height"))


def similarity_chart(sims: DataFrame, col: str = "sim", bins: int = 40, points: int = 200) -> DataFrame:
    """All that the chart of the similarities shows, from one run of the search behind them:
    (part, nth, lo, hi, count, height). ``bin`` rows are the histogram, ``curve`` rows the
    density curve over it (lo = hi = x), and ``mean`` and ``median`` the two lines (lo = hi)."""
    values = cut_lineage(sims.select(col))
    none = F.lit(None)
    bar = similarity_histogram(values, col, bins).select(F.lit("bin").alias("part"), F.col("bin").alias("nth"), "lo", "hi", "count", none.cast("double").alias("height"))
    curve = density_curve(values, col, bins, points).select(F.lit("curve"), "point", "x", F.col("x"), none.cast("long"), "height")
    lines = similarity_stats(values, col).select(F.explode(F.array(*[F.struct(F.lit(k).alias("part"), F.col(f"{k}_similarity").alias("x")) for k in ("mean", "median")])).alias("l"))
    lines = lines.where("l.x IS NOT NULL").select("l.part", F.lit(0), "l.x", F.col("l.x"), none.cast("long"), none.cast("double"))
    return bar.union(curve).union(lines)
