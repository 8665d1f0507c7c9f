"""Approximate nearest neighbours with a hierarchical k-means tree.

A tree of centroids is trained on at most ``max_sample`` vectors (by hash of the
id; this and the tree, at most ``max_leaves`` leaves, are all that the driver
holds). Every vector of the table goes to the leaf that it reaches by the nearest
child at each node; a leaf's vectors lie in buckets of about ``bucket_rows``, so a
leaf that holds a third of all rows (copies) is many groups. A query runs down the
tree best-bin-first: a priority queue holds the branches not taken by their
distance, and gives leaves in that order.

How many leaves a query visits is calibrated: for ``n_calibrate`` vectors the exact
neighbours are found by brute force over all rows, and the visits widen until the
leaves visited hold ``recall`` of them. A query also goes on until its leaves hold
enough candidates. Within a bucket all distances are found in double precision;
only a shortlist whose margin covers rounding is computed again as the root of the
summed squared differences, which is the score returned.

Defined results: vectors that are null, zero, or hold a null or non-finite
component, and vectors of another length than most of the sample, take no part;
ties go to the smaller id; with fewer candidates than k all are returned; rows
that repeat an id are candidates each, but never for their own id; empty tables
give empty results. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curlew.llm.common import stored


@dataclass
class Tree:
    """Nodes by number: 0 is the root. A leaf has no children and a leaf number."""

    children: list[list[int]] = field(default_factory=list)
    centers: list[np.ndarray | None] = field(default_factory=list)  # of the children
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros(len(vectors), np.int32)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            near = _square(vectors[rows], self.centers[node]).argmin(axis=1)
            todo += [(child, rows[near == k]) for k, child in enumerate(self.children[node]) if (near == k).any()]
        return out

    def best_bins(self, query: np.ndarray):
        """Leaves, nearest branch first."""
        queue, tie = [(0.0, 0, 0)], 0
        while queue:
            _, _, node = heapq.heappop(queue)
            while self.children[node]:
                far = ((self.centers[node] - query) ** 2).sum(axis=1)
                order = far.argsort(kind="stable")
                for k in order[1:]:
                    tie += 1
                    heapq.heappush(queue, (float(far[k]), tie, self.children[node][k]))
                node = self.children[node][order[0]]
            yield self.leaf[node]


def _square(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centers = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _square(x, centers).argmin(axis=1)
        for j in range(k):
            own = x[near == j]
            centers[j] = own.mean(axis=0) if len(own) else x[rng.integers(len(x))]
    return centers, _square(x, centers).argmin(axis=1)


def train(sample: np.ndarray, leaf_rows: int, branch: int = 8, seed: int = 3) -> Tree:
    """Splits the sample until nodes hold at most ``leaf_rows`` vectors or equal ones."""
    rng, tree = np.random.default_rng(seed), Tree()

    def grow(x: np.ndarray) -> int:
        node = len(tree.children)
        tree.children.append([])
        tree.centers.append(None)
        tree.leaf.append(-1)
        parts = []
        if len(x) > leaf_rows and np.ptp(x, axis=0).max() > 0:
            k = min(branch, -(-len(x) // max(1, leaf_rows)) + 1)
            centers, near = _kmeans(x, max(2, k), rng)
            parts = [(centers[j], x[near == j]) for j in range(len(centers)) if (near == j).any()]
        if len(parts) < 2:
            tree.leaf[node], tree.leaves = tree.leaves, tree.leaves + 1
            return node
        tree.centers[node] = np.array([c for c, _ in parts])
        tree.children[node] = [grow(p) for _, p in parts]
        return node

    grow(sample)
    return tree


def valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, v (array of double): the vectors that take part."""
    v = F.col("v")
    fine = F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).where(fine)


def _matrix(column) -> np.ndarray:
    """An Arrow list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def nearest(ids: np.ndarray, vectors: np.ndarray, squares: np.ndarray, qid: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and exact distances of the k nearest other rows, ties to the smaller id."""
    rough = squares - 2 * (vectors @ q) + q @ q
    others = np.flatnonzero(ids != qid)
    if len(others) > k:
        limit = np.partition(rough[others], k - 1)[k - 1]
        others = others[rough[others] <= limit + 1e-9 * (q @ q + squares.max())]
    exact = np.sqrt(((vectors[others] - q) ** 2).sum(axis=1))
    order = np.lexsort((ids[others], exact))[:k]
    return others[order], exact[order]


_FOUND = "query_id long, vec_id long, score double"


def _found(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> dict[str, np.ndarray]:
    return {"query_id": np.concatenate([np.full(len(i), q, np.int64) for q, i, _ in rows] or [np.zeros(0, np.int64)]),
            "vec_id": np.concatenate([i for _, i, _ in rows] or [np.zeros(0, np.int64)]),
            "score": np.concatenate([s for *_, s in rows] or [np.zeros(0)])}


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(rows: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """Exact neighbours of a bounded list of queries: each batch of rows keeps its k nearest to each query."""
    qid, q = np.array([x[0] for x in queries], np.int64), np.array([x[1] for x in queries], np.float64)
    shared = rows.sparkSession.sparkContext.broadcast((qid, q))

    def run(batches):
        qid, q = shared.value
        for batch in batches:
            ids, v = batch.column(0).to_numpy(), _matrix(batch.column(1))
            out = []
            if len(ids):
                squares = (v * v).sum(axis=1)
                for a, b in zip(qid, q, strict=True):
                    at, far = nearest(ids, v, squares, a, b, k)
                    out.append((a, ids[at], far))
            yield pa.RecordBatch.from_pydict(_found(out))

    return _ranked(rows.mapInArrow(run, _FOUND), k)


@dataclass
class Fitted:
    tree: Tree
    index: DataFrame  # leaf, vec_id, v
    counts: dict[int, int]  # by leaf
    visits: int
    dim: int


def fit(vectors: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", max_sample: int = 50_000, leaf_target: int = 400,
        max_leaves: int = 4096, recall: float = 0.97, n_calibrate: int = 200) -> Fitted | None:
    """The tree, every vector in its leaf, and the calibrated number of visits; None for an empty table."""
    rows = stored(valid(vectors, id_col, vec_col), "ann-rows")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max_sample).toPandas()
    if not len(sample):
        return None
    dim = int(sample["v"].map(len).mode()[0])
    sample = np.stack([np.asarray(v) for v in sample["v"] if len(v) == dim])
    rows = rows.where(F.size("v") == dim)
    total = rows.count()
    leaves = min(max_leaves, max(1, total // leaf_target), max(1, len(sample) // 8))
    tree = train(sample, max(1, len(sample) // leaves))
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def place(batches):
        for batch in batches:
            leaf = shared.value.assign(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), *batch.columns], ["leaf", "vec_id", "v"])

    index = stored(rows.mapInArrow(place, "leaf int, vec_id long, v array<double>"), "ann-index")
    counts = {r[0]: r[1] for r in index.groupBy("leaf").agg(F.count(F.lit(1))).collect()}
    chosen = [(r[0], list(r[1])) for r in rows.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(n_calibrate).collect()]
    truth = brute_force(rows, chosen, k).select("query_id", "vec_id").join(index.select("vec_id", "leaf"), "vec_id").groupBy("query_id", "leaf").agg(F.countDistinct("vec_id")).collect()
    wanted: dict[int, list[tuple[int, int]]] = {}
    for qid, leaf, n in truth:
        wanted.setdefault(qid, []).append((leaf, n))
    gained = np.zeros(tree.leaves + 1)
    for qid, q in chosen:
        place_of = {leaf: n for n, leaf in enumerate(tree.best_bins(np.array(q)))}
        for leaf, n in wanted.get(qid, ()):
            gained[place_of[leaf]] += n
    share = gained.cumsum() / max(1, gained.sum())
    return Fitted(tree, index, counts, int(np.argmax(share >= min(recall, share[-1]))) + 1, dim)


def search(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", bucket_rows: int = 20_000,
           group_queries: int = 1_000, **how) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found. ``is_query`` is a condition on ``vec_id``."""
    spark = vectors.sparkSession
    fitted = fit(vectors, k, id_col, vec_col, **how)
    if fitted is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast((fitted.tree, fitted.counts, fitted.visits))

    def route(batches):
        tree, counts, visits = shared.value
        for batch in batches:
            at, leaves = [], []
            for i, q in enumerate(_matrix(batch.column(1)) if batch.num_rows else ()):
                held = 0
                for n, leaf in enumerate(tree.best_bins(q)):
                    # rows of the query's own id may fill some places
                    if n >= visits and held > 2 * k:
                        break
                    if counts.get(leaf):
                        at.append(i)
                        leaves.append(leaf)
                        held += counts[leaf]
            picked = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.int32()), *picked.columns], ["leaf", "query_id", "q"])

    queries = fitted.index.where(is_query(F.col("vec_id"))).select("vec_id", "v").dropDuplicates()
    routed = stored(queries.mapInArrow(route, "leaf int, query_id long, q array<double>"), "ann-routes")
    asked = {r[0]: r[1] for r in routed.groupBy("leaf").agg(F.count(F.lit(1))).collect()}
    # each group is one bucket of a leaf and one slot of its queries, both bounded
    buckets = spark.createDataFrame([(leaf, -(-fitted.counts[leaf] // bucket_rows), -(-n // group_queries)) for leaf, n in asked.items()], "leaf int, buckets int, slots int")
    buckets = F.broadcast(buckets)  # one row a leaf, at most max_leaves
    left = fitted.index.join(buckets, "leaf").withColumn("bucket", F.pmod(F.xxhash64("vec_id"), "buckets").cast("int")) \
        .withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1))).select("leaf", "bucket", "slot", "vec_id", "v")
    right = routed.join(buckets, "leaf").withColumn("slot", F.pmod(F.xxhash64("query_id"), "slots").cast("int")) \
        .withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1))).select("leaf", "bucket", "slot", "query_id", "q")

    def near(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows):
            ids, v = rows["vec_id"].to_numpy(), np.stack(rows["v"].to_numpy())
            squares = (v * v).sum(axis=1)
            for qid, q in zip(queries["query_id"], queries["q"], strict=True):
                at, far = nearest(ids, v, squares, qid, np.asarray(q), k)
                out.append((qid, ids[at], far))
        return pd.DataFrame(_found(out))

    key = ["leaf", "bucket", "slot"]
    return _ranked(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(near, _FOUND), k)
