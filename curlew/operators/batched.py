"""All folds and trials of a model in the same passes over the rows.

* Bernoulli naive Bayes: the counts of a fold's train rows are those of all rows less
  those of the fold, so one aggregate per (Repeat, Fold, class, bit) serves every fold
  and every smoothing.
* k-NN: one list of neighbours a row, long enough that the rows outside each of its own
  folds hold ``k`` of them (rows whose list is too short are searched again, twice as
  deep), then running votes serve every fold and every k.
* Logistic regression: one column of coefficients for each (Repeat, Fold, trial); a pass
  over the rows gives the losses and gradients of all columns, and each column has a
  quasi-Newton state of its own. It starts from the curvature of all rows at the origin,
  summed once for all columns, which takes a tenth of the passes. Tables below ``LOCAL_BYTES`` are broadcast once and the
  columns are dealt to tasks, which run the same optimiser on their share; larger ones
  stay where they are and every pass is a Spark job that sums partial gradients.

Input: ``data`` (id, label 0/1, bits) or, for logistic regression, (id, label, x) with a
dense ``array<double>``; ``folds`` (id, Repeat, Fold). Each function gives the held-out
scores (trial, id, Repeat, Fold, y, score, pred) of all folds; a fold whose train rows
hold one class only (or fewer than k rows) has no scores, and ``cv_metrics`` reports it
as failed. Null labels take no part. An empty table gives no scores.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curlew.operators import metrics as M
from curlew.operators import similarity as S
from curlew.session import cut_lineage

#: Bytes of a table of rows, as it is sent, up to which it is broadcast.
LOCAL_BYTES = 64 << 20
#: Bytes of coefficients with their quasi-Newton state that the driver, or a task, holds at a time.
STATE_BYTES = 256 << 20
#: Pairs of steps and gradient changes kept for each column.
MEMORY = 10
#: Features up to which their curvature is summed (a matrix of this width squared).
CURVED = 4096
#: Rows of the curvature that are sent together.
CURVED_ROWS = 256
#: Rows of a dense block.
BLOCK_ROWS = 2048
#: Bytes of a model table up to which it is broadcast.
MODEL_BYTES = 64 << 20


# ---------------------------------------------------------------------------
# Bernoulli naive Bayes: complement counts
# ---------------------------------------------------------------------------

def fold_counts(tagged: DataFrame, label: str = "label") -> DataFrame:
    """Repeat, Fold, n0, n1 (rows of the fold), t0, t1 (rows of the other folds)."""
    per = tagged.groupBy("Repeat", "Fold").agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
    all_ = Window.partitionBy("Repeat")
    return per.withColumn("t0", F.sum("n0").over(all_) - F.col("n0")).withColumn("t1", F.sum("n1").over(all_) - F.col("n1"))


def _with_tags(batch: pa.RecordBatch, cells: dict, at: int, rows: int = BLOCK_ROWS):
    """Slices of a few rows as (slice, its bits, row and cell of each tag that is in ``cells``);
    from column ``at`` on: bits, Repeat of each tag, Fold of each tag."""
    for a in range(0, batch.num_rows, rows):
        part = batch.slice(a, rows)
        bits, repeats, tags = part.column(at), part.column(at + 1), part.column(at + 2)
        row = np.repeat(np.arange(part.num_rows), repeats.value_lengths().to_numpy())
        cell = np.fromiter((cells.get(k, -1) for k in zip(repeats.flatten().to_pylist(), tags.flatten().to_pylist(), strict=True)), np.int64, len(row))
        yield part, bits, row[cell >= 0], cell[cell >= 0]


def nb_counts(rows: DataFrame, cells: dict, nbits: int) -> np.ndarray:
    """Rows of each (cell, class, bit). A task sends its sums, a row for each cell and class."""
    n = len(cells)

    def count(batches):
        sums = np.zeros((2 * n, nbits), np.int64)
        for batch in batches:
            for part, bits, row, cell in _with_tags(batch, cells, 1):
                y, lens, flat = part.column(0).to_numpy(zero_copy_only=False), bits.value_lengths().to_numpy(), bits.flatten().to_numpy()
                start = np.cumsum(lens) - lens
                for c in np.unique(cell):
                    for label in (0, 1):
                        some = row[(cell == c) & (y[row] == label)]
                        size = lens[some]
                        where = np.repeat(start[some] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                        sums[2 * c + label] += np.bincount(flat[where], minlength=nbits)
        some = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([sums[k].tobytes() for k in some], pa.binary())], ["k", "sums"])

    def add(parts: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(x.as_py(), np.int64) for x in parts["sums"])
        return pa.table([parts["k"][:1], pa.array([whole.tobytes()], pa.binary())], ["k", "sums"])

    out = np.zeros((2 * n, nbits), np.int64)
    per = rows.select("y", "bits", "repeats", "tags").mapInArrow(count, "k int, sums binary").groupBy("k").applyInArrow(add, "k int, sums binary")
    for r in per.collect():  # repeats * folds * 2 rows of nbits counts
        out[r["k"]] = np.frombuffer(bytes(r["sums"]), np.int64)
    return out.reshape(n, 2, nbits)


def nb_table(k1: np.ndarray, k0: np.ndarray, t1: int, t0: int, alphas: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of a set bit against a clear one (nbits x alphas), and of a row without bits."""
    p1, p0 = (k1[:, None] + alphas) / (t1 + 2 * alphas), (k0[:, None] + alphas) / (t0 + 2 * alphas)
    clear = np.log1p(-p1) - np.log1p(-p0)
    return np.log(p1) - np.log(p0) - clear, clear.sum(axis=0) + np.log(t1 / t0)


def nb_scores(data: DataFrame, folds: DataFrame, alphas: list[float], nbits: int = 2048, id_col: str = "id", label: str = "label", bits: str = "bits") -> DataFrame:
    """Held-out scores for each smoothing; trial 1 is ``alphas[0]``. A row carries all its
    tags, so its bits are sent once: one pass counts, one scores. Bits are below ``nbits``."""
    tags = folds.groupBy(F.col(id_col).alias("id")).agg(F.collect_list(F.struct("Repeat", "Fold")).alias("t")).select("id", F.col("t.Repeat").alias("repeats"), F.col("t.Fold").alias("tags"))
    rows = data.where(F.col(label).isNotNull()).select(F.col(id_col).alias("id"), F.col(label).alias("y"), F.coalesce(F.col(bits), F.array().cast("array<int>")).cast("array<int>").alias("bits"))
    rows = cut_lineage(rows.join(tags, "id").select("y", "bits", "repeats", "tags", "id"))
    pairs = F.explode(F.arrays_zip(F.col("repeats").alias("Repeat"), F.col("tags").alias("Fold"))).alias("t")
    sizes = {(r["Repeat"], r["Fold"]): (r["n0"], r["n1"], r["t0"], r["t1"]) for r in fold_counts(rows.select("y", pairs).select("y", "t.*"), "y").collect()}  # a row a fold
    cells = {k: i for i, k in enumerate(sorted(sizes))}
    counts = nb_counts(rows, cells, nbits) if cells else np.zeros((0, 2, nbits), np.int64)
    usable = [k for k in cells if sizes[k][2] and sizes[k][3]]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"id {kinds['id']}, Repeat int, Fold int, y {kinds['y']}, odds array<double>"
    grid = np.array(alphas, np.float64)
    total = {rep: sum(counts[cells[k]] for k in cells if k[0] == rep) for rep in {k[0] for k in cells}}
    # tables of some folds at a time, each of nbits rows of n doubles
    at_once = max(1, MODEL_BYTES // (8 * nbits * max(1, len(alphas))))
    found = None
    for first in range(0, max(1, len(usable)), at_once):
        names = usable[first:first + at_once]
        sent = rows.sparkSession.sparkContext.broadcast([(total[k[0]][1] - counts[cells[k]][1], total[k[0]][0] - counts[cells[k]][0], sizes[k][3], sizes[k][2]) for k in names])

        def score(batches, names=names, sent=sent):
            tables: dict = {}
            for batch in batches:
                for part, bits_, row, cell in _with_tags(batch, {k: i for i, k in enumerate(names)}, 1):
                    lens = bits_.value_lengths().to_numpy()
                    x = np.zeros((part.num_rows, nbits))
                    np.add.at(x, (np.repeat(np.arange(part.num_rows), lens), bits_.flatten().to_numpy()), 1.0)
                    for c in np.unique(cell).tolist():
                        if c not in tables:
                            tables[c] = nb_table(*sent.value[c], grid)
                        some = row[cell == c]
                        odds = x[some] @ tables[c][0] + tables[c][1]
                        at = pa.array(some)
                        ends = pa.array(np.arange(len(some) + 1, dtype=np.int32) * len(grid))
                        rep, fold = (pa.array(np.full(len(some), v, np.int32)) for v in names[c])
                        yield pa.RecordBatch.from_arrays([part.column(4).take(at), rep, fold, part.column(0).take(at), pa.ListArray.from_arrays(ends, pa.array(odds.reshape(-1)))], ["id", "Repeat", "Fold", "y", "odds"])

        part = rows.mapInArrow(score, schema)
        found = part if found is None else found.unionByName(part)
    out = found.select("id", "Repeat", "Fold", "y", F.posexplode("odds").alias("at", "odds"))
    # equal rows tie, in whatever order their bits were summed
    score_ = 1.0 / (1.0 + F.exp(-F.round("odds", 9)))
    return out.select((F.col("at") + 1).alias("trial"), "id", "Repeat", "Fold", "y", score_.alias("score"), (score_ >= 0.5).cast("int").alias("pred"))


# ---------------------------------------------------------------------------
# k-NN: neighbour lists deep enough for every fold
# ---------------------------------------------------------------------------

def fold_neighbours(data: DataFrame, folds: DataFrame, k: int, nbits: int = 2048, id_col: str = "id", label: str = "label", bits: str = "bits") -> DataFrame:
    """id, Repeat, Fold, y, nth, near_y: the ``k`` nearest rows outside the row's fold of
    each repeat, by Hamming distance, ties to the smaller id (all, if they are fewer).

    A list of the ``depth`` nearest rows of all is complete for a repeat if it holds ``k``
    rows of other folds, since every row beyond it is farther; it is complete for all if it
    holds every row. Only rows with an incomplete list are searched again."""
    rows = cut_lineage(data.where(F.col(label).isNotNull()).select(F.col(id_col).alias("id"), F.col(label).alias("y"), F.col(bits).alias("bits")))
    tags = cut_lineage(folds.select(F.col(id_col).alias("id"), "Repeat", "Fold").join(rows.select("id", "y"), "id"))
    n = rows.count()
    parts = tags.groupBy("Repeat").agg(F.count_distinct("Fold").alias("k")).agg(F.min("k")).first()[0] or 1
    depth = math.ceil(k * parts / max(1, parts - 1)) + k // 2 + 2
    todo, found = rows, None
    near_tags = tags.select(F.col("id").alias("tid"), "Repeat", F.col("Fold").alias("near_fold"), F.col("y").alias("near_y"))
    while True:
        near = S.similarity_topn(todo, rows, min(depth, n) + 1, "id", "bits", nbits, metric="hamming").where("qid <> tid")
        near = near.select(F.col("qid").alias("id"), "tid", F.col("sim").alias("distance")).join(tags, "id").join(near_tags, ["tid", "Repeat"])
        # k a row and repeat are kept: the others of a list only show that it is complete
        nth = F.row_number().over(Window.partitionBy("id", "Repeat").orderBy("distance", "tid"))
        outside = cut_lineage(near.where("Fold <> near_fold").withColumn("nth", nth).where(F.col("nth") <= k).select("id", "Repeat", "Fold", "y", "nth", "near_y"))
        if depth >= n:
            full = outside
            todo = None
        else:
            have = outside.groupBy("id", "Repeat").agg(F.count(F.lit(1)).alias("c"))
            short = cut_lineage(tags.join(todo.select("id"), "id", "left_semi").select("id", "Repeat").join(have, ["id", "Repeat"], "left").where(F.coalesce("c", F.lit(0)) < k).select("id").distinct())
            full = outside.join(short, "id", "left_anti")
            todo = None if short.isEmpty() else rows.join(short, "id", "left_semi")
        found = full if found is None else found.unionByName(full)
        if todo is None:
            break
        depth *= 2
    return found


def knn_scores(data: DataFrame, folds: DataFrame, ks: list[int], nbits: int = 2048, id_col: str = "id", label: str = "label", bits: str = "bits") -> DataFrame:
    """Held-out scores for each number of neighbours (trial 1 is ``ks[0]``): the share of
    positive rows among them; ``pred`` is 1 on a strict majority only."""
    near = fold_neighbours(data, folds, max(ks), nbits, id_col, label, bits)
    votes = F.avg("near_y").over(Window.partitionBy("id", "Repeat").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0))
    running = near.withColumn("score", votes)
    spark = data.sparkSession
    trials = spark.createDataFrame([(i + 1, int(k)) for i, k in enumerate(ks)], "trial int, nth int")
    # a list shorter than k has no k-th row: such folds have no scores
    return running.join(F.broadcast(trials), "nth").select("trial", "id", "Repeat", "Fold", "y", "score", (F.col("score") > 0.5).cast("int").alias("pred"))


# ---------------------------------------------------------------------------
# Logistic regression: all columns in one optimiser
# ---------------------------------------------------------------------------

def minimise(evaluate, start: np.ndarray, tol: float = 1e-7, max_iter: int = 2000, inverse=None) -> np.ndarray:
    """Columns of ``start``, each moved to the least value of its own smooth convex
    function. ``evaluate(points, columns)`` gives the values and gradients of some
    columns at once. Limited-memory BFGS with backtracking, column by column; a
    column rests when its largest gradient is within ``tol`` of its scale.
    ``inverse(vectors, columns)`` may give the product with a rough inverse of the second
    derivatives, from which the quasi-Newton steps start."""
    b = start.copy()
    p, m = b.shape
    f, g = evaluate(b, np.arange(m))
    steps, turns = np.zeros((MEMORY, p, m)), np.zeros((MEMORY, p, m))
    curve = np.zeros((MEMORY, m))  # step times turn; 0 where there is none
    stuck = np.zeros(m, bool)
    for it in range(max_iter):
        live = np.flatnonzero((np.abs(g).max(axis=0) > tol * np.maximum(1.0, np.abs(b).max(axis=0))) & ~stuck)
        if not len(live):
            break
        d, alpha = -g[:, live], np.zeros((MEMORY, len(live)))
        order = [(it - 1 - j) % MEMORY for j in range(min(it, MEMORY))]
        per_curve = np.where(curve[:, live] > 0, 1.0 / np.where(curve[:, live] > 0, curve[:, live], 1.0), 0.0)
        for j in order:
            alpha[j] = per_curve[j] * (steps[j][:, live] * d).sum(axis=0)
            d -= alpha[j] * turns[j][:, live]
        if inverse is not None:
            d = inverse(d, live)
        elif order:
            last = order[0]
            yy = (turns[last][:, live] ** 2).sum(axis=0)
            d *= np.where(curve[last, live] > 0, curve[last, live] / np.where(yy > 0, yy, 1.0), 1.0)
        for j in reversed(order):
            d += (alpha[j] - per_curve[j] * (turns[j][:, live] * d).sum(axis=0)) * steps[j][:, live]
        slope = (g[:, live] * d).sum(axis=0)
        up = slope >= 0
        d[:, up] = -g[:, live[up]]
        slope = (g[:, live] * d).sum(axis=0)
        t = np.ones(len(live)) if it or inverse is not None else 1.0 / np.maximum(1.0, np.sqrt(-slope))
        slot = it % MEMORY
        curve[slot] = 0.0
        open_ = np.arange(len(live))
        for _ in range(50):
            cols = live[open_]
            point = b[:, cols] + t[open_] * d[:, open_]
            value, grad = evaluate(point, cols)
            good = value <= f[cols] + 1e-4 * t[open_] * slope[open_] + 1e-14 * np.abs(f[cols])
            done = cols[good]
            steps[slot][:, done] = point[:, good] - b[:, done]
            turns[slot][:, done] = grad[:, good] - g[:, done]
            sy = (steps[slot][:, done] * turns[slot][:, done]).sum(axis=0)
            curve[slot, done] = np.where(sy > 1e-300, sy, 0.0)
            b[:, done], f[done], g[:, done] = point[:, good], value[good], grad[:, good]
            open_ = open_[~good]
            if not len(open_):
                break
            t[open_] *= 0.5
        stuck[live[open_]] = True  # no lower point within rounding
    return b


class Rows:
    """Dense blocks of (features and a last column of ones, label, fold of each repeat)."""

    def __init__(self, batch: pa.RecordBatch | pa.Table, width: int):
        self.n, self.width = batch.num_rows, width
        ids, y, values, folds = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in batch.columns)
        self.ids = ids.to_numpy(zero_copy_only=False)
        self.y = y.to_numpy(zero_copy_only=False).astype(np.float64)
        self.is_bits = pa.types.is_integer(values.type.value_type)
        self.lens = values.value_lengths().to_numpy(zero_copy_only=False)
        self.flat = values.flatten().to_numpy(zero_copy_only=False)
        self.starts = np.concatenate([[0], np.cumsum(self.lens)])
        self.folds = folds.flatten().to_numpy(zero_copy_only=False).reshape(self.n, -1) if self.n else np.zeros((0, 1), np.int32)

    def blocks(self):
        for a in range(0, self.n, BLOCK_ROWS):
            z = min(self.n, a + BLOCK_ROWS)
            x = np.zeros((z - a, self.width + 1))
            x[:, -1] = 1.0
            part = self.flat[self.starts[a]:self.starts[z]]
            if self.is_bits:
                x[np.repeat(np.arange(z - a), self.lens[a:z]), part] = 1.0
            else:
                x[:, :self.width] = part.reshape(z - a, self.width)
            yield slice(a, z), x


class Columns:
    """The columns of a fit: each with its repeat, fold, C, class weights, and, where the
    features are scaled on train rows, the least value and range of each feature."""

    def __init__(self, repeat, fold, c, w0, w1, low=None, span=None):
        self.repeat, self.fold, self.c, self.w0, self.w1 = (np.asarray(v) for v in (repeat, fold, c, w0, w1))
        self.low, self.span = low, span

    def take(self, cols: np.ndarray) -> Columns:
        return Columns(self.repeat[cols], self.fold[cols], self.c[cols], self.w0[cols], self.w1[cols], None if self.low is None else self.low[:, cols], None if self.low is None else self.span[:, cols])

    def raw(self, b: np.ndarray) -> np.ndarray:
        """Coefficients on features as they are, from those on scaled features."""
        if self.low is None:
            return b
        out = b.copy()
        out[:-1] = b[:-1] / self.span
        out[-1] -= (out[:-1] * self.low).sum(axis=0)
        return out

    def scaled(self, g: np.ndarray) -> np.ndarray:
        """Gradient for scaled features, from that for features as they are."""
        if self.low is None:
            return g
        out = g.copy()
        out[:-1] = (g[:-1] - self.low * g[-1]) / self.span
        return out

    def penalised(self, b: np.ndarray, loss: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """C times the loss plus half the squared coefficients, without the intercept."""
        ridge = b.copy()
        ridge[-1] = 0.0
        return self.c * loss + 0.5 * (ridge ** 2).sum(axis=0), self.c * self.scaled(g) + ridge


def losses(rows: Rows, columns: Columns, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted logistic losses and raw gradients of the columns over the rows of other folds."""
    loss, g = np.zeros(b.shape[1]), np.zeros(b.shape)
    for at, x in rows.blocks():
        z = x @ b
        y = rows.y[at][:, None]
        w = np.where(y == 1, columns.w1, columns.w0) * (rows.folds[at][:, columns.repeat] != columns.fold)
        signed = np.where(y == 1, -z, z)
        loss += (w * np.logaddexp(0.0, signed)).sum(axis=0)
        g += x.T @ (w * np.where(y == 1, -1.0, 1.0) / (1.0 + np.exp(-np.clip(signed, -700, 700))))
    return loss, g


#: The hinge of the linear machine is rounded so far from its kink, as in ``kernels``.
ROUNDING = 0.05


def hinge_losses(rows: Rows, columns: Columns, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``losses``, of the rounded hinge."""
    loss, g = np.zeros(b.shape[1]), np.zeros(b.shape)
    for at, x in rows.blocks():
        y = rows.y[at][:, None]
        sign = np.where(y == 1, 1.0, -1.0)
        w = np.where(y == 1, columns.w1, columns.w0) * (rows.folds[at][:, columns.repeat] != columns.fold)
        slack = 1.0 + ROUNDING - sign * (x @ b)
        near = np.clip(slack, 0.0, 2 * ROUNDING)
        loss += (w * (near * near / (4 * ROUNDING) + np.maximum(slack - 2 * ROUNDING, 0.0))).sum(axis=0)
        g += x.T @ (w * near / (-2 * ROUNDING) * sign)
    return loss, g


def bit_deviations(table: DataFrame, sizes: dict, place: dict, nbits: int) -> dict:
    """(Repeat, Fold) -> weighted sample deviation of each bit over the other folds' rows, with
    balanced class weights; infinite for a bit that does not vary, which so takes no part."""
    cells = {k: i for i, k in enumerate(sorted(sizes))}
    tags = [F.struct(F.lit(r).cast("int").alias("r"), F.col("folds")[i].alias("f")) for r, i in place.items()]
    tagged = table.select("y", F.col("x").alias("bits"), F.filter(F.array(*tags), lambda t: t["f"] >= 0).alias("t"))
    counts = nb_counts(tagged.select("y", "bits", F.col("t.r").alias("repeats"), F.col("t.f").alias("tags")), cells, nbits)
    out = {}
    for rep, fold in cells:
        t = sizes[rep, fold]
        if not (t[0] and t[1]):
            continue
        other = sum(counts[i] for (r, f), i in cells.items() if r == rep and f != fold)
        w = [sum(t) / (2 * n) for n in t]
        total, squares = sum(t), sum(n * v * v for n, v in zip(t, w))
        mean = (w[0] * other[0] + w[1] * other[1]) / total
        variance = total * mean * (1 - mean) / (total - squares / total)
        out[rep, fold] = np.where(variance > 1e-15, np.sqrt(np.maximum(variance, 1e-15)), np.inf)
    return out


class Curvature:
    """The second derivatives of the logistic losses at the origin, as eigenvalues and vectors,
    from which those of every column follow: C times them, and 1 for the penalty."""

    def __init__(self, values: np.ndarray, vectors: np.ndarray):
        self.values, self.vectors = np.maximum(values, 0.0), vectors

    def inverse(self, columns: Columns):
        def product(d: np.ndarray, cols: np.ndarray) -> np.ndarray:
            return self.vectors @ ((self.vectors.T @ d) / (columns.c[cols] * self.values[:, None] + 1.0))
        return product


def curvature(table: DataFrame, w0: float, w1: float, width: int) -> Curvature | None:
    """Of all rows, with a weight for each class. As many tasks as the session has cores sum
    their rows, so what is sent does not grow with the table. None for features out of range."""
    def partial(batches):
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            rows = Rows(batch, width)
            for at, x in rows.blocks():
                x = x.astype(np.float32)
                total += x.T @ (x * (np.where(rows.y[at] == 1, w1, w0) / 4).astype(np.float32)[:, None])
        for a in range(0, width + 1, CURVED_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array([a], pa.int32()), pa.array([total[a:a + CURVED_ROWS].tobytes()], pa.binary())], ["a", "part"])

    def add(parts: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(x.as_py()) for x in parts["part"])
        return pa.table([parts["a"][:1], pa.array([whole.tobytes()], pa.binary())], ["a", "part"])

    few = table.coalesce(table.sparkSession.sparkContext.defaultParallelism)
    sums = few.mapInArrow(partial, "a int, part binary").groupBy("a").applyInArrow(add, "a int, part binary").collect()  # width / CURVED_ROWS rows
    whole = np.vstack([np.frombuffer(bytes(r["part"])).reshape(-1, width + 1) for r in sorted(sums, key=lambda r: r["a"])])
    return Curvature(*np.linalg.eigh(whole)) if np.isfinite(whole).all() else None


def fit_local(rows: Rows, columns: Columns, width: int, max_iter: int, curved: Curvature | None = None, of=losses) -> np.ndarray:
    def evaluate(b, cols):
        some = columns.take(cols)
        loss, g = of(rows, some, some.raw(b))
        return some.penalised(b, loss, g)

    return minimise(evaluate, np.zeros((width + 1, len(columns.c))), max_iter=max_iter, inverse=curved and curved.inverse(columns))


def fit_spread(table: DataFrame, columns: Columns, width: int, max_iter: int, curved: Curvature | None = None, of=losses) -> np.ndarray:
    """The same with a Spark job for each pass: tasks sum their rows' losses and gradients,
    groups of tasks are summed in a second stage, and the driver adds up the groups."""
    spark = table.sparkSession
    groups = max(1, math.isqrt(table.rdd.getNumPartitions()))

    def evaluate(b, cols):
        some = columns.take(cols)
        sent = spark.sparkContext.broadcast((some, some.raw(b)))

        def partial(batches):
            cols_, b_ = sent.value
            loss, g = np.zeros(b_.shape[1]), np.zeros(b_.shape)
            for batch in batches:
                more = of(Rows(batch, width), cols_, b_)
                loss, g = loss + more[0], g + more[1]
            group = TaskContext.get().partitionId() % groups
            yield pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([np.vstack([loss, g]).tobytes()], pa.binary())], ["g", "part"])

        def add(parts: pa.Table) -> pa.Table:
            whole = sum(np.frombuffer(x.as_py()) for x in parts["part"])
            return pa.table([parts["g"][:1], pa.array([whole.tobytes()], pa.binary())], ["g", "part"])

        sums = table.mapInArrow(partial, "g int, part binary").groupBy("g").applyInArrow(add, "g int, part binary").collect()
        whole = sum(np.frombuffer(bytes(r["part"])) for r in sums).reshape(-1, b.shape[1])
        sent.unpersist()
        return some.penalised(b, whole[0], whole[1:])

    return minimise(evaluate, np.zeros((width + 1, len(columns.c))), max_iter=max_iter, inverse=curved and curved.inverse(columns))


def fold_ranges(tagged: DataFrame, width: int) -> dict:
    """(Repeat, Fold) -> (least, largest) of each feature over the other folds' rows."""
    per = tagged.select("Repeat", "Fold", F.posexplode("x").alias("at", "v")).groupBy("Repeat", "Fold", "at").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    low: dict = {}
    for r in per.collect():  # repeats * folds * width rows
        lo, hi = low.setdefault((r["Repeat"], r["Fold"]), (np.full(width, np.inf), np.full(width, -np.inf)))
        lo[r["at"]], hi[r["at"]] = r["lo"], r["hi"]
    out = {}
    for rep, fold in low:
        others = [v for (r, f), v in low.items() if r == rep and f != fold] or [low[rep, fold]]
        out[rep, fold] = np.minimum.reduce([v[0] for v in others]), np.maximum.reduce([v[1] for v in others])
    return out


def is_local(rows: int, width: int, positions: int | None, columns: int, tasks: int, limit: int) -> bool:
    """Whether the rows are broadcast. Bits are sent as their ``positions`` and unfolded a
    block at a time, so their table may be larger than its dense form; but a task then passes
    over all rows for its columns, which pays with enough columns for the tasks."""
    if positions is None:
        return rows * (width + 1) * 8 <= limit
    return positions * 4 + rows * 64 <= limit and (rows * (width + 1) * 8 <= 8 * limit or columns >= 4 * tasks)


def logistic_scores(data: DataFrame, folds: DataFrame, cs: list[float], nbits: int = 2048, id_col: str = "id", label: str = "label", features: str = "bits", scale: bool = False, max_iter: int = 2000, local_bytes: int | None = None, hinge: bool = False) -> tuple[DataFrame, dict]:
    """Held-out scores for each C (trial 1 is ``cs[0]``), and the coefficients (features,
    then intercept) of each (trial, Repeat, Fold). Balanced class weights of the train
    rows; ``scale`` brings dense features to [0, 1] on the train rows of each fold. With
    ``hinge``, linear machines on bits over their deviation among a fold's train rows (as
    Spark's own standardises them), whose margins pass the same link."""
    spark = data.sparkSession
    rows = data.where(F.col(label).isNotNull()).select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"), F.col(features).alias("x"))
    tags = folds.select(F.col(id_col).alias("id"), "Repeat", "Fold")
    empty = F.array().cast(rows.schema["x"].dataType)
    rows = cut_lineage(rows.withColumn("x", F.coalesce("x", empty)).join(tags, "id"))
    sizes = {(r["Repeat"], r["Fold"]): (r["t0"], r["t1"]) for r in fold_counts(rows, "y").collect()}  # a row a fold
    keys = [(t, rep, fold) for t in range(len(cs)) for (rep, fold), (t0, t1) in sorted(sizes.items()) if t0 and t1]
    schema = "trial int, id long, Repeat int, Fold int, y int, score double"
    if not keys:
        return spark.createDataFrame([], schema + ", pred int"), {}
    dense = "array<int>" not in rows.schema["x"].dataType.simpleString()
    width = rows.agg(F.max(F.size("x"))).first()[0] if dense else nbits
    repeats = sorted({rep for _, rep, _ in keys})
    place = {rep: i for i, rep in enumerate(repeats)}
    by_repeat = F.array(*[F.coalesce(F.max(F.when(F.col("Repeat") == rep, F.col("Fold"))), F.lit(-1)).cast("int") for rep in repeats])
    table = cut_lineage(rows.groupBy("id", "y", "x").agg(by_repeat.alias("folds")).select("id", "y", "x", "folds"))
    n = table.count()
    ranges = fold_ranges(rows, width) if scale else None
    spread = bit_deviations(table, sizes, place, nbits) if hinge else None
    of = hinge_losses if hinge else losses

    def columns_of(some) -> Columns:
        weight = [sizes[rep, fold] for _, rep, fold in some]
        total = [t0 + t1 for t0, t1 in weight]
        low = span = None
        if ranges:
            low = np.array([ranges[rep, fold][0] for _, rep, fold in some]).T
            span = np.array([ranges[rep, fold][1] for _, rep, fold in some]).T - low
            span = np.where(span == 0, 1.0, span)
        if spread:
            span = np.array([spread[rep, fold] for _, rep, fold in some]).T
            low = np.zeros_like(span)
        return Columns([place[rep] for _, rep, _ in some], [fold for _, _, fold in some], [cs[t] for t, _, _ in some], [s / (2 * w[0]) for s, w in zip(total, weight)], [s / (2 * w[1]) for s, w in zip(total, weight)], low, span)

    small = is_local(n, width, None if dense else table.agg(F.sum(F.size("x"))).first()[0] or 0, len(keys), spark.sparkContext.defaultParallelism, LOCAL_BYTES if local_bytes is None else local_bytes)
    at_once = max(1, STATE_BYTES // ((width + 1) * 8 * (2 * MEMORY + 8)))
    curved = None
    if width < CURVED and not scale and not hinge:
        every = columns_of(keys)
        curved = curvature(table, float(every.w0.mean()), float(every.w1.mean()), width)
    if small:
        sent = spark.sparkContext.broadcast((table.toArrow(), curved))
        # a task unfolds the rows once for its columns: few columns go round once, many twice
        tasks = spark.sparkContext.defaultParallelism * (2 if len(keys) >= 8 * spark.sparkContext.defaultParallelism else 1)
        share = min(at_once, max(1, -(-len(keys) // tasks)))
        chunks = [keys[a:a + share] for a in range(0, len(keys), share)]
        plans = spark.sparkContext.broadcast([columns_of(c) for c in chunks])

        def fit(batches):
            for batch in batches:
                for i in batch.column(0).to_pylist():
                    b = fit_local(Rows(sent.value[0], width), plans.value[i], width, max_iter, sent.value[1], of)
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([b.tobytes()], pa.binary())], ["chunk", "b"])

        jobs = spark.range(0, len(chunks), 1, len(chunks)).mapInArrow(fit, "chunk int, b binary")
        found = {r["chunk"]: np.frombuffer(bytes(r["b"])).reshape(width + 1, -1) for r in jobs.collect()}
        fitted = [(c, found[i]) for i, c in enumerate(chunks)]
    else:
        chunks = [keys[a:a + at_once] for a in range(0, len(keys), at_once)]
        fitted = [(c, fit_spread(table, columns_of(c), width, max_iter, curved, of)) for c in chunks]
    out = None
    for some, b in fitted if not small else [(keys, np.hstack([b for _, b in fitted]))]:
        plan = columns_of(some)
        model = spark.sparkContext.broadcast((plan, plan.raw(b), np.array([(t + 1, rep, fold) for t, rep, fold in some])))

        def score(batches, model=model):
            plan, b, names = model.value
            for batch in batches:
                block = Rows(batch, width)
                ids = block.ids
                for at, x in block.blocks():
                    z = x @ b
                    r, j = np.nonzero(block.folds[at][:, plan.repeat] == plan.fold)
                    p = 1.0 / (1.0 + np.exp(-np.clip(z[r, j], -700, 700)))
                    yield pa.RecordBatch.from_arrays([pa.array(names[j, 0], pa.int32()), pa.array(ids[at][r], pa.int64()), pa.array(names[j, 1], pa.int32()), pa.array(names[j, 2], pa.int32()), pa.array(block.y[at][r].astype(np.int32)), pa.array(p)], ["trial", "id", "Repeat", "Fold", "y", "score"])

        part = table.mapInArrow(score, schema)
        out = part if out is None else out.unionByName(part)
    coefficients = {(t + 1, rep, fold): b[:, i] for some, b in fitted for i, (t, rep, fold) in enumerate(some)}
    return out.withColumn("pred", (F.col("score") >= 0.5).cast("int")), coefficients


# ---------------------------------------------------------------------------
# metrics of all trials and folds
# ---------------------------------------------------------------------------

def cv_metrics(scores: DataFrame, folds: DataFrame, trials: int, descriptor: str, model: str) -> DataFrame:
    """trial, Descriptor, Model, Repeat, Fold, status, error, counts and the ten metrics: a
    row for each trial and fold. ``scores`` are read more than once: cut their lineage before."""
    per = ["trial", "Repeat", "Fold"]
    found = M.metrics10(scores, per, pred="pred")
    cells = folds.select("Repeat", "Fold").distinct().withColumn("trial", F.explode(F.sequence(F.lit(1), F.lit(trials))))
    out = cells.join(found, per, "left")
    ok = F.col("tp").isNotNull()
    return out.select("trial", F.lit(descriptor).alias("Descriptor"), F.lit(model).alias("Model"), F.col("Repeat").cast("int").alias("Repeat"), F.col("Fold").cast("int").alias("Fold"), F.when(ok, "ok").otherwise("failed").alias("status"), F.when(~ok, "the train rows hold one class, or too few rows").alias("error"), "tp", "fp", "tn", "fn", *M.METRICS)
