"""Quality classifier by importance resampling.

Two generative models of hashed word uni- and bigrams are fitted: one on the good
labelled texts (the target), one on every text of the table (the raw). A text's
importance weight is the ratio of its probabilities under the two; its logarithm is
a sum over its n-grams. The texts kept are the Gumbel top-k: the k largest of
log weight + Gumbel noise, which is a draw without replacement in proportion to the
weights. The noise comes from a seeded hash of id and text, so reruns agree.

``k`` may be given. Without it, it is found from the labels: the cut on the
perturbed score that best parts good from bad labelled texts held out from the
fit, but never one that would lose more than ``max_loss`` of the good ones; k is
the number of texts of the whole table above it. The k-th largest score is found
by counts of 256 ranges a round, never by a global sort.

At most ``max_labels`` labelled texts (by seeded hash of their id) are used; counts
of the raw model cover every text. Tables on the driver: 2 x ``buckets`` counts and
the labels used.

Defined results: a null or empty text has log weight 0; a label without text is not
used; conflicting labels of one id make it bad; repeated rows are scored each and
share their noise, so they are kept or go together, and ties with the k-th score
are kept; an empty table gives an empty result; without good labels the target is
the raw model and all is kept. Extra columns pass through ``keep_good``.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.llm.common import few, releasing, seeded_hash, stored

TOKEN = re.compile(r"\w+|[^\w\s]+")
_CACHE_LIMIT = 150_000
_REPEAT = np.uint64(zlib.crc32(b"a word twice"))  # the pair of a word and itself is one feature


class _Hashes(dict):
    """CRC-32 of words, kept while there is room."""

    def __missing__(self, word: str) -> int:
        if len(self) > _CACHE_LIMIT:
            self.clear()
        got = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return got


_hashes = _Hashes()


def features(text: str | None, buckets: int) -> np.ndarray:
    """Bucket numbers of a text's words and word pairs."""
    words = TOKEN.findall(text.lower()) if text else []
    one = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    two = (one[:-1] * np.uint64(0x9E3779B1) + one[1:] * np.uint64(0x85EBCA6B)) >> np.uint64(7)
    two[one[:-1] == one[1:]] = _REPEAT
    return np.concatenate([one, two]) % np.uint64(buckets)


def gumbel(key: int | None, text: str | None, seed: int) -> float:
    """Gumbel noise of a row, from its id and text."""
    body = (text or "").encode("utf-8", "surrogatepass")
    head = struct.pack("<qq", seed, -1 if key is None else key)
    u = (zlib.crc32(body, zlib.crc32(head)) * 2**20 + (zlib.crc32(head + b"x", len(body)) & 0xFFFFF) + 0.5) / 2**52
    return -math.log(-math.log(u))


@dataclass(frozen=True)
class Model:
    log_ratio: np.ndarray  # by bucket
    seed: int

    @property
    def buckets(self) -> int:
        return len(self.log_ratio)

    def scores(self, keys, texts) -> tuple[np.ndarray, np.ndarray]:
        """Log weights and perturbed scores."""
        weight = np.array([self.log_ratio[features(t, self.buckets)].sum() if t else 0.0 for t in texts], np.float64).reshape(-1)
        noise = np.array([gumbel(k, t, self.seed) for k, t in zip(keys, texts, strict=True)], np.float64).reshape(-1)
        return weight, weight + noise


def labelled_sample(labels: DataFrame, id_col: str, good_col: str, max_labels: int, seed: int) -> dict[int, int]:
    """id -> 1 good, 0 bad, of at most ``max_labels`` labelled ids."""
    per = labels.where(F.col(id_col).isNotNull() & F.col(good_col).isNotNull()).groupBy(id_col).agg(F.min(good_col).alias("good"))
    rows = per.orderBy(seeded_hash(seed, F.col(id_col)), id_col).limit(max_labels).collect()
    return {int(r[0]): int(r[1]) for r in rows}


def _fitting(key: int, seed: int) -> bool:
    """Whether a labelled id is for the fit (else for the cut)."""
    return zlib.crc32(struct.pack("<qq", seed, key)) % 2 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", good_col: str = "good",
        buckets: int = 1 << 14, max_labels: int = 20_000, seed: int = 7) -> tuple[Model, dict[int, int]]:
    """The model, and the labels held out from it. One pass over all texts, whose
    counts are summed in each task before they meet."""
    known = labelled_sample(labels, id_col, good_col, max_labels, seed)
    target = {k for k, good in known.items() if good and _fitting(k, seed)}

    @releasing
    def count(batches):
        raw, good = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                got = np.bincount(features(text.as_py(), buckets).astype(np.int64), minlength=buckets) if text.is_valid else 0
                raw += got
                if key in target:
                    good += got
        _hashes.clear()
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(good[some])], ["bucket", "raw", "good"])

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(count, "bucket long, raw long, good long")
    sums = rows.groupBy("bucket").agg(F.sum("raw"), F.sum("good")).toPandas().to_numpy(np.int64).reshape(-1, 3)
    raw, good = np.ones(buckets), np.ones(buckets)
    raw[sums[:, 0]] += sums[:, 1]
    good[sums[:, 0]] += sums[:, 2]
    ratio = np.log(good / good.sum()) - np.log(raw / raw.sum()) if sums[:, 2].sum() else np.zeros(buckets)
    return Model(ratio, seed), {k: g for k, g in known.items() if not _fitting(k, seed)}


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, log_weight, score: a row for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x 8 bytes

    @releasing
    def run(batches):
        for batch in batches:
            for part in few(batch, 1):
                weight, total = shared.value.scores(part.column(0).to_pylist(), part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(weight), pa.array(total)], ["doc_id", "log_weight", "score"])
        _hashes.clear()

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, "doc_id long, log_weight double, score double").withColumnRenamed("doc_id", id_col)


def cut_from_labels(scored: DataFrame, held: dict[int, int], id_col: str = "doc_id", max_loss: float = 0.001) -> float:
    """The score that best parts held-out good from bad ids (bounded by max_labels)."""
    ids = scored.sparkSession.createDataFrame([(k, g) for k, g in held.items()], "k long, good int")
    rows = scored.join(F.broadcast(ids), F.col(id_col) == F.col("k")).groupBy("k", "good").agg(F.min("score")).toPandas().to_numpy(float).reshape(-1, 3)
    good, bad = np.sort(rows[rows[:, 1] == 1, 2]), np.sort(rows[rows[:, 1] == 0, 2])
    if not len(good) or not len(bad):
        return -math.inf
    points = np.sort(rows[:, 2])
    gain = np.searchsorted(bad, points) / len(bad) - np.searchsorted(good, points) / len(good)
    best = points[np.argmax(gain)]
    below = bad[bad < best]
    middle = (best + below[-1]) / 2 if len(below) else best
    return float(min(middle, good[int(max_loss * len(good))]))


def kth_largest(scored: DataFrame, k: int, col: str = "score") -> float:
    """The k-th largest value: 256 counts a round, and on with the range of the one that holds it."""
    if k <= 0:
        return math.inf
    low, high = scored.agg(F.min(col), F.max(col)).first()
    if low is None:
        return -math.inf
    while low < high:
        step = (high - low) / 256
        if not step or low + step == low:
            break
        n = F.least(F.floor((F.col(col) - F.lit(low)) / F.lit(step)).cast("int"), F.lit(255))
        inside = scored.where((F.col(col) >= low) & (F.col(col) <= high))
        above = scored.where(F.col(col) > high).count()
        found = sorted(inside.groupBy(n.alias("n")).agg(F.count(F.lit(1)).alias("c"), F.min(col).alias("lo"), F.max(col).alias("hi")).collect(), reverse=True)
        for row in found:
            if above + row["c"] >= k:
                break
            above += row["c"]
        if (row["lo"], row["hi"]) == (low, high):
            break
        low, high = row["lo"], row["hi"]
    return float(low)


def decide(docs: DataFrame, labels: DataFrame, k: int | None = None, id_col: str = "doc_id", text_col: str = "text",
           good_col: str = "good", buckets: int = 1 << 14, max_labels: int = 20_000, max_loss: float = 0.001, seed: int = 7):
    """(scored rows, model, smallest score that is kept)."""
    model, held = fit(docs, labels, id_col, text_col, good_col, buckets, max_labels, seed)
    scored = stored(score(docs, model, id_col, text_col), "quality-scores")
    if k is None:
        k = scored.where(F.col("score") >= cut_from_labels(scored, held, id_col, max_loss)).count()
    return scored, model, kth_largest(scored, k)


def classify(docs: DataFrame, labels: DataFrame, k: int | None = None, id_col: str = "doc_id", **how) -> DataFrame:
    """id, log_weight, score, keep: a row for each row of ``docs``."""
    scored, _, least = decide(docs, labels, k, id_col, **how)
    return scored.withColumn("keep", F.col("score") >= F.lit(least))


def keep_good(docs: DataFrame, labels: DataFrame, k: int | None = None, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that are kept, scored again where they lie, so no text is shuffled."""
    _, model, least = decide(docs, labels, k, id_col, text_col, **how)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = {c: i for i, c in enumerate(docs.columns)}

    @releasing
    def run(batches):
        for batch in batches:
            for part in few(batch, at[text_col]):
                keys = part.column(at[id_col]).cast(pa.int64()).to_pylist()
                _, total = shared.value.scores(keys, part.column(at[text_col]).to_pylist())
                yield part.filter(pa.array(total >= least))
        _hashes.clear()  # the worker goes on with other stages

    return docs.mapInArrow(run, docs.schema)
