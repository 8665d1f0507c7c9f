"""Benchmark decontamination: a BM25 inverted index of the test items, searched
with block-max WAND by every passage of every training text.

The items' postings are ordered by item number and cut into blocks of
``block_items`` items; each term has its largest impact in each block. Impacts are
divided by the item's score against itself, so that one threshold serves items of
every length. Passages are windows of words that overlap by at least the longest
item, so an item that stands in a text stands whole in one window. For all windows
of a text at once, the sums of the terms' block maxima give upper bounds (repeated
words count again, which only raises them); a window goes on only into blocks whose
bound reaches the threshold, where the pivot rule of WAND, with block maxima, skips
what cannot reach it. All items above the threshold are retrieved, without a top-k.

A retrieved item counts as leaked if the passage holds at least ``min_question`` of
the five-word shingles of its question (of its words, if it has fewer than five) and
``min_answer`` of the words of its answer (the last sentence of the item, or its last quarter if it has one sentence).

Only the index is shared with the tasks. It is cut into shards of at most
``max_postings`` postings and the texts pass once for each shard; statistics are
those of all items, so the shards change nothing in the result.

Defined results: null and empty texts hold no leak; items without a word are never
found; repeated rows and items are found each; empty tables give empty results;
texts are read whole. Extra columns pass through ``drop_leaks``.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.llm.common import few, releasing, stored

WORD = re.compile(r"\w+")
SHINGLE = 5
K1, B = 1.2, 0.75
#: Bounds of the shared index: about 200,000 postings and as many rows of 64 block maxima (51 MB).
MAX_POSTINGS = 200_000
MAX_BLOCKS = 64
#: Windows of one text that are bounded at once.
WINDOWS = 512


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    """Five-word shingles; shorter lists are one shingle."""
    n = max(1, len(words) - SHINGLE + 1)
    return {tuple(words[i:i + SHINGLE]) for i in range(n)} if words else set()


def split_item(text: str) -> tuple[list[str], list[str]]:
    """Question and answer: the last sentence that leaves a question is the answer."""
    parts = [p for p in (words_of(s) for s in re.split(r"(?<=[.?!])\s+|\n", text)) if p]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - len(words) // 4
    return words[:cut], words[cut:]


@dataclass
class Index:
    """Postings of one shard of the items."""

    ids: list[int]
    texts: list[str]
    block_items: int
    longest: int  # words of the longest item
    terms: dict[str, int] = field(default_factory=dict)
    postings: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # item numbers, impacts
    bounds: np.ndarray | None = None  # term x block: largest impact
    questions: list[tuple[set, set]] = field(default_factory=list)

    @property
    def blocks(self) -> int:
        return -(-len(self.ids) // self.block_items)


def build_index(items: list[tuple[int, str, dict[str, int], int]], df: dict[str, int], n_items: int, mean_words: float,
                longest: int, block_items: int = 6) -> Index:
    """``items``: (id, text, term frequencies, words)."""
    block_items = max(block_items, -(-len(items) // MAX_BLOCKS))
    index = Index([i[0] for i in items], [i[1] for i in items], block_items, longest)
    lists: dict[str, list[tuple[int, float]]] = defaultdict(list)
    for at, (_, text, tf, length) in enumerate(items):
        impact = {}
        for term, f in tf.items():
            idf = math.log(1 + (n_items - df[term] + 0.5) / (df[term] + 0.5))
            impact[term] = idf * f * (K1 + 1) / (f + K1 * (1 - B + B * length / mean_words))
        own = sum(impact.values())
        for term, x in impact.items():
            lists[term].append((at, x / own))
        question, answer = split_item(text)
        index.questions.append((shingles(question) if len(question) >= SHINGLE else set(question), set(answer)))
    index.bounds = np.zeros((len(lists), max(1, index.blocks)), np.float32)
    for t, (term, rows) in enumerate(sorted(lists.items())):
        index.terms[term] = t
        at, x = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows])
        index.postings.append((at, x))
        np.maximum.at(index.bounds[t], at // block_items, x.astype(np.float32) * np.float32(1 + 1e-6))
    return index


def wand(index: Index, terms: list[int], blocks: np.ndarray, threshold: float) -> list[tuple[int, float]]:
    """All items of ``blocks`` (numbers, ascending) whose score for the distinct
    ``terms`` is at least ``threshold``: document-at-a-time with block-max pivots."""
    found = []
    size = index.block_items
    for block in blocks:
        first, end = block * size, (block + 1) * size
        lists = []
        for t in terms:
            bound = float(index.bounds[t, block])
            if bound > 0:
                at, x = index.postings[t]
                lists.append([int(np.searchsorted(at, first)), at, x, bound])
        while lists:
            lists.sort(key=lambda c: c[1][c[0]])
            total, pivot = 0.0, -1
            for n, c in enumerate(lists):
                total += c[3]
                if total >= threshold:
                    pivot = int(c[1][c[0]])
                    break
            if pivot < 0:
                break
            if int(lists[0][1][lists[0][0]]) == pivot:
                score = 0.0
                for c in lists:
                    if c[1][c[0]] != pivot:
                        break
                    score += float(c[2][c[0]])
                    c[0] += 1
                if score >= threshold - 1e-9:
                    found.append((pivot, score))
            else:
                for c in lists[:n]:
                    c[0] += int(np.searchsorted(c[1][c[0]:], pivot))
            lists = [c for c in lists if c[0] < len(c[1]) and c[1][c[0]] < end]
    return found


def search(index: Index, text: str | None, threshold: float, min_question: float, min_answer: float) -> list[tuple[int, float, float, float]]:
    """(item number, score, question overlap, answer overlap) of each leaked item: the best passage."""
    words = words_of(text)
    if not words or not index.ids:
        return []
    get = index.terms.get
    known = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
    where = np.flatnonzero(known >= 0)
    if not len(where):
        return []
    stride = max(8, index.longest // 4)
    span = index.longest + stride
    best: dict[int, tuple[int, float, float, float]] = {}
    for first in range(0, max(1, len(words) - index.longest + stride), stride * WINDOWS):
        starts = np.arange(first, min(first + stride * WINDOWS, max(1, len(words) - index.longest + stride)), stride)
        a, z = np.searchsorted(where, (starts[0], starts[-1] + span))
        lo, hi = np.searchsorted(where, starts) - a, np.searchsorted(where, starts + span) - a
        terms = known[where[a:z]]
        sums = np.zeros((len(terms) + 1, index.bounds.shape[1]), np.float32)
        np.cumsum(index.bounds[terms], axis=0, dtype=np.float32, out=sums[1:])
        over = sums[hi] - sums[lo] >= threshold - 1e-2
        for w in np.flatnonzero(over.any(axis=1)):
            distinct = np.unique(terms[lo[w]:hi[w]])
            blocks = np.flatnonzero(over[w])
            blocks = blocks[index.bounds[np.ix_(distinct, blocks)].sum(axis=0) >= threshold - 1e-4]
            passage = None
            for item, score in wand(index, distinct.tolist(), blocks, threshold) if len(blocks) else ():
                if passage is None:
                    part = words[starts[w]:starts[w] + span]
                    passage = shingles(part) | set(part), set(part)
                question, answer = index.questions[item]
                q = len(question & passage[0]) / len(question) if question else 1.0
                o = len(answer & passage[1]) / len(answer) if answer else 1.0
                if q >= min_question and o >= min_answer and (item not in best or (q + o, score) > (best[item][2] + best[item][3], best[item][1])):
                    best[item] = (item, score, q, o)
    return [best[i] for i in sorted(best)]


def shards(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", max_postings: int = MAX_POSTINGS) -> list[Index]:
    """The index, in shards of about ``max_postings`` postings. Statistics are counted by Spark over all items."""
    def terms(batches):
        for batch in batches:
            out = [(k, t, n, len(w)) for k, (t, w) in enumerate((t, words_of(t)) for t in batch.column(1).to_pylist()) for t, n in _count(w).items()]
            ids = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([ids[k] for k, *_ in out], pa.int64()), pa.array([x[1] for x in out], pa.string()), pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.int64())], ["item", "term", "tf", "words"])

    items = benchmark.select(F.col(id_col).cast("long").alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    postings = stored(items.mapInArrow(terms, "item long, term string, tf long, words long"), "leak-postings")
    total = postings.count()
    if not total:
        return []
    frequency = stored(postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "leak-terms")
    sized = items.select("item", "text")
    stats = items.mapInArrow(_lengths, "words long").where("words > 0").agg(F.count(F.lit(1)), F.avg("words"), F.max("words")).first()
    parts = -(-total // max_postings)
    out = []
    for part in range(parts):
        own = sized.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part)
        df = postings.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).select("term").distinct().join(frequency, "term")
        counted = {r["term"]: r["df"] for r in df.collect()}
        rows = []
        for r in own.orderBy("item", "text").collect():
            w = words_of(r["text"])
            if w:
                rows.append((r["item"], r["text"], _count(w), len(w)))
        out.append(build_index(rows, counted, stats[0], stats[1], stats[2]))
    return out


def _count(words: list[str]) -> dict[str, int]:
    out: dict[str, int] = {}
    for w in words:
        out[w] = out.get(w, 0) + 1
    return out


def _lengths(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([len(words_of(t)) for t in batch.column(1).to_pylist()], pa.int64())], ["words"])


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               threshold: float = 0.7, min_question: float = 0.5, min_answer: float = 0.8, max_postings: int = MAX_POSTINGS) -> DataFrame:
    """id, item_id, score, question_overlap, answer_overlap: a row for each leaked item of each row of ``docs``."""
    spark = docs.sparkSession
    out = f"`{id_col}` long, item_id long, score double, question_overlap double, answer_overlap double"
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    found = spark.createDataFrame([], out)
    for index in shards(benchmark, item_col, item_text_col, max_postings):
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                got = [(k, index.ids[i], s, q, a) for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
                       for i, s, q, a in search(index, t.as_py(), threshold, min_question, min_answer)]
                cols = list(zip(*got, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), *[pa.float64()] * 3], strict=True)], [id_col, "item_id", "score", "question_overlap", "answer_overlap"])

        found = found.unionByName(rows.mapInArrow(run, out))
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               threshold: float = 0.7, min_question: float = 0.5, min_answer: float = 0.8, max_postings: int = MAX_POSTINGS) -> DataFrame:
    """The rows of ``docs`` without a leak, decided where they lie."""
    at = docs.columns.index(text_col)
    for index in shards(benchmark, item_col, item_text_col, max_postings):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        @releasing
        def run(batches, shared=shared):
            # parts of a few texts, so that no second copy of a whole batch is held
            for part in (p for batch in batches for p in few(batch, at)):
                yield part.filter(pa.array([not search(shared.value, t.as_py(), threshold, min_question, min_answer) for t in part.column(at)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
