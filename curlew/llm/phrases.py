"""Phrase collocations by vertical partitioning of the suffix tree of all word
sequences (as the ERA construction does it), cut at the depth of the longest phrase.

1. The words are counted per language (one pass, partial sums per chunk).
2. Prefixes (first words of suffixes) are grouped by a memory budget: the 65,536 slots of
   the words' 64-bit hashes are packed, in order, into groups of at most ``budget``
   occurrences. A word with more occurrences than the budget has groups of its own, where
   its prefix is extended by one word; where that word too has more, by two.
3. A second pass writes each suffix, cut after ``DEPTH`` words, at the end of its piece and
   before a word that is too rare to be in any candidate, to the group of its prefix, as
   sorted runs with counts.
4. Each group builds its subtree alone: its runs are sorted, so a node is a range of
   leaves with a common prefix, and its count the sum of its leaves. Nodes of at least
   ``least`` occurrences leave the task. Nodes of two words whose prefix was extended by two
   words have leaves in several groups; their sums are added up.
5. Candidates meet the counts of their parts, and are scored and ranked by joins.

A word is known by its hash. The words of the table are checked for equal hashes first;
if two share one, another seed is taken, so counts are exact.

Defined results: a null text is empty, a null language is ``und``; only the letters A-Z are
lower-cased; repeated rows count each; an empty table gives an empty result. Extra columns
are ignored.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curlew.llm.common import stored

DEPTH = 3
#: Occurrences of a group of prefixes: at most BUDGET, fewer where the tasks would else be
#: too few, more where the groups would be more than GROUPS.
BUDGET, GROUPS = 1 << 20, 1 << 18
SLOTS = 1 << 16
#: Bytes of text that are held as words at a time.
CHUNK = 8 << 20
#: Bits of the filter that tells which words may be frequent (2 MB).
FILTER_BITS = 1 << 24

#: Separators become ``.`` (no word holds one), tabs spaces, A-Z a-z.
_LEVEL = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t" + bytes(range(65, 91)), b"." * 10 + b" " + bytes(range(97, 123)))
_BREAK = b"."


def tokens(texts: list[bytes]) -> pa.DictionaryArray:
    """The words of the texts in order; ``.`` between pieces and between texts."""
    joined = _BREAK.join(texts).translate(_LEVEL).replace(_BREAK, b" . ")
    return pa.array(joined.split(), pa.binary()).dictionary_encode()


def _chunks(batches):
    """(lang, texts) of at most about CHUNK bytes each."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            held.setdefault(lang, []).append(raw)
            size[lang] = size.get(lang, 0) + len(raw) + 1
            if size[lang] >= CHUNK or sum(size.values()) >= 4 * CHUNK:
                yield lang, held.pop(lang)
                del size[lang]
    yield from held.items()


def _counted(batches):
    for lang, texts in _chunks(batches):
        found = tokens(texts)
        count = np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary))
        word = found.dictionary.cast(pa.string(), safe=False)
        keep = pa.compute.not_equal(word, _BREAK.decode())
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(word), pa.string()), word, pa.array(count, pa.int64())], ["lang", "word", "f"]).filter(keep)


def word_hash(word: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed).cast("long"), word)


def _hashes(words: list[bytes], seed: int) -> np.ndarray:
    start = xxhash.xxh64_intdigest(struct.pack("<q", seed), 42)
    return np.fromiter((xxhash.xxh64_intdigest(w, start) for w in words), np.uint64, len(words))


class Plan:
    """Where suffixes go: the group of each slot, and the words with groups of their own."""

    def __init__(self, seed: int, bits: np.ndarray, slots: np.ndarray, budget: int, heavy: list[tuple[int, int]]):
        self.seed, self.bits = seed, bits
        # slots in order, each group at most the budget
        group, used, now = np.zeros(SLOTS, np.int64), 0, 0
        for s in np.flatnonzero(slots):
            if used and used + slots[s] > budget:
                now, used = now + 1, 0
            group[s], used = now, used + slots[s]
        self.group = group
        self.heavy = np.array(sorted(h for h, _ in heavy), np.uint64)
        parts = dict(heavy)
        self.parts = np.array([-(-parts[int(h)] // budget) for h in self.heavy], np.int64)
        self.base = now + 1 + np.cumsum(self.parts) - self.parts

    def is_heavy(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.heavy):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.heavy, h), len(self.heavy) - 1)
        return self.heavy[at] == h, at

    def frequent(self, h: np.ndarray) -> np.ndarray:
        return (self.bits[(h % np.uint64(FILTER_BITS) // np.uint64(8)).astype(np.int64)] >> (h % np.uint64(8)).astype(np.uint8)) & 1 == 1

    def groups(self, h1: np.ndarray, h2: np.ndarray, h3: np.ndarray) -> np.ndarray:
        out = self.group[(h1 >> np.uint64(48)).astype(np.int64)]
        big, at = self.is_heavy(h1)
        both = big & self.is_heavy(h2)[0]
        mixed = (h2 ^ (h2 >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        mixed = np.where(both, (mixed ^ h3 ^ (h3 >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9), mixed) >> np.uint64(20)
        if len(self.heavy):
            out = np.where(big, self.base[at] + (mixed % self.parts[at].astype(np.uint64)).astype(np.int64), out)
        return out


def suffixes(found: pa.DictionaryArray, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(h1, h2, h3, count) of the distinct suffixes of two words or more, sorted within the chunk; h3 is 0 where the suffix ends."""
    words = found.dictionary.to_pylist()
    h = np.concatenate([_hashes(words, plan.seed), np.zeros(1, np.uint64)])
    good = plan.frequent(h)
    good[-1] = False
    good[:-1] &= np.array([w != _BREAK for w in words], bool)
    t = found.indices.to_numpy().astype(np.int64)
    none = len(words)
    t = np.concatenate([np.where(good[t], t, none), np.full(2, none)])
    first = np.flatnonzero((t[:-2] < none) & (t[1:-1] < none))
    a, b, c = t[first], t[first + 1], t[first + 2]
    size = none + 1
    if size < 1 << 21:
        key, n = np.unique((a * size + b) * size + c, return_counts=True)
        a, b, c = key // (size * size), key // size % size, key % size
    else:  # ids too large for one number: two steps
        pair, at = np.unique(a * size + b, return_inverse=True)
        key, n = np.unique(at * size + c, return_counts=True)
        a, b, c = pair[key // size] // size, pair[key // size] % size, key % size
    return h[a], h[b], h[c], n


def _dealt(batches, plan):
    plan = plan.value
    for lang, texts in _chunks(batches):
        h1, h2, h3, n = suffixes(tokens(texts), plan)
        group = plan.groups(h1, h2, h3)
        order = np.argsort(group, kind="stable")
        group = group[order]
        cut = np.flatnonzero(np.diff(group)) + 1
        starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(group)]])
        if not len(group):
            continue
        h1, h2, h3, n = h1[order], h2[order], h3[order], n[order].astype(np.uint64)
        for k in range(0, len(starts), 4096):
            some = list(zip(starts[k:k + 4096], ends[k:k + 4096], strict=True))
            runs = [b"".join(x[s:e].tobytes() for x in (h1, h2, h3, n)) for s, e in some]
            yield pa.RecordBatch.from_arrays([pa.array([group[s] for s, _ in some], pa.int64()), pa.array([lang] * len(some), pa.string()), pa.array(runs, pa.binary())], ["g", "lang", "run"])


def subtree(h1: np.ndarray, h2: np.ndarray, h3: np.ndarray, n: np.ndarray):
    """The nodes of two and of three words of the tree over the leaves: (h1, h2, sum) and (h1, h2, h3, sum)."""
    order = np.lexsort((h3, h2, h1))
    h1, h2, h3, n = h1[order], h2[order], h3[order], n[order]
    new2 = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
    new3 = new2 | np.concatenate([[True], h3[1:] != h3[:-1]])
    at2, at3 = np.flatnonzero(new2), np.flatnonzero(new3)
    whole = h3[at3] != 0
    return (h1[at2], h2[at2], np.add.reduceat(n, at2)), tuple(x[whole] for x in (h1[at3], h2[at3], h3[at3], np.add.reduceat(n, at3)))


_NODE = "lang string, h1 long, h2 long, h3 long, a long, part boolean"


def _subtrees(plan, least: int):
    def run(table: pa.Table) -> pa.Table:
        out = []
        for lang in table["lang"].unique().to_pylist():
            runs = [r.as_py() for r in table.filter(pa.compute.equal(table["lang"], lang))["run"]]
            parts = [np.frombuffer(r, np.uint64).reshape(4, -1) for r in runs]
            h1, h2, h3, n = np.concatenate(parts, axis=1)
            two, three = subtree(h1, h2, h3, n.astype(np.int64))
            part = plan.value.is_heavy(two[0])[0] & plan.value.is_heavy(two[1])[0]
            keep2, keep3 = part | (two[2] >= least), three[3] >= least
            for (x1, x2, x3, a, p) in ((*(x[keep2] for x in two[:2]), None, two[2][keep2], part[keep2]), (*(x[keep3] for x in three), np.zeros(keep3.sum(), bool))):
                third = pa.nulls(len(a), pa.int64()) if x3 is None else pa.array(x3.view(np.int64))
                out.append(pa.table([pa.array([lang] * len(a), pa.string()), pa.array(x1.view(np.int64)), pa.array(x2.view(np.int64)), third, pa.array(a, pa.int64()), pa.array(p)], ["lang", "h1", "h2", "h3", "a", "part"]))
        return pa.concat_tables(out)
    return run


def word_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """lang, word, f."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_counted, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _plan(words: DataFrame, seed: int, least: int) -> Plan:
    spark = words.sparkSession
    often = words.where(F.col("f") >= least).groupBy(word_hash(F.col("word"), seed).alias("h")).agg(F.sum("f").alias("f"))
    often = stored(often, "phrase-hashes")
    total = often.agg(F.sum("f")).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    budget = int(max(1, total // GROUPS, min(BUDGET, total // (4 * tasks))))
    # a heavy word has more than the budget, so there are at most GROUPS, or 4 a task, of them
    heavy = [(r["h"] & (2**64 - 1), r["f"]) for r in often.where(F.col("f") > budget).collect()]
    slot = F.shiftrightunsigned("h", 48)
    slots = np.zeros(SLOTS, np.int64)
    for r in often.where(F.col("f") <= budget).groupBy(slot.alias("s")).agg(F.sum("f").alias("f")).collect():
        slots[r["s"]] = r["f"]
    # bit k of the filter: a frequent word's hash has k as its last bits
    last = F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1))
    filled = often.groupBy(F.shiftright(last, 5).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast((h & {FILTER_BITS - 1}) & 31 as int))")).alias("bits")).toPandas()
    bits = np.zeros(FILTER_BITS // 32, np.uint32)
    bits[filled["w"].to_numpy(np.int64)] = filled["bits"].to_numpy(np.int64).astype(np.uint32)
    return Plan(seed, bits.view(np.uint8), slots, budget, heavy)


def _seed(words: DataFrame) -> int:
    """The first seed under which no two words of the table share a hash, nor has one 0."""
    seed = 0
    while True:
        met = words.groupBy(word_hash(F.col("word"), seed).alias("h")).agg(F.min("word").alias("x"), F.max("word").alias("y"))
        if met.where("x <> y OR h = 0").isEmpty():
            return seed
        seed += 1


def frequent_phrases(docs: DataFrame, least: int = 10, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame, int]:
    """The nodes (lang, h1, h2, h3, a) of the tree with at least ``least`` occurrences (h3
    is null for two words), the words (lang, word, f), and the seed of the hashes."""
    spark = docs.sparkSession
    words = stored(word_counts(docs, text_col, lang_col), "phrase-words")
    seed = _seed(words)
    plan = spark.sparkContext.broadcast(_plan(words, seed, least))
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    runs = rows.mapInArrow(lambda batches: _dealt(batches, plan), "g long, lang string, run binary")
    nodes = stored(runs.groupBy("g").applyInArrow(_subtrees(plan, least), _NODE), "phrase-nodes")
    sums = nodes.where("part").groupBy("lang", "h1", "h2", "h3").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return nodes.where("NOT part").drop("part").unionByName(sums), words, seed


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exact: counts below 10**15."""
    whole = "decimal(15,0)"
    return F.expr(f"cast((cast(1000000 as decimal(7,0)) * cast({a} as {whole}) * cast({a} as {whole})) div (cast({left} as {whole}) * cast({right} as {whole})) as long)")


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, covered: int = 50, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of two or three words of
    each language. A phrase is left out if a longer candidate around it has at least
    ``covered`` percent of its occurrences."""
    nodes, words, seed = frequent_phrases(docs, least, text_col, lang_col)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    often = stored(words.where(F.col("f") >= least).select("lang", word_hash(F.col("word"), seed).alias("h"), "word", "f"), "phrase-often")
    two = nodes.where("h3 IS NULL").select("lang", "h1", "h2", "a")
    three = nodes.where("h3 IS NOT NULL")

    def named(df: DataFrame, k: int) -> DataFrame:
        own = often.select("lang", F.col("h").alias(f"h{k}"), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"))
        return df.join(own, ["lang", f"h{k}"])

    # longer candidates around each pair
    around = three.select("lang", "h1", "h2", "a").unionByName(three.select("lang", F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
    around = around.groupBy("lang", "h1", "h2").agg(F.max("a").alias("longer"))
    pairs = two.join(around, ["lang", "h1", "h2"], "left").where(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))
    pairs = named(named(pairs, 1), 2).select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("a", "f1", "f2").alias("score"))
    head = two.select("lang", "h1", "h2", F.col("a").alias("f12"))
    tail = two.select("lang", F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23"))
    triples = three.join(head, ["lang", "h1", "h2"]).join(tail, ["lang", "h2", "h3"])
    triples = named(named(named(triples, 1), 2), 3)
    cut = F.least(F.struct(_score("a", "f1", "f23").alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("f23").alias("r")), F.struct(_score("a", "f12", "f3").alias("score"), F.lit(2).alias("k"), F.col("f12").alias("l"), F.col("f3").alias("r")))
    triples = triples.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", cut.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    best = pairs.unionByName(triples).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
