"""Operators 11 to 13 on small tables against plain versions: nulls, empty and long
texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import heapq
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from curlew.llm import merkle, phrases, sharding
from curlew.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["pos", "total", "tree", "page", "key", "node", "shard", "slot", "size", "group", "item", "h", "word", "f", "_pid", "shard_item"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(i, text, lang, source, n):
    return sha(*map(field, (i, source, lang, n, text)))


def tree(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [sha(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        levels.append(nodes)
    return levels


def way(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((i & 1, level[i ^ 1] if i ^ 1 < len(level) else None))
        i >>= 1
    return out


def plain_manifest(rows):
    """A row for each of ``rows``: id, leaf, subroot, root, proof, folded root, verified."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r))) for g in langs}
    levels = {g: tree([leaf(*r) for r in trees[g]]) for g in langs}
    forest = tree([levels[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(trees[g]):
            path = way(levels[g], i) + way(forest, k)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf(*r[:4], None if r[4] is None else r[4] + changed)
            for side, sib in path:
                node = sha(node) if sib is None else sha(sib, node) if side else sha(node, sib)
            root = forest[-1][0]
            out.append((r[0], leaf(*r), levels[g][-1][0], root, sha(*(s or "" for _, s in path)), node, node == root))
    return out


def manifest(df, levels=10):
    changed = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    got = merkle.verify(merkle.build(df, changed, {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}, levels=levels))
    return [tuple(r)[:6] + (r["verified"],) for r in got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]


def order(rows):
    return sorted(rows, key=repr)


def rows_of(n, seed=3):
    rng = np.random.default_rng(seed)
    langs = ["en", "de", None, "ñ", "z"]
    return [(int(i), None if i % 11 == 0 else "t é%d" % i, langs[int(rng.integers(0, 4))] if i % 5 else "en", None if i % 3 == 0 else "s", None if i % 13 == 0 else int(i)) for i in rng.permutation(n)]


@pytest.mark.parametrize("levels", [10, 2, 1])
def test_manifest_equals_plain_version(spark, levels):
    """Pages of four and of two leaves make many levels of pages."""
    rows = rows_of(157 if levels > 1 else 40) + [(999, "only", "z", None, 2**63 - 1)]
    assert order(manifest(spark.createDataFrame(rows, DOCS), levels)) == order(plain_manifest(rows))


def test_manifest_null_and_repeated_ids_and_one_row(spark):
    rows = [(None, "a", "en", "s", 1), (None, "b", "en", "s", 1), (4, "c", None, "s", 1), (4, "c", None, "s", 1), (4, "d", None, "s", 1), (2, None, "en", None, None)]
    assert order(manifest(spark.createDataFrame(rows, DOCS))) == order(plain_manifest(rows))
    one = [(7, "x " * 40_000, "en", "s", 1)]
    assert manifest(spark.createDataFrame(one, DOCS)) == plain_manifest(one)


def test_manifest_empty_table_and_clashing_names(spark):
    assert manifest(spark.createDataFrame([], DOCS)) == []
    rows = rows_of(20)
    df = spark.createDataFrame(rows, DOCS)
    for c in CLASHES:
        df = df.withColumn(c, F.lit("x"))
    assert order(manifest(df)) == order(plain_manifest(rows))


def test_versions_copy_only_the_way_to_the_root(spark):
    rows = rows_of(60)
    df = spark.createDataFrame(rows, DOCS)
    built = merkle.build(df, F.col("doc_id") == 17, {"text": F.lit("other")})
    got = {r["key"]: r for r in merkle.versions(built).collect()}
    levels = {}
    for g in {r[2] for r in rows}:
        levels[g] = tree([leaf(*r) for r in sorted((r for r in rows if r[2] == g), key=lambda r: r[0])])
    mine = next(r for r in rows if r[0] == 17)
    depth = len(levels[mine[2]]) - 1 + 2  # four languages: two levels more
    assert len(got[17]["copies"]) == depth and got[17]["copies"][-1] != got[17]["root"]
    # every other version is the first one: its nodes are those of the plain tree
    for r in rows:
        if r[0] != 17:
            assert got[r[0]]["copies"][-1] == got[r[0]]["root"]


def plain_differencing(sizes, ways):
    """Full tuples, members as sets."""
    heap = [(-s, i, sorted([(s, [i])] + [(0, [])] * (ways - 1), key=lambda x: -x[0])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        both = sorted(((x[0] + y[0], x[1] + y[1]) for x, y in zip(a, reversed(b))), key=lambda x: -x[0])
        heapq.heappush(heap, (both[-1][0] - both[0][0], n, both))
        n += 1
    return [s for s, _ in heap[0][2]]


@pytest.mark.parametrize("seed", range(6))
def test_differencing_equals_plain_version(seed):
    rng = np.random.default_rng(seed)
    sizes = sorted((int(x) for x in rng.integers(1, 10 ** int(rng.integers(1, 6)), int(rng.integers(1, 300)))), reverse=True)
    for ways in (1, 2, 3, 16):
        lane = sharding.differenced(sizes, ways)
        sums = Counter()
        for s, k in zip(sizes, lane):
            sums[k] += s
        got = sorted((sums[k] for k in range(ways)), reverse=True)
        assert sum(got) == sum(sizes)
        # equal lanes may be combined in another order: the spread is what counts
        want = plain_differencing(sizes, ways)
        assert got == want or got[0] - got[-1] <= max(want[0] - want[-1], min(sizes))


def check_shards(rows, df, task_items=sharding.TASK_ITEMS, shards=16):
    got = [r.asDict() for r in sharding.assign(df, shards, task_items=task_items).collect()]
    size = lambda t: len((t or "").encode()) + 1
    want = Counter((r[0], size(r[1]), zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((g["doc_id"], g["size"], g["text_crc32"]) for g in got) == want
    by = defaultdict(list)
    for g in got:
        assert 0 <= g["shard"] < shards
        by[g["shard"]].append(g)
    for k in by:
        assert sorted(g["slot"] for g in by[k]) == list(range(len(by[k])))
        ids = [g["doc_id"] for g in sorted(by[k], key=lambda g: g["slot"])]
        assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    where = defaultdict(set)
    for g in got:
        where[g["group"]].add(g["shard"])
    assert all(len(s) == 1 for s in where.values())
    groups = Counter()
    for r in rows:
        groups[r[1] or ""] += size(r[1])
    return sorted((sum(g["size"] for g in by[k]) for k in range(shards)), reverse=True), groups


@pytest.mark.parametrize("task_items, uneven", [(100_000, 0.001), (150, 0.03)])
def test_shards_are_level_and_groups_whole(spark, task_items, uneven):
    """Tasks of 150 items have lanes that are large against a shard."""
    rng = np.random.default_rng(8)
    rows = [(i, "x" * int(rng.pareto(1.2) * 60) + str(i), "en", "s", 0) for i in range(1500)]
    rows += [(5000 + i, "copy of a copy", "en", "s", 0) for i in range(600)] + [(None, None, "en", "s", 0), (None, "", "en", "s", 0), (3, "again", "en", "s", 0), (3, "again", "en", "s", 0)]
    loads, groups = check_shards(rows, spark.createDataFrame(rows, DOCS), task_items)
    # level, but for groups that are larger than a share
    free, left = 16, sum(loads)
    for s in sorted(groups.values(), reverse=True):
        if s <= left / free:
            break
        free, left = free - 1, left - s
    rest = loads[16 - free:]
    assert rest[0] - rest[-1] <= uneven * left / free + 16


def test_shards_of_few_empty_and_clashing(spark):
    assert sharding.assign(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(2, "a", "en", "s", 0), (1, "bb", "en", "s", 0), (9, "x" * 50_000, "en", "s", 0)]
    df = spark.createDataFrame(rows, DOCS)
    for c in CLASHES:
        df = df.withColumn(c, F.lit("x"))
    loads, _ = check_shards(rows, df)
    assert loads[:3] == [50_001, 3, 2] and not any(loads[3:])
    path = scratch_path(spark, "t-shards")
    sharding.write_shards(df, path)
    back = spark.read.parquet(path)
    assert sorted(back.select("doc_id", "text").collect()) == sorted((r[0], r[1]) for r in rows)
    assert back.select("shard_").distinct().count() == 3


def plain_phrases(rows, least, top, covered=50):
    total, f = Counter(), defaultdict(Counter)
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cands, found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}, []
        for p, a in cands.items():
            if len(p) == 2 and any(len(q) == 3 and p in (q[:2], q[1:]) and 100 * b >= covered * a for q, b in cands.items()):
                continue
            score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, le, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, le, r, total[lang], -s))
    return out


def phrase_rows(n=300, seed=2):
    rng = np.random.default_rng(seed)
    vocab = ["Ab", "the", "OF", "é", "ÀB", "x\x1cy", "zé", "日本", "a|b", "rare%d"]
    rows = []
    for i in range(n):
        w = [vocab[k] % rng.integers(0, 999) if "%" in vocab[k] else vocab[k] for k in rng.integers(0, len(vocab), 40)]
        text = "".join(x + str(rng.choice([" ", "  ", "\t", ". ", "\n", ",", "\r\n"], p=[.7, .1, .05, .05, .04, .03, .03])) for x in w)
        rows.append((i, text, [None, "en", "und", "fr"][int(rng.integers(0, 4))], "s", 0))
    return rows + [(900, None, "en", "s", 0), (901, "", "xx", "s", 0), (901, "the the the " * 3000, "en", "s", 0)] + [(902, "same line of words", "de", "s", 0)] * 12


@pytest.mark.parametrize("budget", [1 << 20, 40])
def test_phrases_equal_plain_version(spark, monkeypatch, budget):
    """A small budget makes most words heavy, so prefixes are extended by one and by two words."""
    monkeypatch.setattr(phrases, "BUDGET", budget)
    monkeypatch.setattr(phrases, "GROUPS", 1 << 30)
    rows = phrase_rows()
    df = spark.createDataFrame(rows, DOCS)
    for c in CLASHES:
        df = df.withColumn(c, F.lit("x"))
    got = [tuple(r) for r in phrases.collocations(df, 10, 25).collect()]
    assert sorted(got) == sorted(plain_phrases(rows, 10, 25))


def test_phrases_of_empty_tables(spark):
    assert phrases.collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert phrases.collocations(spark.createDataFrame([(1, None, "en", "s", 0), (2, "one two", "en", "s", 0)], DOCS)).collect() == []


def test_word_hashes_are_those_of_spark(spark):
    words = ["", "a", "é", "日本" * 20, "x" * 1000]
    for seed in (0, 1, 77):
        got = [r[0] & (2**64 - 1) for r in spark.createDataFrame([(w,) for w in words], "w string").select(phrases.word_hash(F.col("w"), seed)).collect()]
        assert got == phrases._hashes([w.encode() for w in words], seed).tolist()


def test_long_suffix_ids_take_two_steps():
    class Wide(phrases.Plan):
        pass

    n = (1 << 21) + 5
    words = " ".join("w%d" % i for i in range(n)).encode()
    plan = Wide(0, np.full(phrases.FILTER_BITS // 8, 255, np.uint8), np.ones(phrases.SLOTS, np.int64), 100, [])
    h1, h2, h3, c = phrases.suffixes(phrases.tokens([words + b" w0 w1 w2. w0 w1 w2"]), plan)
    assert len(h1) == n + 1 and c.sum() == n + 2 + 2 and sorted(c)[-2:] == [2, 3]
