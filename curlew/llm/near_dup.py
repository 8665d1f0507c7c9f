"""Near-duplicate classes by BagMinHash.

A text is the multiset of its five-word shingles (lower-cased words). Each shingle
is an element with its count as weight. The weight axis is cut into the bands
[0,1), [1,2), [2,4), [4,8), ...; every band of every element has a Poisson process
of its own, with the band's width as rate, seeded by shingle and band alone. A point
has a time, a component of the signature and a place inside its band; a text counts
the point if the place lies below its weight, so a band that the weight covers in
part is split by the points' places, down to unit weight. A component of the
signature is the earliest time of its points: two texts agree in it with the
probability of their weighted Jaccard similarity. A shingle of count w costs log2 w
processes, and points are drawn in time order only until all components have one.

Texts with the same words form one group first (by digest, partial sums). The
signatures of the groups' first texts are banded: 40 bands of 6 components lose a
pair of similarity 0.8 with probability 5e-6. The hub of a bucket is the member that
meets the most others in all its buckets; each text is compared on the exact multisets with
the best hub of its buckets, its center, and linked texts join classes. Buckets whose members
are still in different classes do so with a second and third hub, one a text again, and
then those outside the bucket's largest class meet the members of other classes.

That last step is of all pairs that can still be linked, so no candidate is left out, but
texts are not compared where their differences from a common center H rule it out. With M
the shingles of H that a text lacks and E those that it has beyond H (as multisets),
overlap(u, v) = |H| - |M_u| - |M_v| + |M_u & M_v| + |E_u & E_v|. The lacking positions of H
are a mask of 512 bits, and shingles that no text of another class has cannot be in E_u & E_v,
so both last terms have bounds that need no texts: a group of copies with edits of their own
costs one comparison a text. Classes are connected components by minimum labels with
pointer jumping; each round is a written table.

Defined results: null and empty texts have no words and form one class (equal texts);
texts of fewer than five words are one shingle; rows that repeat an id, or have
none, are rows of their own, told apart by their place in the order of id and text;
an empty table gives an empty result; texts are read whole. Extra columns are kept by ``keep_first`` and ignored otherwise.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.llm.common import few, fresh, ordered_position, releasing, stored

SHINGLE = 5
BANDS, ROWS = 40, 6
#: Rounds of second hubs before the rest is compared.
HUB_ROUNDS = 2
COMPONENTS = BANDS * ROWS
_CACHE_LIMIT = 150_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _step(n: int) -> np.uint64:
    """n times the mixing constant, modulo 2**64."""
    return np.uint64(n * 0x9E3779B97F4A7C15 % 2**64)


def _stir(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """64-bit hashes of words, kept while there is room."""

    def __missing__(self, word: str) -> int:
        if len(self) > _CACHE_LIMIT:
            self.clear()
        digest = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        got = self[word] = int.from_bytes(digest, "little")
        return got


_words = _Words()


def shingle_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash for each five-word shingle, in order, repeats included."""
    if not words:
        return np.zeros(0, np.uint64)
    h = _stir(np.fromiter(map(_words.__getitem__, words), np.uint64, len(words)))
    n = max(1, len(words) - SHINGLE + 1)
    out = np.full(n, np.uint64(min(len(words), SHINGLE)))
    for k in range(min(SHINGLE, len(words))):
        out = _stir(out * _MIX + h[k:k + n])
    return out


def _draw(seed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-th points of the processes: waiting time (rate 1), component, place in [0,1)."""
    a = _stir(seed + _step(2 * n + 1))
    b = _stir(seed + _step(2 * n + 2))
    wait = -np.log(((a >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
    part = ((b >> np.uint64(32)) * np.uint64(COMPONENTS)) >> np.uint64(32)
    return wait, part.astype(np.int64), (b & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32


def signatures(hashes: np.ndarray, counts: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    """BagMinHash signatures (texts x components) of (shingle, count) elements, each of text ``owner``."""
    sig = np.full(n_texts * COMPONENTS, np.inf)
    if not len(hashes):
        return sig.reshape(n_texts, COMPONENTS)
    # one process for each band of the weight axis that the weight reaches
    seeds, low, width, weight, whose = [], [], [], [], []
    band, at = 0, np.arange(len(hashes))
    while len(at):
        start = 0 if band == 0 else 1 << (band - 1)
        at = at[counts[at] > start]
        seeds.append(_stir(hashes[at] + _step(band + 1)))
        low.append(np.full(len(at), float(start)))
        width.append(np.full(len(at), float(max(1, start))))
        weight.append(counts[at].astype(np.float64))
        whose.append(owner[at])
        band += 1
    seeds, low, width, weight, whose = (np.concatenate(x) for x in (seeds, low, width, weight, whose))
    # times beyond the limit of a text are not drawn; the limit doubles for texts with an empty component
    total = np.bincount(owner, weights=counts, minlength=n_texts)
    limit = (np.log(COMPONENTS) + 3) / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        at = np.flatnonzero(todo[whose])
        time, n = np.zeros(len(at)), 0
        while len(at):
            wait, part, place = _draw(seeds[at], n)
            time = time + wait / (COMPONENTS * width[at])
            early = time <= limit[whose[at]]
            at, time, part, place = at[early], time[early], part[early], place[early]
            inside = low[at] + place * width[at] < weight[at]
            np.minimum.at(sig, whose[at[inside]] * COMPONENTS + part[inside], time[inside])
            n += 1
        todo &= np.isinf(sig.reshape(n_texts, COMPONENTS)).any(axis=1)
        limit = np.where(todo, limit * 2, limit)
    return sig.reshape(n_texts, COMPONENTS)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    bits = sig.view(np.uint64).reshape(len(sig), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(sig), BANDS)).copy()
    for r in range(ROWS):
        key = _stir(key * _MIX + bits[:, :, r])
    return key.view(np.int64)


def _split(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def _multisets(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, count, owner) over all texts."""
    parts = [np.unique(shingle_hashes(w), return_counts=True) for w in texts]
    owner = np.repeat(np.arange(len(parts)), [len(h) for h, _ in parts])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *(h for h, _ in parts)]), np.concatenate([np.zeros(0, np.int64), *(c for _, c in parts)]), owner


@releasing
def _sign(batches):
    for whole in batches:
        # few texts at a time are held as words
        for batch in few(whole, 1):
            words = [_split(t) for t in batch.column(1).to_pylist()]
            digest = [hashlib.blake2b("\x1f".join(w).encode("utf-8", "surrogatepass"), digest_size=16).digest() for w in words]
            got = band_keys(signatures(*_multisets(words), len(words)))
            size = [max(1, len(w) - SHINGLE + 1) if w else 0 for w in words]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digest, pa.binary()), pa.array(size, pa.int32()), pa.array([k if w else [] for k, w in zip(got, words, strict=True)], pa.list_(pa.int64()))], ["doc_id", "digest", "n", "keys"])
    _words.clear()  # the worker goes on with other stages


#: Bits of the filter that tells which texts may be wanted (1 MB).
_FILTER = 1 << 23


def _wanted(ids: DataFrame) -> np.ndarray:
    """A filter over hashes of the ids, of a fixed size: the texts are read where
    they lie and those that no bucket holds are mostly passed by."""
    slot = F.pmod(F.xxhash64("id"), F.lit(_FILTER))
    words = ids.groupBy((slot / 32).cast("int").alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(pmod(xxhash64(id), {_FILTER}), 32) as int))")).alias("bits"))
    got = words.toPandas()
    out = np.zeros(_FILTER // 32, np.uint32)
    out[got["w"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).astype(np.uint32)
    return out


@releasing
def _shingled(batches, bits):
    for batch in batches:
        slot = batch.column(2).to_numpy()
        batch = batch.filter(pa.array((bits[slot // 32] >> (slot % 32).astype(np.uint32)) & np.uint32(1) == 1))
        for part in few(batch, 1):
            sets = [np.sort(shingle_hashes(_split(t.as_py()))).tobytes() for t in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["id", "bag"])
    _words.clear()


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted multisets."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    va, ca = np.unique(a, return_counts=True)
    vb, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    both = int(np.minimum(ca[ia], cb[ib]).sum())
    return both / (len(a) + len(b) - both)


@releasing
def _verified(batches):
    for batch in batches:
        sims = [overlap(np.frombuffer(x.as_py(), np.int64), np.frombuffer(y.as_py(), np.int64)) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sims, pa.float64())], ["a", "b", "similarity"])


def components(nodes: DataFrame, edges: DataFrame, name: str = "near") -> DataFrame:
    """id, label: the smallest id of each connected component. ``nodes`` (id, label)
    has the labels so far; ``edges`` (a, b). Each round takes the smallest label of the
    neighbours and then the label's own label; every round is a written table."""
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = stored(nodes, f"{name}-labels")
    if both.isEmpty():
        return labels
    while True:
        # a label moves to the smallest one that any of its members is linked to
        ends = both.join(labels.select(F.col("id").alias("a"), F.col("label").alias("la")), "a").join(labels.select(F.col("id").alias("b"), F.col("label").alias("lb")), "b")
        moves = stored(ends.where("lb < la").groupBy("la").agg(F.min("lb").alias("to")), f"{name}-moves")
        if moves.isEmpty():
            return labels
        further = moves.select(F.col("la").alias("to"), F.col("to").alias("to2"))
        moves = moves.join(further, "to", "left").select("la", F.coalesce("to2", "to").alias("to"))
        labels = stored(labels.join(moves, F.col("label") == F.col("la"), "left").select("id", F.coalesce("to", "label").alias("label")), f"{name}-labels")


def _similar(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """a, b, similarity of the pairs, on the exact multisets."""
    left = bags.select(F.col("id").alias("a"), F.col("bag").alias("bag_a"))
    right = bags.select(F.col("id").alias("b"), F.col("bag").alias("bag_b"))
    rows = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "bag_a", "bag_b")
    return rows.mapInArrow(_verified, "a long, b long, similarity double")


MASK_WORDS = 8
_CENTRED = "id long, center long, similarity double, met long, center_n long, mask array<long>"


def mask_of(h: np.ndarray, copies: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions of the sorted multiset ``h`` that a text lacks, which has ``copies`` of
    its ``counts`` equal shingles each; long multisets have several positions a bit."""
    bits = 64 * MASK_WORDS
    first = np.repeat(np.cumsum(counts) - counts, counts)
    at = np.flatnonzero(np.arange(len(h)) - first >= np.repeat(copies, counts))
    at = at * bits // len(h) if len(h) > bits else at
    mask = np.zeros(MASK_WORDS, np.uint64)
    np.bitwise_or.at(mask, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    return mask.view(np.int64)


@releasing
def _against_center(batches):
    """Each text (id, center, bag, bag of the center) against its center."""
    for batch in batches:
        out = []
        for bag, center in zip(batch.column(2), batch.column(3), strict=True):
            u, h = np.frombuffer(bag.as_py(), np.int64), np.frombuffer(center.as_py(), np.int64)
            (vu, cu), (vh, ch) = np.unique(u, return_counts=True), np.unique(h, return_counts=True)
            _, iu, ih = np.intersect1d(vu, vh, assume_unique=True, return_indices=True)
            copies = np.zeros(len(vh), np.int64)
            copies[ih] = np.minimum(cu[iu], ch[ih])
            met = int(copies.sum())
            out.append((met / (len(u) + len(h) - met), met, len(h), mask_of(h, copies, ch)))
        sims, met, size, masks = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sims, pa.float64()), pa.array(met, pa.int64()), pa.array(size, pa.int64()), pa.array(masks, pa.list_(pa.int64()))], ["id", "center", "similarity", "met", "center_n", "mask"])


def _centred(centers: DataFrame, bags: DataFrame) -> DataFrame:
    """id, center, similarity, met, center_n, mask of (id, center)."""
    left = bags.select("id", "bag")
    right = bags.select(F.col("id").alias("center"), F.col("bag").alias("center_bag"))
    rows = centers.select("id", "center").join(left, "id").join(right, "center").select("id", "center", "bag", "center_bag")
    return rows.mapInArrow(_against_center, _CENTRED)


@releasing
def _counted(batches):
    for batch in batches:
        for key, bag in zip(batch.column(0), batch.column(1), strict=True):
            value, count = np.unique(np.frombuffer(bag.as_py(), np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), key.as_py(), np.int64)), pa.array(value), pa.array(count)], ["id", "shingle", "c"])


def _mixed(inside: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold several classes, with the bucket's largest
    class (main) and smallest size (least)."""
    marked = inside.join(labels, "id")
    per = marked.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("least"))
    top = per.groupBy("key").agg(F.max(F.struct("c", "label")).alias("top"), F.count(F.lit(1)).alias("k"), F.min("least").alias("least")).where("k > 1")
    return stored(marked.join(top.select("key", F.col("top.label").alias("main"), "least"), "key"), "near-mixed")


def _second_hubs(mixed: DataFrame, threshold: float) -> DataFrame:
    """a, b: each text of a mixed bucket with the best of the buckets' members outside the largest
    class, if that is of another class than the text's own."""
    hub = mixed.where("label <> main").groupBy("key").agg(F.max(F.struct("meets", (-F.col("id")).alias("minus"), "n", "label")).alias("h"))
    hub = hub.select("key", F.col("h.meets").alias("hub_meets"), (-F.col("h.minus")).alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.label").alias("hub_label"))
    fits = F.least("n", "hub_n") >= threshold * F.greatest("n", "hub_n") - 1e-9
    pairs = mixed.join(hub, "key").where((F.col("label") != F.col("hub_label")) & fits)
    best = pairs.groupBy("id").agg(F.max(F.struct("hub_meets", (-F.col("hub")).alias("minus"))).alias("h")).select("id", (-F.col("h.minus")).alias("hub"))
    return best.select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct()


def _rest(mixed: DataFrame, bags: DataFrame, near: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """a, b: the pairs of one bucket and two classes that can still reach the
    threshold. Similarity s needs an overlap of s / (1 + s) of both sizes together.

    Shingles that no text of another class has cannot be in such an overlap, so a text's
    other shingles (``most``) bound it, and texts whose bound fails against the smallest
    size in their bucket go first. For two texts of one center the overlap also follows
    from their differences to it, of which the mask bounds M_u & M_v, and the shingles
    beyond the center that another class has (``extra``) bound E_u & E_v. 1 - similarity
    is a metric, so texts whose similarities to the center are further apart than
    1 - threshold cannot be that near either."""
    here = mixed.select(F.col("id").alias("h"), "label").distinct()
    counted = bags.join(here.select("h"), F.col("id") == F.col("h"), "left_semi").mapInArrow(_counted, "id long, shingle long, c long")
    counted = stored(counted.join(here, F.col("id") == F.col("h")).drop("h"), "near-counted")
    common = counted.groupBy("shingle").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("shingle")
    most = counted.join(common, "shingle", "left_semi").groupBy("id").agg(F.sum("c").alias("most"))
    share = F.lit(threshold / (1 + threshold))
    able = mixed.join(most, "id").where(F.col("most") >= share * (F.col("n") + F.col("least")) - 1e-6)
    center = labels.select(F.col("id").alias("center"), F.col("label").alias("center_label"))
    from_center = near.join(center, "center").withColumnRenamed("id", "h")
    able = able.join(from_center, F.col("id") == F.col("h")).drop("h")
    lacks = F.col("center_n") - F.col("met")
    beyond = F.col("n") - F.col("met")
    # what a text shares with a center of another class is common; the rest of ``most`` lies beyond the center
    extra = F.least(beyond, F.col("most") - F.when(F.col("label") != F.col("center_label"), F.col("met")).otherwise(0))
    able = stored(able.select("key", "id", "n", "label", "main", "most", "center", "center_n", "similarity", "mask", lacks.alias("lacks"), extra.alias("extra")), "near-able")

    def side(x: str, *more: str) -> DataFrame:
        names = {"id": x, "n": f"n{x}", "label": f"l{x}", "most": f"m{x}", "center": f"c{x}", "similarity": f"s{x}", "mask": f"mask{x}", "lacks": f"lacks{x}", "extra": f"extra{x}"}
        return able.select("key", *more, *[F.col(k).alias(v) for k, v in names.items()])

    u, v = side("u", "main").where("lu <> main").drop("main"), side("v", "main", "center_n")
    needs = share * (F.col("nu") + F.col("nv")) - 1e-6
    shared = F.lit(0)
    for i in range(MASK_WORDS):
        shared = shared + F.bit_count(F.col("masku")[i].bitwiseAND(F.col("maskv")[i]))
    width = F.ceil(F.col("center_n") / (64 * MASK_WORDS))  # positions a bit
    both_lack = F.least(shared * width, "lacksu", "lacksv")
    one_center = (F.col("center_n") - F.col("lacksu") - F.col("lacksv") + both_lack + F.least("extrau", "extrav") >= needs) & (F.abs(F.col("su") - F.col("sv")) <= 1 - threshold + 1e-9)
    can = (F.least("mu", "mv") >= needs) & (F.least("nu", "nv") >= threshold * F.greatest("nu", "nv") - 1e-9) & ((F.col("cu") != F.col("cv")) | one_center)
    meet = u.join(v, "key").where("lu <> lv AND (lv = main OR u < v)").where(can)
    return meet.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()


def classes(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest, class_id: a row for each row of ``docs``; ``class_id`` is the
    smallest id of the class. ``docs`` needs an id that is unique and not null."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = stored(rows.mapInArrow(_sign, "doc_id long, digest binary, n int, keys array<long>"), "near-signed")
    # texts of the same words: one group, whose first id stands for it
    groups = stored(signed.groupBy("digest").agg(F.min("doc_id").alias("id")), "near-groups")
    firsts = signed.join(groups.select("id"), F.col("doc_id") == F.col("id")).select("id", "n", "keys")
    member = stored(firsts.select("id", "n", F.explode("keys").alias("key")), "near-buckets")
    buckets = member.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stored(member.join(buckets, "key"), "near-shared")
    # the hub of a bucket: the member that meets the most others in all its buckets, as the origin of copies does
    meets = shared.groupBy("id").agg(F.sum("size").alias("meets"))
    inside = stored(shared.drop("size").join(meets, "id"), "near-members")
    hub = inside.groupBy("key").agg(F.max(F.struct("meets", (-F.col("id")).alias("minus"))).alias("hub"))
    hub = hub.select("key", F.col("hub.meets").alias("hub_meets"), F.col("hub.minus").alias("minus"))
    # the center of a text: the best hub of its buckets (itself, if it is that)
    centers = inside.join(hub, "key").groupBy("id").agg(F.max(F.struct("hub_meets", "minus")).alias("c")).select("id", (-F.col("c.minus")).alias("center"))
    bits = docs.sparkSession.sparkContext.broadcast(_wanted(inside.select("id")))
    slots = rows.withColumn("slot", F.pmod(F.xxhash64("doc_id"), F.lit(_FILTER)).cast("long"))
    bags = stored(slots.mapInArrow(lambda batches: _shingled(batches, bits.value), "id long, bag binary"), "near-bags")
    near = stored(_centred(centers, bags), "near-centred")
    pair = near.where("id <> center").select(F.least("id", "center").alias("a"), F.greatest("id", "center").alias("b"), "similarity").distinct()
    ids = groups.select("id", F.col("id").alias("label"))
    labels = components(ids, pair.where(F.col("similarity") >= threshold), "near")
    done = pair.select("a", "b")
    for n in range(HUB_ROUNDS + 1):
        mixed = _mixed(inside, labels)
        if mixed.isEmpty():
            break
        # second hubs, each outside the largest class of its bucket; at last the rest, exactly
        pairs = _second_hubs(mixed, threshold) if n < HUB_ROUNDS else _rest(mixed, bags, near, labels, threshold)
        pairs = stored(pairs.join(done, ["a", "b"], "left_anti"), "near-pairs")
        if pairs.isEmpty():
            continue
        labels = components(labels, _similar(pairs, bags).where(F.col("similarity") >= threshold), f"near-{n}")
        done = stored(done.unionByName(pairs), "near-done")
    named = groups.join(labels, "id").select("digest", F.col("label").alias("class_id"))
    return signed.select("doc_id", "digest").join(named, "digest").select(F.col("doc_id").alias(id_col), "digest", "class_id")


def _with_key(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """``docs`` and a column that is unique and not null: the id if it is, else the
    place in the order of id and text (nulls last)."""
    repeated = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("c")).where((F.col("c") > 1) | F.col(id_col).isNull())
    if repeated.isEmpty():
        return docs, id_col
    key = fresh(docs, "near_key")
    return ordered_position(docs, [F.col(id_col).asc_nulls_last(), F.md5(F.col(text_col))], key, "near-keyed"), key


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, class_size: a row for each row of ``docs``."""
    keyed, key = _with_key(docs.select(id_col, text_col), id_col, text_col)
    found = stored(classes(keyed, threshold, key, text_col).select(F.col(key).alias("row"), F.col("class_id").alias("label")), "near-classes")
    if key != id_col:
        found = keyed.select(F.col(key).alias("row"), id_col).join(found, "row")
    else:
        found = found.select("row", "label", F.col("row").alias(id_col))
    sizes = found.groupBy("label").agg(F.min(id_col).alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return found.join(sizes, "label").select(id_col, "class_id", "class_size")


def keep_first(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The first row of each class by id: the rows of ``docs`` less the others."""
    keyed, key = _with_key(docs, id_col, text_col)
    found = classes(keyed, threshold, key, text_col)
    gone = fresh(docs, "near_gone")
    others = stored(found.where(F.col(key) != F.col("class_id")).select(F.col(key).alias(gone)), "near-others")
    return keyed.join(others, F.col(key) == F.col(gone), "left_anti").select(*docs.columns)
