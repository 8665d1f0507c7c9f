import numpy as np
import pytest

from curlew.operators import similarity as S
from curlew.operators.cluster import butina_clusters, butina_copies, butina_sequential


def rand_bits(rng, n, nbits=64):
    out = []
    base = [sorted(rng.choice(nbits, rng.integers(3, 20), replace=False).tolist()) for _ in range(6)]
    for i in range(n):
        if i % 17 == 0:
            out.append([])                     # empty fingerprints
            continue
        b = set(base[rng.integers(0, 6)])
        b ^= set(rng.choice(nbits, rng.integers(0, 5)).tolist())
        out.append(sorted(b))
    return out


def brute(bits):
    sims = {}
    for i in range(len(bits)):
        for j in range(i + 1, len(bits)):
            a, b = set(bits[i]), set(bits[j])
            u = len(a | b)
            sims[(i, j)] = len(a & b) / u if u else 0.0
    return sims


@pytest.mark.parametrize("block_rows", [7, 50, 1000])
def test_pairs_exact(spark, block_rows):
    rng = np.random.default_rng(3)
    bits = rand_bits(rng, 90)
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bits)], "id long, bits array<int>")
    got = {(r.id_a, r.id_b): r.sim for r in S.tanimoto_pairs(df, 0.5, nbits=64, block_rows=block_rows).collect()}
    want = {k: v for k, v in brute(bits).items() if v >= 0.5}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_topn_and_hamming(spark):
    rng = np.random.default_rng(5)
    bits = rand_bits(rng, 60)
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bits)], "id long, bits array<int>")
    q, t = df.filter("id < 15"), df.filter("id >= 15")
    top = S.similarity_topn(q, t, 3, nbits=64, block_rows=8).collect()
    ham = S.similarity_topn(q, t, 3, nbits=64, block_rows=8, metric="hamming").collect()
    for i in range(15):
        cand = []
        for j in range(15, 60):
            a, b = set(bits[i]), set(bits[j])
            u = len(a | b)
            cand.append((-(len(a & b) / u if u else 0.0), j, len(a) + len(b) - 2 * len(a & b)))
        best = [j for _, j, _ in sorted(cand)[:3]]
        assert [r.tid for r in sorted((r for r in top if r.qid == i), key=lambda r: r["rank"])] == best
        hbest = [j for _, j in sorted((h, j) for _, j, h in cand)[:3]]
        assert [r.tid for r in sorted((r for r in ham if r.qid == i), key=lambda r: r["rank"])] == hbest


@pytest.mark.parametrize("seed", range(4))
def test_butina_rounds_equal_sequential(spark, seed):
    rng = np.random.default_rng(seed)
    n = 40
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, n, (60, 2)) if a < b]
    nodes = spark.createDataFrame([(i,) for i in range(n)], "id long")
    pdf = spark.createDataFrame(pairs or [(0, 0)], "id_a long, id_b long")
    got = {r.id: r.cluster_id for r in butina_clusters(nodes, pdf).collect()}
    assert got == butina_sequential(list(range(n)), pairs)
    cents = {v for v in got.values()}
    nb = {(a, b) for a, b in pairs} | {(b, a) for a, b in pairs}
    assert not any((a, b) in nb for a in cents for b in cents)     # independent set
    assert all(c == i or (i, c) in nb for i, c in got.items())     # member neighbours centroid


def test_copies_are_clustered_without_their_pairs(spark, monkeypatch):
    rng = np.random.default_rng(11)
    bits = rand_bits(rng, 60)
    rows = [(i, bits[i % 60]) for i in rng.permutation(180).tolist()] + [(7, bits[7]), (3, bits[20])]  # a row twice, an id with two texts
    df = spark.createDataFrame(rows, "id long, bits array<int>").repartition(4)
    classes, members, pairs = S.tanimoto_classes(df, 0.5, nbits=64, block_rows=16)
    assert pairs.count() < 60 * 60 / 2
    ids = sorted({i for i, _ in rows})
    near = {(min(i, j), max(i, j)) for i, a in rows for j, b in rows if i != j and a and len(set(a) & set(b)) >= 0.5 * len(set(a) | set(b))}
    got = {r.id: r for r in butina_copies(classes, members, pairs).collect()}
    assert {i: r.cluster_id for i, r in got.items()} == butina_sequential(ids, sorted(near))
    assert all(r.degree == sum(i in p for p in near) and r.is_centroid == (r.cluster_id == i) for i, r in got.items())
    assert {(r.id_a, r.id_b) for r in S.tanimoto_pairs(df, 0.5, nbits=64, block_rows=16).collect()} == near


@pytest.mark.parametrize("metric", ["tanimoto", "hamming"])
def test_rows_move_once_a_block_and_stay_packed(spark, monkeypatch, metric):
    """Several blocks and tiles, with copies on both sides; what is dealt out is a bit a
    position, once for each left block."""
    monkeypatch.setattr(S, "BLOCKS", 3)
    rng = np.random.default_rng(6)
    bits = [sorted(rng.choice(64, rng.integers(0, 30), replace=False).tolist()) for _ in range(150)]
    t = spark.createDataFrame([(i, bits[i % 150]) for i in range(400)], "id long, bits array<int>")
    q = spark.createDataFrame([(1000 + i, bits[(3 * i) % 150]) for i in range(70)], "id long, bits array<int>")
    seen = []
    met = S._met
    monkeypatch.setattr(S, "_met", lambda left, right, *a: seen.append((left.count(), right.count(), right.schema["__sig"].dataType.simpleString())) or met(left, right, *a))
    got = {}
    for r in S.similarity_topn(q, t, 4, nbits=64, block_rows=8, metric=metric).collect():
        got.setdefault(r.qid, {})[r["rank"]] = (r.tid, r.inter, r.sim)
    (queries, right, kind), = seen
    assert queries <= 50 and right <= 4 * 400 and kind == "binary"
    for i in range(70):
        a, want = set(bits[(3 * i) % 150]), []
        for j in range(400):
            b = set(bits[j % 150])
            inter = len(a & b)
            sim = len(a) + len(b) - 2 * inter if metric == "hamming" else inter / len(a | b) if a | b else 0.0
            want.append((sim if metric == "hamming" else -sim, j, inter, float(sim)))
        assert [got[1000 + i][r] for r in range(1, 5)] == [(j, inter, sim) for _, j, inter, sim in sorted(want)[:4]]


@pytest.mark.parametrize("cells", [None, 1000])
def test_density_curve(spark, cells):
    rng = np.random.default_rng(9)
    v = np.concatenate([rng.beta(2, 5, 300), rng.integers(0, 8, 100) / 8.0, [0.93]])
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "sim double").repartition(3)
    got = sorted((r.point, r.x, r.height) for r in S.density_curve(df, per_bandwidth=cells).collect())
    h = v.std(ddof=1) * len(v) ** -0.2
    x = np.linspace(v.min(), v.max(), 200)
    want = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(1) / (h * np.sqrt(2 * np.pi)) * (v.max() - v.min()) / 40
    assert [p for p, _, _ in got] == list(range(200))
    assert np.allclose([a for _, a, _ in got], x, atol=1e-12)
    assert np.abs(np.array([a for _, _, a in got]) / want - 1).max() < (1e-12 if cells is None else 1e-6)


def test_density_curve_without_spread(spark):
    for rows in ([], [(0.5,)], [(0.5,)] * 3, [(None,)]):
        assert S.density_curve(spark.createDataFrame(rows, "sim double")).count() == 0


def test_butina_moves_each_edge_once_and_drops_decided_ones(spark, monkeypatch):
    """What the rounds keep: an edge once, and only between undecided rows (F18, F22)."""
    from curlew.operators import cluster as CL

    kept, cut = [], CL.cut_lineage

    def counted(df):
        out = cut(df)
        if "dst" in out.columns:
            kept.append(out.count())
        return out

    monkeypatch.setattr(CL, "cut_lineage", counted)
    pairs = [(i, j) for i in range(12) for j in range(i + 1, 12)] + [(i, i + 1) for i in range(20, 40)] + [(7, 7), (3, 2)]
    ids = [*range(12), *range(20, 41), 50]
    nodes = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r.id: r for r in butina_clusters(nodes, spark.createDataFrame(pairs, "id_a long, id_b long")).collect()}
    real = sorted({(min(p), max(p)) for p in pairs if p[0] != p[1]})
    assert {i: r.cluster_id for i, r in got.items()} == butina_sequential(ids, real)
    assert {i: r.degree for i, r in got.items()} == {i: sum(i in p for p in real) for i in ids}
    assert kept[0] == len(real) and kept[1] <= 20 and kept[-1] == 0 and kept == sorted(kept, reverse=True)


def test_histogram_runs_what_is_behind_it_once(spark):
    """The search behind the similarities is not run again for their range (F7)."""
    runs = spark.sparkContext.accumulator(0)

    def read(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    v = [0.0, 0.1, 0.1, 0.25, 0.5, 0.5, 0.5, 1.0]
    sims = spark.createDataFrame([(x,) for x in v], "sim double").mapInArrow(read, "sim double")
    got = sorted((r.bin, r.lo, r.hi, r["count"]) for r in S.similarity_histogram(sims, bins=4).collect())
    assert got == [(0, 0.0, 0.25, 3), (1, 0.25, 0.5, 1), (2, 0.5, 0.75, 3), (3, 0.75, 1.0, 1)]
    assert runs.value == len(v)


def test_chart_has_bins_curve_and_lines(spark):
    """The histogram's chart is whole: bins, density curve, mean and median (F21)."""
    v = np.random.default_rng(2).beta(2, 5, 61)
    df = spark.createDataFrame([(float(x),) for x in v], "sim double")
    got = {}
    for r in S.similarity_chart(df).collect():
        got.setdefault(r.part, []).append(r)
    assert {k: len(rows) for k, rows in got.items()} == {"bin": 40, "curve": 200, "mean": 1, "median": 1}
    assert [r["count"] for r in sorted(got["bin"], key=lambda r: r.nth)] == np.histogram(v, 40)[0].tolist()
    curve = {r.point: (r.x, r.height) for r in S.density_curve(df).collect()}
    assert all((r.lo, r.height) == pytest.approx(curve[r.nth]) and r.lo == r.hi for r in got["curve"])
    assert got["mean"][0].lo == pytest.approx(v.mean()) and got["median"][0].hi == pytest.approx(np.median(v))
    assert S.similarity_chart(df.limit(0)).count() == 0


@pytest.mark.parametrize("nbits, rows", [(2048, 1), (2048, 7), (2048, 300), (4095, 5), (4096, 5), (64, 2)])
def test_two_rows_share_a_lane(nbits, rows):
    """A product carries the counts of two right rows, exactly, up to full fingerprints (F8 to F13)."""
    rng = np.random.default_rng(rows)
    left, right = (rng.random((n, nbits)) < p for n, p in ((9, 0.7), (rows, 0.4)))
    left[0], right[0], right[-1] = True, True, True
    dense = right.astype(np.float32)
    lanes = S._lanes(dense)
    assert len(lanes) == (rows if nbits >= S.LANE else -(-rows // 2)) and (dense == right).all()
    assert (S._inter(left.astype(np.float32), lanes, rows) == left.astype(int) @ right.T.astype(int)).all()
