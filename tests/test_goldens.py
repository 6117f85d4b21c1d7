"""Hand-computed cases and statistical behaviour of the count-matrix operators."""

import math

import numpy as np
import pytest

from tallymesh.config import PipelineConfig
from tallymesh.operators import classify, cluster, integrate, linalg, metrics, neighbors, qc, rogue, umap


def pts(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v], b) for i, (v, b) in enumerate(rows)], "cell long, vec array<double>, batch string")


def nbrs(df, cell):
    return [r.nbr for r in df.where(f"cell = {cell}").orderBy("nbr_batch", "slot").collect()]


def test_batch_balanced_neighbours(spark):
    rows = [((0, 0), "a"), ((0.1, 0), "a"), ((5, 0), "a"), ((0, 0.1), "b"), ((0.2, 0), "b"), ((5.1, 0.1), "b")]
    k = neighbors.knn(pts(spark, rows), 2)
    assert nbrs(k, 0) == [0, 1, 3, 4]
    assert k.where("cell = 0 and nbr = 1").first().dist == pytest.approx(0.1)
    short = neighbors.knn(pts(spark, [((0,), "a"), ((1,), "a"), ((10,), "b")]), 2)
    assert nbrs(short.where("nbr_batch = 'b'"), 2) == [2]
    one = neighbors.knn(pts(spark, [((x,), "z") for x in (0, 0.5, 1, 2, 4)]), 3)
    assert nbrs(one, 0) == [0, 1, 2]


def test_blocks_do_not_change_neighbours(spark):
    rng = np.random.default_rng(0)
    p = pts(spark, [(v, "ab"[i % 2]) for i, v in enumerate(rng.normal(size=(150, 5)))])
    a, b = (sorted(map(tuple, neighbors.knn(p, 4, block=n).collect())) for n in (2048, 17))
    assert [x[:4] for x in a] == [x[:4] for x in b]
    truth, found = neighbors.knn(p, 10), neighbors.knn_ivf(p, 10, lists=8, probes=5)
    assert neighbors.recall(found, truth).first()[0] >= 0.9


@pytest.mark.parametrize("d,offset", [(20, 6.0), (8, 0.0)])
def test_inverted_lists_join_batches(spark, d, offset):
    """At default settings: k rows for every cell and batch, and 0.9 of the true neighbours."""
    rng = np.random.default_rng(8)
    rows = []
    for b, n in ((0, 900), (1, 900), (2, 2)):
        v = rng.normal(size=(n, d))
        v[:, 0] += offset * b
        rows += [(x, "abc"[b]) for x in v]
    p = pts(spark, rows)
    truth, found = neighbors.knn(p, 3).cache(), neighbors.batch_balanced(p, 3, "ivf").cache()
    count = lambda k: {(r.nbr_batch, r["count"]) for r in k.groupBy("nbr_batch").count().collect()}
    assert count(found) == count(truth) == {("a", 1802 * 3), ("b", 1802 * 3), ("c", 1802 * 2)}
    own = truth.join(p.select("cell", "batch"), "cell").where("batch != nbr_batch").drop("batch")
    assert neighbors.recall(found, truth).first()[0] >= 0.9
    assert neighbors.recall(found, own).first()[0] >= 0.9


def test_variable_genes_order(spark):
    """Median rank first; more batches decide ties only."""
    rng = np.random.default_rng(0)
    rows = []
    for b in range(2):
        for g in range(40):
            spread = 40.0 if g == b else 20.0 if g == 2 else 1.0
            rows += [(b * 100 + c, g, float(max(0.0, round(20 + spread * rng.normal())))) for c in range(60)]
    counts = spark.createDataFrame([r for r in rows if r[2]], "cell long, gene long, n double")
    cells = spark.createDataFrame([(b * 100 + c, str(b)) for b in range(2) for c in range(60)], "cell long, batch string")
    got = rogue.variable_genes(counts, cells, 10).orderBy("rank").collect()
    keys = [(r.median_rank, -r.n_batches, r.gene) for r in got]
    assert len(got) == 10 and keys == sorted(keys)
    assert any(a.n_batches < b.n_batches for a, b in zip(got, got[1:], strict=False))


def test_fuzzy_ring_and_symmetry(spark):
    ring = spark.createDataFrame([(i, (i + s) % 4, 1.0) for i in range(4) for s in (1, 3)], "cell long, nbr long, dist double")
    e = neighbors.fuzzy_graph(ring, 2).collect()
    assert len(e) == 8 and all(0 < r.w <= 1 for r in e)
    some = spark.createDataFrame([(0, 1, 0.5), (0, 2, 1.0), (1, 0, 0.5), (1, 3, 2.0), (2, 3, 0.1), (3, 0, 1.0)], "cell long, nbr long, dist double")
    w = {(r.i, r.j): r.w for r in neighbors.fuzzy_graph(some, 2).collect()}
    assert all(w[j, i] == pytest.approx(x, abs=1e-9) for (i, j), x in w.items())


def test_simpson():
    same = np.ones(6)
    assert metrics.simpson(same, np.array([0, 0, 0, 1, 1, 1]), 4) == pytest.approx(2.0, abs=1e-4)
    assert metrics.simpson(same, np.zeros(6, int), 4) == pytest.approx(1.0)
    assert metrics.simpson(np.array([0.1, 0.2, 0.3, 5, 5, 5]), np.array([0, 0, 0, 1, 1, 1]), 3) < 1.5


def test_graph_connectivity(spark):
    def score(edges, labels):
        e = spark.createDataFrame(edges, "cell long, nbr long")
        return metrics.graph_connectivity(e, spark.createDataFrame(list(enumerate(labels)), "cell long, label string")).agg({"share": "avg"}).first()[0]

    tri = [(0, 1), (1, 2), (2, 0)]
    assert score(tri, "aaa") == 1.0
    assert score(tri + [(a + 3, b + 3) for a, b in tri], "aaaaaa") == 0.5
    assert score([(0, 2), (1, 3), (2, 0), (3, 1)], "aabb") == 0.5
    assert score([(0, 1), (2, 3), (2, 2)], "aabb") == 1.0
    assert score([(0, 1), (2, 2)], "aabb") == 0.75


def test_kbet(spark):
    def chi(seen, sizes):
        ids = [b for b, n in sizes.items() for _ in range(n)]
        first = {b: ids.index(b) for b in sizes}
        rows = [(10**6, first[b] + i) for b, n in seen.items() for i in range(n)]
        return metrics.kbet_chi2(spark.createDataFrame(rows, "cell long, nbr long"), spark.createDataFrame(list(enumerate(ids)), "cell long, batch string")).first().chi2

    assert chi({"a": 2, "b": 2}, {"a": 50, "b": 50}) == pytest.approx(0)
    assert chi({"a": 4}, {"a": 50, "b": 50}) == pytest.approx(4)
    assert chi({"a": 2}, {"a": 50, "b": 50}) == pytest.approx(2)
    assert chi({"a": 4, "b": 2, "c": 2}, {"a": 50, "b": 25, "c": 25}) == pytest.approx(0)
    assert metrics.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert metrics.chi2_tail(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-9)


def test_entropy_table(spark):
    c = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (0, 2, 3.0), (1, 2, 4.0)], "cell long, gene long, n double")
    t = {r.gene: (r.mean_expr, r.entropy) for r in qc.entropy_table(c, 2).collect()}
    assert t[0] == pytest.approx((math.log(1.5), math.log(2) / 2))
    assert t[2] == pytest.approx((math.log(4.5), (math.log(4) + math.log(5)) / 2))


def test_rogue_score(spark):
    t = spark.createDataFrame([(1, 2.0, 0.01, 0.01), (1, 5.0, 0.5, 0.01), (1, -3.0, 0.01, 0.04), (2, 9.0, 0.5, 0.5)], "g int, ds double, p_adj double, p double")
    assert {r.g: r.rogue for r in rogue.score(t, ["g"]).collect()} == {1: pytest.approx(0.9), 2: 1.0}
    assert rogue.adjust(np.array([0.01, 0.04, 0.03, 0.5])) == pytest.approx([0.04, 0.0533333, 0.0533333, 0.5], abs=1e-6)
    x = np.linspace(0, 3, 80)
    assert rogue.loess(x, x * x - x, x, 0.5) == pytest.approx(x * x - x, abs=1e-8)


def test_silhouettes(spark):
    def width(d, labels):
        n = len(labels)
        rows = [(i, j, float(d[i][j])) for i in range(n) for j in range(n)]
        s = metrics.silhouettes_precomputed(spark.createDataFrame(rows, "i long, j long, d double"), spark.createDataFrame(list(enumerate(labels)), "cell long, label int"))
        return s.agg({"s": "avg"}).first()[0]

    pairs = [[0, 0.01, 10, 10], [0.01, 0, 10, 10], [10, 10, 0, 0.01], [10, 10, 0.01, 0]]
    assert width(pairs, [0, 0, 1, 1]) > 0.99
    assert width(pairs, [0, 0, 0, 0]) == 0
    rng = np.random.default_rng(3)
    x, lab = rng.normal(size=(60, 4)) + np.repeat([[0], [2], [4]], 20, axis=0), np.repeat([0, 1, 2], 20)
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    want = []
    for i in range(60):
        m = [d[i][(lab == c) & (np.arange(60) != i)].mean() for c in range(3)]
        a, b = m[lab[i]], min(m[c] for c in range(3) if c != lab[i])
        want.append((b - a) / max(a, b))
    p = spark.createDataFrame([(i, [float(v) for v in x[i]], str(lab[i]), "0") for i in range(60)], "cell long, vec array<double>, cluster string, part string")
    got = [r.s for r in metrics.silhouettes(p, block=13).orderBy("cell").collect()]
    assert got == pytest.approx(want, abs=1e-6)


def test_component_choice(spark):
    sv = spark.createDataFrame([(i + 1, float(s)) for i, s in enumerate([50, 40, 30, 20, 10] + [1] * 45)], "i int, s double")
    r = linalg.suggest(sv, 1000, 1000, 5, 15, 40).first()
    assert (r.above, r.suggested) == (5, 15)
    assert linalg.suggest(sv, 1000, 1000, 100, 15, 40).first().suggested == 40


def test_pca_against_svd(spark):
    rng = np.random.default_rng(1)
    x = rng.poisson(2, (60, 12)).astype(float)
    rows = [(i, j, float(v)) for i, r in enumerate(x) for j, v in enumerate(r) if v]
    v = spark.createDataFrame(rows, "cell long, gene long, value double")
    p = linalg.pca(v, spark.range(60).withColumnRenamed("id", "cell"), 5, max_value=None)
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    assert [r.s for r in p["sv"].orderBy("i").collect()] == pytest.approx(np.linalg.svd(z)[1][:5], abs=1e-6)
    e = np.array([r.vec for r in p["emb"].orderBy("cell").collect()])
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    assert np.abs(e) == pytest.approx(np.abs(u[:, :5] * s[:5]), abs=1e-6)


def test_low_rank_is_found(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8)) @ rng.normal(size=(8, 150)) + 0.05 * rng.normal(size=(400, 150))
    s = np.linalg.svd(x)[1][:60]
    sv = spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(s)], "i int, s double")
    assert abs(linalg.suggest(sv, 400, 150, 0, 1, 50).first().above - 8) <= 2


@pytest.mark.parametrize("n,d,offset", [(200, 10, 2.5), (150, 8, 1.5)])
def test_harmony_removes_a_batch_offset(spark, n, d, offset):
    rng = np.random.default_rng(2)
    rows = []
    for c in (-3, 3):
        for b in (0, 1):
            v = rng.normal(0, 0.3, (n, d))
            v[:, 0] += c
            v[:, 1] += offset * b
            rows += [(x, str(b)) for x in v]
    out = integrate.harmony(pts(spark, rows), theta=2.0, n_clusters=4).orderBy("cell").collect()
    z, b = np.array([r.vec for r in out]), np.array([int(r.batch) for r in out])
    side = np.repeat([0, 1], 2 * n)

    def gap(v):
        return max(np.linalg.norm(v[(b == 0) & (side == s)].mean(0) - v[(b == 1) & (side == s)].mean(0)) for s in (0, 1))

    before = np.array([v for v, _ in rows])
    assert gap(z) < 0.3 * gap(before)
    assert np.linalg.norm(z[side == 0].mean(0) - z[side == 1].mean(0)) > 2


def test_fast_mnn(spark):
    rng = np.random.default_rng(4)
    base = np.vstack([rng.normal(c, 0.1, (60, 6)) for c in (np.eye(6)[0] * 3, np.eye(6)[1] * 3)])
    rows = [(v, "a") for v in base] + [(v + np.eye(6)[2] * 1.0, "b") for v in base[::2] + rng.normal(0, 0.02, (60, 6))]
    out = np.array([r.vec for r in integrate.fast_mnn(pts(spark, rows), 10).orderBy("cell").collect()])
    unit = np.array([v / np.linalg.norm(v) for v, _ in rows])
    gap = lambda z: np.linalg.norm(z[:120].mean(0) - z[120:].mean(0))
    assert gap(out) < 0.3 * gap(unit)
    one = pts(spark, rows[:5])
    assert sorted(map(str, integrate.fast_mnn(one).collect())) == sorted(map(str, one.collect()))


def two_blobs(spark, n=200):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(n, 20))
    x[n // 2 :] += 5 / math.sqrt(20) * 4
    p = pts(spark, [(v, "0") for v in x])
    return p, neighbors.fuzzy_graph(neighbors.knn(p, 15))


def test_leiden_and_resolution(spark):
    p, e = two_blobs(spark)
    a, b = (sorted(map(tuple, cluster.sweep(e, p, [0.1, 0.5]).collect())) for _ in range(2))
    assert a == b
    best = cluster.pick_resolution(e, p, n=8)
    lab = {r.cell: r.cluster for r in best["labels"].collect()}
    assert len({lab[i] for i in range(100)}) == 1 and len({lab[i] for i in range(100, 200)}) == 1 and lab[0] != lab[150]
    assert best["curve"].where("picked").count() == 1


def test_large_graphs_are_contracted(spark, monkeypatch):
    """A graph beyond the limit: merged over its partitions first, with the same two clusters in the end."""
    p, e = two_blobs(spark)
    whole = e.count() + 200
    small, nodes = cluster.contracted(e, p, 1.0, whole // 4)
    assert small.count() + nodes.select("node").distinct().count() <= whole // 4
    assert nodes.count() == 200 and small.agg({"w": "sum"}).first()[0] == pytest.approx(e.agg({"w": "sum"}).first()[0])
    side = {r.cell: r.node for r in nodes.collect()}
    assert not {side[c] for c in range(100)} & {side[c] for c in range(100, 200)}
    monkeypatch.setattr(cluster, "MAX_EDGES", whole // 4)
    lab = {r.cell: r.cluster for r in cluster.sweep(e, p, [0.3]).collect()}
    assert len({lab[i] for i in range(100)}) == 1 and len({lab[i] for i in range(100, 200)}) == 1 and lab[0] != lab[150]
    with pytest.raises(ValueError, match="belong together"):
        cluster.contracted(e, p, 1e9, 10)


def test_embedding_silhouettes_and_parsimony(spark):
    p, _ = two_blobs(spark, 120)
    rows = [(g, i, c) for i in range(120) for g, c in ((0.1, 0), (0.5, int(i >= 60)), (1.0, i % 3))]
    got = {r.x: r for r in cluster.embedding_silhouettes(p, spark.createDataFrame(rows, "gamma double, cell long, cluster int"), 60, 3).collect()}
    assert got[0.1]["mean"] == 0 and got[0.5]["mean"] > 0.3 > 0.1 > got[1.0]["mean"] and 0 <= got[0.5].sd < 0.1
    table = spark.createDataFrame([(1.0, 0.5, 0.1), (2.0, 0.9, 0.05), (3.0, 0.86, 0.3), (4.0, 0.8, 0.5)], "x double, mean double, sd double")
    assert cluster.parsimony(table).first().x == 3.0
    up = spark.createDataFrame([(float(i), float(y)) for i, y in enumerate([1, 50, 80, 95, 100])], "x double, y double")
    down = up.withColumn("y", 101 - up["y"])
    assert cluster.bulge(up).first().x == 2.0 and cluster.bulge(down.withColumn("y", -down["y"])).first().x == 2.0


def test_equal_points_are_looked_at_k_times(spark):
    x = np.repeat([[0.0, 0.0], [1.0, 0.0], [0.0, 2.0]], [300, 2, 1], axis=0)
    ids, kept = neighbors._firsts(np.arange(303)[::-1].copy(), x, 3)
    assert sorted(ids.tolist()) == [0, 1, 2, 3, 4, 5] and len(kept) == 6
    found = neighbors.knn(pts(spark, [(v, "a") for v in x]), 4, block=64).groupBy("cell").agg({"nbr": "sum", "*": "count"}).collect()
    assert {(r["count(1)"], r["sum(nbr)"]) for r in found if r.cell < 300} == {(4, 0 + 1 + 2 + 3)}
    assert {(r["count(1)"], r["sum(nbr)"]) for r in found if 300 <= r.cell < 302} == {(4, 300 + 301 + 0 + 1)}


def test_hubs_do_not_fling_the_layout_apart():
    n = 4000
    i = np.concatenate([np.zeros(n - 1, np.int64), np.arange(1, n)])
    y = umap.layout(i, i[::-1].copy(), np.ones(len(i)), np.random.default_rng(0).normal(size=(n, 2)), *umap.fit_ab(), epochs=10)
    assert np.isfinite(y).all() and np.abs(y).max() < 100


def test_graphs_do_not_pass_through_the_driver(spark, monkeypatch):
    ring = [(a, (a + s) % 40, 1.0) for a in range(40) for s in (1, -1)]
    e, cells = spark.createDataFrame(ring, "i long, j long, w double"), spark.range(40).withColumnRenamed("id", "cell")

    def gathered(*_, **__):
        raise AssertionError("gathered on the driver")

    monkeypatch.setattr(type(e), "toArrow", gathered)
    monkeypatch.setattr(type(e), "collect", gathered)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", gathered)
    runs = cluster.sweep(e, cells, [0.3, 1.0])
    y = umap.umap(cells.selectExpr("cell", "array(double(cell)) AS vec"), e, epochs=3)
    monkeypatch.undo()
    assert runs.count() == 80 and y.count() == 40
    i, j, w = (np.array(x) for x in zip(*sorted(ring)))
    assert [r.cluster for r in runs.where("gamma = 1.0").orderBy("cell").collect()] == cluster.leiden(40, i, j, w, 1.0).tolist()


def test_rows_meet_the_genes_of_their_piece_alone(spark, monkeypatch):
    monkeypatch.setattr(linalg, "MAX_SIDE", 0)  # the side matrix is a table

    def whole(*_):
        raise AssertionError("a strip over all genes")

    monkeypatch.setattr(linalg.Side, "strip", whole)
    rng = np.random.default_rng(5)
    x = np.zeros((40, 2500))
    for c in range(40):
        x[c, rng.choice(100, 30, replace=False) + 60 * c] = rng.gamma(2, 1, 30)
    x[:, 0] += 1.0
    used = x[:, x.any(0)]
    values = spark.createDataFrame([(int(c), int(g), float(x[c, g])) for c, g in zip(*np.nonzero(x), strict=True)], "cell long, gene long, value double")
    found = linalg.sparse_svd(values, spark.range(40).withColumnRenamed("id", "cell"), 3, power=3)
    want = np.linalg.svd(used, compute_uv=False)[:3]
    assert np.allclose([r.s for r in found["sv"].orderBy("i").collect()], want, rtol=2e-2)
    assert found["emb"].count() == 40 and found["loadings"].count() == used.shape[1]
    emb = np.array([r.vec for r in found["emb"].orderBy("cell").collect()])
    load = np.array([r.vec for r in found["loadings"].orderBy("gene").collect()])
    assert np.abs(used @ load - emb).max() < 1e-9


def test_hull_does_not_follow_the_order_of_sums():
    p = [(1.0, 1.0), (0.5, 0.3), (0.5 + 1e-16, 0.3 - 1e-16), (0.2, 0.2), (0.2 - 1e-16, 0.2 - 1e-16)]
    for more in ((0, 0), (1e-15, -1e-15), (-1e-15, 1e-15)):
        q = [*p[:2], (p[2][0] + more[0], p[2][1] + more[1]), *p[3:]]
        assert cluster.hull(q) == [3, 1, 0]
        assert [x["on_hull"] for x in cluster.ranges(q, 0.05, 1.5)] == [True, True, False, True, False]


def test_hull_and_ranges():
    p = [(1.0, 1.0), (0.875, 0.5), (0.625, 0.25), (0.5, 0.375), (0.75, 0.375)]
    assert cluster.hull(p) == [2, 1, 0]  # the collinear point between is left out
    r = cluster.ranges(p, 0.05, 1.5)
    assert (r[0]["lo"], r[0]["hi"]) == (0.0, 0.25) and (r[1]["lo"], r[1]["hi"]) == (0.25, 1.0) and r[2]["hi"] == 1.5
    assert r[3]["width"] == -math.inf
    assert [x["lo"] for x in cluster.ranges([(1.0, 1.0), (0.5, 0.5)], 0.05, 1.5)] == [0.0, 1.0]


def test_self_assessment(spark):
    p, _ = two_blobs(spark, 120)
    from pyspark.sql import functions as F

    assert classify.self_assessment(p.withColumn("cluster", (F.col("cell") >= 60).cast("int"))) > 0.95
    assert classify.self_assessment(p.withColumn("cluster", F.lit(1))) == 1.0


@pytest.mark.parametrize("d,s,want", [(0.1, 1, (1.577, 0.8951)), (0.5, 1, (0.583, 1.334)), (0, 1, (1.929, 0.7915))])
def test_layout_kernel(d, s, want):
    assert umap.fit_ab(d, s) == pytest.approx(want, rel=0.02)


def test_layout_separates(spark):
    p, e = two_blobs(spark)
    y = np.array([(r.x, r.y) for r in umap.umap(p, e, epochs=100).orderBy("cell").collect()])
    assert np.isfinite(y).all()
    within = max(y[:100].std(0).max(), y[100:].std(0).max())
    assert np.linalg.norm(y[:100].mean(0) - y[100:].mean(0)) > within


def test_config():
    assert PipelineConfig(integration="all").integration_methods() == ("bbknn", "harmony", "fastmnn")
    assert len(PipelineConfig(integration="all+scvi").integration_methods()) == 4
    with pytest.raises(ValueError):
        PipelineConfig(integration="other").integration_methods()
    with pytest.raises(ImportError):
        integrate.scvi()


@pytest.mark.parametrize("name,value", [("fastmnn_n_threads", 3), ("plot_dir", "x"), ("scib_parallel", True), ("hvg_flavor", "cell_ranger"), ("max_leiden_workers", 2)])
def test_options_without_effect_are_refused(name, value):
    with pytest.raises(ValueError, match=name):
        PipelineConfig(**{name: value})


def test_dispersed_genes(spark):
    """Against the same steps over plain arrays."""
    rng = np.random.default_rng(3)
    x = rng.poisson(rng.gamma(2, 1, 60)[None, :] * rng.gamma(1 / rng.uniform(0.1, 2, 60), rng.uniform(0.1, 2, 60), (80, 60)), (80, 60)).astype(float)
    batch = np.arange(80) % 2
    rows = [(i, j, float(np.log1p(v))) for i, r in enumerate(x) for j, v in enumerate(r) if v]
    cells = spark.createDataFrame([(i, str(b)) for i, b in enumerate(batch)], "cell long, batch string")
    norms, first = np.zeros(60), np.zeros(60, int)
    for b in (0, 1):
        own = x[batch == b]
        mean, var = own.mean(0), own.var(0, ddof=1)
        there = np.flatnonzero(var > 0)
        m, disp = np.log1p(mean[there]), np.log(var[there] / mean[there])
        at = np.maximum(np.ceil((m - m.min()) / (m.max() - m.min()) * 20), 1)
        norm = np.array([1.0 if (at == at[i]).sum() == 1 else (disp[i] - disp[at == at[i]].mean()) / disp[at == at[i]].std(ddof=1) for i in range(len(there))])
        norms[there] += norm / 2
        first[there[np.lexsort((there, -norm))[:15]]] += 1
    want = np.lexsort((np.arange(60), -norms, -first))[:15].tolist()
    got = rogue.dispersed_genes(spark.createDataFrame(rows, "cell long, gene long, value double"), cells, 15).orderBy("rank").collect()
    assert [r.gene for r in got] == want and [r.dispersion for r in got] == pytest.approx(norms[want])


def test_spectral_start():
    """The second eigenvector of two blocks joined by a thread tells them apart."""
    rng = np.random.default_rng(0)
    m = (rng.random((60, 60)) < 0.3).astype(float)
    m[:30, 30:] = 0
    m = np.triu(m, 1)
    m[0, 59] = 1
    m = m + m.T
    i, j = np.nonzero(m)
    y = umap.spectral(60, i, j, m[i, j])
    s = 1 / np.sqrt(m.sum(1))
    want = np.linalg.eigh(s[:, None] * m * s[None])[1][:, -2:-4:-1]
    assert np.abs(y) == pytest.approx(np.abs(want), abs=1e-6)
    assert len({*np.sign(y[:30, 0])}) == 1 and len({*np.sign(y[30:, 0])}) == 1


def test_category_scores_and_pick(spark):
    m = spark.createDataFrame([("a", "ilisi", 0.5), ("a", "clisi", 1.0), ("b", "mean", 0.4), ("a", "mean", 0.4)], "route string, metric string, value double")
    r = {x.route: x.overall for x in metrics.category_scores(m).collect()}
    assert r["a"] == pytest.approx((0.35 * 0.5 + 0.45) / 0.8) and r["b"] is None
    assert metrics.pick_route(m, ["b", "a"]).first().route == "b"
    assert metrics.pick_route(m.where("metric != 'mean'"), ["b", "a"]).first().route == "a"


# ---------------------------------------------------------------- the steps over partitions against plain arrays


def entries(spark, x):
    i, j = np.nonzero(x)
    v = spark.createDataFrame([(int(a), int(b), float(x[a, b])) for a, b in zip(i, j, strict=True)], "cell long, gene long, value double")
    return v, spark.range(len(x)).withColumnRenamed("id", "cell")


@pytest.mark.parametrize("centre", [False, True])
def test_components_of_more_genes_than_a_side_matrix_may_have(spark, monkeypatch, centre):
    monkeypatch.setattr(linalg, "MAX_SIDE", 0)  # the side matrix is a table
    monkeypatch.setattr(linalg, "STRIP", 8 * 1500 * 7)
    rng = np.random.default_rng(8)
    x = (rng.normal(size=(90, 6)) * [40, 30, 22, 15, 9, 5]) @ rng.normal(size=(6, 1500)) * (rng.random((90, 1500)) < 0.2) + 0.0
    x[7] = 0  # a cell without entries
    x[:, 1100] = 0
    v = spark.createDataFrame([(i, j, float(x[i, j])) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(x)), strict=True)], "cell long, gene long, value double")
    cells = spark.range(90).withColumnRenamed("id", "cell")
    if centre:
        got, z = linalg.pca(v, cells, 5, max_value=None), np.delete(x, 1100, 1)
        z = (z - z.mean(0)) / z.std(0, ddof=1)
    else:
        got, z = linalg.sparse_svd(v, cells, 5), np.delete(x, 1100, 1)
    u, s, w = np.linalg.svd(z, full_matrices=False)
    assert [r.s for r in got["sv"].orderBy("i").collect()] == pytest.approx(s[:5], rel=1e-6)
    load = {r.gene: np.array(r.vec) for r in got["loadings"].collect()}
    assert sorted(load) == [g for g in range(1500) if g != 1100]
    load = np.array([load[g] for g in sorted(load)])
    assert np.abs(load.T @ load - np.eye(5)).max() < 1e-9
    assert (load[np.abs(load).argmax(0), range(5)] > 0).all()
    emb = {r.cell: r.vec for r in got["emb"].collect()}
    assert np.abs(np.array([emb[i] for i in range(90)]) - z @ load).max() < 1e-8 * s[0]
    assert np.abs(np.abs(load.T @ w[:5].T) - np.eye(5)).max() < 1e-2


@pytest.mark.parametrize("partitions,fill", [(1, 1 << 22), (7, 500)])
def test_sparse_svd(spark, monkeypatch, partitions, fill):
    """Whatever the partitions and stretches: values, loadings and projections of the matrix as it is."""
    rng = np.random.default_rng(3)
    x = rng.poisson(0.3, (150, 90)) * rng.gamma(2, 1, (1, 90))
    x[3] = 0  # a cell without entries
    monkeypatch.setattr(linalg, "FILL", fill)
    monkeypatch.setattr(linalg, "GENES", 32)
    v, cells = entries(spark, x)
    got = linalg.sparse_svd(v.repartition(partitions), cells, 12)
    u, s, w = np.linalg.svd(x, full_matrices=False)
    assert [r.s for r in got["sv"].orderBy("i").collect()] == pytest.approx(s[:12], rel=1e-3)
    e = np.array([r.vec for r in got["emb"].orderBy("cell").collect()])
    assert e.shape == (150, 12) and np.abs(e[:, :4]) == pytest.approx(np.abs(u[:, :4] * s[:4]), abs=0.05 * s[0] / 10)
    assert got["total_variance"] == pytest.approx((x * x).sum() / 149)
    load = {r.gene: r.vec for r in got["loadings"].collect()}
    m = np.array([load[g] for g in sorted(load)])
    assert m.T @ m == pytest.approx(np.eye(12), abs=1e-9) and (m[np.abs(m).argmax(0), np.arange(12)] > 0).all()


def test_components_of_many_genes(spark):
    """20,000 genes; scores are clipped and centred without spelling zeros out."""
    rng = np.random.default_rng(4)
    n, g = 120, 20_000
    group = rng.integers(0, 3, n)
    x = rng.poisson(0.02 + 0.4 * (np.arange(g)[None] % 3 == group[:, None]) * (rng.random(g) < 0.05)[None], (n, g)).astype(float)
    v, cells = entries(spark, x)
    got = linalg.pca(v, cells, 20, max_value=4.0)
    x = x[:, x.any(0)]
    z = np.clip((x - x.mean(0)) / x.std(0, ddof=1), -4, 4)
    s = np.linalg.svd(z)[1]
    assert [r.s for r in got["sv"].orderBy("i").collect()] == pytest.approx(s[:20], rel=0.01)
    assert got["total_variance"] == pytest.approx((z * z).sum() / (n - 1)) and got["loadings"].count() == x.shape[1]
    e = np.array([r.vec for r in got["emb"].orderBy("cell").collect()])
    assert (e * e).sum(0) == pytest.approx(s[:20] ** 2, rel=0.02)


def two_sided(n=150, d=8, offset=1.5):
    rng, rows = np.random.default_rng(2), []
    for c in (-3, 3):
        for b in (0, 1):
            v = rng.normal(0, 0.6, (n, d))
            v[:, 0] += c
            v[:, 1] += offset * b
            rows += [(x, str(b)) for x in v[: n // (1 + b)]]
    return rows


@pytest.mark.parametrize("cells", [50_000, 40])
def test_block_update(spark, monkeypatch, cells):
    """One block after another, over one partition or many: the objective falls, and ends no higher than that of all cells at once."""
    monkeypatch.setattr(integrate, "CELLS", cells)
    p, seen = pts(spark, two_sided()), {}
    for size in (0.05, 1.0):
        seen[size] = []
        out = integrate.harmony(p, theta=2.0, n_clusters=6, block_size=size, max_iter=1, trace=seen[size])
        assert out.count() == p.count() and out.columns == ["cell", "vec", "batch"]
    assert seen[0.05][-1] <= seen[1.0][-1] + 1e-3 * abs(seen[1.0][-1])
    assert seen[0.05][-1] < seen[0.05][1]
    with pytest.raises(ValueError, match="block_size"):
        integrate.harmony(p, block_size=0.0)
    assert PipelineConfig(harmony_block_size=0.2, pca_n_power_iter=3, pca_random_state=1).harmony_block_size == 0.2


def test_seeding_sees_all_cells(spark):
    """Far groups are found wherever they lie, and the same centres whatever the partitions."""
    rng = np.random.default_rng(5)
    middle = np.linalg.qr(rng.normal(size=(9, 9)))[0]
    size = [400, 300, 200, 3, 3, 2]  # three groups of a few cells
    x = np.vstack([m + rng.normal(0, 0.02, (n, 9)) for m, n in zip(middle, size, strict=False)])
    p = pts(spark, [(v, "0") for v in x]).select("cell", "vec")
    a, b = (integrate.seeded(p.repartition(n), 6, seed=1) for n in (1, 5))
    assert a == pytest.approx(b, abs=1e-6)
    assert sorted((a @ middle[:6].T).argmax(1)) == list(range(6)) and (a @ middle[:6].T).max(1).min() > 0.99


def test_mutual_pairs_in_lists(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(1500, 8))
    rows = [(v, "one") for v in base[:900]] + [(v + 0.1, "two") for v in base[600:]]
    p = pts(spark, rows)
    lists = tuple(integrate._lists(p.where(f"batch = '{b}'"), n) for b, n in (("one", 900), ("two", 900)))
    truth = {tuple(r) for r in neighbors.mutual_pairs(p, "one", "two", 10).collect()}
    found = {tuple(r) for r in neighbors.mutual_pairs(p, "one", "two", 10, lists).collect()}
    assert len(truth & found) >= 0.95 * len(truth) and len(found - truth) <= 0.05 * len(truth)
    whole = integrate.fast_mnn(p, 10, indexed=100).orderBy("cell").collect()
    exact = integrate.fast_mnn(p, 10).orderBy("cell").collect()
    gap = [np.linalg.norm(np.array(a.vec) - np.array(b.vec)) for a, b in zip(whole, exact, strict=True)]
    assert np.quantile(gap, 0.95) < 0.05


@pytest.mark.parametrize("block", [8192, 7])
def test_smoothing_is_the_weighted_mean(spark, monkeypatch, block):
    monkeypatch.setattr(integrate, "SMOOTHED", block)
    rng = np.random.default_rng(7)
    x, a, shift = (rng.normal(size=(n, 5)) for n in (40, 5000, 5000))
    x, a = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, a))
    cells = pts(spark, [(v, "b") for v in x])
    anchors = spark.createDataFrame([(i, i, u.tolist(), v.tolist()) for i, (u, v) in enumerate(zip(a, shift, strict=True))], "ref long, cell long, vec array<double>, shift array<double>")
    got = np.array([r.vec for r in integrate.smoothed(cells, anchors, 0.05).orderBy("cell").collect()])
    e = -((1 - x @ a.T) ** 2) / (2 * 0.05**2)
    w = np.exp(e - e.max(1, keepdims=True))
    assert got == pytest.approx(x + w @ shift / w.sum(1, keepdims=True), abs=1e-9)


def test_lists_answer_other_cells(spark):
    rng = np.random.default_rng(9)
    p = pts(spark, [(v, "ab"[i % 2]) for i, v in enumerate(rng.normal(size=(1200, 6)))])
    q = spark.createDataFrame([(10_000 + i, v.tolist()) for i, v in enumerate(rng.normal(size=(50, 6)))], "cell long, vec array<double>")
    found, truth = neighbors.knn_ivf(p, 5, queries=q), neighbors.knn(p, 5, queries=q)
    assert neighbors.recall(found, truth).first()[0] >= 0.9 and found.count() == truth.count() == 500


def test_loess_has_one_form(spark):
    """Vertices and Hermite pieces at every size; singular neighbourhoods are widened."""
    rng = np.random.default_rng(10)
    x = np.sort(rng.uniform(0, 4, 3000))
    y = np.sin(x) + rng.normal(0, 0.05, 3000)
    fit = rogue.loess(x, y, x, 0.5)
    assert np.abs(fit - np.sin(x)).max() < 0.05
    assert rogue.loess(x, y, x[:7], 0.5) == pytest.approx(fit[:7], abs=1e-12)  # where it is evaluated changes nothing
    direct, _ = rogue._fitted(x, y, x[::100], 0.5, 2)
    assert fit[::100] == pytest.approx(direct, abs=0.01)
    tied = np.repeat([0.0, 1.0, 2.0], [50, 3, 47])
    assert rogue.loess(tied, 2 * tied + 1, tied, 0.3) == pytest.approx(2 * tied + 1, abs=1e-6)
    assert rogue.loess(np.ones(9), np.arange(9.0), np.ones(2), 0.5).tolist() == [4.0, 4.0]


def purity(counts, n_cells, drop=2, k=45.0, min_cells=10):
    """The same steps on one group's counts in pandas."""
    import pandas as pd

    g = counts.groupby("gene")["n"]
    keep = g.transform("size") >= min(min_cells, n_cells)
    g = counts[keep].groupby("gene")["n"]

    def table(total, logs, n):
        return pd.DataFrame({"gene": total.index, "mean_expr": np.log(total.to_numpy() / n + 1.0), "entropy": logs.to_numpy() / n})

    first = rogue.fit_entropy(table(g.sum(), g.agg(lambda v: np.log1p(v).sum()), n_cells), 0.5)
    chosen = set(first.loc[first["p_adj"] < 0.05, "gene"])
    if chosen:
        big = counts[keep & counts["gene"].isin(chosen)].sort_values(["gene", "n"], ascending=[True, False])
        rest = big[big.groupby("gene").cumcount() >= drop].groupby("gene")["n"]
        trimmed = table(rest.sum(), rest.agg(lambda v: np.log1p(v).sum()), n_cells - drop)
        trimmed = trimmed[trimmed["mean_expr"] > first["mean_expr"].min()]
        first = rogue.fit_entropy(pd.concat([first[~first["gene"].isin(chosen)][["gene", "mean_expr", "entropy"]], trimmed]), 0.5)
    return rogue.score_table(first, k), len(chosen)


def test_purity_from_gene_tables(spark):
    rng = np.random.default_rng(11)
    mu = rng.gamma(2, 1.5, 120)
    x = rng.poisson(mu, (90, 120)).astype(float)
    x[:40, :6] *= rng.integers(0, 8, (40, 6))  # genes that spread widely
    rows = [(i, j, float(v)) for i, r in enumerate(x) for j, v in enumerate(r) if v]
    counts = spark.createDataFrame(rows, "cell long, gene long, n double")
    of = [("big", "s") if i < 60 else ("few", "t") if i < 84 else ("tiny", "s") for i in range(90)] + [("bare", "s")] * 12
    labels = spark.createDataFrame([(i, *g) for i, g in enumerate(of)], "cell long, cluster string, sample string")
    got = {r.cluster: r for r in rogue.per_cluster(counts, labels).collect()}
    assert (got["tiny"].score, got["tiny"].note, got["tiny"].n_cells) == (None, "small", 6)
    assert (got["bare"].score, got["bare"].note) == (None, "failed: too few genes")
    frame = counts.toPandas()
    seen = 0
    for name, lo, hi in (("big", 0, 60), ("few", 60, 84)):
        want, n = purity(frame[(frame["cell"] >= lo) & (frame["cell"] < hi)].assign(gene=frame["gene"].astype(str)), hi - lo)
        seen += n
        assert got[name].score == pytest.approx(want, abs=1e-9) and got[name].note == ""
    assert seen  # the trimmed refit took place
    t = rogue.fit_entropy(qc.entropy_table(counts, 90).toPandas(), adjusted=False)
    assert (t["p_adj"] == t["p"]).all()


def test_tails_and_indices_of_many_rows():
    x = np.array([0.0, 0.1, 2.0, 9.0, 50.0])
    for df in (1, 2, 3, 8, 11):
        v = np.linspace(1e-9, 400, 400_001)
        density = v ** (df / 2 - 1) * np.exp(-v / 2) / (2 ** (df / 2) * math.gamma(df / 2))
        for t in x[2:]:
            tail = density[v >= t].sum() * (v[1] - v[0])
            assert metrics.chi2_tails(np.array([t]), df)[0] == pytest.approx(tail, abs=2e-3)
    assert metrics.chi2_tails(x, 0).tolist() == [1.0] * 5
    d, c = np.array([[1.0, 1, 1, 1], [0.5, 2, 0, 0], [3, 0, 0, 0]]), np.array([[0, 1, 2, 3], [1, 0, -1, -1], [5, -1, -1, -1]])
    many = metrics.simpsons(d, c, 2.0)
    assert many[0] == pytest.approx(4.0) and many[2] == 1.0
    assert many[1] == pytest.approx(metrics.simpson(np.array([0.5, 2]), np.array([1, 0]), 2.0))


def test_picker_layout(spark):
    from tallymesh.plans.report import picker_layout

    xy = spark.createDataFrame([(r, i, float(i), -float(i)) for r in ("a", "b") for i in range(4)], "route string, cell long, x double, y double")
    knee = spark.createDataFrame([(r, i, i % 2) for r in ("a", "b") for i in range(4)], "route string, cell long, cluster int")
    champ = spark.createDataFrame([("a", i, i) for i in range(4)], "route string, cell long, cluster int")
    got = picker_layout(xy, {"knee": knee, "champ": champ}).collect()
    assert {(r.route, r.picker, r.k) for r in got} == {("a", "knee", 2), ("a", "champ", 4)} and len(got) == 8


def test_label_sources(spark):
    from tallymesh.plans.pipeline import given_labels

    cells = spark.createDataFrame([(1, "x", "kind")], "cell long, label string, `my label` string")
    pick = lambda key: given_labels(PipelineConfig(label_key=key), cells)
    assert pick("my label").first().label == "kind" and pick("other").first().label == "x" and pick(None) is None


def test_sixty_values_of_the_table(spark):
    """Sixty components of the given counts, each within a hundredth of the exact value."""
    from tallymesh.sources import tables as src

    d = "/root/testdata/sf0.01"
    cells = src.cells(spark, d)
    values = qc.lognorm(src.counts(spark, d)).toPandas()
    got = linalg.pca(qc.lognorm(src.counts(spark, d)), cells, 60)
    ids, genes = np.array(sorted(r.cell for r in cells.collect())), np.unique(values["gene"])
    x = np.zeros((len(ids), len(genes)))
    x[np.searchsorted(ids, values["cell"]), np.searchsorted(genes, values["gene"])] = values["value"]
    z = np.clip((x - x.mean(0)) / x.std(0, ddof=1), -10, 10)
    want = np.sqrt(np.linalg.eigvalsh(z @ z.T)[::-1][:60])
    assert [r.s for r in got["sv"].orderBy("i").collect()] == pytest.approx(want, rel=0.01)


def test_blocks_are_sent_once_per_group_and_ties_go_to_small_ids(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(8)
    x = rng.integers(0, 3, (900, 2)).astype(float)  # nine places of some hundred cells each
    x[7] = np.nan
    p = spark.createDataFrame([(i, v.tolist(), str(i % 2)) for i, v in enumerate(x)], "cell long, vec array<double>, batch string")
    sent = neighbors.block_pairs(p.withColumn("code", F.lit(0)).drop("batch"), 9).count()
    assert sent <= 100 * (2 * 8 + 2)  # all pairs of blocks were 10,000 rows
    got = {(r.cell, r.nbr_batch, r.slot): r.nbr for r in neighbors.knn(p, 3, block=100).collect()}
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        for b in range(2):
            own = np.arange(b, len(x), 2)
            want = own[np.lexsort((own, d[own]))][:3]
            assert [got[i, str(b), k] for k in (1, 2, 3)] == want.tolist()


def test_isolated_labels_are_scored_in_one_pass(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(9)
    x, lab, batch = rng.normal(size=(120, 3)), np.arange(120) % 4, np.arange(120) // 4 % 3
    batch[lab == 3] = np.arange(30) % 5
    p = spark.createDataFrame([(i, x[i].tolist(), int(lab[i]), int(batch[i])) for i in range(120)], "cell long, vec array<double>, label int, batch int")
    d, scores = np.linalg.norm(x[:, None] - x[None], axis=2), []
    for l in range(3):
        s = []
        for i in np.flatnonzero(lab == l):
            a, b = d[i][(lab == l) & (np.arange(120) != i)].mean(), d[i][lab != l].mean()
            s.append(((b - a) / max(a, b) + 1) / 2)
        scores.append(np.mean(s))
    assert metrics.isolated_asw(p).first()[0] == pytest.approx(np.mean(scores), abs=1e-9)
    sums = metrics.distance_sums(p.select("cell", "vec", F.col("label").alias("cluster"), F.lit("0").alias("part")), block=7)
    got = {(r.cell, r.cluster): (r.s, r.n) for r in sums.collect()}
    for i in range(120):
        for l in range(4):
            assert got[i, str(l)] == (pytest.approx(d[i][lab == l].sum(), abs=1e-9), (lab == l).sum() - (lab[i] == l))


def test_anchors_of_a_cell_pass_as_one(spark, monkeypatch):
    passed, own = {}, integrate.stage
    monkeypatch.setattr(integrate, "stage", lambda df, name, *a: passed.setdefault(name, own(df, name, *a)))
    rng = np.random.default_rng(11)
    x, a, shift, of = rng.normal(size=(30, 4)), rng.normal(size=(25, 4)), rng.normal(size=(500, 4)), np.arange(500) % 25
    x, a = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, a))
    anchors = spark.createDataFrame([(i, int(of[i]), a[of[i]].tolist(), v.tolist()) for i, v in enumerate(shift)], "ref long, cell long, vec array<double>, shift array<double>")
    got = np.array([r.vec for r in integrate.smoothed(pts(spark, [(v, "b") for v in x]), anchors, 0.3).orderBy("cell").collect()])
    w = np.exp(-((1 - x @ a[of].T) ** 2) / (2 * 0.3**2))
    assert got == pytest.approx(x + w @ shift / w.sum(1, keepdims=True), abs=1e-9)
    assert passed["shifts"].count() == 25


def test_self_assessment_fits_folds_side_by_side_on_few_partitions(spark, monkeypatch):
    import threading

    from pyspark.sql import functions as F

    all_three, parts, fit = threading.Barrier(3, timeout=60), [], classify.LogisticRegression.fit

    def seen(self, train, *args):
        parts.append(train.rdd.getNumPartitions())
        all_three.wait()  # breaks where one fold waits for another
        return fit(self, train, *args)

    monkeypatch.setattr(classify.LogisticRegression, "fit", seen)
    rng = np.random.default_rng(0)
    p = pts(spark, [(v + 9 * (i % 2), "a") for i, v in enumerate(rng.normal(size=(90, 2)))]).withColumn("cluster", F.col("cell") % 2).repartition(8)
    assert classify.self_assessment(p) == 1.0
    assert parts == [1, 1, 1]


def test_edge_counts_look_for_neighbours_once(spark, monkeypatch):
    from tallymesh import registry

    found, knn = [], neighbors.knn
    monkeypatch.setattr(neighbors, "knn", lambda *a, **k: found.append(1) or knn(*a, **k))
    got = registry.edge_counts(spark, "/root/testdata/sf0.001").first()
    assert got["n_slots"] == 9 * got["n_cells"] and got["n_edges"] >= got["n_slots"]
    assert found == [1]
