"""Queries over the driver's tables and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .operators import classify, cluster, integrate, linalg, metrics, neighbors, qc, rogue, umap
from .plans.staging import stage
from .sources import tables as src

QUERIES: dict = {}
ORACLES: dict = {}

_COUNTS = "counts AS (SELECT o_custkey AS cell, l_partkey AS gene, sum(l_quantity) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"
_CELLS = "cells AS (SELECT c_custkey AS cell, c_mktsegment AS batch, n_regionkey AS label FROM customer JOIN nation ON c_nationkey = n_nationkey)"
_GENES = "genes AS (SELECT p_partkey AS gene, p_name AS name, starts_with(upper(p_name), 'BLUE') AS is_mt FROM part)"
_EMB = "emb AS (SELECT vec_id AS cell, embedding::DOUBLE[] AS vec, (vec_id % 3)::INT AS batch, label FROM embeddings)"
_N = "(SELECT count(*) FROM cells)"
_LIB = "lib AS (SELECT cells.cell, coalesce(sum(n), 0) AS lib FROM cells LEFT JOIN counts USING (cell) GROUP BY 1)"
_MT = "mt AS (SELECT cells.cell, 100 * coalesce(sum(n) FILTER (is_mt), 0) / CASE WHEN coalesce(sum(n), 0) = 0 THEN 1 ELSE sum(n) END AS pct_mt FROM cells LEFT JOIN (counts JOIN genes USING (gene)) USING (cell) GROUP BY 1)"
_NORM = "norm AS (SELECT cell, gene, ln(1 + n * 1e4 / sum(n) OVER (PARTITION BY cell)) AS value FROM counts)"
_ENT = f"ent AS (SELECT gene, ln(sum(n) / {_N} + 1) AS mean_expr, sum(ln(n + 1)) / {_N} AS entropy FROM counts GROUP BY 1)"
_PAIR = "pair AS (SELECT a.cell, a.batch AS cell_batch, b.batch AS nbr_batch, b.cell AS nbr, list_distance(a.vec, b.vec) AS dist FROM emb a, emb b)"
_KNN3 = "knn AS (SELECT cell, nbr_batch, slot, nbr, dist FROM (SELECT *, row_number() OVER (PARTITION BY cell, nbr_batch ORDER BY dist, nbr) AS slot FROM pair) WHERE slot <= 3)"
_KNN10 = "knn AS (SELECT cell, slot, nbr, dist FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY dist, nbr) AS slot FROM pair) WHERE slot <= 10)"
# a graph with weights by rank: 1 / slot, symmetric by p + q - pq
_EDGES = "dir AS (SELECT cell AS i, nbr AS j, 1.0::DOUBLE / slot AS w FROM knn WHERE cell != nbr), edges AS (SELECT coalesce(p.i, q.j) AS i, coalesce(p.j, q.i) AS j, coalesce(p.w, 0) + coalesce(q.w, 0) - coalesce(p.w, 0) * coalesce(q.w, 0) AS w FROM dir p FULL JOIN dir q ON p.i = q.j AND p.j = q.i)"
# fixed labelings of the embeddings, some of them equal: partition g groups labels modulo g
_PARTS = "parts AS (SELECT g * 0.2::DOUBLE AS gamma, cell, (CASE WHEN g = 8 THEN label % 4 WHEN g = 9 THEN label % 6 ELSE label % g END)::INT AS cluster FROM emb, range(1, 10) t(g))"
_TABLE = "tab AS (SELECT p_partkey AS gene, p_brand AS cluster, p_retailprice / 1000 AS ds, (p_size % 7) / 70.0::DOUBLE AS p, (p_partkey % 100) / 500.0::DOUBLE AS p_adj FROM part)"
# the sixty largest of the parts' quantities: a falling curve as singular values are
_SV = "sv AS (SELECT row_number() OVER (ORDER BY q DESC, k)::INT AS i, q::DOUBLE AS s FROM (SELECT l_partkey AS k, sum(l_quantity) AS q FROM lineitem GROUP BY 1) QUALIFY i <= 60)"
_METRICS = "metrics AS (SELECT 'route' || (p_partkey % 4) AS route, ['ilisi','clisi','graph_connectivity','label_silhouette','batch_silhouette','isolated_label','rogue_mean','sccaf','mean'][1 + CAST(p_partkey // 4 % 9 AS INT)] AS metric, sum(CAST(round(p_retailprice * 100) AS BIGINT)) / 250000.0::DOUBLE / count(*) AS value FROM part GROUP BY 1, 2)"


def _query(sql: str | None = None, *ctes: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = f"WITH {', '.join(ctes)} {sql}" if ctes else sql
        return f

    return add


def _r(name: str, digits: int = 6):
    return F.round(name, digits).alias(name)


def _all(s: SparkSession, d: str):
    return src.counts(s, d), src.cells(s, d), src.genes(s, d)


# ---------------------------------------------------------------- counts


@_query("SELECT cell, gene, n FROM counts WHERE gene IN (SELECT gene FROM counts WHERE n > 0 GROUP BY 1 HAVING count(*) >= 5) AND cell IN (SELECT cell FROM counts WHERE n > 0 GROUP BY 1 HAVING count(*) >= 20) AND cell IN (SELECT cell FROM mt WHERE pct_mt <= 20)", _COUNTS, _CELLS, _GENES, _MT)
def qc_filter(s, d):
    return qc.qc_filter(*_all(s, d), min_cells=5, min_genes=20, max_pct_mt=20.0)


@_query("SELECT cell, lib FROM lib", _COUNTS, _CELLS, _LIB)
def library_size(s, d):
    return qc.library_size(src.counts(s, d), src.cells(s, d))


@_query("SELECT cell, round(pct_mt, 6) AS pct_mt FROM mt", _COUNTS, _CELLS, _GENES, _MT)
def mt_fraction(s, d):
    return qc.mt_fraction(*_all(s, d)).select("cell", _r("pct_mt"))


@_query("SELECT gene, count(*) AS n_cells FROM counts WHERE n > 0 GROUP BY 1", _COUNTS)
def cells_per_gene(s, d):
    return qc.cells_per_gene(src.counts(s, d))


@_query("SELECT cell, gene, n FROM g WHERE cell IN (SELECT cell FROM g GROUP BY 1 HAVING count(*) >= 25)", _COUNTS, "g AS (SELECT * FROM counts WHERE gene IN (SELECT gene FROM counts GROUP BY 1 HAVING count(*) >= 20))")
def matrix_filter(s, d):
    return qc.matrix_filter(src.counts(s, d), 20, 25)


@_query("SELECT cell, gene, round(value, 6) AS value FROM norm", _COUNTS, _NORM)
def lognorm(s, d):
    return qc.lognorm(src.counts(s, d)).select("cell", "gene", _r("value"))


@_query("SELECT cell, gene, round(least(greatest((value - mean) / sd, -10), 10), 5) AS z, round(least(greatest(-mean / sd, -10), 10), 5) AS z_zero FROM norm JOIN st USING (gene)", _COUNTS, _CELLS, _NORM, f"st AS (SELECT gene, sum(value) / {_N} AS mean, CASE WHEN greatest(sum(value * value) - sum(value) * sum(value) / {_N}, 0) / ({_N} - 1) > 1e-24 THEN sqrt(greatest(sum(value * value) - sum(value) * sum(value) / {_N}, 0) / ({_N} - 1)) ELSE 1 END AS sd FROM norm GROUP BY 1)")
def gene_scale_clip(s, d):
    return qc.scale(qc.lognorm(src.counts(s, d)), src.cells(s, d).count()).select("cell", "gene", _r("z", 5), _r("z_zero", 5))


@_query("SELECT batch, count(*) AS n_cells FROM cells GROUP BY 1", _CELLS)
def batch_census(s, d):
    return qc.batch_census(src.cells(s, d))


@_query("SELECT cell, label::VARCHAR AS label, (dense_rank() OVER (ORDER BY label::VARCHAR) - 1)::INT AS code FROM cells", _CELLS)
def label_codes(s, d):
    return qc.label_codes(src.cells(s, d))


@_query("SELECT cell, batch, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(cell::VARCHAR), cell) AS r FROM cells) WHERE r <= 20", _CELLS)
def stratified_sample(s, d):
    return qc.stratified_sample(src.cells(s, d), 20)


@_query("SELECT gene, round(mean_expr, 6) AS mean_expr, round(entropy, 6) AS entropy FROM ent", _COUNTS, _CELLS, _ENT)
def entropy_table(s, d):
    return qc.entropy_table(src.counts(s, d), src.cells(s, d).count()).select("gene", _r("mean_expr"), _r("entropy"))


@_query(f"SELECT gene, round(ln(sum(m) / ({_N} - 2) + 1), 6) AS mean_expr, round(sum(ln(m + 1)) / ({_N} - 2), 6) AS entropy FROM (SELECT gene, CASE WHEN row_number() OVER (PARTITION BY gene ORDER BY n DESC, cell) > 2 THEN n ELSE 0 END AS m FROM counts) GROUP BY 1", _COUNTS, _CELLS)
def trimmed_entropy(s, d):
    return qc.trimmed_means(src.counts(s, d), src.cells(s, d).count()).select("gene", _r("mean_expr"), _r("entropy"))


# ---------------------------------------------------------------- purity


def _given(s, d):
    p = src.read(s, d, "part")
    return p.select(F.col("p_partkey").alias("gene"), F.col("p_brand").alias("cluster"), (F.col("p_retailprice") / 1000).alias("ds"), ((F.col("p_size") % 7) / 70.0).alias("p"), ((F.col("p_partkey") % 100) / 500.0).alias("p_adj"))


@_query("SELECT cluster, round(1 - s / (s + 45), 6) AS rogue FROM (SELECT cluster, sum(CASE WHEN p_adj < 0.05 AND p < 0.05 THEN abs(ds) ELSE 0 END) AS s FROM tab GROUP BY 1)", _TABLE)
def rogue_score_given_table(s, d):
    return rogue.score(_given(s, d), ["cluster"]).select("cluster", _r("rogue"))


@_query("SELECT round(sum(ds) / 2, 6) AS k FROM tab WHERE p_adj < 0.05 AND p < 0.05", _TABLE)
def rogue_k(s, d):
    return rogue.determine_k(_given(s, d)).select(_r("k"))


@_query("SELECT id, round(p, 9) AS p, round(least(1, min(q) OVER (ORDER BY p DESC, id DESC)), 9) AS p_adj FROM (SELECT *, p * (SELECT count(*) FROM part) / row_number() OVER (ORDER BY p, id) AS q FROM (SELECT p_partkey AS id, (p_partkey * 7919 % 10007) / 10007.0::DOUBLE AS p FROM part))")
def bh_fdr(s, d):
    p = src.read(s, d, "part").select(F.col("p_partkey").alias("id"), ((F.col("p_partkey") * 7919 % 10007) / F.lit(10007.0)).alias("p"))
    return rogue.bh(p).select("id", _r("p", 9), _r("p_adj", 9))


@_query("SELECT cluster, round(avg(score), 6) AS mean, round(median(score), 6) AS median, count(score) AS scored, count(*) FILTER (score IS NULL)::BIGINT AS skipped FROM (SELECT p_brand AS cluster, CASE WHEN p_size > 45 THEN NULL ELSE p_retailprice / 2500 END AS score FROM part) GROUP BY GROUPING SETS ((cluster), ())")
def rogue_rollup(s, d):
    p = src.read(s, d, "part").select(F.col("p_brand").alias("cluster"), F.when(F.col("p_size") <= 45, F.col("p_retailprice") / 2500).alias("score"))
    return rogue.roll_up(p).select("cluster", _r("mean"), _r("median"), "scored", "skipped")


def _by_region(s, d):
    """Cells by region and market segment: groups for purity."""
    return src.cells(s, d).select("cell", F.col("label").alias("cluster"), F.col("batch").alias("sample"))


_GROUPS = "lab AS (SELECT cell, label::VARCHAR AS cluster, batch AS sample, count(*) OVER (PARTITION BY label, batch) AS n_cells FROM cells)"


@_query("SELECT cluster, sample, gene::VARCHAR AS gene, round(ln(sum(m) / (max(n_cells) - 2) + 1), 6) AS mean_expr, round(sum(ln(m + 1)) / (max(n_cells) - 2), 6) AS entropy FROM (SELECT cluster, sample, n_cells, gene, CASE WHEN row_number() OVER (PARTITION BY cluster, sample, gene ORDER BY n DESC) > 2 THEN n ELSE 0 END AS m FROM counts JOIN lab USING (cell) WHERE n_cells > 2) GROUP BY 1, 2, 3", _COUNTS, _CELLS, _GROUPS)
def trimmed_entropy_by_group(s, d):
    """Every group's gene table without each gene's two largest cells."""
    return rogue.trimmed_table(src.counts(s, d), _by_region(s, d), 2).select("cluster", "sample", "gene", _r("mean_expr"), _r("entropy"))


@_query()
def rogue_by_region(s, d):
    return rogue.per_cluster(src.counts(s, d), _by_region(s, d))


# ---------------------------------------------------------------- components


def _sv(s, d):
    q = src.read(s, d, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").cast("double").alias("s")).orderBy(F.desc("s"), "l_partkey").limit(60)
    return q.select(F.row_number().over(Window.orderBy(F.desc("s"), "l_partkey")).alias("i"), "s")


@_query("SELECT round(tau, 6) AS tau, above::BIGINT AS above, least(greatest(above + 5, 1, 15), 50)::BIGINT AS suggested FROM (SELECT tau, count(*) FILTER (s > tau) AS above FROM sv, (SELECT median(s) * sqrt(2 * 1.5 + 8 * 0.5 / (1.5 + sqrt(0.25 + 7 + 1))) AS tau FROM sv) GROUP BY tau)", _SV)
def gavish_donoho_given_sv(s, d):
    return linalg.suggest(_sv(s, d), 2000, 1000).select(_r("tau"), "above", F.col("suggested").cast("long").alias("suggested"))


@_query("SELECT max_by(i, round(abs((y2 - y1) * (i - 1) - (l - 1) * s + (l - 1) * y1), 9) * 1000 - i)::BIGINT AS elbow FROM sv, (SELECT min_by(s, i) AS y1, max_by(s, i) AS y2, count(*) AS l FROM sv) WHERE i > 1 AND i < l", _SV)
def perpendicular_elbow_given_sv(s, d):
    return linalg.elbow(_sv(s, d))


@_query("SELECT x, round((last_value(y) OVER w - first_value(y) OVER w) / nullif(last_value(x) OVER w - first_value(x) OVER w, 0), 6) AS slope FROM (SELECT i AS x, s AS y FROM sv) WINDOW w AS (ORDER BY x ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)", _SV)
def sliding_slopes(s, d):
    return linalg.slopes(_sv(s, d).select(F.col("i").alias("x"), F.col("s").alias("y")), 5).select("x", _r("slope"))


# ---------------------------------------------------------------- neighbours and graphs


def _points(s, d):
    return src.points(s, d)


@_query("SELECT cell, unnest(range(64))::INT AS dim, round(unnest(list_transform(vec, lambda x: x / sqrt(list_inner_product(vec, vec)))), 6) AS value FROM emb", _EMB)
def l2_normalize(s, d):
    return neighbors.normalise(_points(s, d)).select("cell", F.posexplode("vec").alias("dim", "value")).select("cell", "dim", _r("value"))


@_query("SELECT cell, nbr_batch::VARCHAR AS nbr_batch, slot::INT AS slot, nbr, round(dist, 4) AS dist FROM knn", _EMB, _PAIR, _KNN3)
def bbknn_k3(s, d):
    return neighbors.batch_balanced(_points(s, d), 3, "brute").withColumn("dist", F.round("dist", 4))


def _knn10(s, d):
    """Ten neighbours of every cell, staged: what follows reads them more than once."""
    return stage(neighbors.knn(_points(s, d).withColumn("batch", F.lit("0")), 10), "knn")


@_query("SELECT cell, slot::INT AS slot, nbr, round(dist, 4) AS dist FROM knn", _EMB, _PAIR, _KNN10)
def plain_knn_k10(s, d):
    return _knn10(s, d).select("cell", "slot", "nbr", _r("dist", 4))


@_query("SELECT r.ref, r.cell FROM (SELECT cell AS ref, nbr AS cell FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY dist, nbr) AS k FROM pair WHERE cell_batch = 0 AND nbr_batch = 1) WHERE k <= 5) r JOIN (SELECT cell, nbr AS ref FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY dist, nbr) AS k FROM pair WHERE cell_batch = 1 AND nbr_batch = 0) WHERE k <= 5) b USING (ref, cell)", _EMB, _PAIR)
def mutual_nn_pairs(s, d):
    return neighbors.mutual_pairs(_points(s, d), 0, 1, 5)


@_query("SELECT batch, count(*) AS n_cells, row_number() OVER (ORDER BY count(*) DESC, batch)::INT AS step FROM cells GROUP BY 1", _CELLS)
def mnn_merge_order(s, d):
    return neighbors.merge_order(src.cells(s, d))


def _directed(s, d, knn=None):
    return (knn or _knn10(s, d)).where("cell != nbr").select(F.col("cell").alias("i"), F.col("nbr").alias("j"), (F.lit(1.0) / F.col("slot")).alias("w"))


def _edges(s, d, knn=None):
    return neighbors.fuzzy_union(_directed(s, d, knn))


@_query("SELECT i, j, round(w, 6) AS w FROM edges", _EMB, _PAIR, _KNN10, _EDGES)
def fuzzy_union_given_weights(s, d):
    return _edges(s, d).select("i", "j", _r("w"))


@_query("SELECT round(avg(r), 6) AS recall FROM (SELECT t.cell, count(g.nbr) / count(*) AS r FROM (SELECT cell, nbr FROM knn) t LEFT JOIN (SELECT cell, nbr FROM knn WHERE slot <= 7) g USING (cell, nbr) GROUP BY 1)", _EMB, _PAIR, _KNN10)
def neighbor_recall(s, d):
    k = _knn10(s, d)
    return neighbors.recall(k.where("slot <= 7"), k).select(_r("recall"))


@_query("SELECT true AS enough, count(DISTINCT nbr_batch)::BIGINT AS batches, count(*)::BIGINT AS n_rows FROM knn", _EMB, _PAIR, _KNN3)
def neighbor_recall_ivf(s, d):
    """Inverted lists at default settings: rows for every cell and batch, and 0.9 of the true neighbours among them."""
    p = _points(s, d)
    found, truth = neighbors.batch_balanced(p, 3, "ivf"), neighbors.knn(p, 3)
    size = found.agg(F.countDistinct("nbr_batch").alias("batches"), F.count("*").alias("n_rows"))
    return neighbors.recall(found, truth).select((F.col("recall") >= 0.9).alias("enough")).crossJoin(size)  # a row each


@_query()
def ivf_recall(s, d):
    """The recall itself, of neighbours of other batches too."""
    p = _points(s, d)
    return neighbors.recall(neighbors.batch_balanced(p, 3, "ivf"), neighbors.knn(p, 3))


@_query("SELECT i, j, round(max(w), 6) AS w FROM (SELECT i, j, w FROM edges UNION ALL SELECT i, j, w / 2 FROM edges) GROUP BY 1, 2", _EMB, _PAIR, _KNN10, _EDGES)
def edge_max(s, d):
    e = _edges(s, d)
    return neighbors.strongest(e.unionByName(e.withColumn("w", F.col("w") / 2))).select("i", "j", _r("w"))


_BANDS = "bands AS (SELECT cell, min(dist) FILTER (dist > 0) AS rho, avg(dist) AS sigma FROM knn GROUP BY 1)"


@_query("SELECT cell AS i, nbr AS j, round(CASE WHEN dist <= rho THEN 1 ELSE exp(-(dist - rho) / sigma) END, 5) AS w FROM knn JOIN bands USING (cell) WHERE cell != nbr", _EMB, _PAIR, _KNN10, _BANDS)
def fuzzy_given_bandwidths(s, d):
    """The kernel of the fuzzy graph, at bandwidths that SQL can say."""
    k = _knn10(s, d)
    bands = k.groupBy("cell").agg(F.min(F.when(F.col("dist") > 0, F.col("dist"))).alias("rho"), F.avg("dist").alias("sigma"))
    return neighbors.kernel(k, bands).select("i", "j", _r("w", 5))


# ---------------------------------------------------------------- soft clusters and anchors

_UNIT = "u AS (SELECT cell, batch, label, list_transform(vec, lambda x: x / sqrt(list_inner_product(vec, vec))) AS x FROM emb)"
_CENTRE = "mid AS (SELECT label, list(m ORDER BY k) AS m FROM (SELECT label, k, avg(v) AS m FROM (SELECT label, unnest(vec) AS v, unnest(range(len(vec))) AS k FROM emb) GROUP BY 1, 2) GROUP BY 1), centre AS (SELECT row_number() OVER (ORDER BY label) - 1 AS cluster, list_transform(m, lambda x: x / sqrt(list_inner_product(m, m))) AS y FROM mid)"
_SOFT = "far AS (SELECT cell, batch, cluster, x, -2 * (1 - list_inner_product(x, y)) / 0.1::DOUBLE AS d FROM u, centre), soft AS (SELECT cell, batch, cluster, x, exp(d - max(d) OVER (PARTITION BY cell)) / sum(exp(d)) OVER (PARTITION BY cell) * exp(max(d) OVER (PARTITION BY cell)) AS r FROM far)"


def _soft(s, d):
    """Memberships in the mean vectors of the labels."""
    p = _points(s, d)
    means = p.select("label", F.posexplode("vec").alias("k", "v")).groupBy("label", "k").agg(F.avg("v").alias("m")).groupBy("label").agg(F.sort_array(F.collect_list(F.struct("k", "m"))).alias("ms"))
    return integrate.memberships(p, [[m["m"] for m in r["ms"]] for r in means.orderBy("label").collect()])  # a row per label


@_query("SELECT cluster::INT AS cluster, batch::VARCHAR AS batch, round(sum(r), 5) AS o, round(max(t) * count(*) / (SELECT count(*) FROM u), 5) AS e FROM (SELECT *, sum(r) OVER (PARTITION BY cluster) AS t FROM soft) GROUP BY 1, 2", _EMB, _UNIT, _CENTRE, _SOFT)
def cluster_batch_masses(s, d):
    return integrate.mass_table(_soft(s, d)).select("cluster", "batch", _r("o", 5), _r("e", 5))


@_query("SELECT cluster::INT AS cluster, batch::VARCHAR AS batch, k::INT AS dim, round(sum(r * v), 5) AS s FROM (SELECT cluster, batch, r, unnest(x) AS v, unnest(range(len(x))) AS k FROM soft) GROUP BY 1, 2, 3", _EMB, _UNIT, _CENTRE, _SOFT)
def cluster_weighted_sums(s, d):
    return integrate.weighted_sums(_soft(s, d)).select("cluster", "batch", "dim", _r("s", 5))


_NEAR = "near AS (SELECT a.cell, a.batch, b.cell AS nbr, row_number() OVER (PARTITION BY a.cell ORDER BY list_distance(a.x, b.x), b.cell) AS k FROM u a JOIN u b ON a.batch + b.batch = 1)"
_ANCHORS = "anchor AS (SELECT b.x AS spot, list_transform(range(1, len(b.x) + 1), lambda i: a.x[i] - b.x[i]) AS shift FROM near p JOIN near q ON p.cell = q.nbr AND p.nbr = q.cell JOIN u a ON a.cell = p.cell JOIN u b ON b.cell = p.nbr WHERE p.batch = 0 AND p.k <= 5 AND q.k <= 5)"


@_query("SELECT cell, k::INT AS dim, round(max(v) + sum(w * h) / sum(w), 5) + 0.0 AS value FROM (SELECT cell, w, unnest(x) AS v, unnest(shift) AS h, unnest(range(len(x))) AS k FROM (SELECT cell, x, shift, exp(-((1 - list_inner_product(x, spot)) ** 2) / (2 * 0.3 ** 2)) AS w FROM u, anchor WHERE batch = 1)) GROUP BY 1, 2", _EMB, _UNIT, _NEAR, _ANCHORS)
def anchor_smoothing(s, d):
    """Cells of batch 1 moved by the anchors that they have in batch 0."""
    p = neighbors.normalise(_points(s, d)).withColumn("batch", F.col("batch").cast("string"))
    pairs = neighbors.mutual_pairs(p, "0", "1", 5)
    there = pairs.join(p.select(F.col("cell").alias("ref"), F.col("vec").alias("rv")), "ref").join(p.select("cell", "vec"), "cell")
    anchors = stage(there.select("ref", "cell", "vec", F.zip_with("rv", "vec", lambda x, y: x - y).alias("shift")), "anchors")
    moved = integrate.smoothed(p.where("batch = '1'"), anchors, 0.3)
    return moved.select("cell", F.posexplode("vec").alias("dim", "value")).select("cell", "dim", (F.round("value", 5) + 0.0).alias("value"))  # no negative zero


# ---------------------------------------------------------------- metrics


_LISI = "lisi AS (SELECT cell, 1 / sum(p * p) AS lisi FROM (SELECT k.cell, e.batch, count(*) / sum(count(*)) OVER (PARTITION BY k.cell) AS p FROM knn k JOIN emb e ON k.nbr = e.cell GROUP BY 1, 2) GROUP BY 1)"
_LISI_C = _LISI.replace("lisi AS (", "clisi AS (", 1).replace("e.batch", "e.label").replace("AS lisi FROM", "AS clisi FROM")


def _batch_labels(p):
    return p.select("cell", F.col("batch").alias("label"))


@_query("SELECT cell, round(lisi, 4) AS lisi FROM lisi", _EMB, _PAIR, _KNN10, _LISI)
def lisi_per_cell(s, d):
    p = _points(s, d)
    return metrics.lisi(_knn10(s, d), _batch_labels(p)).select("cell", _r("lisi", 4))


@_query("SELECT round(greatest(0, least(1, ((SELECT avg(lisi) FROM lisi) - 1) / 2)), 4) AS ilisi, round(greatest(0, least(1, 1 - ((SELECT avg(clisi) FROM clisi) - 1) / ((SELECT count(DISTINCT label) FROM emb) - 1))), 4) AS clisi", _EMB, _PAIR, _KNN10, _LISI, _LISI_C)
def ilisi_clisi(s, d):
    p, k = _points(s, d), _knn10(s, d)
    b, l = _batch_labels(p), p.select("cell", "label")
    i = metrics.lisi_score(metrics.lisi(k, b), b, True).select(F.round("score", 4).alias("ilisi"))
    return i.crossJoin(metrics.lisi_score(metrics.lisi(k, l), l, False).select(F.round("score", 4).alias("clisi")))  # one row each


@_query("SELECT cell, round(sum((coalesce(o, 0) - 10 * p) * (coalesce(o, 0) - 10 * p) / (10 * p)), 4) AS chi2, 10::BIGINT AS k FROM (SELECT DISTINCT cell FROM emb) c CROSS JOIN (SELECT batch, count(*) / sum(count(*)) OVER () AS p FROM emb GROUP BY 1) b LEFT JOIN (SELECT k.cell, e.batch, count(*) AS o FROM knn k JOIN emb e ON k.nbr = e.cell GROUP BY 1, 2) USING (cell, batch) GROUP BY 1", _EMB, _PAIR, _KNN10)
def kbet_chi2(s, d):
    return metrics.kbet_chi2(_knn10(s, d), _points(s, d).select("cell", "batch")).select("cell", _r("chi2", 4), "k")


@_query("SELECT cell, round(chi2, 4) AS chi2, 10::BIGINT AS k, round(exp(-chi2 / 2), 6) AS p FROM (SELECT cell, sum((coalesce(o, 0) - 10 * p) * (coalesce(o, 0) - 10 * p) / (10 * p)) AS chi2 FROM (SELECT DISTINCT cell FROM emb) c CROSS JOIN (SELECT batch, count(*) / sum(count(*)) OVER () AS p FROM emb GROUP BY 1) b LEFT JOIN (SELECT k.cell, e.batch, count(*) AS o FROM knn k JOIN emb e ON k.nbr = e.cell GROUP BY 1, 2) USING (cell, batch) GROUP BY 1)", _EMB, _PAIR, _KNN10)
def kbet_pvalues(s, d):
    """Three batches, so two degrees of freedom, whose upper tail is exp(-x / 2)."""
    return metrics.kbet_pvalues(_knn10(s, d), _points(s, d).select("cell", "batch")).select("cell", _r("chi2", 4), "k", _r("p"))


@_query("SELECT round(avg(CASE WHEN exp(-chi2 / 2) >= 0.05 THEN 1.0::DOUBLE ELSE 0 END), 6) AS acceptance FROM (SELECT cell, sum((coalesce(o, 0) - 10 * p) * (coalesce(o, 0) - 10 * p) / (10 * p)) AS chi2 FROM (SELECT DISTINCT cell FROM emb) c CROSS JOIN (SELECT batch, count(*) / sum(count(*)) OVER () AS p FROM emb GROUP BY 1) b LEFT JOIN (SELECT k.cell, e.batch, count(*) AS o FROM knn k JOIN emb e ON k.nbr = e.cell GROUP BY 1, 2) USING (cell, batch) GROUP BY 1)", _EMB, _PAIR, _KNN10)
def kbet_acceptance(s, d):
    p = metrics.kbet_pvalues(_knn10(s, d), _points(s, d).select("cell", "batch"))
    return p.agg(F.avg((F.col("p") >= 0.05).cast("double")).alias("acceptance")).select(_r("acceptance"))


@_query("SELECT round(max(sd), 6) AS max_std FROM (SELECT batch, stddev_pop(coalesce(o, 0)) AS sd FROM (SELECT cell FROM emb) c CROSS JOIN (SELECT DISTINCT batch FROM emb) b LEFT JOIN (SELECT k.cell, e.batch, count(*) AS o FROM knn k JOIN emb e ON k.nbr = e.cell GROUP BY 1, 2) USING (cell, batch) GROUP BY 1)", _EMB, _PAIR, _KNN10)
def kbet_balance_check(s, d):
    return metrics.kbet_balance(_knn10(s, d), _points(s, d).select("cell", "batch")).select(_r("max_std"))


ORACLES["graph_connectivity"] = f"WITH RECURSIVE {_EMB}, {_PAIR}, {_KNN10}, same AS (SELECT k.cell AS u, k.nbr AS v FROM knn k JOIN emb a ON k.cell = a.cell JOIN emb b ON k.nbr = b.cell WHERE a.label = b.label), link AS (SELECT u, v FROM same UNION SELECT v, u FROM same), reach(node, root) AS (SELECT cell, cell FROM emb UNION SELECT link.v, reach.root FROM reach JOIN link ON link.u = reach.node), comp AS (SELECT node, min(root) AS root FROM reach GROUP BY 1), size AS (SELECT label, root, count(*) AS n FROM comp JOIN emb ON node = cell GROUP BY 1, 2) SELECT label::VARCHAR AS label, sum(n)::BIGINT AS n_cells, max(n) AS largest, round(max(n) / sum(n), 6) AS share FROM size GROUP BY 1"


@_query()
def graph_connectivity(s, d):
    return metrics.graph_connectivity(_knn10(s, d), _points(s, d)).select("label", "n_cells", "largest", _r("share"))


_SIL = "sums AS (SELECT a.cell, a.part, a.cluster AS own, b.cluster AS other, sum(list_distance(a.vec, b.vec)) AS s, count(*) FILTER (a.cell != b.cell) AS n FROM pts a JOIN pts b ON a.part = b.part GROUP BY 1, 2, 3, 4), sil AS (SELECT cell, part, own AS cluster, CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM (SELECT cell, part, own, max(CASE WHEN own = other AND n > 0 THEN s / n END) AS a, min(CASE WHEN own != other THEN s / n END) AS b FROM sums GROUP BY 1, 2, 3))"


@_query("SELECT round((avg(s) + 1) / 2, 5) AS score FROM sil", _EMB, "pts AS (SELECT cell, vec, 0 AS part, label AS cluster FROM emb)", _SIL)
def silhouette_label(s, d):
    return metrics.label_asw(_points(s, d)).select(_r("score", 5))


@_query("SELECT cell, round(s, 5) AS s FROM sil", _EMB, "pts AS (SELECT cell, vec, 0 AS part, label AS cluster FROM emb)", _SIL)
def silhouette_per_cell(s, d):
    p = _points(s, d)
    return metrics.silhouettes(p.select("cell", "vec", F.col("label").alias("cluster"), F.lit("0").alias("part"))).select("cell", _r("s", 5))


@_query("SELECT round(avg(m), 5) AS score FROM (SELECT part, avg(1 - abs(s)) AS m, count(DISTINCT cluster) AS k, count(*) AS n FROM sil GROUP BY 1) WHERE k > 1 AND k < n", _EMB, "pts AS (SELECT cell, vec, label AS part, batch AS cluster FROM emb)", _SIL)
def silhouette_batch(s, d):
    return metrics.batch_asw(_points(s, d)).select(_r("score", 5))


@_query("SELECT round(avg(m), 5) AS score FROM (SELECT part, avg((s + 1) / 2) AS m FROM sil WHERE cluster GROUP BY 1)", _EMB, "alone AS (SELECT label AS part FROM emb GROUP BY 1 HAVING count(DISTINCT batch) <= 3 AND label < 3), pts AS (SELECT cell, vec, part, label = part AS cluster FROM emb, alone)", _SIL)
def silhouette_isolated(s, d):
    p = _points(s, d)  # labels of 3 and more are spread over an extra batch, so that they are not isolated
    extra = p.where("label >= 3").groupBy("label").agg(F.min("cell").alias("first"))
    p = p.join(extra, "label", "left").withColumn("batch", F.when(F.col("cell") == F.col("first"), 9).otherwise(F.col("batch")))
    return metrics.isolated_asw(p, 3).select(_r("score", 5))


@_query("SELECT round(CASE WHEN (i + j) / 2 = i * j / t THEN 1 ELSE (ij - i * j / t) / ((i + j) / 2 - i * j / t) END, 6) AS ari FROM (SELECT (SELECT sum(n * (n - 1) / 2) FROM tab) AS ij, (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM tab GROUP BY x)) AS i, (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM tab GROUP BY y)) AS j, (SELECT sum(n) * (sum(n) - 1) / 2 FROM tab) AS t)", _EMB, "tab AS (SELECT label % 4 AS x, label % 6 AS y, count(*)::DOUBLE AS n FROM emb GROUP BY 1, 2)")
def ari(s, d):
    p = _points(s, d)
    return metrics.adjusted_rand(p.select("cell", (F.col("label") % 4).alias("cluster")), p.select("cell", (F.col("label") % 6).alias("cluster"))).select(_r("ari"))


_LAB = "lab AS (SELECT cell, label AS c FROM emb), deg AS (SELECT a.c, sum(w) AS vol, sum(CASE WHEN a.c = b.c THEN w ELSE 0 END) AS inside FROM edges JOIN lab a ON i = a.cell JOIN lab b ON j = b.cell GROUP BY 1)"


def _labels(s, d):
    return _points(s, d).select("cell", F.col("label").alias("cluster"))


@_query("SELECT round(sum(inside) / sum(vol), 6) AS a, round(sum(vol * vol) / (sum(vol) * sum(vol)), 6) AS b FROM deg", _EMB, _PAIR, _KNN10, _EDGES, _LAB)
def modularity_ab_newman(s, d):
    return metrics.modularity(_edges(s, d), _labels(s, d)).select(_r("a"), _r("b"))


@_query("SELECT round(sum(inside) / sum(vol), 6) AS a, round((SELECT sum(n * n) / (sum(n) * sum(n)) FROM (SELECT count(*) AS n FROM lab GROUP BY c)), 6) AS b FROM deg", _EMB, _PAIR, _KNN10, _EDGES, _LAB)
def modularity_ab_cpm(s, d):
    return metrics.modularity(_edges(s, d), _labels(s, d), "cpm").select(_r("a"), _r("b"))


@_query("SELECT round(sum(inside) / sum(vol) - 0.7 * sum(vol * vol) / (sum(vol) * sum(vol)), 6) AS q FROM deg", _EMB, _PAIR, _KNN10, _EDGES, _LAB)
def modularity_at_gamma(s, d):
    return cluster.partition_score(_edges(s, d), _labels(s, d), 0.7).select(_r("q"))


@_query("SELECT round(coalesce(sum(n * (vol - inside) / low) / sum(n), 1), 6) AS conductance FROM (SELECT c, vol, inside, least(vol, (SELECT sum(vol) FROM deg) - vol) AS low, n FROM deg JOIN (SELECT c, count(*) AS n FROM lab GROUP BY 1) USING (c)) WHERE n >= 2 AND low > 0", _EMB, _PAIR, _KNN10, _EDGES, _LAB)
def mean_conductance(s, d):
    return metrics.mean_conductance(_edges(s, d), _labels(s, d)).select(_r("conductance"))


# ---------------------------------------------------------------- resolution


def _parts(s, d):
    p = _points(s, d).select("cell", "label", F.explode(F.sequence(F.lit(1), F.lit(9))).alias("g"))
    mod = F.when(F.col("g") == 8, 4).when(F.col("g") == 9, 6).otherwise(F.col("g"))
    return p.select((F.col("g") * F.lit(0.2)).alias("gamma"), "cell", (F.col("label") % mod).cast("int").alias("cluster"))


@_query("SELECT round(gamma, 6) AS gamma FROM (SELECT gamma, row_number() OVER (PARTITION BY p ORDER BY gamma) AS r FROM (SELECT gamma, string_agg(cluster, ',' ORDER BY cell) AS p FROM parts GROUP BY 1)) WHERE r = 1", _EMB, _PARTS)
def partition_dedupe(s, d):
    return cluster.distinct_partitions(_parts(s, d)).select(_r("gamma"))


_AB = "deg AS (SELECT gamma, x.cluster AS c, sum(w) AS vol, sum(CASE WHEN x.cluster = y.cluster THEN w ELSE 0 END) AS inside FROM edges JOIN parts x ON i = x.cell JOIN parts y USING (gamma) WHERE j = y.cell GROUP BY 1, 2), ab AS (SELECT gamma, sum(inside) / sum(vol) AS a, sum(vol * vol) / (sum(vol) * sum(vol)) AS b FROM deg GROUP BY 1)"
_HULL = "hull AS (SELECT gamma, a, b FROM ab k WHERE NOT EXISTS (SELECT 1 FROM ab x, ab y WHERE x.b < k.b AND k.b < y.b AND k.a <= x.a + (y.a - x.a) * (k.b - x.b) / (y.b - x.b)) AND NOT EXISTS (SELECT 1 FROM ab x WHERE x.b = k.b AND (x.a > k.a OR x.a = k.a AND x.gamma < k.gamma)))"
_WIDTH = "cross_ AS (SELECT gamma, a, b, (lead(a) OVER (ORDER BY b) - a) / (lead(b) OVER (ORDER BY b) - b) AS lo, (a - lag(a) OVER (ORDER BY b)) / (b - lag(b) OVER (ORDER BY b)) AS hi FROM hull), rng AS (SELECT gamma, least(greatest(coalesce(lo, 0), 0), 1.8) AS lo, least(greatest(coalesce(hi, 1.8), 0), 1.8) AS hi FROM cross_)"


def _ranges(s, d):
    rows = cluster.coefficients(_edges(s, d), _parts(s, d)).orderBy("gamma").collect()  # nine partitions
    found = cluster.ranges([(r["a"], r["b"]) for r in rows], 0.2, 1.8)
    return s.createDataFrame([(float(r["gamma"]), f["on_hull"], f["lo"], f["hi"], f["width"]) for r, f in zip(rows, found, strict=True)], "gamma double, on_hull boolean, lo double, hi double, width double")


@_query("SELECT round(gamma, 6) AS gamma, round(a, 6) AS a, round(b, 6) AS b FROM ab", _EMB, _PAIR, _KNN10, _EDGES, _PARTS, _AB)
def champ_coefficients(s, d):
    return cluster.coefficients(_edges(s, d), _parts(s, d)).select(_r("gamma"), _r("a"), _r("b"))


@_query("SELECT round(gamma, 6) AS gamma, gamma IN (SELECT gamma FROM hull) AS on_hull FROM ab", _EMB, _PAIR, _KNN10, _EDGES, _PARTS, _AB, _HULL)
def champ_hull(s, d):
    return _ranges(s, d).select(_r("gamma"), "on_hull")


@_query("SELECT round(gamma, 6) AS gamma, round(lo, 5) AS lo, round(hi, 5) AS hi, round(greatest(ln(greatest(hi, greatest(lo, 0.2))) - ln(greatest(lo, 0.2)), 0), 5) AS width FROM rng", _EMB, _PAIR, _KNN10, _EDGES, _PARTS, _AB, _HULL, _WIDTH)
def champ_widths(s, d):
    return _ranges(s, d).where("on_hull").select(_r("gamma"), _r("lo", 5), _r("hi", 5), _r("width", 5))


@_query("SELECT round(gamma, 6) AS gamma, round(CASE WHEN (i + j) / 2 = i * j / t THEN 1 ELSE (ij - i * j / t) / ((i + j) / 2 - i * j / t) END, 6) AS ari FROM (SELECT gamma, sum(n * (n - 1) / 2) AS ij, sum(n) * (sum(n) - 1) / 2 AS t FROM tab GROUP BY 1) JOIN (SELECT gamma, sum(n * (n - 1) / 2) AS i FROM (SELECT gamma, sum(n) AS n FROM tab GROUP BY gamma, x) GROUP BY 1) USING (gamma) JOIN (SELECT gamma, sum(n * (n - 1) / 2) AS j FROM (SELECT gamma, sum(n) AS n FROM tab GROUP BY gamma, y) GROUP BY 1) USING (gamma)", _EMB, _PARTS, "tab AS (SELECT a.gamma, a.cluster AS x, b.cluster AS y, count(*)::DOUBLE AS n FROM parts a JOIN parts b ON a.cell = b.cell AND round(b.gamma * 5) = round(a.gamma * 5) + 1 GROUP BY 1, 2, 3)")
def resolution_stability(s, d):
    return cluster.stability(_parts(s, d)).select(_r("gamma"), _r("ari"))


@_query("SELECT DISTINCT round(lo + i * (hi - lo) / 29, 4)::DOUBLE AS gamma FROM range(30) t(i), (SELECT min(p_size) / 20.0::DOUBLE AS lo, max(p_size) / 20.0::DOUBLE AS hi FROM part)")
def gamma_grid(s, d):
    """Thirty resolutions over the range that a table gives."""
    r = src.read(s, d, "part").agg((F.min("p_size") / 20.0).alias("lo"), (F.max("p_size") / 20.0).alias("hi")).first()
    return s.createDataFrame([(g,) for g in cluster.gammas(r["lo"], r["hi"], 30)], "gamma double")


@_query("SELECT max_by(x, round(abs((y2 - y1) * (x - x1) - (x2 - x1) * (y - y1)), 9) * 1e4 - x) AS x FROM (SELECT i AS x, s AS y FROM sv), (SELECT min(i) AS x1, max(i) AS x2, min_by(s, i) AS y1, max_by(s, i) AS y2 FROM sv)", _SV)
def curve_knee(s, d):
    return cluster.knee(_sv(s, d).select(F.col("i").alias("x"), F.col("s").alias("y")))


def _curve(s, d):
    return _sv(s, d).select(F.col("i").alias("x"), F.col("s").alias("y"))


@_query("SELECT max_by(x, round(d, 9) * 1e4 - x / 1e3) AS x FROM (SELECT i AS x, s - lag(s) OVER (ORDER BY i) AS d FROM sv) WHERE d IS NOT NULL", _SV)
def curve_steepest(s, d):
    return cluster.steepest(_curve(s, d))


@_query("SELECT max_by(x, round(d, 9) * 1e4 - x / 1e3) AS x FROM (SELECT i AS x, lead(s) OVER (ORDER BY i) - 2 * s + lag(s) OVER (ORDER BY i) AS d FROM sv) WHERE d IS NOT NULL", _SV)
def curve_bend(s, d):
    return cluster.bend(_curve(s, d))


@_query("SELECT min(x) AS x FROM st, (SELECT median(abs(d)) * 2 AS t FROM st) WHERE abs(d) > t", _SV, "st AS (SELECT * FROM (SELECT i AS x, s - lag(s) OVER (ORDER BY i) AS d FROM sv) WHERE d IS NOT NULL)")
def curve_first_jump(s, d):
    return cluster.first_jump(_curve(s, d))


@_query("SELECT min(i) AS x FROM sv, (SELECT min(s) AS lo, max(s) AS hi FROM sv) WHERE s >= lo + 0.9 * (hi - lo)", _SV)
def curve_rise(s, d):
    return cluster.rise(_curve(s, d))


@_query("SELECT min(x) AS x FROM sl WHERE abs(slope) <= 0.1 * (SELECT max(abs(slope)) FROM sl)", _SV, "sl AS (SELECT i AS x, (last_value(s) OVER w - first_value(s) OVER w) / (last_value(i) OVER w - first_value(i) OVER w) AS slope FROM sv WINDOW w AS (ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))")
def curve_first_plateau(s, d):
    return cluster.first_plateau(_curve(s, d))


@_query("SELECT max_by(x, round(abs((y2 - y1) * (x - x1) - (x2 - x1) * (y - y1)), 9) * 1e4 - x / 1e3) AS x FROM (SELECT i AS x, log10(greatest(s, 1e-9)) AS y FROM sv), (SELECT min(i) AS x1, max(i) AS x2, log10(min_by(s, i)) AS y1, log10(max_by(s, i)) AS y2 FROM sv)", _SV)
def curve_log_knee(s, d):
    return cluster.log_knee(_curve(s, d))


@_query("SELECT CASE WHEN avg(d) < 0 THEN min_by(x, round(d, 9) * 1e4 + x / 1e3) ELSE max_by(x, round(d, 9) * 1e4 - x / 1e3) END AS x FROM (SELECT i AS x, (s - y1) / greatest(y2 - y1, 1e-12) - (i - 1) / 59.0::DOUBLE AS d FROM (SELECT i, 1000.0::DOUBLE - s AS s FROM sv), (SELECT 1000.0::DOUBLE - min_by(s, i) AS y1, 1000.0::DOUBLE - max_by(s, i) AS y2 FROM sv))", _SV)
def curve_bulge(s, d):
    return cluster.bulge(_curve(s, d).withColumn("y", 1000.0 - F.col("y")))


@_query("SELECT max(x) AS x FROM t, (SELECT mean AS m, sd AS v FROM t ORDER BY mean DESC, x LIMIT 1) WHERE mean >= m - v", "t AS (SELECT p_size AS x, avg(p_partkey % 1000)::DOUBLE AS mean, stddev_pop(p_partkey % 1000) / 20 AS sd FROM part GROUP BY 1)")
def parsimonious_pick(s, d):
    k = F.col("p_partkey") % 1000
    return cluster.parsimony(src.read(s, d, "part").groupBy(F.col("p_size").alias("x")).agg(F.avg(k).alias("mean"), (F.stddev_pop(k) / 20).alias("sd")))


@_query("SELECT count(*)::BIGINT AS n_edges, count(DISTINCT i)::BIGINT AS n_cells, (SELECT count(*) FROM knn WHERE cell != nbr)::BIGINT AS n_slots FROM edges", _EMB, _PAIR, _KNN10, _EDGES)
def edge_counts(s, d):
    knn = _knn10(s, d)
    slots = knn.where("cell != nbr").agg(F.count("*").alias("n_slots"))
    return _edges(s, d, knn).agg(F.count("*").alias("n_edges"), F.countDistinct("i").alias("n_cells")).crossJoin(slots)  # a row each


# ---------------------------------------------------------------- reporting


@_query("SELECT route, cluster, round(score, 6) AS score, up::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY route ORDER BY score DESC, cluster) AS up, row_number() OVER (PARTITION BY route ORDER BY score, cluster DESC) AS down FROM (SELECT p_type AS route, p_brand AS cluster, avg(p_retailprice / 2500) AS score FROM part GROUP BY 1, 2)) WHERE up <= 2 OR down <= 1")
def purity_head_and_tail(s, d):
    from .plans.report import purity_bands as bands

    p = src.read(s, d, "part").select(F.col("p_type").alias("route"), F.col("p_brand").alias("cluster"), (F.col("p_retailprice") / 2500).alias("score"))
    return bands(p, 2, 1).select("route", "cluster", _r("score"), "rank")


@_query("SELECT route, cluster, round(score, 6) AS score, CASE WHEN score >= 0.85 THEN 'high' WHEN score >= 0.7 THEN 'fair' ELSE 'low' END AS band, (row_number() OVER (PARTITION BY route ORDER BY score DESC, cluster))::INT AS rank FROM (SELECT p_type AS route, p_brand AS cluster, avg(p_retailprice / 2500) AS score FROM part GROUP BY 1, 2)")
def purity_bands(s, d):
    from .plans.report import purity_bands as bands

    p = src.read(s, d, "part").select(F.col("p_type").alias("route"), F.col("p_brand").alias("cluster"), (F.col("p_retailprice") / 2500).alias("score"))
    return bands(p).select("route", "cluster", _r("score"), "band", "rank")


@_query("SELECT j AS i, i AS j, round(w, 6) AS w FROM dir", _EMB, _PAIR, _KNN10, _EDGES)
def transposed_graph(s, d):
    return neighbors.transpose(_directed(s, d)).select("i", "j", _r("w"))


def _metrics(s, d):
    names = F.array(*[F.lit(x) for x in ("ilisi", "clisi", "graph_connectivity", "label_silhouette", "batch_silhouette", "isolated_label", "rogue_mean", "sccaf", "mean")])
    route, metric = F.concat(F.lit("route"), (F.col("p_partkey") % 4).cast("string")), F.element_at(names, (F.floor(F.col("p_partkey") / 4) % 9 + 1).cast("int"))
    cents = F.sum(F.round(F.col("p_retailprice") * 100).cast("long"))
    return src.read(s, d, "part").groupBy(route.alias("route"), metric.alias("metric")).agg((cents / F.lit(250000.0) / F.count("*")).alias("value"))


@_query("SELECT route, round(batch, 6) AS batch, round(bio, 6) AS bio, round(homogeneity, 6) AS homogeneity, round((0.35 * coalesce(batch, 0) + 0.45 * coalesce(bio, 0) + 0.2 * coalesce(homogeneity, 0)) / (CASE WHEN batch IS NULL THEN 0 ELSE 0.35 END + CASE WHEN bio IS NULL THEN 0 ELSE 0.45 END + CASE WHEN homogeneity IS NULL THEN 0 ELSE 0.2 END), 6) AS overall FROM (SELECT route, avg(value) FILTER (metric IN ('ilisi', 'batch_silhouette')) AS batch, avg(value) FILTER (metric IN ('clisi', 'graph_connectivity', 'label_silhouette', 'isolated_label')) AS bio, avg(value) FILTER (metric IN ('rogue_mean', 'sccaf')) AS homogeneity FROM metrics GROUP BY 1)", _METRICS)
def scib_summary_weights(s, d):
    return metrics.category_scores(_metrics(s, d)).select("route", *[_r(c) for c in ("batch", "bio", "homogeneity", "overall")])


@_query("SELECT route, round(value, 6) AS mean FROM metrics WHERE metric = 'mean' ORDER BY value DESC, route LIMIT 1", _METRICS)
def auto_pick_route(s, d):
    return metrics.pick_route(_metrics(s, d), ["route0", "route1", "route2", "route3"]).select("route", _r("mean"))


@_query("SELECT route, round(max(value) FILTER (metric = 'ilisi'), 4) AS ilisi, round(max(value) FILTER (metric = 'clisi'), 4) AS clisi, round(max(value) FILTER (metric = 'mean'), 4) AS mean FROM metrics GROUP BY 1", _METRICS)
def comparison_table_pivot(s, d):
    return metrics.comparison_table(_metrics(s, d), ["ilisi", "clisi", "mean"])


# ---------------------------------------------------------------- numeric kernels, checked by the tests


def _small_graph(s, d):
    return stage(neighbors.fuzzy_graph(_knn10(s, d)), "graph")


@_query()
def fuzzy_graph(s, d):
    return _small_graph(s, d)


@_query("SELECT gene, round(dispersion, 6) AS dispersion, n_batches::BIGINT AS n_batches, rank::INT AS rank FROM (SELECT *, row_number() OVER (ORDER BY n_batches DESC, dispersion DESC, gene) AS rank FROM (SELECT gene, sum(norm) / (SELECT count(DISTINCT batch) FROM cells) AS dispersion, sum(first) AS n_batches FROM ranked GROUP BY 1)) WHERE rank <= 300", _COUNTS, _CELLS, "lib AS (SELECT cell, sum(n) AS lib FROM counts GROUP BY 1), size AS (SELECT batch, count(*) AS c FROM cells GROUP BY 1), st AS (SELECT batch, gene, c, sum(n * 1e4 / lib) AS s, sum((n * 1e4 / lib) ** 2) AS q FROM counts JOIN lib USING (cell) JOIN cells USING (cell) JOIN size USING (batch) GROUP BY 1, 2, 3), disp AS (SELECT batch, gene, ln(1 + s / c) AS mean, ln((q - s * s / c) / (c - 1) / (s / c)) AS disp FROM st WHERE c > 1 AND (q - s * s / c) / (c - 1) > 0), bin AS (SELECT *, greatest(ceil(CASE WHEN max(mean) OVER w > min(mean) OVER w THEN (mean - min(mean) OVER w) / (max(mean) OVER w - min(mean) OVER w) * 20 ELSE 0 END), 1) AS bin FROM disp WINDOW w AS (PARTITION BY batch)), norm AS (SELECT batch, gene, CASE WHEN stddev_samp(disp) OVER b > 0 THEN (disp - avg(disp) OVER b) / stddev_samp(disp) OVER b WHEN count(*) OVER b = 1 THEN 1 ELSE 0 END AS norm FROM bin WINDOW b AS (PARTITION BY batch, bin)), ranked AS (SELECT gene, norm, (row_number() OVER (PARTITION BY batch ORDER BY norm DESC, gene) <= 300)::INT AS first FROM norm)")
def hvg_seurat(s, d):
    return rogue.dispersed_genes(qc.lognorm(src.counts(s, d)), src.cells(s, d), 300).select("gene", _r("dispersion"), "n_batches", "rank")


@_query()
def hvg_seurat_v3(s, d):
    return rogue.variable_genes(src.counts(s, d), src.cells(s, d), 300)


@_query()
def pca_auto(s, d):
    counts, cells = src.counts(s, d), src.cells(s, d)
    top = rogue.variable_genes(counts, cells, 300)
    return linalg.pca(qc.lognorm(counts).join(top.select("gene"), "gene", "left_semi"), cells)["emb"]


@_query(f"SELECT {_N}::BIGINT AS n_cells, round(sum(value * value) / ({_N} - 1), 4) AS total_variance FROM norm", _COUNTS, _CELLS, _NORM)
def sparse_svd_variance(s, d):
    """Components of the log counts as they are; the variance that they share out."""
    cells = src.cells(s, d)
    found = linalg.sparse_svd(qc.lognorm(src.counts(s, d)), cells, 20)
    return found["emb"].agg(F.count("*").alias("n_cells")).withColumn("total_variance", F.round(F.lit(found["total_variance"]), 4))


@_query()
def sparse_svd_values(s, d):
    return linalg.sparse_svd(qc.lognorm(src.counts(s, d)), src.cells(s, d), 50, scores=False)["sv"]


@_query()
def harmony_corrected(s, d):
    return integrate.harmony(_points(s, d), theta=4.0, max_iter=5)


@_query()
def fastmnn_corrected(s, d):
    return integrate.fast_mnn(_points(s, d))


@_query()
def leiden_labels(s, d):
    return cluster.sweep(_small_graph(s, d), _points(s, d), [0.5, 1.0])


@_query()
def champ_pick(s, d):
    return cluster.pick_resolution(_small_graph(s, d), _points(s, d), n=10)["curve"]


@_query()
def rogue_per_cluster(s, d):
    w = src.words(s, d)
    return rogue.per_cluster(w, w.select("cell", F.col("label").alias("cluster"), F.lit("all").alias("sample")).distinct())


@_query()
def sccaf(s, d):
    p = _points(s, d).select("cell", "vec", F.col("label").alias("cluster"))
    return s.createDataFrame([(classify.self_assessment(p),)], "accuracy double")


@_query()
def umap_layout(s, d):
    return umap.umap(_points(s, d), _small_graph(s, d))


@_query()
def pipeline_end_to_end(s, d):
    from .plans.pipeline import run_pipeline

    counts, cells, genes = _all(s, d)
    res = run_pipeline(s, counts, cells, genes, min_genes=5, min_cells=2, hvg_n_top_genes=200, integration="bbknn", label_key="label", champ_n_partitions=6, umap_n_epochs=50)
    return res.tables["metrics"]
