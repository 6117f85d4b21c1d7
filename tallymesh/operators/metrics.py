"""Integration and clustering metrics over neighbour, edge and label tables."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.staging import components, partitions, stage
from .neighbors import BLOCK, beside, meetings, packed, sides
from .qc import label_codes


def simpsons(dist: np.ndarray, code: np.ndarray, perplexity: float, steps: int = 50, tol: float = 1e-5) -> np.ndarray:
    """Inverse Simpson index of each row's labels under weights exp(-beta d^2) of the given perplexity; code -1: absent."""
    there = code >= 0
    x, want = np.where(there, dist * dist, 0.0), math.log2(perplexity)
    low = np.where(there, x, np.inf).min(1, keepdims=True)
    x = np.where(there, x - np.where(np.isfinite(low), low, 0.0), np.inf)
    beta, lo, hi = np.ones(len(x)), np.full(len(x), -np.inf), np.full(len(x), np.inf)
    open_ = there.sum(1) > 1
    w = np.zeros_like(x)
    for _ in range(steps):
        rows = np.flatnonzero(open_)
        if not len(rows):
            break
        own = np.exp(-beta[rows, None] * x[rows])
        own /= own.sum(1, keepdims=True)
        w[rows] = own
        h = -(own * np.log2(np.where(own > 0, own, 1.0))).sum(1) - want
        up, down = rows[h > 0], rows[h <= 0]
        open_[rows[np.abs(h) < tol]] = False
        lo[up], hi[down] = beta[up], beta[down]
        with np.errstate(invalid="ignore"):
            beta[up] = np.where(np.isinf(hi[up]), beta[up] * 2, (beta[up] + hi[up]) / 2)
            beta[down] = np.where(np.isinf(lo[down]), beta[down] / 2, (beta[down] + lo[down]) / 2)
    share = np.zeros((len(x), int(code.max(initial=0)) + 1))
    np.add.at(share, (np.nonzero(there)[0], code[there]), w[there])
    total = (share * share).sum(1)
    return np.where(total > 0, 1 / np.where(total > 0, total, 1.0), 1.0)


def simpson(dist: np.ndarray, code: np.ndarray, perplexity: float, steps: int = 50, tol: float = 1e-5) -> float:
    """simpsons of one row."""
    return float(simpsons(dist[None], np.asarray(code)[None], perplexity, steps, tol)[0])


def lisi(neighbours: DataFrame, labels: DataFrame, perplexity: float = 30.0) -> DataFrame:
    """(cell, lisi): neighbours (cell, nbr, dist), labels (cell, label); unlabelled neighbours are left out."""
    lab = label_codes(labels.where("label is not null")).select(F.col("cell").alias("nbr"), "code")
    per = neighbours.join(lab, "nbr").groupBy("cell").agg(F.collect_list("dist").alias("d"), F.collect_list("code").alias("c"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for at in range(0, len(b), 1024):
                some = b.slice(at, 1024)
                size = some.column(1).value_lengths().to_numpy(zero_copy_only=False)
                put = np.arange(size.max(initial=0)) < size[:, None]
                dist, code = np.zeros(put.shape), np.full(put.shape, -1, np.int64)
                dist[put] = some.column(1).flatten().to_numpy(zero_copy_only=False)
                found, code[put] = np.unique(some.column(2).flatten().to_numpy(zero_copy_only=False), return_inverse=True)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(simpsons(dist, code, perplexity))], ["cell", "lisi"])

    return per.mapInArrow(run, "cell long, lisi double")


def lisi_score(per_cell: DataFrame, labels: DataFrame, mixing: bool) -> DataFrame:
    """(score): (mean - 1) / (labels - 1) if mixing, else 1 minus it; clipped; 1 for one label."""
    n = labels.agg(F.countDistinct("label").alias("b"))
    x = (F.col("m") - 1) / (F.col("b") - 1)
    x = F.greatest(F.lit(0.0), F.least(F.lit(1.0), x if mixing else 1 - x))
    return per_cell.agg(F.avg("lisi").alias("m")).crossJoin(n).select(F.when(F.col("b") <= 1, 1.0).otherwise(x).alias("score"))


def chi2_tails(x: np.ndarray, df: int) -> np.ndarray:
    """Upper tails of the chi-squared law: a closed form for 1 or 2 degrees, then a term for every two more."""
    half = np.maximum(np.asarray(x, float), 0.0) / 2
    if df <= 0:
        return np.ones(len(half))
    a, out = (0.5, np.array([math.erfc(v) for v in np.sqrt(half)])) if df % 2 else (1.0, np.exp(-half))
    log = np.log(np.where(half > 0, half, 1.0))
    while a < df / 2:
        out = out + np.where(half > 0, np.exp(a * log - half - math.lgamma(a + 1)), 0.0)
        a += 1
    return np.minimum(out, 1.0)


def chi2_tail(x: float, df: int) -> float:
    return float(chi2_tails(np.array([x]), df)[0])


def kbet_chi2(neighbours: DataFrame, batches: DataFrame) -> DataFrame:
    """(cell, chi2, k): observed against expected batch counts; absent batches count as 0.

    Sum (o - e)^2 / e over all batches is k * (sum o^2 / (k^2 p) - 1) with sums over present ones.
    """
    b = batches.select(F.col("cell").alias("nbr"), F.col("batch").cast("string").alias("batch"))
    prior = b.groupBy("batch").agg(F.count("*").alias("c")).withColumn("p", F.col("c") / F.sum("c").over(Window.partitionBy(F.lit(0))))
    seen = neighbours.join(b, "nbr").groupBy("cell", "batch").agg(F.count("*").alias("o"))
    both = seen.join(prior.select("batch", "p"), "batch")
    per = both.groupBy("cell").agg(F.sum("o").alias("k"), F.sum(F.col("o") * F.col("o") / F.col("p")).alias("s"))
    return per.select("cell", (F.col("s") / F.col("k") - F.col("k")).alias("chi2"), "k")


def kbet_balance(neighbours: DataFrame, batches: DataFrame) -> DataFrame:
    """(max_std): largest deviation over cells of a batch's neighbour count; near 0: balanced by design."""
    b = batches.select(F.col("cell").alias("nbr"), F.col("batch").cast("string").alias("batch"))
    n = batches.agg(F.count("*").alias("n"))
    seen = neighbours.join(b, "nbr").groupBy("cell", "batch").agg(F.count("*").alias("o"))
    s = seen.groupBy("batch").agg(F.sum("o").alias("s"), F.sum(F.col("o") * F.col("o")).alias("q")).crossJoin(n)
    return s.agg(F.max(F.sqrt(F.greatest(F.col("q") / F.col("n") - (F.col("s") / F.col("n")) * (F.col("s") / F.col("n")), F.lit(0.0)))).alias("max_std"))


def kbet_pvalues(neighbours: DataFrame, batches: DataFrame) -> DataFrame:
    """(cell, chi2, k, p): the test of every cell; p is 1 for a single batch and null where neighbours are balanced by construction."""
    n = batches.select("batch").distinct().count()
    chi2 = kbet_chi2(neighbours, batches)
    if n > 1 and kbet_balance(neighbours, batches).first()[0] < 0.01:
        return chi2.withColumn("p", F.lit(None).cast("double"))

    @F.pandas_udf("double")
    def tail(x: pd.Series) -> pd.Series:
        return pd.Series(chi2_tails(x.to_numpy(), n - 1))

    return chi2.withColumn("p", tail("chi2"))


def kbet(neighbours: DataFrame, batches: DataFrame, alpha: float = 0.05) -> tuple[float | None, str]:
    """(acceptance, note): share of cells whose test is not rejected; None where it means nothing."""
    if batches.select("batch").distinct().count() <= 1:
        return 1.0, ""
    share = kbet_pvalues(neighbours, batches).agg(F.avg((F.col("p") >= alpha).cast("double"))).first()[0]
    return share, "" if share is not None else "neighbours are balanced over batches by construction"


def graph_connectivity(neighbours: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, n_cells, largest, share): each label's largest component of same-label edges."""
    lab = labels.select("cell", F.col("label").cast("string").alias("label")).where("label is not null")
    e = neighbours.select("cell", "nbr").join(lab, "cell").join(lab.select(F.col("cell").alias("nbr"), F.col("label").alias("l")), "nbr").where("label = l")
    comp = components(e.select(F.col("cell").alias("u"), F.col("nbr").alias("v")), "graph")
    size = lab.join(comp, lab.cell == comp.node, "left").groupBy("label", F.coalesce("root", "cell").alias("root")).agg(F.count("*").alias("n"))
    per = size.groupBy("label").agg(F.sum("n").alias("n_cells"), F.max("n").alias("largest"))
    return per.select("label", "n_cells", "largest", (F.col("largest") / F.col("n_cells")).alias("share"))


def distance_sums(points: DataFrame, block: int = BLOCK) -> DataFrame:
    """(cell, part, own, cluster, s, n): sum of distances to, and number of, other cells of each cluster.

    points: (cell, vec, cluster, part); only cells of the same part are compared: blocks are dealt
    inside each part.
    """
    pts = points.select("cell", F.col("part").cast("string").alias("part"), F.col("cluster").cast("string").alias("cluster"), "vec")
    codes = pts.select("part", "cluster").distinct().withColumn("code", F.row_number().over(Window.partitionBy("part").orderBy("cluster")) - 1)
    many = pts.groupBy("part").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).collect()  # a row per part
    tasks, pairs, grid = partitions(points.sparkSession), max(1, sum(r["blocks"] ** 2 for r in many)), []
    for r in many:
        grid.append((r["part"], r["blocks"], *sides(r["blocks"], r["blocks"], -(-tasks * r["blocks"] ** 2 // pairs))))
    grid = points.sparkSession.createDataFrame(grid, "part string, blocks int, rows int, cols int")
    pts = pts.join(codes, ["part", "cluster"]).join(grid, "part").withColumn("b", F.pmod(F.xxhash64("cell"), F.col("blocks")).cast("int"))
    ps = stage(packed(pts, "part", "rows", "cols", "b"), "blocks")
    both = beside(ps, ps, ["part"], tasks)

    def run(batches):
        import pyarrow as pa

        for (part,), qc, qb, q, held in meetings(batches, 1):
            one = np.hstack([-2 * q, np.ones((len(q), 1)), (q * q).sum(1)[:, None]])
            s, n = np.zeros((len(qc), len(held))), np.zeros((len(qc), len(held)), np.int64)
            for at, (_, cells, x) in enumerate(held):
                for lo in range(0, len(cells), BLOCK):
                    pc, p = cells[lo : lo + BLOCK], x[lo : lo + BLOCK]
                    d = one @ np.hstack([p, (p * p).sum(1)[:, None], np.ones((len(p), 1))]).T
                    np.sqrt(np.maximum(d, 0, out=d), out=d)
                    own = np.flatnonzero(np.isin(pc, qc))
                    same = qc[:, None] == pc[None, own]
                    s[:, at] += d.sum(1) - np.where(same, d[:, own], 0.0).sum(1)
                    n[:, at] += len(pc) - same.sum(1)
            rows = [np.repeat(qc, len(held)), np.repeat(qb, len(held)), np.tile(np.array([c for c, _, _ in held], np.int32), len(qc)), s.ravel(), n.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array([part] * s.size, pa.string()), *map(pa.array, rows)], ["part", "cell", "own", "other", "s", "n"])

    sums = both.mapInArrow(run, "part string, cell long, own int, other int, s double, n long").groupBy("part", "cell", "own", "other").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    one, two = (codes.select("part", F.col("code").alias(c), F.col("cluster").alias(f"name {c}")) for c in ("own", "other"))
    return sums.join(one, ["part", "own"]).join(two, ["part", "other"]).select("cell", "part", F.col("name own").alias("own"), F.col("name other").alias("cluster"), "s", "n")


def silhouettes(points: DataFrame, block: int = BLOCK) -> DataFrame:
    """(cell, part, cluster, s): silhouette of every cell inside its part.

    A cell alone in its cluster has 0, and so have all cells of a part with one cluster.
    """
    return _widths(distance_sums(points, block))


def silhouettes_precomputed(dist: DataFrame, labels: DataFrame) -> DataFrame:
    """The same from distances (i, j, d) and labels (cell, label); a zero diagonal is ignored."""
    lab = labels.select("cell", F.col("label").cast("string").alias("l"))
    a, b = lab.select(F.col("cell").alias("i"), F.col("l").alias("own")), lab.select(F.col("cell").alias("j"), F.col("l").alias("cluster"))
    s = dist.join(a, "i").join(b, "j").groupBy(F.col("i").alias("cell"), "own", "cluster").agg(F.sum(F.when(F.col("i") == F.col("j"), 0.0).otherwise(F.col("d"))).alias("s"), F.sum((F.col("i") != F.col("j")).cast("long")).alias("n"))
    return _widths(s.withColumn("part", F.lit("0")))


def _widths(sums: DataFrame) -> DataFrame:
    mean = F.col("s") / F.when(F.col("n") == 0, None).otherwise(F.col("n"))
    per = sums.groupBy("cell", "part", "own").agg(F.max(F.when(F.col("own") == F.col("cluster"), mean)).alias("a"), F.min(F.when(F.col("own") != F.col("cluster"), mean)).alias("b"))
    top = F.greatest("a", "b")
    s = F.when(F.col("a").isNull() | F.col("b").isNull() | (top == 0), 0.0).otherwise((F.col("b") - F.col("a")) / top)
    return per.select("cell", "part", F.col("own").alias("cluster"), s.alias("s"))


def label_asw(points: DataFrame) -> DataFrame:
    """(score): mean silhouette over labels, rescaled to 0..1; 1 for one label."""
    s = silhouettes(points.select("cell", "vec", F.col("label").alias("cluster"), F.lit("0").alias("part")))
    return s.agg(F.countDistinct("cluster").alias("k"), F.avg("s").alias("m")).select(F.when(F.col("k") < 2, 1.0).otherwise((F.col("m") + 1) / 2).alias("score"))


def batch_asw(points: DataFrame) -> DataFrame:
    """(score): mean over labels of the mean of 1 - |s|, s over batches inside the label.

    Only labels with more than one batch and fewer batches than cells count.
    """
    s = silhouettes(points.select("cell", "vec", F.col("batch").alias("cluster"), F.col("label").alias("part")))
    per = s.groupBy("part").agg(F.countDistinct("cluster").alias("k"), F.count("*").alias("n"), F.avg(1 - F.abs("s")).alias("m"))
    return per.where("k > 1 and k < n").agg(F.avg("m").alias("score"))


def isolated_asw(points: DataFrame, threshold: int | None = None) -> DataFrame:
    """(score): mean over isolated labels (in few batches) of their members' rescaled silhouette."""
    spread = points.groupBy("label").agg(F.countDistinct("batch").alias("b"))
    most = threshold if threshold is not None else spread.agg(F.min("b")).first()[0]
    alone = spread.where(F.col("b") <= F.lit(most)).select(F.col("label").alias("part"))
    # distances to the label's own cells and, over all other labels, to the rest: one pass whatever the number of isolated labels
    sums = distance_sums(points.select("cell", "vec", F.col("label").alias("cluster"), F.lit("0").alias("part"))).join(alone.select(F.col("part").cast("string").alias("own")), "own", "left_semi")
    two = F.when(F.col("own") == F.col("cluster"), F.col("own")).alias("cluster")
    s = _widths(sums.groupBy("cell", "part", "own", two).agg(F.sum("s").alias("s"), F.sum("n").alias("n")).withColumn("cluster", F.coalesce("cluster", F.concat(F.lit("not "), "own"))))
    return s.groupBy("cluster").agg(F.avg((F.col("s") + 1) / 2).alias("m")).agg(F.avg("m").alias("score"))


def adjusted_rand(a: DataFrame, b: DataFrame) -> DataFrame:
    """(ari) of two labelings (cell, cluster)."""
    both = a.select("cell", F.col("cluster").alias("x")).join(b.select("cell", F.col("cluster").alias("y")), "cell")
    table = both.groupBy("x", "y").agg(F.count("*").cast("double").alias("n"))
    pairs = F.sum(F.col("n") * (F.col("n") - 1) / 2)
    cells = table.agg(pairs.alias("ij"), F.sum("n").alias("t"))
    rows = table.groupBy("x").agg(F.sum("n").alias("n")).agg(pairs.alias("i"))
    cols = table.groupBy("y").agg(F.sum("n").alias("n")).agg(pairs.alias("j"))
    all_ = cells.crossJoin(rows).crossJoin(cols)  # one row each
    expect = F.col("i") * F.col("j") / (F.col("t") * (F.col("t") - 1) / 2)
    half = (F.col("i") + F.col("j")) / 2
    return all_.select(F.when(half == expect, 1.0).otherwise((F.col("ij") - expect) / (half - expect)).alias("ari"))


def modularity(edges: DataFrame, labels: DataFrame, kind: str = "newman") -> DataFrame:
    """(a, b) of a partition: quality at resolution g is a - g b. edges: (i, j, w) both ways."""
    if kind not in ("newman", "cpm"):
        raise ValueError(f"modularity: {kind!r}")
    l = labels.select("cell", "cluster")
    e = edges.join(l.select(F.col("cell").alias("i"), F.col("cluster").alias("ci")), "i").join(l.select(F.col("cell").alias("j"), F.col("cluster").alias("cj")), "j")
    per = e.groupBy("ci").agg(F.sum("w").alias("deg"), F.sum(F.when(F.col("ci") == F.col("cj"), F.col("w")).otherwise(0.0)).alias("inside"))
    total = per.agg(F.sum("deg").alias("t"), F.sum("inside").alias("in"), F.sum(F.col("deg") * F.col("deg")).alias("d2"))
    if kind == "cpm":
        size = l.groupBy("cluster").agg(F.count("*").cast("double").alias("n")).agg((F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))).alias("b"))
        out = total.crossJoin(size)
        return out.select(F.when(F.col("t") > 0, F.col("in") / F.col("t")).otherwise(0.0).alias("a"), F.when(F.col("t") > 0, F.col("b")).otherwise(0.0).alias("b"))
    return total.select(F.when(F.col("t") > 0, F.col("in") / F.col("t")).otherwise(0.0).alias("a"), F.when(F.col("t") > 0, F.col("d2") / (F.col("t") * F.col("t"))).otherwise(0.0).alias("b"))


def mean_conductance(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(conductance): cut / min(volume, rest) averaged over clusters by size; 1 if none counts."""
    l = labels.select("cell", "cluster")
    e = edges.join(l.select(F.col("cell").alias("i"), F.col("cluster").alias("ci")), "i").join(l.select(F.col("cell").alias("j"), F.col("cluster").alias("cj")), "j")
    per = e.groupBy(F.col("ci").alias("cluster")).agg(F.sum("w").alias("vol"), F.sum(F.when(F.col("ci") != F.col("cj"), F.col("w")).otherwise(0.0)).alias("cut"))
    total = per.agg(F.sum("vol").alias("t"))
    size = l.groupBy("cluster").agg(F.count("*").alias("n"))
    x = size.join(per, "cluster").crossJoin(total).withColumn("low", F.least(F.col("vol"), F.col("t") - F.col("vol"))).where("n >= 2 and low > 0")
    return x.agg(F.coalesce(F.sum(F.col("n") * F.col("cut") / F.col("low")) / F.sum("n"), F.lit(1.0)).alias("conductance"))


def category_scores(metrics: DataFrame) -> DataFrame:
    """(route, batch, bio, homogeneity, overall) of (route, metric, value); weights over what is there."""
    groups = {"batch": ("ilisi", "batch_silhouette"), "bio": ("clisi", "graph_connectivity", "label_silhouette", "isolated_label"), "homogeneity": ("rogue_mean", "sccaf")}
    per = metrics.groupBy("route").agg(*[F.avg(F.when(F.col("metric").isin(*m), F.col("value"))).alias(g) for g, m in groups.items()])
    weights = {"batch": 0.35, "bio": 0.45, "homogeneity": 0.20}
    top = sum((F.coalesce(F.col(g) * w, F.lit(0.0)) for g, w in weights.items()), F.lit(0.0))
    low = sum((F.when(F.col(g).isNotNull(), F.lit(w)).otherwise(0.0) for g, w in weights.items()), F.lit(0.0))
    return per.select("route", *groups, F.when(low > 0, top / low).alias("overall"))


def pick_route(metrics: DataFrame, order: list[str]) -> DataFrame:
    """(route, mean): the best by metric ``mean``; ties and nothing at all go to the first in order."""
    means = metrics.where("metric = 'mean' and value is not null and not isnan(value)").select("route", "value")
    rank = F.array_position(F.array(*[F.lit(r) for r in order]), F.col("route"))
    known = metrics.select("route").distinct().join(means, "route", "left").where(rank > 0)
    return known.orderBy(F.col("value").desc_nulls_last(), rank).limit(1).select("route", F.coalesce("value", F.lit(float("-inf"))).alias("mean"))


def comparison_table(metrics: DataFrame, names: list[str]) -> DataFrame:
    """One row per route, one column per metric, values rounded to 4 digits."""
    return metrics.groupBy("route").pivot("metric", names).agg(F.round(F.first("value"), 4))
