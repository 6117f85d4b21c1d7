"""Nearest neighbours and weighted graphs as edge tables.

Points are dealt into blocks of bounded size. A task holds some blocks while others pass by; each pair of
blocks is one unit of numpy work, whatever the batch sizes, and a window keeps the nearest of the partial results.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.staging import partitions, stage

BLOCK = 2048
HELD = 1 << 17  # points that a task holds while others pass by: 64 MB at 64 components
PIECE = 1 << 16  # exact distances at once


def normalise(points: DataFrame) -> DataFrame:
    """points with vec of unit length; a zero vector stays as it is."""
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    return points.withColumn("norm", norm).withColumn("vec", F.transform("vec", lambda x: x / F.when(F.col("norm") == 0, 1.0).otherwise(F.col("norm")))).drop("norm")


def coded(points: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """points with an int ``code`` for their batch, and the batches' sizes by name in order of code."""
    sizes = {r["batch"]: r["count"] for r in points.groupBy("batch").count().orderBy("batch").collect()}  # a row per batch
    codes = points.sparkSession.createDataFrame([(b, i) for i, b in enumerate(sizes)], "name string, code int")
    return points.join(codes, points["batch"].eqNullSafe(codes["name"])).drop("name"), sizes


def packed(points: DataFrame, *key) -> DataFrame:
    """Blocks (*key, cells, codes, xs) of points (cell, code, vec, *key): flat arrays of numbers."""
    flat = [F.collect_list("cell").alias("cells"), F.collect_list("code").alias("codes"), F.flatten(F.collect_list(F.col("vec").cast("array<double>"))).alias("xs")]
    return points.groupBy(*key).agg(*flat)


def arrays(batch, row: int, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells, codes and vectors of the block in a row of an Arrow batch, whose columns start at first."""
    cells, codes, xs = (batch.column(first + i)[row].values.to_numpy(zero_copy_only=False) for i in range(3))
    return cells, codes, xs.reshape(len(cells), -1)


def _dealt(points: DataFrame, block: int, n: int | None = None) -> tuple[DataFrame, int]:
    blocks = max(1, -(-(points.count() if n is None else n) // block))
    return packed(points.withColumn("b", F.pmod(F.xxhash64("cell"), F.lit(blocks)).cast("int")), "b"), blocks


def sides(blocks: int, others: int, p: int) -> tuple[int, int]:
    """Groups of blocks that tasks hold and of blocks that pass by: tasks for p partitions, at most HELD points held in each.

    Every block is sent once per group of the other side, so what is sent grows with the points and not with their pairs.
    """
    rows = max(1, min(blocks, max(math.isqrt(p), -(-blocks * BLOCK // HELD))))
    return rows, max(1, min(others, -(-p // rows)))


def beside(points: DataFrame, queries: DataFrame, key: list[str], tasks: int) -> DataFrame:
    """Rows (*key, r, c, side, cells, codes, xs) in which the blocks of a grid's place follow each other, points (side 0) first.

    Blocks are (*key, b, cells, codes, xs, rows, cols); rows and cols: `sides` of the key. A place holds the points
    of its row and meets the queries of its column.
    """
    block = ["cells", "codes", "xs"]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    p = points.select(*key, F.pmod("b", "rows").cast("int").alias("r"), every("cols").alias("c"), F.lit(0).alias("side"), "cols", *block)
    q = queries.select(*key, every("rows").alias("r"), F.pmod("b", "cols").cast("int").alias("c"), F.lit(1).alias("side"), "cols", *block)
    place = F.pmod((F.xxhash64(*key) if key else F.lit(0)) + F.col("r") * F.col("cols") + F.col("c"), F.lit(tasks)).cast("int")
    both = p.unionByName(q).repartitionById(tasks, place)
    return both.sortWithinPartitions(*key, "r", "c", "side").select(*key, "r", "c", "side", *block)


def meetings(batches, keys: int):
    """(key, cells, codes, vectors, held) for every block of queries; held: [(code, cells, vectors)] of the points in its place, by code."""
    at, parts, held = None, [], None
    for f in batches:
        for i in range(len(f)):
            now = tuple(f.column(c)[i].as_py() for c in range(keys + 2))
            if now != at:
                at, parts, held = now, [], None
            if not f.column(keys + 2)[i].as_py():
                parts.append(arrays(f, i, keys + 3))
                continue
            if held is None:
                held = []
                for code in np.unique(np.concatenate([c for _, c, _ in parts])) if parts else []:
                    own = [(cells[codes == code], x[codes == code]) for cells, codes, x in parts]
                    held.append((int(code), np.concatenate([c for c, _ in own]), np.concatenate([x for _, x in own])))
                parts = []
            yield now[:keys], *arrays(f, i, keys + 3), held


def block_pairs(points: DataFrame, block: int = BLOCK, queries: DataFrame | None = None, n: int | None = None) -> DataFrame:
    """Every block of queries beside every block of points, both (cell, code, vec), as `beside` has them; n: how many points, where that is known."""
    ps, n = _dealt(points, block, n)
    qs, m = (ps, n) if queries is None else _dealt(queries, block)
    rows, cols = sides(n, m, partitions(points.sparkSession))
    grid = {"rows": F.lit(rows), "cols": F.lit(cols)}
    return beside(ps.withColumns(grid), qs.withColumns(grid), [], rows * cols)


class Nearest:
    """The k nearest of each query among the points looked at; ties go to the smaller id."""

    def __init__(self, q: np.ndarray, k: int):
        self.q, self.k, self.n = q, k, np.zeros(len(q), np.int64)
        self.norm, self.dist, self.ids = (q * q).sum(1), np.full((len(q), k), np.inf), np.zeros((len(q), k), np.int64)

    def look(self, ids: np.ndarray, x: np.ndarray) -> None:
        """One product in single precision, where the size of the numbers allows it, rules out what is farther than the k-th so far by more than its rounding; exact distances decide."""
        norm = (x * x).sum(1)
        top, most = norm.max(initial=0.0), self.norm.max(initial=0.0)
        single = 1e-20 < top < 1e30 and 1e-20 < most < 1e30
        slack = (1e-6 * (10 + x.shape[1]) if single else 1e-9) * (self.norm + top)
        bound = self.dist[:, -1] ** 2 - self.norm + slack
        short = np.flatnonzero(self.n < self.k)
        if len(short) and len(x) > self.k:
            rough = norm - 2 * self.q[short] @ x.T
            bound[short] = np.partition(rough, self.k - 1, axis=1)[:, self.k - 1] + 2 * slack[short]
        kind = np.float32 if single else np.float64
        one = np.hstack([-2 * self.q, np.ones((len(self.q), 1)), -bound[:, None]]).astype(kind)
        two = np.hstack([x, norm[:, None], np.ones((len(x), 1))]).astype(kind)
        row, col = np.nonzero(~(one @ two.T > 0))  # what is no number stays in
        for at in range(0, len(row), PIECE):
            self._take(row[at : at + PIECE], ids[col[at : at + PIECE]], x[col[at : at + PIECE]])

    def _take(self, row: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        d = np.sqrt(((self.q[row] - x) ** 2).sum(1))
        own = np.unique(row)
        has = np.arange(self.k) < self.n[own, None]
        row = np.concatenate([row, np.repeat(own, self.n[own])])
        d, ids = np.concatenate([d, self.dist[own][has]]), np.concatenate([ids, self.ids[own][has]])
        order = np.lexsort((ids, d, row))
        row = row[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        kept = rank < self.k
        row, rank, order = row[kept], rank[kept], order[kept]
        self.dist[row, rank], self.ids[row, rank] = d[order], ids[order]
        self.n[own] = np.bincount(row, minlength=len(self.q))[own]


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of each kind of equal rows, and the kind of each row."""
    if not x.size:
        return np.arange(len(x)), np.arange(len(x))
    rows = np.ascontiguousarray(x).view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel()
    return np.unique(rows, return_index=True, return_inverse=True)[1:]


def _firsts(ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Points without those that have k equal ones of smaller id: no point has them among its k nearest."""
    first, kind = _distinct(x)
    if len(first) == len(x):
        return ids, x
    order = np.lexsort((ids, kind))
    kind = kind[order]
    kept = np.sort(order[np.arange(len(kind)) - np.searchsorted(kind, kind) < k])
    return ids[kept], x[kept]


_NEAR = "cell long, code int, nbr long, dist double"


def _nearest(pairs: DataFrame, k: int, names: list[str], keys: int = 0) -> DataFrame:
    """(cell, nbr_batch, slot, nbr, dist): the k nearest of each batch over the pairs of blocks; ties go to the smaller id."""

    def run(batches):
        import pyarrow as pa

        last, some = None, []
        for _, qc, _, q, held in meetings(batches, keys):
            if held is not last:
                last, some = held, [(code, *_firsts(ids, x, k)) for code, ids, x in held]
            first, kind = _distinct(q)  # equal points, which may be very many, have the same neighbours
            for code, ids, x in some:
                best = Nearest(q[first], k)
                for lo in range(0, len(ids), BLOCK):
                    best.look(ids[lo : lo + BLOCK], x[lo : lo + BLOCK])
                n = best.n[kind]
                there = np.arange(k) < n[:, None]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qc, n)), pa.array(np.full(n.sum(), code, np.int32)), pa.array(best.ids[kind][there]), pa.array(best.dist[kind][there])], ["cell", "code", "nbr", "dist"])

    w = Window.partitionBy("cell", "code").orderBy("dist", "nbr")
    best = pairs.mapInArrow(run, _NEAR).withColumn("slot", F.row_number().over(w)).where(F.col("slot") <= k)
    name = F.element_at(F.array(*[F.lit(x).cast("string") for x in names]), F.col("code") + 1) if names else F.lit(None).cast("string")
    return best.select("cell", name.alias("nbr_batch"), "slot", "nbr", "dist")


def _plain(points: DataFrame, metric: str) -> DataFrame:
    """(cell, batch, vec) of points, for a metric."""
    if metric not in ("euclidean", "cosine"):
        raise ValueError(f"metric: {metric!r}")
    pts = points.select("cell", F.col("batch").cast("string").alias("batch") if "batch" in points.columns else F.lit("").alias("batch"), "vec")
    return normalise(pts) if metric == "cosine" else pts


def knn(points: DataFrame, k: int, metric: str = "euclidean", queries: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """(cell, nbr_batch, slot, nbr, dist): the k nearest of each batch to every cell, itself included.

    points: (cell, vec, batch). Ties go to the smaller id. A batch of fewer than k cells gives
    fewer rows. metric: euclidean, or cosine (of normalised vectors, as euclidean distance).
    """
    pts, sizes = coded(_plain(points, metric))
    qry = None if queries is None else _plain(queries, metric).withColumn("code", F.lit(0))
    return _nearest(block_pairs(pts, block, qry, sum(sizes.values())), k, [*sizes])


MAX_CENTRES = 100_000  # of all batches, which are broadcast: 40 MB at 50 dimensions
GROUP = 4  # a group holds so many times the lists that a query looks into


def _centroids(x: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centre = x[rng.choice(len(x), min(n, len(x)), replace=False)]
    for _ in range(10):
        near = ((centre**2).sum(1)[None] - 2 * x @ centre.T).argmin(1)
        size, total = np.bincount(near, minlength=len(centre)), np.zeros_like(centre)
        np.add.at(total, near, x)
        centre = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centre)
    return centre


def fit_lists(points: DataFrame, sizes: dict[int, int], lists: int | None = None, sample: int = 20_000) -> dict[int, np.ndarray]:
    """Centroids of each batch (code) of points (cell, code, vec), fit side by side on about ``sample`` of its points or fewer."""
    rate = F.element_at(F.map_from_arrays(F.array(*map(F.lit, sizes)), F.array(*[F.lit(int(min(1.0, sample / n) * (1 << 20))) for n in sizes.values()])), F.col("code"))
    drawn = F.pmod(F.xxhash64("cell"), F.lit(1 << 20))
    # a small batch may have no point under its rate, but it has a first one
    first = points.groupBy("code").agg(F.min_by("cell", drawn).alias("cell")).withColumn("first", F.lit(True))
    some = points.join(first, ["code", "cell"], "left").where((drawn <= rate) | F.col("first")).select("code", "cell", "vec")
    most = max(1, MAX_CENTRES // len(sizes))

    def fit(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("cell")
        x, n = np.stack(f["vec"].to_numpy()), sizes[int(f["code"].iloc[0])]
        c = _centroids(x, min(most, lists or max(1, min(int(np.sqrt(n)), len(x)))))
        return pd.DataFrame({"code": f["code"].iloc[0], "list": np.arange(len(c)), "centre": list(c)})

    found: dict[int, list] = {}
    for r in some.groupBy("code").applyInPandas(fit, "code int, list int, centre array<double>").orderBy("code", "list").collect():
        found.setdefault(r["code"], []).append(r["centre"])
    return {c: np.array(v) for c, v in found.items()}


def _ranks(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Lists in order of distance, a row for each vector."""
    return np.argsort((centres**2).sum(1)[None] - 2 * v @ centres.T, axis=1, kind="stable")


def _probes(pts: DataFrame, centres: dict[int, np.ndarray], names: list[str], k: int, share: float, trials: int, n: int) -> int:
    """Lists to look into so that, for some cells, share of the true neighbours of every batch lie there."""
    some = pts.where(F.pmod(F.xxhash64("cell", F.lit("trial")), F.lit(1 << 20)) <= int(min(1.0, trials / n) * (1 << 20))).orderBy("cell").limit(2 * trials)
    vec = {r["cell"]: np.array(r["vec"], float) for r in some.select("cell", "vec").collect()}
    found = _nearest(block_pairs(pts, BLOCK, some), k, [str(c) for c in range(len(names))])
    truth = found.join(pts.select(F.col("cell").alias("nbr"), "vec"), "nbr").select("cell", "nbr_batch", "vec").collect()  # trials x batches x k rows
    need: dict[str, list[int]] = {}
    for cell, batch, near in truth:
        c = centres[int(batch)]
        own = int(((c - np.array(near)) ** 2).sum(1).argmin())
        d = ((c - vec[cell]) ** 2).sum(1)
        need.setdefault(batch, []).append(int((d < d[own]).sum()) + 1)
    return max((int(np.quantile(v, share, method="higher")) for v in need.values()), default=1)


def knn_ivf(points: DataFrame, k: int, lists: int | None = None, probes: int | None = None, sample: int = 20_000, metric: str = "euclidean", share: float = 0.97, trials: int = 200, queries: DataFrame | None = None, centres: list[np.ndarray] | None = None) -> DataFrame:
    """Approximate knn, for large tables: cells meet only in the neighbourhood of near centroids.

    Each batch has its own lists, whose centroids are fit on at most about ``sample`` of its
    points (or given: one array for each batch in order of name); every point is in one list. Lists that lie
    together, of all batches, form a group, and a query goes, with one copy of its vector, to each group that
    has one of its ``probes`` nearest lists of some batch; there it is compared with all points. Where no number of
    probes is given, it is as many as hold ``share`` of the true neighbours of some ``trials`` cells. Groups of more
    than BLOCK points are cut into blocks. Cells that find fewer than k of a batch that has more are
    compared with all of it. So every cell has k rows for each batch (all of a smaller one).
    """
    pts, found = coded(_plain(points, metric))
    names, sizes = [*found], dict(enumerate(found.values()))
    pts = stage(pts.select("cell", "code", "vec", "batch"), "points")
    qry = pts if queries is None else stage(_plain(queries, metric).select("cell", F.lit(0).alias("code"), "vec"), "queries")
    if not sizes:
        return _nearest(block_pairs(pts, BLOCK, qry), k, names)
    held = dict(enumerate(centres)) if centres is not None else fit_lists(pts, sizes, lists, sample)
    probes = probes or _probes(pts, held, names, k, share, trials, sum(sizes.values()))
    every = np.vstack([held[c] for c in sorted(held)])
    n_groups = max(1, len(every) // (GROUP * probes * len(held)))
    middle = _centroids(every, n_groups)
    groups, at = {}, _ranks(every, middle)[:, 0]
    for c in sorted(held):
        groups[c], at = at[: len(held[c])], at[len(held[c]) :]
    sent = pts.sparkSession.sparkContext.broadcast((held, groups))

    def to_groups(own: bool):
        def run(batches):
            import pyarrow as pa

            held, groups = sent.value
            for b in batches:
                if not len(b):
                    continue
                v, code = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1), b.column(1).to_numpy()
                if own:
                    of, group = np.arange(len(b)), np.zeros(len(b), np.int64)
                    for c in np.unique(code):
                        some = np.flatnonzero(code == c)
                        group[some] = groups[c][_ranks(v[some], held[c])[:, 0]]
                else:
                    asked = np.hstack([groups[c][_ranks(v, held[c])[:, :probes]] for c in held])
                    pair = np.unique(np.repeat(np.arange(len(b)), asked.shape[1]) * (n_groups + 1) + asked.ravel())
                    of, group = pair // (n_groups + 1), pair % (n_groups + 1)
                yield pa.RecordBatch.from_arrays([*(b.column(i).take(pa.array(of)) for i in range(3)), pa.array(group.astype(np.int32))], ["cell", "code", "vec", "g"])

        return run

    schema = "cell long, code int, vec array<double>, g int"
    part = F.pmod(F.xxhash64("cell"), F.lit(1 << 16)).cast("int")

    placed, asked = (stage(rows.select("cell", "code", F.col("vec").cast("array<double>").alias("vec")).mapInArrow(to_groups(own), schema), name) for rows, own, name in ((pts, True, "placed"), (qry, False, "asked")))
    cuts = (rows.groupBy("g").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name)) for rows, name in ((placed, "points"), (asked, "queries")))
    tasks, grid = partitions(pts.sparkSession), []
    sizes_of = {r["g"]: (r["points"], r["queries"]) for r in next(cuts).join(next(cuts), "g").collect()}  # a row per group
    for g, (a, b) in sizes_of.items():
        rows, cols = sides(a, b, -(-tasks * a * b // max(1, sum(x * y for x, y in sizes_of.values()))))
        grid.append((g, a, b, rows, cols))
    grid = stage(pts.sparkSession.createDataFrame(grid, "g int, points int, queries int, rows int, cols int"), "grid")

    def blocks(rows: DataFrame, cuts: str) -> DataFrame:
        return packed(rows.join(F.broadcast(grid), "g").withColumn("b", F.pmod(part, F.col(cuts))), "g", "b", "rows", "cols")

    found = stage(_nearest(beside(blocks(placed, "points"), blocks(asked, "queries"), ["g"], tasks), k, names, 1), "found")
    want = pts.sparkSession.createDataFrame([(names[c], min(k, n)) for c, n in sizes.items()], "nbr_batch string, want int")
    have = found.groupBy("cell", "nbr_batch").count()
    short = qry.select("cell", "vec").crossJoin(want).join(have, ["cell", "nbr_batch"], "left").where(F.coalesce("count", F.lit(0)) < F.col("want")).select("cell", "vec", "nbr_batch")  # a row per batch
    short = stage(short, "short")
    for batch in [r[0] for r in short.select("nbr_batch").distinct().collect()]:
        own = short.where(F.col("nbr_batch") == batch)
        exact = knn(pts.where(F.col("batch") == batch), k, queries=own.select("cell", "vec"))
        found = found.join(own.select("cell", "nbr_batch"), ["cell", "nbr_batch"], "left_anti").select(exact.columns).unionByName(exact)
    return found


def batch_balanced(points: DataFrame, k: int = 3, backend: str = "auto", threshold: int = 5000, metric: str = "euclidean") -> DataFrame:
    """knn per batch; backend auto is exact until a batch has ``threshold`` cells."""
    if backend not in ("auto", "brute", "hnsw", "ivf"):
        raise ValueError(f"backend: {backend!r}")
    if backend == "auto":
        largest = points.groupBy("batch").count().agg(F.max("count")).first()[0] or 0
        backend = "brute" if largest < threshold else "ivf"
    return knn(points, k, metric) if backend == "brute" else knn_ivf(points, k, metric=metric)


def plain(points: DataFrame, k: int = 30, metric: str = "cosine", backend: str = "auto") -> DataFrame:
    return batch_balanced(points.withColumn("batch", F.lit("0")), k, backend, metric=metric)


def distances(neighbours: DataFrame) -> DataFrame:
    return neighbours.select(F.col("cell").alias("i"), F.col("nbr").alias("j"), F.col("dist").alias("d"))


def transpose(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("j").alias("i"), F.col("i").alias("j"), *[c for c in edges.columns if c not in ("i", "j")])


def strongest(edges: DataFrame) -> DataFrame:
    """Edges (i, j, w) with the largest weight where one is listed more than once."""
    return edges.groupBy("i", "j").agg(F.max("w").alias("w"))


def bandwidths(dist: np.ndarray, steps: int = 64, tol: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """rho and sigma per row of distances (inf: absent): the kernel's sum meets log2 of the width."""
    target = np.log2(dist.shape[1])
    there = np.isfinite(dist)
    rho = np.where(there & (dist > 0), dist, np.inf).min(1)
    rho = np.where(np.isfinite(rho), rho, 0.0)
    lo, hi, mid = np.zeros(len(dist)), np.full(len(dist), np.inf), np.ones(len(dist))
    open_ = np.ones(len(dist), bool)
    gap = np.where(there, dist, 0.0) - rho[:, None]
    for _ in range(steps):
        total = np.where(there, np.exp(-np.maximum(gap, 0.0) / mid[:, None]), 0.0).sum(1)
        open_ &= np.abs(total - target) >= tol
        if not open_.any():
            break
        above = total > target
        hi = np.where(open_ & above, mid, hi)
        lo = np.where(open_ & ~above, mid, lo)
        with np.errstate(invalid="ignore"):
            new = np.where(np.isinf(hi), mid * 2, (lo + hi) / 2)
        mid = np.where(open_, new, mid)
    return rho, mid


def bandwidth_table(neighbours: DataFrame, width: int) -> DataFrame:
    """(cell, rho, sigma): `bandwidths` of each cell's neighbour distances; width: slots a cell has."""
    per = neighbours.groupBy("cell").agg(F.collect_list("dist").alias("d"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            size = b.column(1).value_lengths().to_numpy(zero_copy_only=False)
            d = np.full((len(b), width), np.inf)
            d[np.arange(width) < size[:, None]] = b.column(1).flatten().to_numpy(zero_copy_only=False)
            rho, sigma = bandwidths(d)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rho), pa.array(sigma)], ["cell", "rho", "sigma"])

    return per.mapInArrow(run, "cell long, rho double, sigma double")


def kernel(neighbours: DataFrame, bands: DataFrame, least: float = 1e-8) -> DataFrame:
    """(i, j, w): 1 up to rho and exp(-(d - rho) / sigma) beyond it, for neighbours (cell, nbr, dist) and bands (cell, rho, sigma)."""
    near = (F.col("dist") <= F.col("rho")) | (F.col("sigma") <= 0)
    w = F.when(near, 1.0).otherwise(F.exp(-(F.col("dist") - F.col("rho")) / F.col("sigma")))
    e = neighbours.where("cell != nbr").join(bands, "cell").select(F.col("cell").alias("i"), F.col("nbr").alias("j"), w.alias("w"))
    return strongest(e.where(F.col("w") > least))


def memberships(neighbours: DataFrame, width: int) -> DataFrame:
    """(i, j, w): directed weights of each cell's neighbours; width: slots a cell has."""
    return kernel(neighbours, bandwidth_table(neighbours, width))


def fuzzy_union(directed: DataFrame, mix: float = 1.0, least: float = 1e-8) -> DataFrame:
    """Symmetric weights p + q - pq (mix 1) or pq (mix 0) of (i, j, w) and its transpose."""
    p, q = directed.select("i", "j", F.col("w").alias("p")), transpose(directed).select("i", "j", F.col("w").alias("q"))
    both = p.join(q, ["i", "j"], "full_outer").na.fill(0.0, ["p", "q"])
    one = F.col("p") * F.col("q")
    w = mix * (F.col("p") + F.col("q") - one) + (1 - mix) * one
    return both.select("i", "j", w.alias("w")).where(F.col("w") > least)


def fuzzy_graph(neighbours: DataFrame, width: int | None = None) -> DataFrame:
    if width is None:
        width = neighbours.groupBy("cell").count().agg(F.max("count")).first()[0] or 1
    return fuzzy_union(memberships(neighbours, width))


def mutual_pairs(points: DataFrame, one, two, k: int, centres: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """(ref, cell): cells of batch two and of batch one that are among each other's k nearest.

    centres: centroids of either batch; with them neighbours are looked for in lists only.
    """
    a, b = points.where(F.col("batch") == one), points.where(F.col("batch") == two)
    if centres is None:
        there, back = knn(b, k, queries=a), knn(a, k, queries=b)
    else:
        there, back = knn_ivf(b, k, queries=a, centres=[centres[1]]), knn_ivf(a, k, queries=b, centres=[centres[0]])
    return there.select(F.col("cell").alias("ref"), F.col("nbr").alias("cell")).intersect(back.select(F.col("nbr").alias("ref"), "cell"))


def merge_order(points: DataFrame) -> DataFrame:
    """(batch, n_cells, step): batches by size, largest first, ties by name."""
    n = points.groupBy("batch").agg(F.count("*").alias("n_cells"))
    return n.withColumn("step", F.row_number().over(Window.orderBy(F.desc("n_cells"), "batch")))


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """(recall): mean share of each cell's true neighbours that were found."""
    t, g = truth.select("cell", "nbr").distinct(), found.select("cell", "nbr").distinct()
    hit = t.join(g.withColumn("hit", F.lit(1.0)), ["cell", "nbr"], "left")
    return hit.groupBy("cell").agg((F.sum(F.coalesce("hit", F.lit(0.0))) / F.count("*")).alias("r")).agg(F.avg("r").alias("recall"))
