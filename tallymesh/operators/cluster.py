"""Graph clustering and the choice of its resolution.

A clustering sweep sends the blocks of one graph to a task for each resolution; a graph of more edges
than that allows is contracted over its partitions first. Scores, hull and admissible ranges of the
partitions are small tables.
"""

from __future__ import annotations

import math
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .linalg import slopes
from ..plans.staging import partitions, stage
from .metrics import modularity, silhouettes

MAX_EDGES = 60_000_000  # edges and nodes of a graph that is sent to tasks (1.4 GB)


class _Graph:
    def __init__(self, n: int, i: np.ndarray, j: np.ndarray, w: np.ndarray):
        if (i[1:] < i[:-1]).any():
            order = np.argsort(i, kind="stable")
            i, j, w = i[order], j[order], w[order]
        self.n, self.to, self.w = n, j, w
        self.at = np.append(0, np.cumsum(np.bincount(i, minlength=n)))
        self.deg = np.bincount(i, w, n)

    def row(self, v: int) -> tuple[list[int], list[float]]:
        a, b = self.at[v], self.at[v + 1]
        return self.to[a:b].tolist(), self.w[a:b].tolist()


def _move(g: _Graph, part: np.ndarray, gamma: float, total: float, rng, within: np.ndarray | None = None) -> bool:
    """Move nodes to the best neighbouring community until none gains; in place.

    within: only into communities of the same coarse community, and only from singletons.
    """
    deg, load = g.deg, np.bincount(part, g.deg, g.n)
    size = np.bincount(part, minlength=g.n)
    queue, queued, moved, at = rng.permutation(g.n).tolist(), np.ones(g.n, bool), False, 0
    while at < len(queue):
        v = queue[at]
        at += 1
        queued[v] = False
        own = int(part[v])
        if within is not None and size[own] > 1:
            continue
        links: dict[int, float] = {}
        to, w = g.row(v)
        for u, x in zip(to, w, strict=True):
            if u != v and (within is None or within[u] == within[v]):
                c = int(part[u])
                links[c] = links.get(c, 0.0) + x
        d, scale = float(deg[v]), gamma * float(deg[v]) / total
        best, gain = own, links.get(own, 0.0) - scale * (load[own] - d)
        for c in sorted(links):
            if c != own:
                q = links[c] - scale * load[c]
                if q > gain + 1e-12:
                    best, gain = c, q
        if best != own:
            part[v] = best
            load[own] -= d
            load[best] += d
            size[own] -= 1
            size[best] += 1
            moved = True
            if within is None:
                for u in to:
                    if part[u] != best and not queued[u]:
                        queued[u] = True
                        queue.append(u)
    return moved


def leiden(n: int, i: np.ndarray, j: np.ndarray, w: np.ndarray, gamma: float = 1.0, iterations: int = 2, seed: int = 0) -> np.ndarray:
    """Communities (0, 1, ... by size) of an undirected graph given with both directions."""
    rng = np.random.default_rng(seed)
    part = np.arange(n)
    for _ in range(max(iterations, 1)):
        g, node, coarse = _Graph(n, i, j, w), np.arange(n), part.copy()
        total = float(g.deg.sum()) or 1.0
        while True:
            _move(g, coarse, gamma, total, rng)
            fine = np.arange(g.n)
            _move(g, fine, gamma, total, rng, within=coarse)
            names, code = np.unique(fine, return_inverse=True)
            if len(names) == g.n:
                break
            up = np.zeros(len(names), np.int64)
            up[code] = coarse
            a, b = code[np.repeat(np.arange(g.n), np.diff(g.at))], code[g.to]
            key, back = np.unique(a * len(names) + b, return_inverse=True)
            weight = np.bincount(back, g.w)
            node = code[node]
            _, coarse = np.unique(up, return_inverse=True)
            g = _Graph(len(names), key // len(names), key % len(names), weight)
        new = coarse[node]
        if len(np.unique(new)) == len(np.unique(part)) and len(np.unique(new * (part.max() + 1) + part)) == len(np.unique(part)):
            part = new
            break
        part = new
    names, code, size = np.unique(part, return_inverse=True, return_counts=True)
    order = np.lexsort((names, -size))
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names))
    return rank[code]


def gammas(least: float = 0.05, most: float = 1.5, n: int = 30) -> list[float]:
    """A grid of at least two resolutions, rounded to four digits, ascending."""
    return sorted({round(float(x), 4) for x in np.linspace(least, most, max(n, 2))})


GRAPH = "kind int, first long, second long, a binary, b binary, c binary"


def packed_graph(edges: DataFrame, cells: DataFrame) -> DataFrame:
    """A graph of up to MAX_EDGES edges and cells as staged blocks in order, nodes (kind 0) before edges (1), for `graph_of`.

    cells: (cell[, x, y]), y and x numbers that go along. Nothing passes through the driver.
    """
    n, m = edges.count(), cells.count()
    if n + m > MAX_EDGES:
        raise ValueError(f"{n} edges of {m} cells: more than the {MAX_EDGES} that are sent to tasks")
    x, y = (F.col(c).cast("double") if c in cells.columns else F.lit(0.0) for c in ("x", "y"))
    nodes = cells.select(F.lit(0).alias("kind"), F.col("cell").cast("long").alias("i"), F.lit(0).cast("long").alias("j"), x.alias("w"), y.alias("v"))
    rows = nodes.unionByName(edges.select(F.lit(1).alias("kind"), F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), F.col("w").cast("double").alias("w"), F.lit(0.0).alias("v")))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            kind, i, j, w, v = (b.column(c).to_numpy(zero_copy_only=False) for c in range(5))
            for k in (0, 1):
                lo, hi = np.searchsorted(kind, (k, k + 1))
                if hi > lo:
                    own = [x[lo:hi].tobytes() for x in ((i, w, v) if k == 0 else (i, j, w))]
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([i[lo]]), pa.array([j[lo]]), *[pa.array([x], pa.binary()) for x in own]], ["kind", "first", "second", "a", "b", "c"])

    dealt = rows.repartitionByRange(partitions(edges.sparkSession), "kind", "i", "j").sortWithinPartitions("kind", "i", "j")
    return stage(dealt.mapInArrow(run, GRAPH), "packed")


def graph_of(batches, first: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cells, their numbers, i, j, w) of the blocks of a graph in order, whose columns start at first; ends as positions among the cells."""
    nodes, held, ids = [], [], None
    for f in batches:
        kind = f.column(first).to_pylist()
        for r, k in enumerate(kind):
            a, b, c = (f.column(first + 3 + x)[r].as_py() for x in range(3))
            if k == 0:
                nodes.append((np.frombuffer(a, np.int64), np.stack([np.frombuffer(b), np.frombuffer(c)], axis=1)))
                continue
            if ids is None:
                ids = np.concatenate([x for x, _ in nodes])
            held.append((*(np.searchsorted(ids, np.frombuffer(x, np.int64)).astype(np.int32) for x in (a, b)), np.frombuffer(c)))
    ids = np.concatenate([np.zeros(0, np.int64), *(x for x, _ in nodes)])
    own = np.concatenate([np.zeros((0, 2)), *(x for _, x in nodes)])
    kinds = (np.int32, np.int32, np.float64)
    return ids, own, *(np.concatenate([np.zeros(0, t), *(x[c] for x in held)]) for c, t in enumerate(kinds))


def contracted(edges: DataFrame, cells: DataFrame, gamma: float, limit: int, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(edges, nodes): the graph (i, j, w) with like nodes merged until it has ``limit`` edges and nodes at most; nodes: (cell, node).

    In a round every node picks the neighbour whose company gains most at the resolution gamma; by
    a coin of the round half of the nodes stay, and those of the other half that picked one of them join it. A graph
    that is small enough comes back as it is; one in which nothing gains any more and that is still too large is an error.
    """
    nodes, e, idle = cells.select("cell", F.col("cell").alias("node")), edges.select("i", "j", F.col("w").cast("double").alias("w")), 0
    for turn in range(1000):
        size = e.count() + nodes.select("node").distinct().count()
        if size <= limit:
            return e, nodes
        deg = stage(e.groupBy("i").agg(F.sum("w").alias("d")), "degrees")
        total = deg.agg(F.sum("d")).first()[0] or 1.0
        both = e.where("i != j").join(deg.withColumnRenamed("d", "di"), "i").join(deg.select(F.col("i").alias("j"), F.col("d").alias("dj")), "j")
        gain = F.col("w") - gamma * F.col("di") * F.col("dj") / total
        best = both.where(gain > 0).groupBy("i").agg(F.max_by("j", F.struct(gain.alias("gain"), F.xxhash64(F.least("i", "j"), F.greatest("i", "j"), F.lit(turn)))).alias("to"))
        coin = lambda c, t=turn: F.pmod(F.xxhash64(c, F.lit(seed), F.lit(t)), F.lit(2))
        joins = stage(best.where((coin("i") == 0) & (coin("to") == 1)), "joins")
        idle = idle + 1 if joins.isEmpty() else 0
        if idle > 8:
            break
        i, j = (joins.select(F.col("i").alias(c), F.col("to").alias(f"to {c}")) for c in ("i", "j"))
        moved = e.join(i, "i", "left").join(j, "j", "left").select(F.coalesce("to i", "i").alias("i"), F.coalesce("to j", "j").alias("j"), "w")
        e = stage(moved.groupBy("i", "j").agg(F.sum("w").alias("w")), "contracted")
        nodes = stage(nodes.join(joins.select(F.col("i").alias("node"), "to"), "node", "left").select("cell", F.coalesce("to", "node").alias("node")), "nodes")
    raise ValueError(f"{size} edges and nodes, more than the {limit} that are sent to tasks, and no two of them belong together")


def sweep(edges: DataFrame, cells: DataFrame, grid: list[float], iterations: int = 2, seed: int = 0) -> DataFrame:
    """(gamma, cell, cluster) at every resolution of the grid. edges: (i, j, w) both ways.

    A graph of more than MAX_EDGES is contracted at the highest resolution, whose communities are the smallest.
    """
    spark = edges.sparkSession
    edges, nodes = contracted(edges, cells, max(grid), MAX_EDGES, seed)
    graph = packed_graph(edges, nodes.select(F.col("node").alias("cell")).distinct())

    def run(batches):
        import pyarrow as pa

        first = next((b for b in batches if len(b)), None)
        if first is None:
            return
        gamma = first.column(1)[0].as_py()
        ids, _, i, j, w = graph_of(chain([first], batches), 2)
        own = leiden(len(ids), i, j, w, gamma, iterations, seed)
        for at in range(0, len(ids), 1 << 16):
            x = ids[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), gamma)), pa.array(x), pa.array(own[at : at + len(x)].astype(np.int32))], ["gamma", "node", "cluster"])

    turns = spark.createDataFrame([(t, float(g)) for t, g in enumerate(grid)], "turn int, gamma double")  # a task for each resolution
    dealt = graph.crossJoin(F.broadcast(turns)).select("turn", "gamma", *graph.columns).repartitionById(len(grid), "turn").sortWithinPartitions("kind", "first", "second")
    found = dealt.mapInArrow(run, "gamma double, node long, cluster int")
    found = stage(found.join(nodes, "node").select("gamma", "cell", "cluster"), "found")
    size = found.groupBy("gamma", "cluster").agg(F.count("*").alias("n"))  # clusters are numbered by their cells
    size = size.withColumn("rank", (F.row_number().over(Window.partitionBy("gamma").orderBy(F.desc("n"), "cluster")) - 1).cast("int"))
    return found.join(size.drop("n"), ["gamma", "cluster"]).select("gamma", "cell", F.col("rank").alias("cluster"))


def distinct_partitions(labels: DataFrame) -> DataFrame:
    """(gamma, print): of equal labelings the one of lowest gamma. labels: (gamma, cell, cluster)."""
    one, two = F.xxhash64("cell", "cluster"), F.xxhash64("cluster", F.lit("print"), "cell")  # sums of hashes: no labeling is gathered
    marks = F.concat_ws(" ", F.count("*"), F.bit_xor(one), F.sum(F.pmod(one, F.lit(1 << 31))), F.bit_xor(two), F.sum(F.pmod(two, F.lit(1 << 31))))
    prints = labels.groupBy("gamma").agg(marks.alias("print"))
    return prints.withColumn("r", F.row_number().over(Window.partitionBy("print").orderBy("gamma"))).where("r = 1").drop("r")


def coefficients(edges: DataFrame, labels: DataFrame, kind: str = "newman") -> DataFrame:
    """(gamma, a, b) of every partition at once."""
    l = labels.select("gamma", "cell", "cluster")
    e = edges.join(l.withColumnsRenamed({"cell": "i", "cluster": "ci"}), "i").join(l.withColumnsRenamed({"cell": "j", "cluster": "cj"}), ["gamma", "j"])
    per = e.groupBy("gamma", "ci").agg(F.sum("w").alias("deg"), F.sum(F.when(F.col("ci") == F.col("cj"), F.col("w")).otherwise(0.0)).alias("inside"))
    t = per.groupBy("gamma").agg((F.sum("inside") / F.sum("deg")).alias("a"), (F.sum(F.col("deg") * F.col("deg")) / (F.sum("deg") * F.sum("deg"))).alias("b"))
    if kind == "cpm":
        n = l.groupBy("gamma", "cluster").agg(F.count("*").cast("double").alias("n"))
        t = t.drop("b").join(n.groupBy("gamma").agg((F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))).alias("b")), "gamma")
    return t.select("gamma", "a", "b")


def hull(points: list[tuple[float, float]]) -> list[int]:
    """Indices of the upper hull of (a, b), by ascending b; collinear points are left out.

    Twelve digits count: what the order of a sum changes beyond them decides nothing, and of equal points the first is meant.
    """
    points = [(round(a, 12), round(b, 12)) for a, b in points]
    order = sorted(range(len(points)), key=lambda k: (points[k][1], -points[k][0]))
    chain: list[int] = []
    for k in order:
        a, b = points[k]
        if chain and points[chain[-1]][1] == b:
            continue
        while len(chain) > 1:
            (a1, b1), (a2, b2) = points[chain[-2]], points[chain[-1]]
            if (b2 - b1) * (a - a1) - (a2 - a1) * (b - b1) < 0:
                break
            chain.pop()
        chain.append(k)
    return chain


def ranges(points: list[tuple[float, float]], gamma_min: float, gamma_max: float, metric: str = "log") -> list[dict]:
    """For each (a, b): on_hull, lo, hi and the width of the resolutions at which it is best."""
    chain = hull(points)
    cross = [(points[y][0] - points[x][0]) / (points[y][1] - points[x][1]) for x, y in zip(chain, chain[1:], strict=False)]
    out = [{"on_hull": False, "lo": None, "hi": None, "width": -math.inf} for _ in points]
    for k, p in enumerate(chain):
        lo = cross[k] if k < len(cross) else 0.0
        hi = cross[k - 1] if k else gamma_max
        lo, hi = min(max(lo, 0.0), gamma_max), min(max(hi, 0.0), gamma_max)
        if metric == "log":
            low = max(lo, gamma_min)
            width = math.log(max(hi, low)) - math.log(low)
        else:
            width = max(hi - lo, 0.0)
            if metric == "relative":
                width = width / ((hi + lo) / 2) if hi + lo > 0 else 0.0
        out[p] = {"on_hull": True, "lo": lo, "hi": hi, "width": max(width, 0.0)}
    return out


def pick_resolution(edges: DataFrame, cells: DataFrame, grid: list[float] | None = None, least: float = 0.05, most: float = 1.5, n: int = 30, kind: str = "newman", metric: str = "log", iterations: int = 2, seed: int = 0, labels: DataFrame | None = None) -> dict:
    """Cluster at every resolution and keep the partition that is best over the widest range.

    Returns gamma, labels (cell, cluster) and curve (gamma, a, b, on_hull, lo, hi, width, picked).
    """
    from ..plans.staging import stage

    grid = grid or gammas(least, most, n)
    runs = stage(sweep(edges, cells, grid, iterations, seed), "sweep") if labels is None else labels
    one = distinct_partitions(runs).select("gamma")
    rows = coefficients(edges, runs.join(one, "gamma"), kind).orderBy("gamma").collect()  # a row per resolution
    found = ranges([(r["a"], r["b"]) for r in rows], min(grid), max(grid), metric)
    best = max(range(len(rows)), key=lambda k: (found[k]["width"], -rows[k]["gamma"]))
    curve = [(float(r["gamma"]), float(r["a"]), float(r["b"]), f["on_hull"], f["lo"], f["hi"], f["width"], k == best) for k, (r, f) in enumerate(zip(rows, found, strict=True))]
    spark, gamma = edges.sparkSession, rows[best]["gamma"]
    table = spark.createDataFrame(curve, "gamma double, a double, b double, on_hull boolean, lo double, hi double, width double, picked boolean")
    return {"gamma": gamma, "labels": runs.where(F.col("gamma") == gamma).select("cell", "cluster"), "curve": table, "runs": runs}


def knee(curve: DataFrame) -> DataFrame:
    """(x): the point of (x, y) farthest from the chord between its ends."""
    ends = curve.agg(F.min("x").alias("x1"), F.max("x").alias("x2"), F.min_by("y", "x").alias("y1"), F.max_by("y", "x").alias("y2"))
    c = curve.crossJoin(ends)
    d = F.abs((F.col("y2") - F.col("y1")) * (F.col("x") - F.col("x1")) - (F.col("x2") - F.col("x1")) * (F.col("y") - F.col("y1")))
    return c.agg(F.max_by("x", F.struct(F.round(d, 9), -F.col("x"))).alias("x"))


def steepest(curve: DataFrame) -> DataFrame:
    """(x): where y rises most from one point to the next, the first of equals."""
    w = Window.orderBy("x")
    step = curve.select("x", (F.col("y") - F.lag("y").over(w)).alias("d")).where("d is not null")
    return step.agg(F.max_by("x", F.struct(F.round("d", 9), -F.col("x"))).alias("x"))


def bend(curve: DataFrame) -> DataFrame:
    """(x): the inner point of largest second difference, the first of equals."""
    w = Window.orderBy("x")
    d = F.lead("y").over(w) - 2 * F.col("y") + F.lag("y").over(w)
    return curve.select("x", d.alias("d")).where("d is not null").agg(F.max_by("x", F.struct(F.round("d", 9), -F.col("x"))).alias("x"))


def first_jump(curve: DataFrame, factor: float = 2.0) -> DataFrame:
    """(x): the first point whose step is over ``factor`` times the median step; null if none."""
    w = Window.orderBy("x")
    step = curve.select("x", (F.col("y") - F.lag("y").over(w)).alias("d")).where("d is not null")
    typical = step.agg((F.median(F.abs("d")) * factor).alias("t"))
    return step.crossJoin(typical).where("abs(d) > t").agg(F.min("x").alias("x"))


def rise(curve: DataFrame, share: float = 0.9) -> DataFrame:
    """(x): the first point at which y has made ``share`` of its way from least to most."""
    ends = curve.agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    return curve.crossJoin(ends).where(F.col("y") >= F.col("lo") + share * (F.col("hi") - F.col("lo"))).agg(F.min("x").alias("x"))


def first_plateau(curve: DataFrame, width: int = 5, share: float = 0.1) -> DataFrame:
    """(x): the first point whose windowed slope is at most ``share`` of the steepest; null if none."""
    s = slopes(curve, width)
    top = s.agg(F.max(F.abs("slope")).alias("top"))
    return s.crossJoin(top).where(F.abs("slope") <= share * F.col("top")).agg(F.min("x").alias("x"))


def log_knee(curve: DataFrame) -> DataFrame:
    """(x): knee of the curve with y on a logarithmic scale."""
    return knee(curve.select("x", F.log10(F.greatest(F.col("y").cast("double"), F.lit(1e-9))).alias("y")))


def bulge(curve: DataFrame) -> DataFrame:
    """(x): where the curve, scaled to the unit square, lies farthest from its diagonal; on the side it mostly lies on."""
    ends = curve.agg(F.min("x").alias("x1"), F.max("x").alias("x2"), F.min_by("y", "x").alias("y1"), F.max_by("y", "x").alias("y2"))
    unit = lambda v: (F.col(v) - F.col(f"{v}1")) / F.greatest(F.col(f"{v}2") - F.col(f"{v}1"), F.lit(1e-12))
    d = curve.crossJoin(ends).select("x", (unit("y") - unit("x")).alias("d"))  # one row of ends
    up, down = (F.max_by("x", F.struct(F.round(s * F.col("d"), 9), -F.col("x"))) for s in (1, -1))
    return d.agg(F.when(F.avg("d") < 0, down).otherwise(up).alias("x"))


def parsimony(scores: DataFrame) -> DataFrame:
    """(x): the largest x of (x, mean, sd) whose mean is within one deviation of the best mean's."""
    best = scores.agg(F.max(F.struct("mean", -F.col("x"), "sd")).alias("b"))
    return scores.crossJoin(best).where(F.col("mean") >= F.col("b.mean") - F.col("b.sd")).agg(F.max("x").alias("x"))


def embedding_silhouettes(points: DataFrame, labels: DataFrame, sample: int = 1000, rounds: int = 5) -> DataFrame:
    """(x, mean, sd): silhouette of each resolution's labels (gamma, cell, cluster) on the embedding.

    The mean and deviation of ``rounds`` samples of cells chosen by hash, at most ``sample`` each;
    a sample of one cluster scores 0. `parsimony` picks from the result.
    """
    per = None
    for r in range(rounds):
        some = points.select("cell", "vec").orderBy(F.xxhash64("cell", F.lit(r))).limit(sample)
        own = some.join(labels.select("gamma", "cell", "cluster"), "cell").withColumn("part", F.concat_ws("/", F.col("gamma").cast("string"), F.lit(str(r))))
        per = own if per is None else per.unionByName(own)
    per = stage(per, "samples")
    parts = per.groupBy("part", "gamma").agg(F.countDistinct("cluster").alias("k"))
    width = silhouettes(per.select("cell", "vec", "cluster", "part")).groupBy("part").agg(F.avg("s").alias("s"))
    one = parts.join(width, "part", "left").select("gamma", F.when(F.col("k") < 2, 0.0).otherwise(F.coalesce("s", F.lit(0.0))).alias("s"))
    return one.groupBy(F.col("gamma").alias("x")).agg(F.avg("s").alias("mean"), F.stddev_pop("s").alias("sd"))


def stability(runs: DataFrame) -> DataFrame:
    """(gamma, ari): agreement of each resolution's labels (gamma, cell, cluster) with the next one's."""
    grid = runs.select("gamma").distinct().withColumn("next", F.lead("gamma").over(Window.orderBy("gamma"))).where("next is not null")
    both = runs.join(grid, "gamma").select("gamma", "next", "cell", F.col("cluster").alias("x")).join(runs.select(F.col("gamma").alias("next"), "cell", F.col("cluster").alias("y")), ["next", "cell"])
    table = both.groupBy("gamma", "x", "y").agg(F.count("*").cast("double").alias("n"))
    pairs = F.sum(F.col("n") * (F.col("n") - 1) / 2)
    all_ = table.groupBy("gamma").agg(pairs.alias("ij"), F.sum("n").alias("t"))
    for c, name in (("x", "i"), ("y", "j")):
        all_ = all_.join(table.groupBy("gamma", c).agg(F.sum("n").alias("n")).groupBy("gamma").agg(pairs.alias(name)), "gamma")
    expect, half = F.col("i") * F.col("j") / (F.col("t") * (F.col("t") - 1) / 2), (F.col("i") + F.col("j")) / 2
    return all_.select("gamma", F.when(half == expect, 1.0).otherwise((F.col("ij") - expect) / (half - expect)).alias("ari"))


def partition_score(edges: DataFrame, labels: DataFrame, gamma: float, kind: str = "newman") -> DataFrame:
    return modularity(edges, labels, kind).select((F.col("a") - gamma * F.col("b")).alias("q"))
