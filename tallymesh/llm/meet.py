"""Fingerprints that share a key are compared: the join behind SimHash links and line links.

A row is (key, node, fp, more, size): node is met under key and carries a fingerprint of 64 bits,
or of 128 with more, and a size; two nodes are close when their fingerprints differ in few bits
and the smaller size is at least a given share of the larger. Rows travel packed, many to a binary value, dealt by a range of keys (a segment); a task sorts one
segment at a time, so its memory does not follow the input. The three low bits of a key are its
class, which says how many bits of difference still make a candidate.

Keys that many nodes share are found first, on the nodes of every RATE-th hash (this decides
who does the work, never what is compared). Their nodes are dealt into blocks, and each pair of
blocks is a cell that another task may take. Where many nodes of a cell are close they are connected by a
spanning forest, so a group of M copies gives about M candidates and not M squared. Where a
candidate has to be verified by other means, `rest` adds what a forest may leave out: pairs
within a cell whose ends the verified links do not connect yet.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, mix, partitions, stage, text_bytes

BLOCK = 8192  # nodes of a block of a hot key; a key of N nodes gives N * N / BLOCK rows
RATE = 16  # hot keys are looked for on one node in so many
HOT_LIST = 1_000_000  # hot keys that are sent to all tasks, the hottest (12 MB); a key left out has at most that part of all rows
SEGMENT_ROWS = 1 << 20
PACK = 640  # rows of one binary value, 23 KB
FEW = 8  # nodes of a key up to which all its pairs are candidates
SPARSE = 4  # times the nodes of a key that its close pairs may be for all of them to be candidates
ROW = np.dtype([("key", "<u8"), ("node", "<i8"), ("fp", "<u8"), ("more", "<u8"), ("size", "<u4")])
_CLASS, _REST = np.uint64(7), np.uint64(0xFFFFFFFFFFFFFFF8)


def flips(bits: list[int], t: int) -> np.ndarray:
    """Masks of every choice of up to t of these bits (bit 0 is the highest)."""
    return np.array([sum(1 << (63 - b) for b in c) for i in range(t + 1) for c in combinations(bits, i)], np.uint64)


def _rows(batch, probes) -> np.ndarray:
    """The ROWs of an Arrow batch (node, fp, more, size, keys): its keys, and those of the probes (bits, flipped)."""
    node = batch.column(0).to_numpy(zero_copy_only=False)
    fp = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
    more = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
    size = batch.column(3).to_numpy(zero_copy_only=False)
    keys = batch.column(4)
    if isinstance(keys, pa.ChunkedArray):
        keys = keys.combine_chunks()
    n = keys.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    own = keys.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    masks = [(part, np.uint64(sum(1 << (63 - x) for x in bits)), flips(bits, t)) for part, (bits, t) in enumerate(probes)]
    out = np.empty(len(own) + len(node) * sum(len(m) for _, _, m in masks), ROW)
    for name, x in (("key", own), ("node", np.repeat(node, n)), ("fp", np.repeat(fp, n)), ("more", np.repeat(more, n)), ("size", np.repeat(size, n))):
        out[name][: len(own)] = x
    at = len(own)
    for part, bits, many in masks:
        for mask in many:
            to = slice(at, at + len(node))
            out["key"][to] = mix(((fp & bits) ^ mask) + np.uint64(part)) & _REST
            out["node"][to], out["fp"][to], out["more"][to], out["size"][to] = node, fp, more, size
            at += len(node)
    return out


def _hot(rows: DataFrame, probes, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of more than about block nodes, ascending, and the blocks of each."""
    some = rows.where(F.pmod(F.xxhash64("node"), F.lit(RATE)) == 0).dropDuplicates(["node"])

    def run(batches):
        for b in batches:
            key, n = np.unique(_rows(b, probes)["key"], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    found = some.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") * RATE > block)
    held = found.orderBy(F.desc("n"), "key").limit(HOT_LIST).toArrow()
    key, n = held["key"].to_numpy().view(np.uint64), held["n"].to_numpy()
    order = np.argsort(key)
    return key[order], -(-n[order] * RATE // block)


def _cells(a: np.ndarray, hot: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Rows of hot keys once for every cell their block is part of; others as they are."""
    if not len(hot):
        return a
    at = np.minimum(np.searchsorted(hot, a["key"]), len(hot) - 1)
    split = hot[at] == a["key"]
    if not split.any():
        return a
    out, many = [a[~split]], a[split]
    of = at[split]
    for k in np.unique(of).tolist():
        own, n = many[of == k], int(blocks[k])
        block = (mix(own["node"].view(np.uint64)) % np.uint64(n)).astype(np.int64)
        for other in range(n):
            cell = (np.minimum(block, other) * n + np.maximum(block, other)).astype(np.uint64) + np.uint64(1)
            copy = own.copy()
            copy["key"] = (mix(own["key"] ^ mix(cell)) & _REST) | (own["key"] & _CLASS)
            out.append(copy)
    return np.concatenate(out)


def _packed(a: np.ndarray, segments: int):
    """Arrow batch (segment, rows) of the rows, in order of key.

    A value holds the first bytes of all its rows, then the second and so on: those that rows share are compressed on the way.
    """
    a = a[np.argsort(a["key"], kind="stable")]
    seg = ((a["key"] >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)
    edge = np.flatnonzero(np.diff(seg, prepend=-1))
    start = np.concatenate([np.arange(i, j, PACK) for i, j in zip(edge, [*edge[1:], len(a)], strict=True)])
    ends = np.append(start, len(a))
    off = pa.py_buffer((ends * ROW.itemsize).astype(np.int32))
    bytes_ = a.view(np.uint8).reshape(-1, ROW.itemsize)
    data = b"".join(bytes_[i:j].T.tobytes() for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))
    return pa.RecordBatch.from_arrays([pa.array(seg[start]), pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, off, pa.py_buffer(data)])], ["segment", "rows"])


def _unpacked(value: np.ndarray) -> np.ndarray:
    """The ROWs of one binary value."""
    return np.ascontiguousarray(value.reshape(ROW.itemsize, -1).T).reshape(-1).view(ROW)


def _close(fp: np.ndarray, more: np.ndarray, size: np.ndarray, i, j, radius, share: float) -> np.ndarray:
    x, y = size[i], size[j]
    return (np.bitwise_count(fp[i] ^ fp[j]) + np.bitwise_count(more[i] ^ more[j]) <= radius) & (np.minimum(x, y) >= share * np.maximum(x, y) - 1e-9)


def _forest(fp: np.ndarray, more: np.ndarray, size: np.ndarray, radius: int, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(u, v) positions of a spanning forest of the close pairs, and each position's tree.

    Trees grow from the nodes nearest to what most of the bits say: in a group of variants of
    one text that is the text, which is the likeliest to be similar to all of them.
    """
    most = np.packbits(np.unpackbits(fp.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0) * 2 > len(fp)).view(">u8")[0]
    left, tree = np.argsort(np.bitwise_count(fp ^ np.uint64(most)), kind="stable"), np.zeros(len(fp), np.int64)
    front, u, v, t = left[:0], [], [], 0
    while len(left):
        if not len(front):
            t += 1
            front, left = left[:1], left[1:]
            tree[front] = t
        near = _close(fp, more, size, left, front[0], radius, share)
        new = left[near]
        u.append(np.full(len(new), front[0])), v.append(new)
        tree[new] = t
        front, left = np.concatenate([front[1:], new]), left[~near]
    return np.concatenate(u), np.concatenate(v), tree


def _every(fp: np.ndarray, more: np.ndarray, size: np.ndarray, radius: int, share: float, most: int | None = None) -> tuple[np.ndarray, np.ndarray] | None:
    """(u, v), u < v: positions of all close pairs, None if they turn out to be more than most.

    In order of size, only those near in size are looked at.
    """
    total = 0
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    order = np.argsort(size, kind="stable")
    fp, more, size = fp[order], more[order], size[order]
    step = max(16, min(256, (1 << 19) // max(1, len(fp))))  # some 4 MB a comparison
    for i in range(0, len(fp), step):
        last = min(i + step, len(fp))
        end = int(np.searchsorted(size, size[last - 1] / share + 1e-6, "right")) if share > 0 else len(fp)
        at, to = np.arange(i, last), np.arange(i, end)
        u, v = np.nonzero(_close(fp, more, size, at[:, None], to[None, :], radius, share) & (to[None, :] > at[:, None]))
        us.append(order[u + i]), vs.append(order[v + i])
        total += len(u)
        if most is not None and total > most:
            return None
    u, v = np.concatenate(us), np.concatenate(vs)
    return np.minimum(u, v), np.maximum(u, v)


def _settle(a: np.ndarray, radii: np.ndarray, share: float, every: bool):
    """Candidates among the rows of one segment, as a batch (u, v, cell, fp, more, size)."""
    a = a[np.lexsort((a["node"], a["key"]))]
    key, node, fp, more, big = (np.ascontiguousarray(a[x]) for x in ("key", "node", "fp", "more", "size"))
    new = np.ones(len(a), bool)
    new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])  # a node may come twice
    if not new.all():
        key, node, fp, more, big = key[new], node[new], fp[new], more[new], big[new]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(start, len(key)))
    radius = radii[(key & _CLASS).astype(np.int64)]
    few = np.repeat(size <= FEW, size)
    us, vs, cells, members = [], [], [], []
    for lag in range(1, min(FEW, len(key))):
        i = np.flatnonzero((key[lag:] == key[:-lag]) & few[lag:])
        i = i[_close(fp, more, big, i, i + lag, radius[i], share)]
        us.append(i), vs.append(i + lag)
    for i, n in zip(start[size > FEW].tolist(), size[size > FEW].tolist(), strict=True):
        own = fp[i : i + n], more[i : i + n], big[i : i + n], int(radius[i]), share
        found = _every(*own, None if every else SPARSE * n)
        if found:
            u, v = found
        else:
            u, v, tree = _forest(*own)
            many = np.flatnonzero(np.bincount(tree)[tree] > 2)
            members.append(many + i)
            cells.append((mix(np.full(len(many), key[i]) + mix(tree[many].astype(np.uint64))) & _REST) | (key[i] & _CLASS))
        us.append(u + i), vs.append(v + i)
    none = np.zeros(0, np.int64)
    u, v, m = (np.concatenate([none, *x]) for x in (us, vs, members))
    cell = np.concatenate([none.view(np.uint64), *cells]).view(np.int64)
    x, y = node[u], node[v]
    empty = pa.nulls(len(u), pa.int64())
    two = [(pa.array(np.minimum(x, y)), pa.array(node[m])), (pa.array(np.maximum(x, y)), pa.nulls(len(m), pa.int64())), (empty, pa.array(cell)), (empty, pa.array(fp[m].view(np.int64))), (empty, pa.array(more[m].view(np.int64))), (empty, pa.array(big[m].astype(np.int64)))]
    return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in two], ["u", "v", "cell", "fp", "more", "size"])


def meetings(rows: DataFrame, radii: list[int], share: float, probes=(), every: bool = False, block: int = BLOCK) -> DataFrame:
    """(u, v, cell, fp, more, size) for rows (node, fp, more, size, keys) whose class-c keys ask for radii[c] bits or fewer.

    Rows without cell are pairs u < v of nodes that share a key and are close enough, sizes to
    the given share included: all of them (every), or enough to connect all that are. Those with
    a cell name a node u of a cell whose pairs are not all given (see `rest`). probes: (bits, bits flipped) under
    which the fingerprints themselves are met, in class 0. A node that comes twice counts once.
    """
    spark = rows.sparkSession
    rows = rows.select("node", "fp", "more", F.col("size").cast("long").alias("size"), "keys")
    per = sum(len(flips(bits, t)) for bits, t in probes)
    total = rows.agg(F.coalesce(F.sum(F.size(F.coalesce("keys", F.array().cast("array<long>"))) + per), F.lit(0))).first()[0]
    p, (hot, blocks) = partitions(spark), _hot(rows, probes, block)
    total += int((blocks * (blocks - 1)).sum()) * block  # with the copies for their cells
    segments = max(4 * p, -(-total // SEGMENT_ROWS))
    held = spark.sparkContext.broadcast((hot, blocks))
    width = np.array([*radii, *[128] * (8 - len(radii))])

    def send(batches):
        some, n = [], 0
        for b in batches:
            for at in range(0, len(b), 4096):
                some.append(_cells(_rows(b.slice(at, 4096), probes), *held.value))
                n += len(some[-1])
                if n > SEGMENT_ROWS:
                    yield _packed(np.concatenate(some), segments)
                    some, n = [], 0
        if n:
            yield _packed(np.concatenate(some), segments)

    dealt = rows.mapInArrow(send, "segment long, rows binary").repartition(p, "segment").sortWithinPartitions("segment")

    def receive(batches):
        some, last = [], None
        for b in batches:
            if not len(b):
                continue
            seg = b.column(0).to_numpy(zero_copy_only=False)
            data, off = text_bytes(b.column(1))
            edge = np.flatnonzero(np.diff(seg)) + 1
            for i, j in zip([0, *edge.tolist()], [*edge.tolist(), len(seg)], strict=True):
                if some and seg[i] != last:
                    yield _settle(np.concatenate(some), width, share, every)
                    some = []
                some += [_unpacked(data[off[x] : off[x + 1]]) for x in range(i, j)]
                last = seg[i]
        if some:
            yield _settle(np.concatenate(some), width, share, every)

    return dealt.mapInArrow(receive, "u long, v long, cell long, fp long, more long, size long")


def pairs_of(met: DataFrame) -> DataFrame:
    """(u, v): the distinct pairs of meetings."""
    return met.where("cell is null").select("u", "v").distinct()


def rest(met: DataFrame, roots: DataFrame, radii: list[int], share: float, name: str) -> DataFrame:
    """(u, v): close pairs of cells left open whose ends have different roots (node, root). radii ascend.

    In each cell the nodes outside its most frequent root are paired with all others, so a cell
    whose nodes are connected gives none, and one with few strays gives few for each.
    """
    opened = met.where("cell is not null").select("cell", F.col("u").alias("node"), "fp", "more", "size")
    named = stage(opened.join(roots, "node", "left").select("cell", "node", "fp", "more", "size", F.coalesce("root", "node").alias("root")), name)
    main = named.groupBy("cell", "root").agg(F.count("*").alias("n")).groupBy("cell").agg(F.max_by("root", "n").alias("main"), F.count("*").alias("roots")).where("roots > 1")
    named = named.join(main.select("cell", "main"), "cell")
    # class first: of the cells that two nodes share, the one of most bits decides, once
    named = named.withColumn("turn", F.shiftleft(F.col("cell").bitwiseAND(F.lit(7)), 60) + F.shiftrightunsigned("cell", 4))
    named = named.join(named.groupBy("node").agg(F.collect_set("turn").alias("turns")), "node")  # as many as a node has keys
    strays = named.where("root != main").select("cell", F.col("node").alias("x"), F.col("fp").alias("fx"), F.col("more").alias("mx"), F.col("root").alias("rx"), F.col("size").alias("sx"), F.col("turns").alias("tx"))
    radius = F.element_at(F.array(*[F.lit(r) for r in [*radii, *[128] * (8 - len(radii))]]), (F.col("cell").bitwiseAND(F.lit(7)) + 1).cast("int"))
    near = (F.bit_count(F.col("fx").bitwiseXOR(F.col("fp"))) + F.bit_count(F.col("mx").bitwiseXOR(F.col("more"))) <= radius) & (F.least("sx", "size") >= share * F.greatest("sx", "size") - 1e-9)
    once = (F.col("root") == F.col("main")) | (F.col("x") < F.col("node"))  # two strays meet twice
    return strays.join(named, "cell").where((F.col("rx") != F.col("root")) & once & near & (F.array_max(F.array_intersect("tx", "turns")) == F.col("turn"))).select(F.least("x", "node").alias("u"), F.greatest("x", "node").alias("v")).distinct()


def verified(met: DataFrame, check, radii: list[int], share: float, name: str) -> DataFrame:
    """(node, root): components of the pairs of meetings that check, (u, v) to (u, v), lets pass.

    Pairs of the forests are checked first; then those that the result does not connect.
    """
    first = stage(check(pairs_of(met)), f"{name}_linked")
    comp = stage(components(first, name), f"{name}_components")
    more = stage(rest(met, comp, radii, share, f"{name}_open"), f"{name}_rest")
    second = stage(check(more.join(pairs_of(met), ["u", "v"], "left_anti")), f"{name}_more")
    if second.isEmpty():
        return comp
    # components of the components found first
    u, v = (comp.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in ("u", "v"))
    joined = stage(second.join(u, "u", "left").join(v, "v", "left").select("u", "v", F.coalesce("ru", "u").alias("ru"), F.coalesce("rv", "v").alias("rv")), f"{name}_joined")
    upper = components(joined.select(F.col("ru").alias("u"), F.col("rv").alias("v")), name)
    upper = stage(upper.select(F.col("node").alias("root"), F.col("root").alias("top")), f"{name}_upper")
    new = joined.select(F.col("u").alias("node"), F.col("ru").alias("root")).unionByName(joined.select(F.col("v").alias("node"), F.col("rv").alias("root"))).where("node = root")
    return comp.unionByName(new).distinct().join(upper, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
