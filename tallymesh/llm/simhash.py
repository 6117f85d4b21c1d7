"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints are collapsed to distinct values first, so exact copies never meet in a join.
Bits that vary together are grouped into partitions; a dynamic program gives each partition
its own threshold (-1: not probed) such that sum(t + 1) = tau + 1, by candidate counts
estimated from bit statistics of all fingerprints. A probe of threshold t spells out the
flips of half as many bits on either side; fingerprints that meet under a key are verified
on all bits (see meet.py, which also splits hot keys).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, mix, stage, text_bytes
from .meet import BLOCK, meetings, pairs_of, verified

SKETCH = 8  # least shingle hashes of a text; at a similarity of 0.8 two texts share one but for 3 in a million
WIDE = 24  # bits within which texts that share one are compared; at a similarity of 0.8 about 10 are expected
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_PLANES = np.arange(8, dtype=np.int64) * 256


def shingles(text: bytes, shingle: int) -> np.ndarray:
    """Hashes of the shingles of A-Z lower-cased words, none for no words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, ">u8")
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.concatenate([[0], np.cumsum(size)])
    n = max(1, len(words) - shingle + 1)
    ends = starts[min(shingle, len(words)) :][:n] - 1
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], 42) for a, b in zip(starts[:n].tolist(), ends.tolist(), strict=True)], ">u8")


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of the shingles of A-Z lower-cased words; 0 for no words."""
    return simhash(shingles(text, shingle))


def simhash(h: np.ndarray) -> int:
    n = len(h)
    counts = np.bincount((h.view(np.uint8).reshape(n, 8) + _PLANES).ravel(), minlength=2048).reshape(8, 256)
    ones = (counts @ _BYTE_BITS).ravel()
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): one row per document; null text counts as empty."""

    def run(batches):
        for b in batches:
            data, off = text_bytes(b.column(1))
            raw, at = data.tobytes(), off.tolist()
            fp = np.array([fingerprint(raw[i:j], shingle) for i, j in zip(at, at[1:], strict=False)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


# ---------------------------------------------------------------- plan of the probes


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of bits set together, over all of them."""

    def run(batches):
        total, n = np.zeros((64, 64)), 0
        for b in batches:
            v = b.column(0).to_numpy(zero_copy_only=False).astype(">i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(v, axis=1).astype(np.float32)
            total, n = total + (bits.T @ bits), n + len(bits)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(4097)), pa.array(np.append(total.ravel(), n))], ["k", "c"])

    rows = fps.mapInArrow(run, "k long, c double").groupBy("k").agg(F.sum("c").alias("c")).collect()
    got = np.zeros(4097)
    for k, c in rows:  # 4097 rows at most, whatever the input
        got[k] = c
    return int(got[4096]), got[:4096].reshape(64, 64)


def _groups(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """Bits in m groups of almost equal size; each takes the bits most correlated with it."""
    p = np.diag(together) / n
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(together / n - np.outer(p, p)) / np.outer(sd, sd)
    left, out = list(range(64)), []
    for g in range(m):
        size = 64 // m + (g < 64 % m)
        seed = max(left, key=lambda b: (corr[b, left].sum(), -b))
        group = [seed]
        left.remove(seed)
        while len(group) < size:
            b = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(b)
            left.remove(b)
        out.append(sorted(group))
    return out


def _keys(width: int, t: int) -> int:
    return sum(int(np.prod(range(width - i + 1, width + 1))) // int(np.prod(range(1, i + 1))) for i in range(t + 1)) if t >= 0 else 0


def _flipped(t: int) -> int:
    """Bits that a probe of threshold t flips: two that differ in t bits meet half way."""
    return (t + 1) // 2


def plan(n: int, together: np.ndarray, tau: int, pair_cost: float = 0.02) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of least estimated cost for n fingerprints: keys written plus pairs verified."""
    n = max(n, 1)
    q = 2 * (p := np.diag(together) / n) * (1 - p)
    best = None
    for m in range(1, tau + 3):
        groups, table = _groups(together, n, m), []
        for g in groups:
            dist = np.array([1.0])  # chance of so many differing bits in this group
            for b in g:
                dist = np.convolve(dist, [1 - q[b], q[b]])
            row = {-1: 0.0}
            for t in range(min(tau, 4) + 1):
                row[t] = n * _keys(len(g), _flipped(t)) + pair_cost * n * n / 2 * dist[: 2 * _flipped(t) + 1].sum()
            table.append(row)
        cost = {0: (0.0, ())}
        for row in table:
            now: dict[int, tuple[float, tuple]] = {}
            for used, (c, ts) in cost.items():
                for t, add in row.items():
                    k = used + t + 1
                    if k <= tau + 1 and (k not in now or c + add < now[k][0]):
                        now[k] = (c + add, (*ts, t))
            cost = now
        if tau + 1 in cost and (best is None or cost[tau + 1][0] < best[0]):
            best = (cost[tau + 1][0], list(zip(groups, cost[tau + 1][1], strict=True)))
    return [(g, t) for g, t in best[1] if t >= 0]


def probes_of(planned: list[tuple[list[int], int]]) -> list[tuple[list[int], int]]:
    """(bits, bits flipped) of each part of a plan."""
    return [(bits, _flipped(t)) for bits, t in planned]


def links(fps: DataFrame, tau: int = 2, whole: bool = True, block: int = BLOCK) -> DataFrame:
    """(u, v): links between distinct fingerprints (column fp) that differ in tau bits or fewer.

    whole=True: enough links to connect all that are linked (a forest per key, linear output);
    whole=False: every linked pair, u < v as unsigned, each once.
    """
    rows = fps.select(F.col("fp").alias("node"), "fp", F.lit(0).cast("long").alias("more"), F.lit(0).alias("size"), F.array().cast("array<long>").alias("keys"))
    met = pairs_of(meetings(rows, [tau], 0.0, probes_of(plan(*bit_statistics(fps), tau)), not whole, block))
    sign = F.lit(-(1 << 63))
    after = F.col("u").bitwiseXOR(sign) > F.col("v").bitwiseXOR(sign)
    return met.select(F.when(after, F.col("v")).otherwise(F.col("u")).alias("u"), F.when(after, F.col("u")).otherwise(F.col("v")).alias("v"))


def near_duplicates(docs: DataFrame, shingle: int = 3, tau: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs (doc_id, text).

    Rows are linked when their fingerprints differ in tau bits or fewer; component_id is the
    smallest doc_id reachable. Null or empty text: no words, fingerprint 0, linked like any
    other. A null doc_id is kept and never names a component unless no other id is there.
    Repeated rows come back as often as they went in; other columns of docs are ignored.
    """
    fp = stage(fingerprints(docs, shingle), "fingerprints")
    per = fp.groupBy("fp").agg(F.min("doc_id").alias("low"))
    comp = components(links(per.select("fp"), tau), "simhash")
    named = per.join(comp, per.fp == comp.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    per_fp = named.join(least, "root").select("fp", "component_id")
    return fp.join(per_fp, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _sketch(h: np.ndarray) -> list[int]:
    """Keys of class 1: the SKETCH least of ascending hashes."""
    return (mix(h[:SKETCH].astype(np.uint64)) & np.uint64(0xFFFFFFFFFFFFFFF8) | np.uint64(1)).view(np.int64).tolist()


def _signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, th, node, fp, size, sketch) of docs (doc_id, th, text); node: hash of the words in lower case; size: distinct shingles."""

    def run(batches):
        for b in batches:
            data, off = text_bytes(b.column(2))
            raw, at = data.tobytes(), off.tolist()
            fps, nodes, sizes, least = [], [], [], []
            for i, j in zip(at, at[1:], strict=False):
                h = shingles(raw[i:j], shingle)
                own = np.unique(h)
                fps.append(simhash(h)), sizes.append(len(own)), least.append(_sketch(own))
                nodes.append(xxhash.xxh64_intdigest(b" ".join(raw[i:j].lower().split())))
            cols = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (nodes, fps)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols, pa.array(sizes, pa.int64()), pa.array(least, pa.list_(pa.int64()))], ["doc_id", "th", "node", "fp", "size", "sketch"])

    return docs.select("doc_id", "th", "text").mapInArrow(run, "doc_id long, th long, node long, fp long, size long, sketch array<long>")


def _alike(pairs: DataFrame, shingle: int, least: float) -> DataFrame:
    """(u, v) of the pairs (u, v, tx, ty) whose texts have a shingle similarity of least or more."""

    def run(batches):
        for b in batches:
            ok = []
            last, own = None, frozenset()
            for p, q in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if p != last:
                    last, own = p, frozenset(shingles(p.encode(), shingle).tolist())
                other = frozenset(shingles(q.encode(), shingle).tolist())
                ok.append(len(own & other) >= least * len(own | other) - 1e-9)
            yield pa.RecordBatch.from_arrays([b.column(i).filter(pa.array(ok, pa.bool_())) for i in (0, 1)], ["u", "v"])

    return pairs.select("u", "v", "tx", "ty").mapInArrow(run, "u long, v long")


def keep_one(documents: DataFrame, shingle: int = 5, tau: int = 3, least: float = 0.8) -> DataFrame:
    """documents with one row of each near-duplicate group, that of smallest doc_id.

    Texts are linked when the similarity of their sets of shingles is least or more, which is
    checked for texts whose fingerprints differ in tau bits or fewer and for those within WIDE
    bits that share one of their SKETCH least shingle hashes. Of repeated rows one stays, and of
    rows with one id the one of least text hash; rows without id stay only where their group has
    no id (one of each group). All columns are passed through as they are.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    sigs = stage(_signatures(base, shingle), "signatures")
    row = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "th")
    per = stage(sigs.groupBy("node").agg(F.first("fp").alias("fp"), F.min(row).alias("low"), F.first("size").alias("size"), F.first("sketch").alias("keys")), "texts")
    radii = [tau, WIDE]
    met = stage(meetings(per.withColumn("more", F.lit(0).cast("long")), radii, least, probes_of(plan(*bit_statistics(per.select("fp")), tau))), "met")
    nodes = met.select(F.col("u").alias("node")).unionByName(met.where("v is not null").select(F.col("v").alias("node"))).distinct()
    wanted = per.join(nodes, "node").select("node", F.col("low.th").alias("th"))
    texts = stage(base.select("th", "text").join(wanted, "th").dropDuplicates(["node"]).select("node", "text"), "pair_texts")

    def check(pairs: DataFrame) -> DataFrame:
        return _alike(pairs.join(texts.toDF("u", "tx"), "u").join(texts.toDF("v", "ty"), "v"), shingle, least)

    comp = verified(met, check, radii, least, "simhash")
    heads = per.join(comp, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("low").alias("low"))
    heads = heads.select(F.col("low.doc_id").alias("kept id"), F.col("low.th").alias("kept text"))
    own_text = F.xxhash64(F.coalesce(documents["text"].cast("string"), F.lit("")))
    kept = documents.withColumn("own text", own_text).join(heads, documents["doc_id"].cast("long").eqNullSafe(heads["kept id"]) & (own_text == heads["kept text"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "own text"]).drop("own text")
