"""Source divergence audit: how far the word use of each source is from its peers and its language.

Words are counted per group (language and source) inside the tasks, then summed. The terms that a
language keeps are cut into shards of about SHARD terms, so what a task holds is bounded however
large the vocabulary. In each shard the groups of a language are the players of a round robin, in
blocks of GROUPS: a block stays resident in its partition, while the compressed vectors of the other
blocks come by in the order of the tournament's rounds, one vector in memory at a time. Two blocks
meet once, at one of the two, and the meeting gives the distances of both directions. The language's
own vector comes first and leaves each resident group's best terms in a local heap. What the
shards give is summed, and ranked, by Spark.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, stage, text_bytes

LEAST_DOCS = 30  # documents of a language that a term is in at least
SMOOTH = 5
UNIT = 1_000_000_000
TOP = 50
SHARD = 2048
GROUPS = 32
SPREAD = 64  # parts of a language's terms in the join that tells them how many shards there are
FLUSH = 500_000  # distinct (group, term) that a task sums up before it hands them on
ENTRY = np.dtype([("term", "<u4"), ("n", "<i8")])
#: ASCII letters in lower case and bytes of other characters; all else parts terms.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def share(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(UNIT * (count + SMOOTH) / (total + SMOOTH * kept)), by long division in steps of 1000 that fit 64 bits."""
    whole = total + SMOOTH * kept
    if not whole:  # nothing is kept, so nothing is counted
        return np.zeros(len(count), np.int64)
    out, left = np.divmod(np.asarray(count, np.int64) + SMOOTH, whole)
    for _ in range(3):
        more, left = np.divmod(left * 1000, whole)
        out = out * 1000 + more
    return out + 1


def _counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): sums of a task's rows; term is null in a row that names the group."""

    def run(batches):
        count: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush():
            cols: tuple[list, ...] = ([], [], [], [], [])
            for (lang, source), (n, of) in count.items():
                cols[0].extend([lang] * (len(n) + 1)), cols[1].extend([source] * (len(n) + 1))
                cols[2].extend([None, *n]), cols[3].extend([0, *n.values()]), cols[4].extend([0, *(of[t] for t in n)])
            count.clear()
            made = [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.binary()).cast(pa.string()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())]
            return pa.RecordBatch.from_arrays(made, ["lang", "source", "term", "n", "docs"])

        for b in batches:
            langs, sources = b.column(0).to_pylist(), b.column(1).to_pylist()
            data, offsets = text_bytes(b.column(2))
            for lo, hi in chunks(offsets):
                flat, off = data[offsets[lo] : offsets[hi]].tobytes().translate(_TERM), (offsets[lo : hi + 1] - offsets[lo]).tolist()
                for i in range(lo, hi):
                    n, of = count.setdefault((langs[i], sources[i]), (Counter(), Counter()))
                    words = flat[off[i - lo] : off[i - lo + 1]].split()
                    n.update(words)
                    of.update(set(words))
                if sum(len(n) for n, _ in count.values()) > FLUSH:
                    yield flush()
        if count:
            yield flush()

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _pack(entries: np.ndarray) -> bytes:
    entries = np.sort(entries, order="term")
    return zlib.compress(np.diff(entries["term"], prepend=np.uint32(0)).astype("<u4").tobytes() + entries["n"].astype("<i8").tobytes(), 1)


def _unpack(data: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of terms in the shard, ascending, and their counts."""
    raw = zlib.decompress(data) if data else b""
    n = len(raw) // 12
    return np.cumsum(np.frombuffer(raw, "<u4", n)).astype(np.int64), np.frombuffer(raw, "<i8", n, 4 * n)


def _vectors(rows: DataFrame, *key: str) -> DataFrame:
    """(*key, data) for rows (*key, place, n): each key's counts, packed; a key has a shard's terms at most."""
    held = rows.groupBy(*key).agg(F.collect_list("place").alias("places"), F.collect_list("n").alias("ns"))

    @F.pandas_udf("binary")
    def pack(places: pd.Series, ns: pd.Series) -> pd.Series:
        out = []
        for p, n in zip(places, ns, strict=True):
            e = np.empty(len(p), ENTRY)
            e["term"], e["n"] = p, n
            out.append(_pack(e))
        return pd.Series(out, dtype=object)

    return held.select(*key, pack("places", "ns").alias("data"))


class Residents:
    """The groups of one block in one shard, and what they make of the vectors that come by."""

    def __init__(self, width: int):
        self.width, self.groups, self.own, self.rows = width, [], [], []

    def settle(self, group: int, place: np.ndarray, n: np.ndarray, total: int, kept: int) -> None:
        row = np.full(self.width, share(np.zeros(1), total, kept)[0], np.int64)
        row[place] = share(n, total, kept)
        self.groups.append(group), self.own.append(place), self.rows.append(row)

    def among_themselves(self):
        """(group, other, distances) of the pairs of residents; then the block is ready for guests."""
        p = self.p = np.stack(self.rows)
        self.order = np.sort(p, axis=1)
        self.below = np.hstack([np.zeros((len(p), 1), np.int64), np.cumsum(self.order, axis=1)])
        for j in range(1, len(p)):
            yield self.groups[j], np.array(self.groups[:j]), np.abs(p[:j] - p[j]).sum(1)

    def best(self, n: np.ndarray, total: int, kept: int):
        """(group, places, values): each resident's terms that it uses most beyond its language."""
        q = share(n, total, kept)
        for group, place, row in zip(self.groups, self.own, self.p, strict=True):
            over = row[place] - q[place]
            some = np.flatnonzero(over > 0)
            if len(some) > TOP:  # the heap takes what reaches the last of the best, ties included
                some = some[over[some] >= np.partition(over[some], -TOP)[-TOP]]
            held = heapq.nsmallest(TOP, zip((-over[some]).tolist(), place[some].tolist(), strict=True))
            yield group, np.array([t for _, t in held], np.int64), np.array([-v for v, _ in held], np.int64)

    def meet(self, place: np.ndarray, n: np.ndarray, total: int, kept: int) -> np.ndarray:
        """The distance of every resident from a guest, of which only the terms it has are looked at.

        All others have the same share, whose distances come from the sorted rows' running sums.
        """
        if not self.width:
            return np.zeros(len(self.groups), np.int64)
        rest, q = int(share(np.zeros(1), total, kept)[0]), share(n, total, kept)
        k = np.array([np.searchsorted(row, rest) for row in self.order])
        low = self.below[np.arange(len(k)), k]
        flat = rest * k - low + self.below[:, -1] - low - rest * (self.width - k)
        at = self.p[:, place]
        return flat + (np.abs(at - q) - np.abs(at - rest)).sum(1)


_SENT = "lang string, shard int, host int, turn int, player int, total long, kept long, width int, data binary"
_FOUND = "lang string, player int, peer int, shard int, place int, value long"


def _rotated(sent: DataFrame) -> DataFrame:
    """_FOUND rows: (player, peer, value) of every meeting, (player, shard, place, value) of every heap."""

    def run(batches):
        at, home = None, None
        cols: tuple[list, ...] = ([], [], [], [], [], [])
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())

        def made():
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["lang", "player", "peer", "shard", "place", "value"])
            for c in cols:
                c.clear()
            return batch

        for b in batches:
            langs, *numbers, data = (b.column(i).to_pylist() for i in range(b.num_columns))

            def met(lang, group, peers, values):
                n = len(peers)
                for a, c in (([group] * n, peers.tolist()), (peers.tolist(), [group] * n)):  # both directions
                    cols[0].extend([lang] * n), cols[1].extend(a), cols[2].extend(c), cols[3].extend([-1] * n), cols[4].extend([-1] * n), cols[5].extend(values.tolist())

            for lang, (shard, host, turn, player, total, kept, width), packed in zip(langs, zip(*numbers, strict=True), data, strict=True):
                if at != (lang, shard, host):
                    at, home = (lang, shard, host), Residents(width)
                place, n = _unpack(packed)
                if turn < 0:
                    home.settle(player, place, n, total, kept)
                elif not turn:
                    for found in home.among_themselves():
                        met(lang, *found)
                    full = np.zeros(width, np.int64)
                    full[place] = n
                    for group, places, values in home.best(full, total, kept):
                        m = len(places)
                        cols[0].extend([lang] * m), cols[1].extend([group] * m), cols[2].extend([-1] * m), cols[3].extend([shard] * m), cols[4].extend(places.tolist()), cols[5].extend(values.tolist())
                else:
                    met(lang, player, np.array(home.groups), home.meet(place, n, total, kept))
                if len(cols[0]) > 50_000:
                    yield made()
            yield made()

    dealt = sent.repartition("lang", "shard", "host").sortWithinPartitions("lang", "shard", "host", "turn", "player")
    return dealt.mapInArrow(run, _FOUND)


def audit(documents: DataFrame, least: int = LEAST_DOCS, shard: int = SHARD, block: int = GROUPS) -> DataFrame:
    """(lang, source, part, item, value, rank) for documents (lang, source, text).

    Part pair: the distance of the source's shares of the kept terms from those of each other source
    of the language; part term: the TOP kept terms whose share most exceeds the language's. Null lang, source
    and text count as empty; a source without kept terms has the shares of zero counts; where a
    language keeps no term, distances are 0. A repeated row counts as often as it is there. Ties
    go to the item that is first in UTF-8. Other columns are ignored; an empty table gives no rows.
    """
    docs = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = stage(_counted(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    terms = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")).where(F.col("docs") >= least).select("lang", "term", "n")
    terms = stage(terms, "kept")
    groups = counts.where("term is null").select("lang", "source").withColumn("player", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    langs = groups.groupBy("lang").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).join(terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("total")), "lang", "left").na.fill(0, ["kept", "total"])
    langs = langs.withColumn("shards", F.greatest(F.ceil(F.col("kept") / shard), F.lit(1)).cast("int"))
    # places ascend with the terms, so ties in a heap fall as they do in the end
    spread = langs.select("lang", "shards", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("salt"))
    terms = terms.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SPREAD)).cast("int")).join(spread, ["lang", "salt"]).select("lang", F.pmod(F.xxhash64("term"), "shards").cast("int").alias("shard"), "term", "n")
    terms = stage(terms.withColumn("place", F.row_number().over(Window.partitionBy("lang", "shard").orderBy("term")) - 1), "terms")
    width = terms.groupBy("lang", "shard").agg(F.count("*").cast("int").alias("width"))
    own = counts.join(terms.select("lang", "term", "shard", "place"), ["lang", "term"]).select("lang", "source", "shard", "place", "n")
    own = stage(own, "own")
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("own_total"))
    # every group and every shard, its vector or none
    cells = langs.select("lang", "kept", "total", "blocks", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")).join(width, ["lang", "shard"], "left").na.fill(0, ["width"])
    players = groups.join(totals, ["lang", "source"], "left").na.fill(0, ["own_total"]).join(cells, "lang").join(_vectors(own, "lang", "source", "shard"), ["lang", "source", "shard"], "left")
    players = players.withColumn("block", F.floor(F.col("player") / block).cast("int"))
    one, two = F.col("block"), F.col("host")
    # the circle method: the last of an even number stays, the others turn
    m = F.col("blocks") - 1 + F.col("blocks") % 2
    turn = F.when(one == two, -1).when((one == m) | (two == m), 1 + (2 * F.least(one, two)) % m).otherwise(1 + (one + two) % m)
    travels = (one == two) | ((one < two) == ((one + two) % 2 == 1))
    sent = players.withColumn("host", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where(travels).select("lang", "shard", "host", turn.alias("turn"), "player", F.col("own_total").alias("total"), "kept", "width", "data")
    lead = cells.join(_vectors(terms, "lang", "shard"), ["lang", "shard"], "left").select("lang", "shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("host"), F.lit(0).alias("turn"), F.lit(-1).alias("player"), "total", "kept", "width", "data")
    found = _rotated(sent.unionByName(lead)).groupBy("lang", "player", "peer", "shard", "place").agg(F.sum("value").alias("value"))
    found = stage(found, "met")
    pair = found.where("peer >= 0").join(groups.select("lang", F.col("player").alias("peer"), F.col("source").alias("item")), ["lang", "peer"]).select("lang", "player", F.lit("pair").alias("part"), "item", "value")
    term = found.where("peer < 0").join(terms.select("lang", "shard", "place", F.col("term").alias("item")), ["lang", "shard", "place"]).select("lang", "player", F.lit("term").alias("part"), "item", "value")
    ranked = pair.unionByName(term).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "player", "part").orderBy(F.desc("value"), "item")))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= TOP)).join(groups, ["lang", "player"]).select("lang", "source", "part", "item", "value", "rank")
