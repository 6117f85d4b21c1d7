"""Exact removal of repeated word windows by super-k-mer partitioning.

A window is k consecutive words of one document. Each window's minimiser is the m-gram of
least hash inside it; consecutive windows with the same minimiser form a super-k-mer, which
travels as one packed string to the bucket of its minimiser, where sorting counts windows.

Two facts keep this small and even at any size. A window can only repeat if its minimiser
occurs twice, so minimisers are counted first and only repeated ones travel (a Bloom filter of
bounded size pre-filters; a false positive costs a row, never a result). And a minimiser that
occurs more than HOT times is never gathered, at any size of the input: its windows are counted
one by one, each task sends a window once, and the counts come back through a join that Spark
may split.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GRAM_A, GRAM_B, Words, chunks, grams, mix, partitions, stage, text_bytes

GRAM = 8
BLOOM_BITS = 28  # at most 2**28 bits (32 MB) are broadcast
HOT = 2048  # occurrences beyond which a minimiser's windows are counted one by one; others are gathered in one task
HOT_BITS = 26  # at most 2**26 bits (8 MB) say which are; what they let through besides is counted one by one, too
PIECE = 256  # windows in one packed string
UNIT_BYTES = 6 << 20
SEEN = 500_000
_SEGMENTS = 16
_POS = np.uint64((1 << 28) - 1)


class _Runs:
    """Super-k-mers of one chunk: first word, windows, minimiser, occurrences (1 or 2) and row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, k: int):
        self.words = words = Words(data, offsets)
        self.hash = h = words.hashes()
        m = min(GRAM, k)
        none = np.zeros(0, np.int64)
        self.at, self.n, self.mini, self.weight, self.row = none, none, none.view(np.uint64), none, none
        self.k, count = k, len(h)
        self.rows = np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))
        if count < k:
            return
        g = mix(grams(h, m))
        low = (g & ~_POS) | np.arange(len(g), dtype=np.uint64)
        have, span = 1, k - m + 1
        while have * 2 <= span:
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        if have < span:
            low = np.minimum(low[: have - span], low[span - have :])
        window = np.flatnonzero(self.rows[: count - k + 1] == self.rows[k - 1 :])
        if not len(window):
            return
        pos = (low[window] & _POS).astype(np.int64)
        value, row = g[pos], self.rows[window]
        new = np.ones(len(window), bool)
        new[1:] = (window[1:] != window[:-1] + 1) | (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(window)))
        if (size > PIECE).any():  # cut long runs, as in periodic text
            step = np.arange(len(window)) - np.repeat(start, size)
            start = np.flatnonzero(step % PIECE == 0)
            size = np.diff(np.append(start, len(window)))
        moved = np.zeros(len(window), np.int64)
        moved[1:] = pos[1:] != pos[:-1]
        moved[start] = 0
        self.at, self.n, self.mini, self.row = window[start], size, value[start], row[start]
        self.weight = 1 + (np.add.reduceat(moved, start) > 0)


def _batches(batches, k: int):
    """(doc_id array, text hash array, runs, chunk rows) for each chunk of each Arrow batch."""
    for b in batches:
        data, off = text_bytes(b.column(2))
        for lo, hi in chunks(off):
            yield b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), _Runs(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], k)


def _count(docs: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for _, _, r in _batches(batches, k):
            mini, back = np.unique(r.mini, return_inverse=True)
            w = np.bincount(back, r.weight, minlength=len(mini)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(mini.view(np.int64)), pa.array(w)], ["mini", "w"])

    return docs.mapInArrow(run, "mini long, w long").groupBy("mini").agg(F.sum("w").alias("w")).where("w > 1")


def _slots(mini: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mini = mix(mini)  # minimisers are small numbers
    mask = np.uint64((1 << (bits - 4)) - 1)
    return (mini >> np.uint64(60)).astype(np.int64), (mini & mask).astype(np.int64), ((mini >> np.uint64(24)) & mask).astype(np.int64)


def bloom_filter(repeated: DataFrame, count: int, most: int = BLOOM_BITS) -> tuple[int, np.ndarray]:
    """A bit per slot, as (segments, bytes); each segment is built by one task."""
    bits = int(np.clip(int(16 * max(count, 1)).bit_length(), 16, most))

    def deal(batches):
        for b in batches:
            mini = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_slots(mini, bits)[0])], ["mini", "segment"])

    def run(batches):
        made: dict[int, np.ndarray] = {}
        for b in batches:
            seg, i, j = _slots(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits)
            for s in np.unique(seg).tolist():
                on = made.setdefault(s, np.zeros(1 << (bits - 4), bool))
                on[i[seg == s]] = on[j[seg == s]] = True
        for s, on in made.items():
            yield pa.RecordBatch.from_arrays([pa.array([s]), pa.array([np.packbits(on).tobytes()], pa.binary())], ["segment", "bits"])

    dealt = repeated.select("mini").mapInArrow(deal, "mini long, segment long").repartition(_SEGMENTS, "segment").select("mini")
    out = np.zeros((_SEGMENTS, 1 << (bits - 7)), np.uint8)
    for s, raw in dealt.mapInArrow(run, "segment long, bits binary").collect():
        out[s] = np.frombuffer(raw, np.uint8)
    return bits, out


def in_bloom(mini: np.ndarray, bits: int, filled: np.ndarray) -> np.ndarray:
    seg, i, j = _slots(mini, bits)
    return ((filled[seg, i >> 3] >> (7 - (i & 7)) & 1) & (filled[seg, j >> 3] >> (7 - (j & 7)) & 1)).astype(bool)


def _take(column, rows: np.ndarray):
    return column.take(pa.array(rows))


def _ranges(row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive windows: (row, start, n); at ascends within each row."""
    if not len(at):
        return row, at, at
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1])
    start = np.flatnonzero(new)
    return row[start], at[start], np.diff(np.append(start, len(at)))


_FLAGS = "doc_id long, th long, start int, n int"


def _flag_batch(ids, ths, start, n):
    return pa.RecordBatch.from_arrays([ids, ths, pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))], ["doc_id", "th", "start", "n"])


def _cold(docs: DataFrame, k: int, bits: int, bloom, hot) -> DataFrame:
    """Windows that repeat, of minimisers that are not hot."""
    spark = docs.sparkSession

    def send(batches):
        filled, often = bloom.value, hot.value
        for ids, ths, r in _batches(batches, k):
            keep = np.flatnonzero(in_bloom(r.mini, bits, filled) & ~in_bloom(r.mini, *often))
            w, raw = r.words, r.words.data.tobytes()
            at = r.at[keep]
            lo, hi = w.starts[at].tolist(), w.ends[at + r.n[keep] + k - 2].tolist()
            row = r.row[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(r.mini[keep].view(np.int64)), _take(ids, row), _take(ths, row), pa.array((at - w.first[row]).astype(np.int32)), pa.array([raw[i:j] for i, j in zip(lo, hi, strict=True)], pa.binary())],
                ["bucket", "doc_id", "th", "start", "packed"],
            )

    sent = docs.mapInArrow(send, "bucket long, doc_id long, th long, start int, packed binary")
    sent = sent.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket")

    def settle(held):
        b = pa.Table.from_batches(held).combine_chunks()
        data, off = text_bytes(b.column(4))
        w = Words(data, off)
        h = w.hashes()
        rows = np.repeat(np.arange(len(off) - 1), np.diff(w.first))
        at = np.flatnonzero(rows[: len(h) - k + 1] == rows[k - 1 :]) if len(h) >= k else np.zeros(0, np.int64)
        one, two = grams(h, k)[at], grams(h, k, GRAM_B)[at]
        order = np.lexsort((two, one))
        same = (one[order[1:]] == one[order[:-1]]) & (two[order[1:]] == two[order[:-1]])
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = at[twice]
        row, start, n = _ranges(rows[at], at)
        return _flag_batch(_take(b.column(1).combine_chunks(), row), _take(b.column(2).combine_chunks(), row), start - w.first[row] + b.column(3).to_numpy()[row], n)

    def run(batches):
        held, size, last = [], 0, None
        for b in batches:
            if not len(b):
                continue
            key = b.column(0).to_numpy(zero_copy_only=False)
            cut = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
            ends = np.cumsum([0, *np.diff(text_bytes(b.column(4))[1]).tolist()])
            at = 0
            if held and key[0] != last and size >= UNIT_BYTES:
                yield settle(held)
                held, size = [], 0
            for c in cut.tolist():
                if size + ends[c] - ends[at] >= UNIT_BYTES and c < len(key):
                    held.append(b.slice(at, c - at))
                    yield settle(held)
                    held, size, at = [], 0, c
            if at < len(key):
                held.append(b.slice(at))
                size += int(ends[-1] - ends[at])
            last = key[-1]
        if held:
            yield settle(held)

    return sent.mapInArrow(run, _FLAGS)


def _often(docs: DataFrame, k: int, hot) -> DataFrame:
    """Windows that repeat, of hot minimisers: counted window by window."""
    schema = "one long, two long, doc_id long, th long, start int, w int"

    def send(batches):
        often, seen = hot.value, {}
        for ids, ths, r in _batches(batches, k):
            runs = np.flatnonzero(in_bloom(r.mini, *often))
            if not len(runs):
                continue
            n = r.n[runs]
            at = np.repeat(r.at[runs] - np.cumsum(n) + n, n) + np.arange(n.sum())
            one, two = grams(r.hash, k)[at], grams(r.hash, k, GRAM_B)[at]
            order = np.lexsort((at, two, one))
            o, t = one[order], two[order]
            new = np.ones(len(order), bool)
            new[1:] = (o[1:] != o[:-1]) | (t[1:] != t[:-1])
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, len(order)))
            if len(seen) > SEEN:
                seen.clear()
            # weight 0: known to repeat here; 1: this task's only one so far; 2: repeats, seen first here
            weight, note = np.zeros(len(order), np.int32), []
            for s, c, x, y in zip(start.tolist(), size.tolist(), o[start].tolist(), t[start].tolist(), strict=True):
                had = seen.get((x, y), 0)
                if not had:
                    weight[s] = seen[x, y] = min(c, 2)
                elif had == 1:
                    note.append((x, y))
                    seen[x, y] = 2
            sole = np.zeros(len(order), bool)
            sole[start] = (size == 1) & (weight[start] == 1)
            # rows: positions to settle (w 1), notes (w 1 without a document), known ones (w 2 or 0)
            row = r.rows[at[order]]
            where = at[order] - r.words.first[row]
            yield pa.RecordBatch.from_arrays([pa.array(o.view(np.int64)), pa.array(t.view(np.int64)), _take(ids, row), _take(ths, row), pa.array(where.astype(np.int32)), pa.array(np.where(sole, 1, np.where(weight == 2, 2, 0)).astype(np.int32))], ["one", "two", "doc_id", "th", "start", "w"])
            if note:
                x, y = np.array([v[0] for v in note], np.uint64), np.array([v[1] for v in note], np.uint64)
                nothing = pa.nulls(len(note), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64)), nothing, nothing, pa.nulls(len(note), pa.int32()), pa.array(np.ones(len(note), np.int32))], ["one", "two", "doc_id", "th", "start", "w"])

    sent = stage(docs.mapInArrow(send, schema), "hot")
    known = sent.where("w != 1").select("doc_id", "th", "start", F.lit(1).alias("n"))
    open_ = sent.where("w = 1 and start is not null")
    twice = sent.where("w > 0").groupBy("one", "two").agg(F.sum("w").alias("c")).where("c > 1").select("one", "two")
    return known.unionByName(open_.join(twice, ["one", "two"]).select("doc_id", "th", "start", F.lit(1).alias("n")))


def repeated_windows(docs: DataFrame, k: int = 35) -> DataFrame:
    """(doc_id, th, start, n): runs of windows of docs (doc_id, th, text) that start elsewhere too."""
    sc = docs.sparkSession.sparkContext
    repeated = stage(_count(docs, k), "minimisers")
    count, often = repeated.agg(F.count("*"), F.count_if(F.col("w") > HOT)).first()
    bits, filled = bloom_filter(repeated, count)
    bloom, hot = sc.broadcast(filled), sc.broadcast(bloom_filter(repeated.where(F.col("w") > HOT), often, HOT_BITS))
    found = _cold(docs, k, bits, bloom, hot)
    return found.unionByName(_often(docs, k, hot)) if often else found


def remove_repeats(documents: DataFrame, window: int = 35) -> DataFrame:
    """Per row of documents (doc_id, text): doc_id, n_words, n_removed, kept_sha256, kept.

    Every word goes that is covered by a window whose words also start anywhere else; windows
    are judged on the input. Null or empty text has no words and keeps the empty string; texts
    shorter than a window keep all. Repeated rows are repeats of each other; null ids are kept.
    Other columns are ignored. ``kept`` (the remaining words) is pruned when not selected.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    found = repeated_windows(docs.select("doc_id", "th", "text"), window)
    per = found.groupBy(F.col("doc_id").alias("d"), F.col("th").alias("t")).agg(F.collect_set(F.struct("start", "n")).alias("cut"))
    both = docs.join(per, docs.doc_id.eqNullSafe(per.d) & (docs.th == per.t), "left").select("doc_id", "text", "cut")

    def run(batches):
        for b in batches:
            data, off = text_bytes(b.column(1))
            cut = b.column(2).fill_null([]) if b.column(2).null_count else b.column(2)
            flat = cut.flatten()
            start, n = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            ends = np.concatenate([[0], np.cumsum(cut.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            raw, at = data.tobytes(), off.tolist()
            words, gone, sha = [], [], []
            for i in range(len(b)):
                own = raw[at[i] : at[i + 1]].split()
                words.append(len(own))
                s, e = ends[i], ends[i + 1]
                lost = 0
                if e > s:
                    edge = np.zeros(len(own) + 1, np.int64)
                    np.add.at(edge, start[s:e], 1)
                    np.add.at(edge, start[s:e] + n[s:e] + window - 1, -1)
                    keep = np.cumsum(edge[:-1]) == 0
                    lost = len(own) - int(keep.sum())
                    own = [own[j] for j in np.flatnonzero(keep).tolist()]
                gone.append(lost)
                sha.append(hashlib.sha256(b" ".join(own)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return both.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
