"""Quality classifier: Naive Bayes support vectors over n-gram indicators.

Features are indicators of word uni- and bigrams and of uni- to trigrams of word shapes (case,
digits, punctuation, length, repetition), hashed into BINS bins. Each indicator is scaled by
its class log-count ratio, each document to unit length, and a linear hinge-loss model is fit
by dual coordinate descent; a logistic curve over cross-fitted margins turns margins into
scores. The model is fit on at most about SAMPLE labelled rows, chosen by a hash of their id;
every document is scored, over its whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, chunks, mix, text_bytes

BINS = 1 << 17
SAMPLE = 10_000  # labelled rows that a model is fit on, about
THRESHOLD = 0.3
ALPHA, COST, EPOCHS, FOLDS = 1.0, 1.0, 6, 3

_CLASS = np.zeros((4, 256), np.int32)  # upper, lower (or beyond ASCII), digit, other
_CLASS[0, 65:91] = 1
_CLASS[1, 97:123] = 1
_CLASS[1, 128:] = 1
_CLASS[2, 48:58] = 1
_CLASS[3, [b for b in range(33, 127) if not chr(b).isalnum()]] = 1
_BITS = np.uint64(64 - (BINS.bit_length() - 1))


def _shapes(w: Words, h: np.ndarray) -> np.ndarray:
    """A small code for the look of each word."""
    counts = []
    for row in _CLASS:
        total = np.zeros(len(w.data) + 1, np.int32)
        np.cumsum(row[w.data], out=total[1:])
        counts.append(total[w.ends] - total[w.starts])
    upper, lower, digit, other = counts
    # the second byte of a two-byte capital letter (C3 80 to C3 9E) counts as lower above
    wide = np.zeros(len(w.data) + 1, np.int32)
    np.cumsum((w.data[1:] >= 0x80) & (w.data[1:] <= 0x9E) & (w.data[:-1] == 0xC3), out=wide[2:]) if len(w.data) > 1 else None
    big = wide[w.ends] - wide[w.starts]
    upper, lower = upper + big, lower - 2 * big
    size = upper + lower + digit
    code = (upper > 1) * 1 + (lower > 0) * 2 + (digit > 0) * 4 + (size == 0) * 8 + np.minimum(other, 3) * 16
    code += np.searchsorted([2, 4, 8, 13, 25], size, "right") * 64
    last = w.data[w.ends - 1].astype(np.int64)
    code += np.where(_CLASS[3, last] > 0, last, 0) * 1024
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    return code.astype(np.uint64) + same.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(1)


def document_bins(data: np.ndarray, offsets: np.ndarray):
    """For each document the sorted, distinct bins of its features."""
    w = Words(data, offsets)
    h = w.hashes()
    s = mix(_shapes(w, h)) if len(h) else h
    p, q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    with np.errstate(over="ignore"):
        sets = [h, mix(h[:-1] * p + h[1:]), s ^ q, mix((s[:-1] * p) ^ s[1:]), mix((s[:-2] * p + s[1:-1]) * q ^ s[2:])]
    sets = [((mix(x + np.uint64(i)) >> _BITS).astype(np.int32), min(i % 2 if i < 2 else i - 2, 2)) for i, x in enumerate(sets)]
    mark = np.zeros(BINS, bool)
    first = w.first.tolist()
    for a, b in zip(first, first[1:], strict=False):
        for bins, longer in sets:
            mark[bins[a : max(a, b - longer)]] = True
        own = np.flatnonzero(mark)
        mark[own] = False
        yield own


def _bins_of(batches, column: int):
    for b in batches:
        data, off = text_bytes(b.column(column))
        for lo, hi in chunks(off):
            yield b, lo, hi, document_bins(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])


# ---------------------------------------------------------------- fitting


def descend(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: float = COST, epochs: int = EPOCHS) -> np.ndarray:
    """Weights of the hinge-loss model (last one: bias) by dual coordinate descent.

    rows: (indices, values) of unit length; the bias is one more feature of value 1.
    """
    w, alpha = np.zeros(size + 1), np.zeros(len(y))
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)).tolist():
            idx, x = rows[i]
            slope = y[i] * (w[idx] @ x + w[size]) - 1
            new = min(max(alpha[i] - slope / 2, 0.0), cost)  # |x|^2 + 1 = 2
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[idx] += step * x
                w[size] += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def ratios(bins: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Class log-count ratio of each bin."""
    p, q = np.full(BINS, ALPHA), np.full(BINS, ALPHA)
    for b, v in zip(bins, y, strict=True):
        (p if v > 0 else q)[b] += 1
    return np.log((p / p.sum()) / (q / q.sum()))


def _unit(b: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = r[b]
    return b, (x / max(float(np.sqrt(x @ x)), 1e-12)).astype(np.float32)


def _logistic(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) of the score 1 / (1 + exp(-(a m + b))), a > 0, by Newton steps."""
    t, ab = (y > 0).astype(float), np.array([1.0, 0.0])
    x = np.stack([m, np.ones(len(m))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        grad = x.T @ (p - t) + 1e-3 * ab
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        ab = ab - step
        if np.abs(step).max() < 1e-8:
            break
    return max(float(ab[0]), 1e-3), float(ab[1])


def fit(bins: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, float, float, float]:
    """(weights of raw indicators' ratios folded in, bias, a, b); y: +1 or -1."""
    if len(set(y.tolist())) < 2:  # nothing to tell apart: one score for all
        return np.zeros(BINS), 0.0, 1.0, 3.0 if len(y) and y[0] > 0 else -3.0 if len(y) else 0.0
    margins = np.zeros(len(y))
    fold = np.arange(len(y)) % FOLDS
    for f in range(FOLDS):
        on = np.flatnonzero(fold != f)
        if len(set(y[on].tolist())) < 2:
            continue
        r = ratios([bins[i] for i in on], y[on])
        w = descend([_unit(bins[i], r) for i in on], y[on], BINS)
        for i in np.flatnonzero(fold == f):
            idx, x = _unit(bins[i], r)
            margins[i] = w[idx] @ x + w[BINS]
    a, b = _logistic(margins, y)
    r = ratios(bins, y)
    w = descend([_unit(x, r) for x in bins], y, BINS)
    return np.stack([w[:BINS] * r, r * r]), float(w[BINS]), a, b


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """A model, as a small tuple, from about ``sample`` of the rows of labels (doc_id, quality)."""
    ids = labels.where("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    count = ids.count()
    share = min(1.0, sample / max(count, 1))
    ids = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")  # about SAMPLE rows of 12 bytes

    def features(batches):
        for b, lo, hi, found in _bins_of(batches, 1):
            packed = [x.astype("<u4").tobytes() for x in found]
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo), pa.array(packed, pa.binary())], ["doc_id", "quality", "bins"])

    def learn(batches):
        got = [x for b in batches for x in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)]
        got.sort(key=lambda x: (x[0], x[2]))
        y = np.array([2 * x[1] - 1 for x in got])
        w, bias, a, b = fit([np.frombuffer(x[2], "<u4").astype(np.int32) for x in got], y)
        yield pa.RecordBatch.from_arrays([pa.array([w.astype("<f4").tobytes()], pa.binary()), *(pa.array([v], pa.float64()) for v in (bias, a, b))], ["w", "bias", "a", "b"])

    sampled = rows.select("doc_id", "text", "quality").mapInArrow(features, "doc_id long, quality int, bins binary")
    found = sampled.repartition(1).mapInArrow(learn, "w binary, bias double, a double, b double").collect()
    if not found:
        return np.zeros((2, BINS), np.float32), 0.0, 1.0, 0.0
    w, bias, a, b = found[0]
    w = np.frombuffer(w, "<f4")
    return (w.reshape(2, BINS) if len(w) == 2 * BINS else np.zeros((2, BINS), np.float32)), bias, a, b


def score(documents: DataFrame, model) -> DataFrame:
    """documents with ``score`` (double, 0 to 1) appended; only the column text is looked at."""
    held = documents.sparkSession.sparkContext.broadcast(model)
    docs = documents.withColumn("text", F.col("text").cast("string"))
    at = docs.columns.index("text")
    schema = docs.select("*", F.lit(0.0).alias("score")).schema

    def run(batches):
        (w, square), bias, a, b = held.value
        for batch, lo, hi, found in _bins_of(batches, at):
            m = np.empty(hi - lo)
            for i, own in enumerate(found):
                m[i] = w[own].sum(dtype=np.float64) / max(np.sqrt(square[own].sum(dtype=np.float64)), 1e-12) + bias
            s = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s)], [*part.schema.names, "score"])

    return docs.mapInArrow(run, schema)


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def score_documents(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of documents (doc_id, text): doc_id, held_out, score, predicted.

    Labels of held-out documents (crc32 of the id as text, modulo 5, is 0) are never learnt
    from. Null and empty texts have no features and get the score of the bias alone; repeated
    rows get equal scores; null ids are scored and count as not held out; of labels that
    disagree the higher counts, null or other labels are skipped; without labels of both
    classes every row gets one score. Other columns are ignored.
    """
    model = train(documents, labels.where(~held_out(F.col("doc_id"))))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of documents that are not rejected, with their columns as they were."""
    model = train(documents, labels.where(~held_out(F.col("doc_id"))))
    clash = "score" in documents.columns
    docs = documents.withColumnRenamed("score", "own score") if clash else documents
    kept = score(docs, model).where(F.col("score") >= threshold).drop("score")
    return kept.withColumnRenamed("own score", "score") if clash else kept
