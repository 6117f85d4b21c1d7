"""Media columns: PNG files in binary columns, read back with checksum tests.

The writer lays bytes out as an 8-bit grey image; the reader walks the chunks, tests every
CRC, inflates through zlib and undoes all five row filters in numpy. The feature is a hash of
the low frequencies of a two-dimensional cosine transform.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_bytes

WIDTH = 64
_SIGN = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def write_png(pixels: np.ndarray, row_filter: int = 0, level: int = 1) -> bytes:
    """An 8-bit grey PNG. row_filter: 0 (none), 1 (left) or 2 (above) for all rows."""
    rows = pixels.astype(np.uint8)
    if row_filter == 1:
        rows = np.concatenate([rows[:, :1], rows[:, 1:] - rows[:, :-1]], axis=1)
    elif row_filter == 2:
        rows = np.concatenate([rows[:1], rows[1:] - rows[:-1]])
    raw = np.empty((rows.shape[0], rows.shape[1] + 1), np.uint8)
    raw[:, 0], raw[:, 1:] = row_filter, rows
    head = struct.pack(">IIBBBBB", pixels.shape[1], pixels.shape[0], 8, 0, 0, 0, 0)
    return _SIGN + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(raw.tobytes(), level)) + _chunk(b"IEND", b"")


def _diagonals(kinds: np.ndarray, rows: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Consecutive rows with the average (3) or Paeth (4) filter undone.

    A sample needs those to its left, above and above left, so the samples of one diagonal are
    independent of each other and are done at once.
    """
    m, w = rows.shape
    out = np.zeros((m + 1, w + 1), np.int64)  # a row above, a column of zeros before
    out[0, 1:] = above
    for t in range(m + w - 1):
        r = np.arange(max(0, t - w + 1), min(m, t + 1))
        c = t - r
        left, up, corner = out[r + 1, c], out[r, c + 1], out[r, c]
        base = left + up - corner
        x, y, z = np.abs(base - left), np.abs(base - up), np.abs(base - corner)
        nearest = np.where((x <= y) & (x <= z), left, np.where(y <= z, up, corner))
        out[r + 1, c + 1] = (rows[r, c] + np.where(kinds[r] == 3, (left + up) >> 1, nearest)) & 255
    return out[1:, 1:].astype(np.uint8)


def _unfilter(kinds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    if not kinds.any():
        return rows
    if kinds.max() > 4:
        raise ValueError(f"PNG: unknown row filter {kinds.max()}")
    out = np.zeros_like(rows)
    above = np.zeros(rows.shape[1], np.uint8)
    i = 0
    while i < len(rows):
        kind, to = int(kinds[i]), i + 1
        if kind > 2:
            while to < len(rows) and kinds[to] > 2:
                to += 1
            out[i:to] = _diagonals(kinds[i:to], rows[i:to], above)
        else:
            out[i] = np.cumsum(rows[i], dtype=np.uint8) if kind == 1 else rows[i] + above if kind == 2 else rows[i]
        above, i = out[to - 1], to
    return out


def read_png(data: bytes) -> np.ndarray:
    """Pixels of an 8-bit grey, non-interlaced PNG; ValueError if any part is damaged."""
    if data[:8] != _SIGN:
        raise ValueError("PNG: no signature")
    at, size, parts, ended = 8, None, [], False
    while at < len(data) and not ended:
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body, check = data[at + 8 : at + 8 + n], data[at + 8 + n : at + 12 + n]
        if len(body) != n or check != struct.pack(">I", zlib.crc32(kind + body)):
            raise ValueError(f"PNG: checksum of {kind!r} at byte {at}")
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            parts.append(body)
        ended = kind == b"IEND"
        at += 12 + n
    if not ended or size is None or size[2:] != (8, 0, 0, 0, 0):
        raise ValueError("PNG: incomplete or not 8-bit grey")
    raw = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8)
    if len(raw) != size[1] * (size[0] + 1):
        raise ValueError("PNG: pixel data of another size")
    raw = raw.reshape(size[1], size[0] + 1)
    return _unfilter(raw[:, 0], raw[:, 1:])


def _basis(n: int, k: int) -> np.ndarray:
    return np.cos(np.pi * (2 * np.arange(n) + 1) * np.arange(k)[:, None] / (2 * n))


_C32 = _basis(32, 8)


def _shrink(n: int) -> np.ndarray:
    """Weights (32, n) that average n samples into 32 cells of equal extent."""
    edges = np.linspace(0, n, 33)
    lo, hi = edges[:-1, None], edges[1:, None]
    cell = np.arange(n)
    return np.clip(np.minimum(hi, cell + 1) - np.maximum(lo, cell), 0, None) / (n / 32)


_ACROSS = _shrink(WIDTH)


def _area_rows(pixels: np.ndarray) -> np.ndarray:
    """pixels averaged into 32 rows, linear in the number of rows."""
    n = len(pixels)
    total = np.zeros((n + 1, pixels.shape[1]))
    np.cumsum(pixels, axis=0, out=total[1:])
    edges = np.linspace(0, n, 33)
    whole = np.minimum(edges.astype(int), n - 1)
    at = total[whole] + (edges - whole)[:, None] * pixels[whole]
    return np.diff(at, axis=0) / (n / 32)


def cosine_hash(pixels: np.ndarray) -> str:
    """64 bits as 16 hex digits: which low-frequency coefficients lie above their median."""
    small = _area_rows(pixels.astype(np.float64))
    small = small @ (_ACROSS if pixels.shape[1] == WIDTH else _shrink(pixels.shape[1])).T
    low = _C32 @ small @ _C32.T
    return np.packbits((low > np.median(low)).ravel()).tobytes().hex()


def encode(docs: DataFrame, level: int = 1) -> DataFrame:
    """(doc_id, n_bytes, png): each text as UTF-8, zero-padded to a positive multiple of 64."""

    def run(batches):
        for b in batches:
            data, off = text_bytes(b.column(1))
            png = []
            for i, j in zip(off.tolist(), off.tolist()[1:], strict=False):
                rows = max(1, -(-(j - i) // WIDTH))
                pixels = np.zeros(rows * WIDTH, np.uint8)
                pixels[: j - i] = data[i:j]
                png.append(write_png(pixels.reshape(rows, WIDTH), level=level))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(off)), pa.array(png, pa.binary())], ["doc_id", "n_bytes", "png"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, png binary")


def decode(stored: DataFrame) -> DataFrame:
    """Checks and features of stored PNG columns (doc_id, n_bytes, png); damage raises."""

    def run(batches):
        for b in batches:
            size, sha, tail, length, media, feature = [], [], [], [], [], []
            for x in b.column(2):
                png = x.as_py()
                pixels = read_png(png)
                raw = pixels.tobytes()
                size.append(len(raw)), sha.append(hashlib.sha256(raw).hexdigest()), tail.append(zlib.crc32(raw[-64:]))
                length.append(len(png)), media.append(hashlib.sha256(png).hexdigest()), feature.append(cosine_hash(pixels))
            cols = [b.column(0), b.column(1), *(pa.array(v, t) for v, t in ((size, pa.int64()), (sha, pa.string()), (tail, pa.int64()), (length, pa.int64()), (media, pa.string()), (feature, pa.string())))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return stored.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def store_and_read(docs: DataFrame) -> DataFrame:
    """Store every text of docs (doc_id, text) as a PNG column, read it back and describe it.

    Null text: empty (one row of zeros). Repeated rows, null ids and empty tables pass through;
    other columns are ignored. PNG files are already deflated, so the table is not compressed.
    """
    return decode(stage(encode(docs), "media", "none"))
