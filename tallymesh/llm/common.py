"""Word spans over Arrow buffers, shared by the text operators; staged tables are the library's."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ..plans.staging import components, partitions, shared_dir, stage

__all__ = ["CHUNK_BYTES", "GRAM_A", "GRAM_B", "Words", "chunks", "components", "grams", "mix", "partitions", "shared_dir", "stage", "text_bytes"]

CHUNK_BYTES = 4 << 20

# ---------------------------------------------------------------- words in numpy

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
GRAM_A, GRAM_B = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    h = (h ^ (h >> np.uint64(32))) * _C2
    h = (h ^ (h >> np.uint64(29))) * _C1
    return h ^ (h >> np.uint64(32))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of an Arrow string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Row ranges of about limit bytes each; a longer row stands alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to
        at = to


class Words:
    """Words (runs of bytes other than ASCII white space) of consecutive rows.

    starts, ends: byte positions; first: index of each row's first word, with one more at the end.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, n = data, offsets, len(data)
        space = _SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.ones(n, bool)
        before[1:] = space[:-1]
        after = np.ones(n, bool)
        after[:-1] = space[1:]
        self.starts = np.flatnonzero(~space & (before | edge[:n]))
        self.ends = np.flatnonzero(~space & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes, eight bytes at a time."""
        return span_hashes(self.data, self.starts, self.ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded.tobytes(), strides=(1,))
    length = ends - starts
    h = length.astype(np.uint64) * _C1
    at, left, rows = starts, length, None
    while len(at):
        part = eight[at] & _MASK[np.minimum(left, 8)]
        if rows is None:
            h = mix(h ^ part)
        else:
            h[rows] = mix(h[rows] ^ part)
        more = np.flatnonzero(left > 8)
        rows = more if rows is None else rows[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def grams(h: np.ndarray, n: int, p: np.uint64 = GRAM_A) -> np.ndarray:
    """Hash of each run of n consecutive values, order included (by doubling)."""
    out, have, power = h, 1, p
    with np.errstate(over="ignore"):
        while have * 2 <= n:
            out = out[:-have] * power + out[have:] if len(out) > have else out[:0]
            have, power = have * 2, power * power
        if have < n:
            step = n - have
            out = out[:-step] * GRAM_B + (out[step:] ^ GRAM_A) if len(out) > step else out[:0]
    return out
