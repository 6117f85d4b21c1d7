"""Cost-balanced packing of documents into training sequences.

A document of n tokens costs n + n*n/capacity (linear layers plus attention). Documents go in
descending order of length to the sequence of least cost that has room for them; what fits in
none is cut, its first part fills the sequence with most room. Packing runs inside each input partition, over
groups of bounded size, so nothing is shuffled and no group grows with the corpus. A group's
remainder is split into sequences whose sizes are powers of two, which need no padding.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP_TOKENS = 4 << 20
CACHE_WORDS = 1_000_000


#: Bytes as letters (a), commas and full stops (,), white space, bytes that may be no letters (!), others (#).
_KIND = bytearray(b"#" * 128 + b"!" * 128)
_KIND[97:123] = b"a" * 26
_KIND[0xC3] = 97
_KIND[0x80:0xC0] = b"a" * 64  # after C3: Latin-1 letters
_KIND[0x97] = _KIND[0xB7] = 33
for _b in b" \t\n\r\x0b\x0c":
    _KIND[_b] = 32
for _b in b",.":
    _KIND[_b] = 44
_KIND = bytes(_KIND)
_SPACED = [(m + w, b" " + m + w) for m in (b",", b".") for w in (b" ", b"\n")]


def _loosen(text: bytes) -> bytes:
    """text with a space before the commas and full stops that end words of letters.

    Done only where every mark before white space follows a letter, so that no run of marks
    is cut; tokens are the same either way, and far fewer pieces are distinct.
    """
    kind = text.translate(_KIND)
    if b"!" in kind or b"#, " in kind or b",, " in kind:
        return text
    for a, b in _SPACED:
        text = text.replace(a, b)
    return text


#: Marks that end a word without joining with its letters in any token.
_TAIL = ".,!?;:*$%&#"


class CachedTokenizer:
    """Token ids by white-space separated pieces, which a tokenizer that drops white space
    encodes independently of each other; a bounded cache from piece to packed ids.

    A word of letters with marks at its end is looked up as two pieces: this family of
    tokenizers splits letters from marks before any merge. Only words that stay letters in
    lower case are cut so; others may end in a combining mark that joins the marks after it.
    The cache has two generations, so
    that words met once make room for those that come back.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        self.model, self.limit = Tokenizer.from_file(path), limit
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.unit = np.dtype("<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4")
        spec = json.loads(self.model.to_str())
        own = spec["normalizer"] or {}
        self.lower = "Lowercase" in [x["type"] for x in own.get("normalizers", [own]) if "type" in x]
        self.apart = "[\\p{L}]+|" in json.dumps(spec["pre_tokenizer"]).replace("\\\\", "\\")

    def _encode(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word; words of letters are encoded many at a time."""
        out: dict[str, bytes] = {}
        plain = [w for w in words if w.isalpha() and w.lower().isalpha()] if self.apart else []
        groups = [plain[i : i + 128] for i in range(0, len(plain), 128)]
        size = self.unit.itemsize
        for group, e in zip(groups, self.model.encode_batch([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            cut = (np.flatnonzero(np.diff(np.array(e.word_ids, np.int64))) + 1) * size
            if len(cut) == len(group) - 1:  # each word is one pre-token
                raw, at = np.array(e.ids, self.unit).tobytes(), [0, *cut.tolist(), len(e.ids) * size]
                out.update(zip(group, [raw[i:j] for i, j in zip(at, at[1:], strict=False)], strict=True))
        rest = [w for w in words if w not in out]
        for w, e in zip(rest, self.model.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            out[w] = np.array(e.ids, self.unit).tobytes()
        return [out[w] for w in words]

    def _learn(self, pieces: set[bytes]) -> None:
        known, old = self.known, self.old
        new, joined = set(), []
        for p in pieces:
            if p in old:
                known[p] = old[p]
                continue
            word = p.decode()
            core = word.rstrip(_TAIL) if self.apart else word
            if len(core) < len(word) and core.isalpha() and core.lower().isalpha():
                parts = core.encode(), word[len(core) :].encode()
                joined.append((p, parts))
                for x in parts:
                    if x not in known:
                        if x in old:
                            known[x] = old[x]
                        else:
                            new.add(x)
            else:
                new.add(p)
        names = sorted(new)
        known.update(zip(names, self._encode([x.decode() for x in names]), strict=True))
        for p, (x, y) in joined:
            known[p] = known[x] + known[y]

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each UTF-8 text; pieces that differ in case only are one where case is dropped."""
        if len(self.known) > self.limit // 2:
            self.old, self.known = self.known, {}
        split = [(_loosen(x.lower()) if self.apart and self.lower and b"<|" not in x else x).split() for x in texts]
        self._learn(set().union(*split).difference(self.known))
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, words)), self.unit) for words in split]


@functools.cache
def cached_tokenizer(path: str) -> CachedTokenizer:
    """One per Python worker: its cache serves all the tasks the worker runs."""
    return CachedTokenizer(path)


def assign(lengths: np.ndarray, capacity: int = 2048) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of one group."""
    total = int(lengths.sum())
    sizes = [capacity] * (total // capacity)
    rest = total % capacity
    sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    room, cost, out = np.array(sizes, np.int64), np.zeros(len(sizes)), []
    for doc in np.argsort(-lengths, kind="stable").tolist():
        start, left = 0, int(lengths[doc])
        while left:
            fits = room >= left
            s = int(np.where(fits, cost, np.inf).argmin() if fits.any() else room.argmax())
            n = min(left, int(room[s]))
            out.append((doc, start, n, s, sizes[s] - int(room[s])))
            room[s] -= n
            cost[s] += n + n * n / capacity
            start, left = start + n, left - n
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Pieces of all docs (doc_id, text) in sequences of at most ``capacity`` tokens.

    Null or empty text: just the end id. Repeated rows and null ids are packed as they are;
    longer documents than a sequence are cut. Sequence ids are unique over the table: the
    partition's number in the high bits. An empty table gives no rows; other columns are ignored.
    """

    def run(batches):
        own, seq = cached_tokenizer(tokenizer), TaskContext.get().partitionId() << 36
        held: list[tuple] = []
        size = 0

        def flush():
            nonlocal seq, size
            lengths = np.array([len(x[1]) + 1 for x in held], np.int64)
            rows = assign(lengths, capacity)
            cols: tuple[list, ...] = tuple([] for _ in range(7))
            top = 0
            for doc, start, n, s, offset in rows:
                who, ids = held[doc]
                top = max(top, s + 1)
                part = ids[start : start + n].astype("<u4").tobytes()
                if start + n > len(ids):
                    part += end
                for c, v in zip(cols, (who, start, n, zlib.crc32(part), int(lengths[doc]), seq + s, offset), strict=True):
                    c.append(v)
            seq += top
            held.clear()
            size = 0
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            who = b.column(0).to_pylist()
            for at in range(0, len(who), 256):
                part = b.column(1).slice(at, 256).cast(pa.binary()).to_pylist()
                for w, ids in zip(who[at : at + 256], own.ids([x or b"" for x in part]), strict=True):
                    held.append((w, ids))
                    size += len(ids) + 1
                    if size >= group_tokens:
                        yield flush()
        if held:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
