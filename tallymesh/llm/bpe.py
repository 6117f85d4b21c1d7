"""Byte-pair encoding and decoding with a public vocabulary.

A text is cut at the added tokens and then into pieces (words with the space before them, runs of
digits, of marks, of white space). In a piece each byte is a symbol of a doubly linked list. Pairs
of neighbours that the vocabulary merges wait in a priority queue by rank, then place; a merged pair
links in its new neighbours' pairs, and entries whose symbols have changed since are skipped as they
surface. Decoding concatenates the vocabulary's strings. Encoding is a map over rows: nothing is
shuffled, and a piece that was met before is looked up in a cache of bounded size.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, text_bytes

CACHE_PIECES = 1 << 19  # a round trip has two workers a core, and either may hold a cache
CACHE_LENGTH = 64  # characters of a piece up to which it is cached
#: Fixed value: the pattern by which this family of vocabularies cuts text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary's strings."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Vocabulary:
    """Merges, added tokens and strings of a byte-level vocabulary file (its JSON text)."""

    def __init__(self, spec: str):
        found = json.loads(spec)
        model, cut, added = found["model"], found["pre_tokenizer"] or {}, found["added_tokens"]
        plain = not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut["add_prefix_space"] or not cut.get("use_regex", True) or found["normalizer"] or odd or not plain:
            raise ValueError("a byte-level vocabulary without normaliser and prefix space is needed")
        ids, letters = model["vocab"], byte_letters()
        self.byte = [ids[c] for c in letters]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in reversed([*enumerate(pairs)])}
        self.added = {t["content"]: t["id"] for t in added}
        self.added_at = re.compile("|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))) if added else None
        value = {c: b for b, c in enumerate(letters)}
        strings = [b""] * (1 + max(chain(ids.values(), self.added.values()), default=-1))
        for text, i in chain(ids.items(), self.added.items()):
            strings[i] = bytes(value[c] for c in text) if all(c in value for c in text) else text.encode()
        self.strings = np.frombuffer(b"".join(strings), np.uint8)
        self.ends = np.append(0, np.cumsum([len(s) for s in strings]))


def merge(symbols: list[int], merges: dict) -> list[int]:
    """The symbols left when the pair of least rank, leftmost first, is merged until none can be."""
    n = len(symbols)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    queue = [(*found, i) for i, pair in enumerate(zip(symbols, symbols[1:], strict=False)) if (found := merges.get(pair))]
    queue = [(rank, i, new) for rank, new, i in queue]
    heapq.heapify(queue)
    while queue:
        rank, i, new = heapq.heappop(queue)
        j = after[i]
        if symbols[i] < 0 or j < 0 or merges.get((symbols[i], symbols[j])) != (rank, new):
            continue  # stale: one of the two has been merged since
        symbols[i], symbols[j] = new, -1
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            if found := merges.get((new, symbols[k])):
                heapq.heappush(queue, (found[0], i, found[1]))
        if (k := before[i]) >= 0 and (found := merges.get((symbols[k], new))):
            heapq.heappush(queue, (found[0], k, found[1]))
    return [s for s in symbols if s >= 0]


class Codec(dict):
    """Encodes and decodes texts; as a dict, the ids of each piece met, up to a bounded number."""

    def __init__(self, spec: str, limit: int = CACHE_PIECES):
        super().__init__()
        self.words, self.limit, self.spec = Vocabulary(spec), limit, spec
        self.old: dict[str, tuple[int, ...]] = {}  # the generation before: pieces that come back stay
        self.cut = regex.compile(PIECES)
        self.fine: set[str] = set()  # characters whose kind is beyond doubt

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.old.get(piece)
        if ids is None:
            byte = self.words.byte
            ids = tuple(merge([byte[b] for b in piece.encode()], self.words.merges))
        if len(piece) <= CACHE_LENGTH:
            if len(self) >= self.limit // 2:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    @functools.cached_property
    def _library(self):
        from tokenizers import pre_tokenizers

        return pre_tokenizers.ByteLevel(add_prefix_space=False)

    def _pieces(self, text: str) -> list[str]:
        """text in pieces. Characters newer than this Python's Unicode have the kind that the tokenizers library gives them."""
        if not text.isascii():
            new = set(text) - self.fine
            if any(unicodedata.category(c) == "Cn" for c in new):
                return [text[i:j] for _, (i, j) in self._library.pre_tokenize_str(text)]
            self.fine |= new
        return self.cut.findall(text)

    def encode(self, text: str) -> list[int]:
        if not self.words.added_at:
            return [*chain.from_iterable(map(self.__getitem__, self._pieces(text)))]
        out, at = [], 0
        for m in self.words.added_at.finditer(text):
            out += chain.from_iterable(map(self.__getitem__, self._pieces(text[at : m.start()])))
            out.append(self.words.added[m[0]])
            at = m.end()
        out += chain.from_iterable(map(self.__getitem__, self._pieces(text[at:] if at else text)))
        return out

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The texts of consecutive rows of ids, sizes ids each."""
        start, width = self.words.ends[ids], self.words.ends[ids + 1] - self.words.ends[ids]
        to = np.append(0, np.cumsum(width))
        raw = self.words.strings[np.repeat(start - to[:-1], width) + np.arange(to[-1])].tobytes()
        edge = to[np.append(0, np.cumsum(sizes))].tolist()
        return [raw[i:j].decode("utf-8", "replace") for i, j in zip(edge, edge[1:], strict=False)]


@functools.lru_cache(maxsize=1)
def _codec(spec: str) -> Codec:
    return Codec(spec)


def vocabulary(path: str) -> str:
    """The vocabulary file's text, which tasks get from the driver (a few MB at most)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(documents: DataFrame, path: str) -> DataFrame:
    """Per row of documents (doc_id, text): doc_id and ids, the token ids of the whole text.

    Null and empty texts have no ids; strings of added tokens in a text become their ids; repeated
    rows, null and repeated doc_ids are kept, other columns ignored. An empty table gives no rows.
    """
    held = documents.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        codec = _codec(held.value)
        for b in batches:
            _, offsets = text_bytes(b.column(1))
            for lo, hi in chunks(offsets):
                found = [codec.encode(t or "") for t in b.column(1).slice(lo, hi - lo).to_pylist()]
                size = np.array([len(x) for x in found], np.int64)
                ids = np.fromiter(chain.from_iterable(found), np.int32, int(size.sum()))
                rows = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), rows], ["doc_id", "ids"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """encoded (doc_id, ids) with ``text``, what the ids say; null ids say the empty text.

    Byte sequences that are no UTF-8 become replacement characters; an id outside the vocabulary
    is an error.
    """
    held = encoded.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        codec = _codec(held.value)
        for b in batches:
            ids = b.column(1)
            size = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            off = np.append(0, np.cumsum(size))
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            for lo, hi in chunks(off, 1 << 20):
                texts = codec.decode(flat[off[lo] : off[hi]], size[lo:hi])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), ids.slice(lo, hi - lo), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def round_trip(documents: DataFrame, path: str) -> DataFrame:
    """Per row of documents: doc_id, n_tokens, and the digests of its ids and of the text they decode to."""
    both = decode(encode(documents, path), path)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
