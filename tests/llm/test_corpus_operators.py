"""Source divergence, Merkle manifests and byte-pair encoding against plain Python over whole tables."""

import collections
import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma délta EPSILON zeta 你好 ïota".split()


def awkward(spark, n=400, seed=0):
    """Nulls in every column, empty and long texts, repeated rows, shared ids, empty and null groups, clashing columns."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(WORDS[: 2 + i % 7]) for _ in range(rng.randint(0, 12))) + rng.choice(["", "!", "\n42", "<|endoftext|>"])
        rows.append((i, text, rng.choice(["en", "en", "en", "de", "", None]), rng.choice(["a", "b", "c", "ü", "", None]), len(text)))
    rows += [rows[7]] * 3 + [(None, "alpha", "en", "a", 5), (None, None, None, None, None), (9, "other text", "en", "a", 10), (5, None, "fr", "lone", None), (7**5, "x" * 50_000 + " alpha", "en", "b", 2**63 - 1)]
    extra = {c: F.lit("?") for c in ("term", "player", "tree", "pos", "digest", "size", "ids", "key", "n", "block")}
    return spark.createDataFrame(rows, DOCS).withColumns(extra)


# ---------------------------------------------------------------- divergence


def audited(rows, least):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    count, docs, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for r in rows:
        lang, source = r.lang or "", r.source or ""
        words = [re.sub("[A-Z]", lambda c: c[0].lower(), w) for w in term.findall(r.text or "")]
        groups.add((lang, source))
        count[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = {t for t, n in docs[lang].items() if n >= least}
        own = {s: {t: count[lang, s][t] for t in kept} for la, s in groups if la == lang}
        all_ = {t: sum(o[t] for o in own.values()) for t in kept}

        def share(c, kept=kept):
            n = sum(c.values())
            return {t: 1 + 10**9 * (v + 5) // (n + 5 * len(kept)) for t, v in c.items()}

        q, p = share(all_), {s: share(o) for s, o in own.items()}
        for s in own:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in own if o != s]
            terms = [(-(p[s][t] - q[t]), t.encode(), t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:50])):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("least,shard,block", [(30, 2048, 32), (30, 3, 2), (2, 1, 1), (10_000, 4, 3)])
def test_divergence(spark, least, shard, block):
    """Whatever the shards and blocks: odd and even tournaments, languages of one source and without kept terms."""
    from tallymesh.llm.divergence import audit

    df = awkward(spark)
    got = audit(df, least, shard, block)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == audited(df.collect(), least)


def test_divergence_of_the_table(spark):
    from tallymesh.llm.divergence import audit

    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(map(tuple, audit(df).collect())) == audited(df.collect(), 30)
    assert audit(df.limit(0)).collect() == []


def test_shares_are_exact():
    from tallymesh.llm.divergence import share

    rng = random.Random(1)
    for _ in range(300):
        kept = rng.randint(1, 10**rng.randint(1, 8))
        n = [rng.randint(0, 10 ** rng.randint(1, 14)) for _ in range(5)]
        total = sum(n) + rng.randint(0, 10**14)
        assert share(np.array(n), total, kept).tolist() == [1 + 10**9 * (c + 5) // (total + 5 * kept) for c in n]


# ---------------------------------------------------------------- Merkle manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, more=0):
    said = (r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + more, r.text)
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in said))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def path_of(tree, at):
    """(left, right) of every level below the top."""
    out = []
    for level in tree[:-1]:
        other = level[at ^ 1] if at ^ 1 < len(level) else ""
        out.append((other, "") if at & 1 else ("", other))
        at >>= 1
    return out


def manifested(rows):
    langs = collections.defaultdict(list)
    for r in rows:
        langs[r.lang].append(r)
    order = sorted(langs, key=lambda la: (la is not None, (la or "").encode()))
    trees = {}
    for la in order:
        langs[la].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r)))
        trees[la] = levels([leaf_of(r) for r in langs[la]])
    top = levels([trees[la][-1][0] for la in order])
    out = []
    for i, la in enumerate(order):
        for j, r in enumerate(langs[la]):
            path = path_of(trees[la], j) + path_of(top, i)
            forged = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and r.n_chars is not None
            node = leaf_of(r, 1) if forged else leaf_of(r)
            for left, right in path:
                node = digest(left, node, right)
            out.append((r.doc_id, leaf_of(r), trees[la][-1][0], top[-1][0], digest(*(x for s in path for x in s)), node, node == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits,band", [(10, 5), (2, 1), (3, 2), (1, 1)])
def test_manifest(spark, monkeypatch, bits, band):
    """Whatever the blocks: several tiers, partial blocks, bands that do not divide a block."""
    from tallymesh.llm import merkle

    monkeypatch.setattr(merkle, "BITS", bits)
    monkeypatch.setattr(merkle, "BAND", band)
    df = awkward(spark, 60 if bits < 3 else 150)
    got = merkle.verify_documents(df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = sorted(map(tuple, got.collect()), key=repr)
    assert found == manifested(df.collect())
    assert {r[6] for r in found} == {True, False}


@pytest.mark.parametrize("rows", [[], [(1, "x", "en", "s", 1)], [(7, None, None, None, None)] * 2, [(i, "x", "en", "s", 1) for i in range(9)]])
def test_small_manifests(spark, rows):
    from tallymesh.llm.merkle import verify_documents

    df = spark.createDataFrame(rows, DOCS)
    assert sorted(map(tuple, verify_documents(df).collect()), key=repr) == manifested(df.collect())


@pytest.mark.parametrize("n,height,band", [(1, 0, 4), (5, 3, 2), (8, 3, 5), (100, 7, 3), (129, 9, 4)])
def test_traversal(monkeypatch, n, height, band):
    """Paths one after another are those of the whole tree, from subtrees of a few levels."""
    from tallymesh.llm import merkle

    monkeypatch.setattr(merkle, "BAND", band)
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    tree = [leaves]
    for _ in range(height):
        tree.append([merkle.join(*(*tree[-1][i : i + 2], None)[:2]) for i in range(0, len(tree[-1]), 2)])
    top, paths = merkle.top_and_paths(leaves, height)
    assert [top] == tree[-1]
    for at, path in enumerate(paths):
        want = b""
        for level in tree[:-1]:
            other = level[at ^ 1] if at ^ 1 < len(level) else None
            want += bytes(merkle.STEP) if other is None else bytes([merkle.LEFT if at & 1 else merkle.RIGHT]) + other
            at >>= 1
        assert path == want


# ---------------------------------------------------------------- byte-pair encoding


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    return path, Tokenizer.from_file(path)


def encoded(rows, model):
    out = []
    for r in rows:
        ids = model.encode(r.text or "", add_special_tokens=False).ids
        said = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        out.append((r.doc_id, len(ids), said, hashlib.sha256(model.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("own", [True, False])
def test_round_trip(spark, library, own):
    from tallymesh.llm.bpe import round_trip

    path, model = library
    df = awkward(spark) if own else spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(map(tuple, round_trip(df, path).collect()), key=repr) == encoded(df.collect(), model)
    assert round_trip(df.limit(0), path).collect() == []


def test_pieces_of_any_script(library):
    """White space, marks, digits, added tokens, letters of any script, also ones newer than Python's Unicode."""
    from tallymesh.llm.bpe import Codec, vocabulary

    path, model = library
    codec, rng = Codec(vocabulary(path), limit=50), random.Random(3)  # a cache that is emptied often
    pool = [chr(c) for c in [*range(0x250), *range(0x2000, 0x2070), 0x558, 0xA7CE, 0x1C89, 0x323B0, 0x180E, 0x3000, 0x1F600, 0x4E2D, 0x661]] + ["<|endoftext|>", " ", "  ", "\n", "'s", "'ll", " a", "the"] * 20
    for _ in range(4000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))
        want = model.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == want
        assert codec.decode(np.array(want, np.int64), np.array([len(want)])) == [model.decode(want, skip_special_tokens=False)]
    for text in ("a" * 30_000, " " * 30_000, "ab" * 20_000 + "é" * 500):
        assert codec.encode(text) == model.encode(text, add_special_tokens=False).ids
    for _ in range(500):  # ids that say no whole characters
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 12))]
        assert codec.decode(np.array(ids, np.int64), np.array([len(ids)])) == [model.decode(ids, skip_special_tokens=False)]


def test_other_vocabularies_are_refused():
    import public_tokenizers

    from tallymesh.llm.bpe import Vocabulary, vocabulary

    with pytest.raises(ValueError, match="byte-level"):
        Vocabulary(vocabulary(public_tokenizers.path("word_bpe_49k.json")))


def test_decode_takes_nulls(spark, library):
    from tallymesh.llm.bpe import decode, encode

    path, _ = library
    df = spark.createDataFrame([(1, [15496]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert [r.text for r in decode(df, path).orderBy("doc_id").collect()] == ["Hello", "", ""]
    docs = spark.createDataFrame([(1, "Hello world"), (2, None)], "doc_id long, text string")
    assert [r.text for r in decode(encode(docs, path), path).orderBy("doc_id").collect()] == ["Hello world", ""]


# ---------------------------------------------------------------- SQL


@pytest.mark.parametrize("name", ["op11_divergence", "op12_merkle"])
def test_sql(spark, name):
    from tallymesh.llm.queries import ORACLES, QUERIES

    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    got, want = QUERIES[name](spark, SF), c.execute(ORACLES[name])
    names = sorted(got.columns)
    at = [[d[0] for d in want.description].index(x) for x in names]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(tuple(r[i] for i in at) for r in want.fetchall())
