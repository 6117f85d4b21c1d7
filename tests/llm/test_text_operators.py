"""Text operators against brute force, on whole small tables and on awkward rows."""

import collections
import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "a b c"), (5, "a b c"), (5, "a b c"), (None, "A B c"), (6, "é" * 50), (7, "x"),
    (8, " ".join(["same"] * 400)), (9, " ".join(f"w{i}" for i in range(3000))), (10, " ".join(f"w{i}" for i in range(20, 90)) + " end"), (11, "word\x1cpart more " * 40),
]


def rows(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def odd(spark):
    df = spark.createDataFrame(ODD, DOCS)
    for c in ("fp", "score", "words", "th", "n", "key", "start", "cut"):  # clashing extra columns
        df = df.withColumn(c, F.lit("?"))
    return df


def both(spark):
    return [rows(spark, "documents"), odd(spark), spark.createDataFrame([], DOCS)]


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


# ---------------------------------------------------------------- SimHash


def simhash(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(ids, fps, tau):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    own = list(parent)
    for i, a in enumerate(own):
        for b in own[i + 1 :]:
            if (a ^ b).bit_count() <= tau:
                parent[find(a)] = find(b)
    low = {}
    for d, f in zip(ids, fps, strict=True):
        if d is not None:
            low[find(f)] = min(low.get(find(f), d), d)
    return [low.get(find(f)) for f in fps]


def test_simhash_groups(spark):
    from tallymesh.llm.simhash import near_duplicates

    for df in both(spark):
        want = texts(df)
        fps = [simhash(t) for _, t in want]
        want = sorted(map(repr, zip([d for d, _ in want], [f"{f:016x}" for f in fps], groups([d for d, _ in want], fps, 2), strict=True)))
        got = sorted(repr((r.doc_id, r.fingerprint, r.component_id)) for r in near_duplicates(df).collect())
        assert got == want


@pytest.mark.parametrize("tau,block", [(0, 2048), (2, 4), (3, 2048), (6, 16), (8, 2048)])
def test_simhash_links_are_complete(spark, tau, block):
    from tallymesh.llm.simhash import links

    rng = np.random.default_rng(tau)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 10), replace=False)) for b in np.repeat(base, 6)]
    fps = sorted({*map(int, base), *near, 0})
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= tau}
    got = {tuple(int(np.int64(x).view(np.uint64)) for x in r) for r in links(df, tau, whole=False, block=block).collect()}
    assert got == want
    forest = [tuple(int(np.int64(x).view(np.uint64)) for x in r) for r in links(df, tau, block=block).collect()]
    assert set(forest) <= want

    def comps(edges):
        parent = {f: f for f in fps}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            parent[max(find(a), find(b))] = min(find(a), find(b))
        return [find(f) for f in fps]

    assert comps(forest) == comps(want)


def test_components_of_long_chain(spark):
    from tallymesh.llm.common import components

    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 3), (3, 5), (7, 7), (9, None), (3, 8)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {3: 3, 5: 3, 8: 3}


# ---------------------------------------------------------------- repeated windows


def spans(docs, k):
    words = [re.findall(rb"[^\x20\x09-\x0D]+", t.encode()) for _, t in docs]
    seen = collections.Counter(tuple(w[i : i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for (d, _), w in zip(docs, words, strict=True):
        gone = set()
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i : i + k])] > 1:
                gone.update(range(i, i + k))
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("k,hot", [(35, None), (5, None), (12, 0)])
def test_spans(spark, monkeypatch, k, hot):
    from tallymesh.llm import spans as op

    if hot is not None:
        monkeypatch.setattr(op, "HOT", hot)
    for df in both(spark):
        got = sorted(repr(tuple(r)) for r in op.remove_repeats(df, k).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
        assert got == spans(texts(df), k)


# ---------------------------------------------------------------- benchmark leaks

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def leaks(docs, items, k):
    win = collections.defaultdict(set)
    for i, t in items:
        w = WORD.findall(t.encode().lower())
        n = min(k, len(w))
        for j in range(len(w) - n + 1) if w else ():
            win[tuple(w[j : j + n])].add(i)
    sizes = {len(x) for x in win}
    out = []
    for d, t in docs:
        w = WORD.findall(t.encode().lower())
        hit, named = set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if found := win.get(tuple(w[j : j + n])):
                    hit.update(range(j, j + n))
                    named |= {str(x) for x in found if x is not None}
        out.append((d, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return sorted(map(repr, out))


@pytest.mark.parametrize("rows_sent", [500_000, 0])
def test_leaks(spark, monkeypatch, rows_sent):
    from tallymesh.llm import decontam

    monkeypatch.setattr(decontam, "BROADCAST_ROWS", rows_sent)
    items = rows(spark, "benchmark")
    short = spark.createDataFrame([(900, "W25 w26, W27"), (901, "the"), (None, "same same"), (902, None), (903, "--"), (904, " ".join(f"w{i}" for i in range(40, 53)))], "item_id long, text string")
    for df, own in ((rows(spark, "documents"), items), (odd(spark), short), (rows(spark, "documents"), items.unionByName(short)), (odd(spark), items.limit(0)), (both(spark)[2], items)):
        want = leaks(texts(df), [(r.item_id, r.text or "") for r in own.collect()], 10)
        got = sorted(repr(tuple(r)) for r in decontam.find_leaks(df, own).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect())
        assert got == want


# ---------------------------------------------------------------- SQL


@pytest.mark.parametrize("name", ["op2_url_rules", "op5_spans", "op7_decontaminate", "op8_warc"])
def test_queries_give_the_rows_of_their_sql(spark, name):
    import duckdb

    from tallymesh.llm.queries import ORACLES, QUERIES

    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        spark.read.parquet(f"{SF}/{table}.parquet").createOrReplaceTempView(table)
        duck.register(table, spark.table(table).toArrow())
    want = duck.execute(ORACLES[name]).fetchall()
    cols = [c[0] for c in duck.description]
    got = QUERIES[name](spark, SF)
    assert set(cols) <= set(got.columns) and sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.select(*cols).collect())
