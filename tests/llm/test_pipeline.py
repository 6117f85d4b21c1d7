"""The pipeline stage by stage, each on its own input, and as a whole."""

import re

import pytest
import xxhash
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stage_list():
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "simhash near-dedup", "benchmark decontamination", "packing"]


def test_filters_keep_columns_and_rows(spark, documents):
    import corpus_pipeline

    odd = documents.withColumn("fp", F.lit("?")).withColumn("kept id", F.lit(1)).withColumn("hit d", F.lit(1)).withColumn("gone lines", F.lit(1))
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, odd, SF)
        assert out.columns == odd.columns
        assert step(spark, odd.limit(0), SF).count() == 0


def test_stages_take_awkward_rows(spark, documents):
    """Null ids and texts, empty and very long texts, repeated rows, clashing names, one stage after the other."""
    import corpus_pipeline

    some = documents.limit(3)
    kinds = {f.name: f.dataType.simpleString() for f in documents.schema}
    row = lambda i, t: [i if c == "doc_id" else t if c == "text" else None for c in documents.columns]
    odd = [row(None, None), row(None, ""), row(1, None), row(1, None), row(2, ""), row(3, " \n\n"), row(4, "x" * 200_000), row(5, "word " * 50_000), row(None, "lone text of a row without id"), row(6, "é\nÉ\n\n")]
    docs = spark.createDataFrame(odd, ", ".join(f"{c} {kinds[c]}" for c in documents.columns)).unionByName(some).withColumn("own score", F.lit(1)).withColumn("TH", F.lit("?")).withColumn("node", F.lit(2))
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
            kept = {(r.doc_id, r.text) for r in out.collect()}
            assert name == "line dedup" or kept <= {(r.doc_id, r.text) for r in docs.collect()}
            assert (name == "line dedup") <= (len(out.collect()) == docs.count())
        else:
            assert sum(r.length for r in out.collect()) == sum(r.doc_tokens for r in out.where("start = 0").collect())


def test_quality_stage_is_the_classifier(spark, documents):
    import corpus_pipeline

    from tallymesh.llm.queries import op1_quality

    kept = {r.doc_id for r in corpus_pipeline.quality_classifier(spark, documents, SF).collect()}
    assert kept == {r.doc_id for r in op1_quality(spark, SF).collect() if r.predicted}


def bits(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 5]), 42) for i in range(max(1, len(w) - 4))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def alike(a, b):
    """Similarity of the sets of five-word shingles; the whole sequence where there are fewer words."""
    return len(a & b) / len(a | b) if a | b else 1.0


def shingle_set(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_near_duplicates_leave_one_of_each_group(spark, documents):
    """Against brute force: every pair of documents is compared by its shingles."""
    import corpus_pipeline

    odd = documents.unionByName(documents.where("doc_id < 20")).unionByName(documents.where("doc_id < 5").withColumn("doc_id", F.col("doc_id") + 90_000))
    rows = [(r.doc_id, shingle_set(r.text)) for r in odd.select("doc_id", "text").collect()]
    sets = list(dict.fromkeys(s for _, s in rows))
    parent = {s: s for s in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for b in sets[i + 1 :]:
            if alike(a, b) >= 0.8:
                parent[find(a)] = find(b)
    low = {}
    for d, s in rows:
        low[find(s)] = min(low.get(find(s), d), d)
    got = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, odd, SF).collect()]
    assert len(low) < len(sets) and sorted(got) == sorted(low.values())


def test_leaks_go_and_others_stay(spark, documents):
    import corpus_pipeline

    from tallymesh.llm.queries import op7_decontaminate

    hit = {r.doc_id for r in op7_decontaminate(spark, SF).collect() if r.contaminated}
    got = [r.doc_id for r in corpus_pipeline.decontamination(spark, documents, SF).collect()]
    assert hit and sorted(got) == sorted(r.doc_id for r in documents.collect() if r.doc_id not in hit)


def test_run_is_the_chain_of_stages(spark, documents, tmp_path):
    import corpus_pipeline

    docs = documents
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)  # noqa: E731  sequences depend on the partitions
    whole = corpus_pipeline.run(spark, SF).collect()
    assert {(r.doc_id, r.doc_tokens) for r in whole} == {(r.doc_id, r.doc_tokens) for r in docs.collect()}
    assert len({key(r) for r in whole}) == len(whole)


def test_near_duplicates_are_checked_by_shingles(spark):
    from tallymesh.llm.simhash import keep_one

    def share(a, b):
        a, b = (({tuple(w[i : i + 5]) for i in range(len(w) - 4)}) for w in (a.split(), b.split()))
        return len(a & b) / len(a | b)

    base = {d: [f"d{d}w{i}" for i in range(200)] for d in range(120)}
    docs = []
    for d, w in base.items():  # a run of other words at the end: similarity from 0.68 to 0.98
        n = 4 + d % 34
        docs += [(2 * d, " ".join(w)), (2 * d + 1, " ".join([*w[:-n], *(f"x{d}y{i}" for i in range(n))]))]
    want = sorted([2 * d for d in base] + [2 * d + 1 for d in base if share(docs[2 * d][1], docs[2 * d + 1][1]) < 0.8])
    far = sum((bits(docs[2 * d][1]) ^ bits(docs[2 * d + 1][1])).bit_count() > 8 and 2 * d + 1 not in want for d in base)
    close = sum((bits(docs[2 * d][1]) ^ bits(docs[2 * d + 1][1])).bit_count() <= 8 and 2 * d + 1 in want for d in base)
    assert far and close  # a radius alone misses some and takes others
    assert sorted(r.doc_id for r in keep_one(spark.createDataFrame(docs, "doc_id long, text string")).collect()) == want


def test_rows_without_id_or_of_one_id_stay(spark):
    from tallymesh.llm.simhash import keep_one

    text = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "abcdef"}
    docs = [(None, text["a"]), (None, text["b"]), (None, text["b"]), (None, text["c"]), (1, text["c"]), (2, text["d"]), (2, text["e"]), (3, text["f"]), (2, text["f"])]
    got = sorted(((r.doc_id, r.text) for r in keep_one(spark.createDataFrame(docs, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(None, text["a"]), (None, text["b"]), (1, text["c"]), (2, text["d"]), (2, text["e"]), (2, text["f"])], key=repr)
