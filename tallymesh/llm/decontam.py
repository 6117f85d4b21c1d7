"""Benchmark decontamination by winnowing, in DataFrame operations only.

Both sides keep the minimum k-gram hash of every sliding window of k-grams. With k-grams of
K words and minima over ``window - K + 1`` of them, any shared span of ``window`` words shares
a kept hash, so joining kept hashes finds every document that can hold a benchmark window;
hits are then extended to exact windows, compared as strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

K = 7
BROADCAST_ROWS = 500_000  # fingerprints or windows of the benchmark that may be broadcast (under 64 MB)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: F.Column) -> F.Column:
    """Words of A-Z lower-cased text: runs of ASCII letters, digits and all beyond ASCII."""
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), _BREAK), "")


def _pairs(a: F.Column, n: F.Column, shift: int, f) -> F.Column:
    """f of each value and the one ``shift`` after it; n: length of a, or less than 0."""
    left = F.greatest(n - shift, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), left), F.slice(a, F.lit(1 + shift), left), f)


def _kept(df: DataFrame, window: int) -> DataFrame:
    """df with column ``fps``: the kept hashes of ``words``, none for fewer than ``window`` words.

    Explode it with explode_outer: for explode, Spark infers a filter on its size, which it
    pushes down through all steps and so spells out every step twice over and over.
    """
    k = min(K, window)
    df = df.withColumn("a", F.transform("words", lambda w: F.xxhash64(w)))
    n, have = F.size("words"), 1
    while have < k:
        step = min(have, k - have)
        df = df.withColumn("a", _pairs(F.col("a"), n - (have - 1), step, lambda x, y: F.xxhash64(x, y)))
        have += step
    wide, have = window - k + 1, 1
    while have < wide:
        step = min(have, wide - have)
        df = df.withColumn("a", _pairs(F.col("a"), n - (k - 1) - (have - 1), step, lambda x, y: F.least(x, y)))
        have += step
    return df.withColumn("fps", F.array_distinct("a")).drop("a")


def _windows(n: int) -> F.Column:
    """All windows of n words of column ``words``, each as one string."""
    return F.transform(F.sequence(F.lit(1), F.size("words") - n + 1), lambda i: F.array_join(F.slice("words", i, F.lit(n)), " "))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _probe(df: DataFrame, window: int, short: list[int]) -> DataFrame:
    """(…, fp): hashes under which rows of df (with ``words``) may meet the benchmark."""
    out = _kept(df, window).withColumn("fp", F.explode_outer("fps")).drop("fps", "words")
    for n in short:
        hashes = F.array_distinct(F.transform(_windows(n), lambda s: F.xxhash64(s)))
        out = out.unionByName(df.where(F.size("words") >= n).withColumn("fp", F.explode_outer(hashes)).drop("words"))
    return out


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("th", F.xxhash64("text"))


def _hits(base: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """(doc_id, th, pos, n, item_id): every occurrence of a benchmark window, staged."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = items.withColumn("n", F.least(F.size("words"), F.lit(window)))
    short = sorted(r[0] for r in items.where(F.col("n") < window).select("n").distinct().collect())  # window - 1 values at most
    item_windows = items.select("item_id", F.explode_outer(F.transform(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1), lambda i: F.array_join(F.slice("words", i, F.col("n")), " "))).alias("win"), "n").distinct()
    item_windows = stage(item_windows, "item_windows")
    long_fps = _kept(items.where(F.col("n") == window), window).select(F.explode_outer("fps").alias("fp")).where("fp is not null")
    short_fps = items.where(F.col("n") < window).select(F.xxhash64(F.array_join("words", " ")).alias("fp"))
    item_fps = stage(long_fps.unionByName(short_fps).distinct(), "item_fps")
    n_fps, n_windows = item_fps.count(), item_windows.count()

    docs = base.withColumn("words", words(F.col("text")))
    if n_fps <= BROADCAST_ROWS:
        met = _probe(docs, window, short).join(F.broadcast(item_fps), "fp", "left_semi")
        cand = met.groupBy("doc_id", "th").agg(F.first("text").alias("text"))
    else:
        keys = _probe(docs.drop("text"), window, short).join(item_fps, "fp", "left_semi").select(F.col("doc_id").alias("d"), F.col("th").alias("t")).distinct()
        cand = base.join(keys, base.doc_id.eqNullSafe(keys.d) & (base.th == keys.t), "left_semi").dropDuplicates(["doc_id", "th"])
    cand = cand.select("doc_id", "th", words(F.col("text")).alias("words"))

    spots = None
    for n in [*short, window]:
        at = cand.where(F.size("words") >= n).select("doc_id", "th", F.posexplode_outer(_windows(n)).alias("pos", "win"), F.lit(n).alias("n"))
        spots = at if spots is None else spots.unionByName(at)
    hits = spots.join(_small(item_windows.drop("n"), n_windows), "win")
    return stage(hits.select("doc_id", "th", "pos", "n", "item_id").distinct(), "hits")


def find_leaks(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per row of documents (doc_id, text): which words lie in windows of benchmark (item_id, text).

    Returns doc_id, n_words, n_hit, n_items, items_sha256, contaminated. A window is ``window``
    consecutive words of an item; an item of fewer words, but not none, is one window. Null and
    empty texts have no words. Rows with the same item_id are one item; items without id mark
    words but are not counted. Repeated documents get equal rows, null ids are kept, an empty
    benchmark hits nothing. Other columns of either table are ignored.
    """
    base = _keyed(documents)
    hits = _hits(base, benchmark, window)
    covered = hits.select("doc_id", "th", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("n") - 1)).alias("at")).distinct().groupBy("doc_id", "th").agg(F.count("*").alias("n_hit"))
    named = hits.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    found = covered.join(named, covered.doc_id.eqNullSafe(named.doc_id) & (covered.th == named.th)).select(covered.doc_id.alias("d"), covered.th.alias("t"), "n_hit", "items")
    sizes = base.select("doc_id", "th", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    out = sizes.join(found, sizes.doc_id.eqNullSafe(found.d) & (sizes.th == found.t), "left")
    named_items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(named_items).cast("long").alias("n_items"),
        F.sha2(F.array_join(named_items, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_leaks(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of documents that hold no benchmark window, with their columns as they were."""
    found = _hits(_keyed(documents), benchmark, window).select(F.col("doc_id").alias("hit d"), F.col("th").alias("hit t")).distinct()
    same = documents["doc_id"].cast("long").eqNullSafe(found["hit d"]) & (F.xxhash64(documents["text"].cast("string")) == found["hit t"])
    return documents.join(found, same, "left_anti")
