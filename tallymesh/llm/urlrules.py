"""URL rules as a sort-merge range join, in DataFrame operations only.

A rule ``host/path`` becomes the key ``reversed.host.labels./path``; the urls it fits are an
interval of keys. Rule intervals are nested or disjoint, so one sorted sweep with a stack of
the active rules answers every url: the sweep is a running window over keys, in which each
interval's start pushes its rule and each end pops back to the rule around it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HOST = r"(?s)^.*?://([^/?#]*)"
_PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"


def host_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """Lower-cased (A-Z) host and raw path; both empty for null or a url without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(url, _HOST, 1), _UPPER, _LOWER), F.regexp_extract(url, _PATH, 1)


def _key(labels: F.Column, path: F.Column) -> F.Column:
    return F.concat(F.array_join(labels, "."), F.lit("."), path).cast("binary")


def _events(rules: DataFrame) -> DataFrame:
    """(key, rank, top): the rule on top of the stack from this key on."""
    cut = F.instr("rule", "/")
    r = rules.where("rule is not null").groupBy("rule").agg(F.max("verdict").alias("verdict"))
    r = r.withColumn("host", F.when(cut == 0, F.col("rule")).otherwise(F.expr("substr(rule, 1, instr(rule, '/') - 1)")))
    r = r.withColumn("path", F.when(cut == 0, F.lit("")).otherwise(F.expr("substr(rule, instr(rule, '/'))")))
    r = r.withColumn("labels", F.reverse(F.split(F.translate("host", _UPPER, _LOWER), r"\.")))
    r = r.withColumn("key", _key(F.col("labels"), F.col("path"))).select("key", "rule", "verdict", F.size("labels").alias("depth"))
    r = r.groupBy("key").agg(F.max(F.struct("verdict", "rule")).alias("x"), F.max("depth").alias("depth")).select("key", "depth", F.struct("x.rule", "x.verdict").alias("top"))
    # the rule around each rule: the longest other rule whose key is a prefix of its key
    inner = r.select(F.col("key").alias("own"), F.explode(F.expr("transform(sequence(1, greatest(length(key) - 1, 1)), i -> substr(key, 1, i))")).alias("key")).where("own != key")
    around = inner.join(r, "key").groupBy("own").agg(F.max_by("top", F.length("key")).alias("below"))
    none = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    ends = r.join(around, r.key == around.own, "left").select(F.concat("key", F.lit(b"\xff")).alias("key"), F.coalesce("below", none).alias("top"))
    return r.select("key", "top").unionByName(ends)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Every row of pages (page_id, url) with host, path, rule and verdict.

    rules: (rule ``host/path``, verdict ``allow`` or ``block``). A rule fits its host and all
    subdomains if the url's path starts with the rule's; the longest rule string wins, of equal
    length the one with the longer host; of equal rules block wins; null rules are skipped. No
    rule: null and the default. Null urls and urls without ``://`` have empty host and path.
    Repeated rows are kept, null ids too; other columns of pages are ignored. Rows are dealt by
    a salt, never by host, so a hot host is spread evenly; rule events go to every salt.
    """
    spark = pages.sparkSession
    salts = 4 * partitions(spark)
    events = _events(rules)
    depth = rules.agg(F.max(F.size(F.split(F.split("rule", "/")[0], r"\.")))).first()[0] or 1
    host, path = host_path(F.col("url"))
    urls = pages.select(F.col("page_id"), host.alias("host"), path.alias("path")).withColumn("id", F.monotonically_increasing_id())
    urls = urls.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    rev = F.reverse(F.split("host", r"\."))
    probes = urls.withColumn("d", F.explode(F.sequence(F.lit(1), F.least(F.size(rev), F.lit(depth)))))
    probes = probes.select("salt", _key(F.slice(rev, F.lit(1), F.col("d")), F.col("path")).alias("key"), F.lit(1).alias("rank"), F.lit(None).cast("struct<rule:string,verdict:string>").alias("top"), "id", "page_id", "host", "path")
    starts = events.select(F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "key", F.lit(0).alias("rank"), "top")
    sweep = probes.unionByName(starts, allowMissingColumns=True)
    w = Window.partitionBy("salt").orderBy("key", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = sweep.withColumn("hit", F.last("top", ignorenulls=True).over(w)).where("rank = 1")
    best = swept.groupBy("salt", "id").agg(
        F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"),
        F.max(F.when(F.col("hit.rule").isNotNull(), F.struct(F.length("hit.rule").alias("n"), F.instr(F.concat("hit.rule", F.lit("/")), "/").alias("h"), F.col("hit.verdict").alias("verdict"), F.col("hit.rule").alias("rule")))).alias("hit"),
    )
    return best.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
