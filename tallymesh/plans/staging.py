"""Staged tables and connected components: how iterative jobs cut lineage.

Every table that cuts lineage is written to the folder that the session names in
``spark.checkpoint.dir``, which driver and executors share; a lost executor therefore
never takes staged rows with it.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_staged: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder; a temporary one only where none is set and the master is local."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tallymesh-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def stage(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write df to the shared folder and read it back: later steps restart from the files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tallymesh-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", codec).parquet(path)
    _staged.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete a staged table that no later step reads."""
    for path in df.inputFiles()[:1]:
        _delete(df.sparkSession, path.rsplit("/", 1)[0])


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for spark, path in _staged:
        try:
            _delete(spark, path)
        except Exception:  # the session may be gone already; nothing is left to do then
            return


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(node, root) for every node of the edge table (u, v): root is the smallest node reachable.

    Alternating large-star and small-star rounds: every round is joins and partial minima, so
    a node with very many neighbours is never gathered; each round is staged. Self loops and
    nulls are ignored; an empty table gives no rows.
    """
    e = edges.where("u is not null and v is not null and u != v").select(F.greatest("u", "v").alias("n"), F.least("u", "v").alias("m")).distinct()
    e, mark = stage(e, name), None
    while True:
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("n", "m"))).first()
        if now == mark or not now[0]:
            return e.select(F.col("n").alias("node"), F.col("m").alias("root")).unionByName(e.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct())
        mark = now
        both = e.unionByName(e.select(F.col("m").alias("n"), F.col("n").alias("m")))
        low = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("r"))
        large = both.join(low, "n").where("m > n").select(F.col("m").alias("n"), F.col("r").alias("m")).distinct()
        low = large.groupBy("n").agg(F.min("m").alias("r"))
        pairs = large.join(low, "n")
        small = pairs.where("m != r").select(F.col("m").alias("n"), F.col("r").alias("m")).unionByName(low.select("n", F.col("r").alias("m"))).distinct()
        e, old = stage(small, name), e
        unstage(old)
