"""Sources and sinks: matrices, annotations and graphs are long tables in Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cell, gene, n): what each customer ordered of each part."""
    items = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    both = items.join(orders, items.l_orderkey == orders.o_orderkey)
    return both.groupBy(F.col("o_custkey").alias("cell"), F.col("l_partkey").alias("gene")).agg(F.sum("l_quantity").alias("n"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cell, batch, label): every customer with its market segment and region."""
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    c = read(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select(F.col("c_custkey").alias("cell"), F.col("c_mktsegment").alias("batch"), F.col("n_regionkey").alias("label"))


def genes(spark: SparkSession, sf_dir: str, prefix: str = "blue") -> DataFrame:
    """(gene, name, is_mt): every part; is_mt: its name starts with the prefix, case ignored."""
    p = read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("gene"), F.col("p_name").alias("name"), F.upper("p_name").startswith(prefix.upper()).alias("is_mt"))


def points(spark: SparkSession, sf_dir: str, batches: int = 3) -> DataFrame:
    """(cell, vec, batch, label): every embedding in double precision."""
    e = read(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("cell"), F.col("embedding").cast("array<double>").alias("vec"), F.pmod("vec_id", F.lit(batches)).cast("int").alias("batch"), F.col("label").cast("int").alias("label"))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cell, gene, n, batch, label): words of every document, by source and language."""
    d = read(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.explode(F.split(F.lower("text"), r"\s+")).alias("gene")).where("gene != ''")
    return d.groupBy(F.col("doc_id").alias("cell"), "gene", F.col("source").alias("batch"), F.col("lang").alias("label")).agg(F.count("*").cast("double").alias("n"))


def read_mtx(spark: SparkSession, path: str) -> DataFrame:
    """(cell, gene, n) of a MatrixMarket coordinate file of genes by cells, ids from 0."""
    lines = spark.read.text(path).where(~F.col("value").startswith("%"))
    part = F.split(F.trim("value"), r"\s+")
    rows = lines.select(part[0].cast("long").alias("g"), part[1].cast("long").alias("c"), part[2].cast("double").alias("n"), F.monotonically_increasing_id().alias("at"))
    first = rows.agg(F.min("at")).first()[0]  # the line of sizes
    return rows.where(F.col("at") != first).select((F.col("c") - 1).alias("cell"), (F.col("g") - 1).alias("gene"), "n")


def write_artifact(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """An artifact as Parquet, split by route where it has one."""
    out = df.write.mode(mode)
    (out.partitionBy("route") if "route" in df.columns else out).parquet(path)


def read_artifact(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
