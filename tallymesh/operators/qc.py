"""Quality control and expression algebra on long count tables (cell, gene, n)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def library_size(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """(cell, lib) for every cell, 0 where it has no counts."""
    lib = counts.groupBy("cell").agg(F.sum("n").alias("lib"))
    return cells.select("cell").join(lib, "cell", "left").select("cell", F.coalesce("lib", F.lit(0.0)).alias("lib"))


def genes_per_cell(counts: DataFrame) -> DataFrame:
    return counts.where("n > 0").groupBy("cell").agg(F.count("*").alias("n_genes"))


def cells_per_gene(counts: DataFrame) -> DataFrame:
    return counts.where("n > 0").groupBy("gene").agg(F.count("*").alias("n_cells"))


def mt_fraction(counts: DataFrame, cells: DataFrame, genes: DataFrame) -> DataFrame:
    """(cell, pct_mt): per cent of a cell's counts in marked genes; an empty library counts as 1."""
    marked = counts.join(genes.select("gene", "is_mt"), "gene")
    per = marked.groupBy("cell").agg(F.sum("n").alias("lib"), F.sum(F.when(F.col("is_mt"), F.col("n")).otherwise(0.0)).alias("mt"))
    lib = F.coalesce("lib", F.lit(0.0))
    return cells.select("cell").join(per, "cell", "left").select("cell", (100 * F.coalesce("mt", F.lit(0.0)) / F.when(lib == 0, 1.0).otherwise(lib)).alias("pct_mt"))


def qc_filter(counts: DataFrame, cells: DataFrame, genes: DataFrame, min_cells: int = 3, min_genes: int = 200, max_pct_mt: float = 20.0) -> DataFrame:
    """Counts of kept cells and genes. Both masks are taken on the unfiltered matrix.

    The marked share only counts if 0 < max_pct_mt < 100 and there is a marked gene.
    """
    keep_gene = cells_per_gene(counts).where(F.col("n_cells") >= min_cells).select("gene")
    keep_cell = genes_per_cell(counts).where(F.col("n_genes") >= min_genes).select("cell")
    if 0 < max_pct_mt < 100 and genes.where("is_mt").limit(1).count():
        keep_cell = keep_cell.join(mt_fraction(counts, cells, genes).where(F.col("pct_mt") <= max_pct_mt), "cell", "left_semi")
    return counts.join(keep_cell, "cell", "left_semi").join(keep_gene, "gene", "left_semi").select("cell", "gene", "n")


def matrix_filter(counts: DataFrame, min_cells: int, min_genes: int) -> DataFrame:
    """Genes on at least min_cells cells, then cells with at least min_genes of those genes."""
    g = counts.join(cells_per_gene(counts).where(F.col("n_cells") >= min_cells), "gene", "left_semi")
    return g.join(genes_per_cell(g).where(F.col("n_genes") >= min_genes), "cell", "left_semi").select("cell", "gene", "n")


def lognorm(counts: DataFrame, target_sum: float = 1e4) -> DataFrame:
    """(cell, gene, value): log1p of counts scaled to a common library size."""
    lib = F.sum("n").over(Window.partitionBy("cell"))
    return counts.select("cell", "gene", F.log1p(F.col("n") * target_sum / F.when(lib == 0, 1.0).otherwise(lib)).alias("value"))


def gene_stats(values: DataFrame, n_cells: int) -> DataFrame:
    """(gene, mean, sd): over all cells, absent entries as zeros; sd 0 becomes 1."""
    s = values.groupBy("gene").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"))
    mean = F.col("s") / n_cells
    var = F.greatest(F.col("q") - F.col("s") * mean, F.lit(0.0)) / max(n_cells - 1, 1)
    return s.select("gene", mean.alias("mean"), F.when(var > 1e-24, F.sqrt(var)).otherwise(1.0).alias("sd"))


def scale(values: DataFrame, n_cells: int, max_value: float | None = 10.0, zero_center: bool = True) -> DataFrame:
    """(cell, gene, z, z_zero): clipped z-score of each stored entry and of its gene's zeros.

    Zeros are never spelled out: their score is one number per gene.
    """
    both = values.join(gene_stats(values, n_cells), "gene")
    shift = F.col("mean") if zero_center else F.lit(0.0)
    z, zero = (F.col("value") - shift) / F.col("sd"), -shift / F.col("sd")
    if max_value is not None:
        z, zero = (F.least(F.greatest(x, F.lit(-max_value)), F.lit(max_value)) for x in (z, zero))
    return both.select("cell", "gene", z.alias("z"), zero.alias("z_zero"))


def batch_census(cells: DataFrame) -> DataFrame:
    return cells.groupBy(F.col("batch").cast("string").alias("batch")).agg(F.count("*").alias("n_cells"))


def label_codes(cells: DataFrame, column: str = "label") -> DataFrame:
    """(cell, label, code): labels as strings and their dense rank from 0.

    Only the distinct labels are ranked in one task; they are few beside the cells.
    """
    text = F.col(column).cast("string").alias("label")
    codes = cells.select(text).distinct().withColumn("code", F.dense_rank().over(Window.orderBy("label")) - 1)
    return cells.select("cell", text).join(codes, "label").select("cell", "label", "code")


def stratified_sample(cells: DataFrame, n: int) -> DataFrame:
    """At most n cells of each label, those of least md5 of their id."""
    w = Window.partitionBy("label").orderBy(F.md5(F.col("cell").cast("string")), "cell")
    return cells.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n).drop("r")


def entropy_table(counts: DataFrame, n_cells: int, r: float = 1.0) -> DataFrame:
    """(gene, mean_expr, entropy): log of the mean count plus r, mean of log1p, over all cells."""
    return counts.groupBy("gene").agg(F.log(F.sum("n") / n_cells + r).alias("mean_expr"), (F.sum(F.log1p("n")) / n_cells).alias("entropy"))


def trimmed_means(counts: DataFrame, n_cells: int, drop: int = 2, r: float = 1.0) -> DataFrame:
    """The entropy table without each gene's ``drop`` largest cells; zeros count as cells."""
    w = Window.partitionBy("gene").orderBy(F.desc("n"), "cell")
    kept = counts.withColumn("k", F.row_number().over(w)).withColumn("m", F.when(F.col("k") > drop, F.col("n")).otherwise(0.0))
    left = n_cells - drop
    return kept.groupBy("gene").agg(F.log(F.sum("m") / left + r).alias("mean_expr"), (F.sum(F.log1p("m")) / left).alias("entropy"))
