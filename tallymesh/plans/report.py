"""The tables behind the comparison plots; drawing them is left to the reader's tools."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.metrics import category_scores, comparison_table
from .pipeline import METRICS, Result

HIGH, FAIR = 0.85, 0.70  # bands of purity


def purity_bands(scores: DataFrame, head: int | None = None, tail: int | None = None) -> DataFrame:
    """(route, cluster, score, band, rank): clusters by mean purity, best first.

    head, tail: only so many of the best and of the worst clusters of each route.
    """
    per = scores.groupBy("route", "cluster").agg(F.avg("score").alias("score")).where("score is not null")
    band = F.when(F.col("score") >= HIGH, "high").when(F.col("score") >= FAIR, "fair").otherwise("low")
    up, down = Window.partitionBy("route").orderBy(F.desc("score"), "cluster"), Window.partitionBy("route").orderBy("score", F.desc("cluster"))
    out = per.select("route", "cluster", "score", band.alias("band"), F.row_number().over(up).alias("rank"), F.row_number().over(down).alias("back"))
    if head is not None or tail is not None:
        out = out.where((F.col("rank") <= (head or 0)) | (F.col("back") <= (tail or 0)))
    return out.drop("back")


def score_table(metrics: DataFrame) -> DataFrame:
    """One row per route: every metric, the category scores and the overall score."""
    return comparison_table(metrics, METRICS).join(category_scores(metrics), "route")


def layout_table(res: Result, color: str = "batch") -> DataFrame:
    """(route, cell, x, y, color): the layout with a column of cells, or the clusters."""
    xy = res.tables["umap"]
    if color == "cluster":
        return xy.join(res.tables["leiden"].withColumnRenamed("cluster", "color"), ["route", "cell"])
    return xy.join(res.tables["cells"].select("cell", F.col(color).alias("color")), "cell")


def picker_layout(layout: DataFrame, pickers: dict[str, DataFrame]) -> DataFrame:
    """(route, picker, cell, x, y, cluster, k): the layout (route, cell, x, y) beside the clusters (route, cell, cluster) of several pickers.

    k: clusters of the route under that picker. Routes that not every picker has are left out.
    """
    both = reduce(DataFrame.unionByName, [c.select("route", "cell", F.col("cluster").cast("string").alias("cluster"), F.lit(name).alias("picker")) for name, c in pickers.items()])
    k = both.groupBy("route", "picker").agg(F.countDistinct("cluster").alias("k"))
    full = k.groupBy("route").agg(F.count("*").alias("n")).where(F.col("n") == len(pickers)).select("route")
    return layout.join(full, "route").join(both, ["route", "cell"]).join(k, ["route", "picker"]).select("route", "picker", "cell", "x", "y", "cluster", "k")


def landscape(res: Result) -> DataFrame:
    """(route, gamma, a, b, on_hull, lo, hi, width, picked) of the resolution choice."""
    return res.tables["champ"].orderBy("route", "b")


def all_tables(res: Result, spark) -> dict[str, DataFrame]:
    """Every table that the artifacts at hand allow."""
    out: dict[str, DataFrame] = {}
    if res.route_metrics:
        out["scores"] = score_table(res.metrics_table(spark))
    purity = [df for name, df in res.tables.items() if name.startswith("rogue_")]
    if purity:
        out["purity"] = purity_bands(reduce(DataFrame.unionByName, purity))
    if "umap" in res.tables:
        out["layout"] = layout_table(res)
        if "leiden" in res.tables:
            out["clusters"] = layout_table(res, "cluster")
    if "champ" in res.tables:
        out["landscape"] = landscape(res)
    return out
