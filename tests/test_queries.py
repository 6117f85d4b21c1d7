"""Every query with SQL gives the rows that DuckDB gives; one whole run passes its gate."""

import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymesh import registry
from tallymesh.plans.pipeline import run_pipeline

SF = "/root/testdata/sf0.001"


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(repr(tuple(None if v is None or v != v else round(float(v), 6) if isinstance(v, (int, float, np.number)) and not isinstance(v, bool) else v for v in r)) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, duck, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), duck.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def planted(spark, n=120, g=150):
    rng = np.random.default_rng(42)
    batch, group = rng.integers(0, 2, n), rng.integers(0, 3, n)
    mu = rng.gamma(2, 1.5, (3, g))[group] + rng.normal(0, 0.3, (2, g))[batch]
    x = rng.poisson(np.maximum(mu, 0.05))
    counts = spark.createDataFrame([(i, j, float(x[i, j])) for i in range(n) for j in range(g) if x[i, j]], "cell long, gene long, n double")
    cells = spark.createDataFrame([(i, "AB"[batch[i]], f"g{group[i]}") for i in range(n)], "cell long, batch string, label string")
    return counts, cells, spark.createDataFrame([(j, f"g{j}") for j in range(g)], "gene long, name string")


def test_whole_run(spark, tmp_path):
    res = run_pipeline(spark, *planted(spark), min_genes=20, hvg_n_top_genes=80, label_key="label", champ_n_partitions=5, umap_n_epochs=30, out_path=str(tmp_path / "out"))
    m = res.route_metrics["bbknn"]
    assert m["mean"] > 0.5 and "kbet" not in m
    assert all(m[k] is not None and np.isfinite(m[k]) for k in ("ilisi", "clisi", "graph_connectivity", "label_silhouette", "batch_silhouette", "isolated_label", "sccaf"))
    assert res.tables["umap"].count() == 120 and res.gamma is not None
    assert spark.read.parquet(str(tmp_path / "out" / "graph")).where("route = 'bbknn'").count() > 0


def test_other_keys_and_flavour(spark):
    counts, cells, genes = planted(spark, 90, 80)
    cells = cells.withColumnRenamed("batch", "orig.ident").withColumn("donor", F.pmod("cell", F.lit(2)).cast("string"))
    res = run_pipeline(spark, counts, cells, genes, min_genes=10, hvg_n_top_genes=40, hvg_flavor="seurat", scale_zero_center=False, umap_init="spectral", compute_silhouette=False, champ_n_partitions=3, umap_n_epochs=5, rogue_sample_key="donor")
    assert res.tables["hvg"].count() == 40 and "dispersion" in res.tables["hvg"].columns
    assert {r.sample for r in res.tables["rogue_bbknn"].select("sample").distinct().collect()} == {"0", "1"}
    assert {r.batch for r in res.tables["batches"].collect()} == {"A", "B"}


def test_gate_pauses(spark):
    res = run_pipeline(spark, *planted(spark, 80, 60), min_genes=10, hvg_n_top_genes=40, integration="all", label_key="label", compute_silhouette=False, run_umap=False, harmony_max_iter=2)
    assert res.gate_paused and res.auto_pick in res.route_metrics and "leiden" not in res.tables
    assert res.comparison(spark).count() == 3
