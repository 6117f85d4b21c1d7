"""Make the package importable on every executor, wherever the driver was started."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per Spark application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    target = Path(tempfile.mkdtemp(prefix="tallymesh-src-")) / "tallymesh_src.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted([*(root / "tallymesh").rglob("*.py"), *root.glob("corpus_pipeline.py")]):
            z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
