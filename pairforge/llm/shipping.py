"""Give this package to the Python workers of executors on which it is not installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package once per application; Spark's file server hands it to each executor."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix=f"{top.name}-")) / f"{top.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(top.rglob("*.py")):
            out.write(source, source.relative_to(top.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
