"""Sends this package to the executors, which may not have it on their path."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application: the package's sources as a zip file for Python workers."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="voxelweave-")) / "voxelweave.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    context.addPyFile(str(target))
    _sent.add(context.applicationId)
