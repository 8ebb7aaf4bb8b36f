"""Send this package to the executors, for clusters on which it isn't installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's modules to the session's Python files, once for each Spark context."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="mendflow-ship-"), "mendflow.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    sc.addPyFile(str(archive))
