"""Makes this package importable in the Python workers of a session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors the package's source, once per application.

    Spark serves the archive from the driver, as with ``--py-files``; executors
    need no folder of ours.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    archive = Path(tempfile.mkdtemp()) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, str(file.relative_to(PACKAGE.parent)))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
