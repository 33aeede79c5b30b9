"""The package on the executors: their Python workers run its functions, so they must have it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's sources to the executors of this session, once.

    The archive lies where the driver runs, which serves it; no executor reads that folder.
    """
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="haulback-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SENT.add(context.applicationId)
