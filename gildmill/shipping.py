"""Send this package to the executors of a session, as ``--py-files`` would."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Make functions of this package importable in Python workers; once per session."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(
            str(Path(tempfile.mkdtemp(prefix="gildmill-ship-")) / package.name),
            "zip",
            root_dir=package.parent,
            base_dir=package.name,
        )
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark
