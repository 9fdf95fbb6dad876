"""Sessions, and what executors need from the driver."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def session(name: str = "waymark", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` keys have _ for dots."""
    build = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.ui.enabled", "false").config("spark.python.sql.dataFrameDebugging.enabled", "false")
    for key, value in conf.items():
        build = build.config(key.replace("_", "."), value)
    return build.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Give executors this package, once per application, so that Python workers can import it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_waymark_shipped", False):
        return spark
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="waymark-"), "waymark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    context._waymark_shipped = True
    return spark
