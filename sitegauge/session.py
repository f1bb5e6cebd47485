"""Session settings the library is written for. None of them changes a result."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "sitegauge", master: str | None = None, **extra: str) -> SparkSession:
    """Session with SETTINGS; pass dotted keys in ``extra`` as ``**{"spark.x": "y"}``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SHIPPED: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Give the Python workers of this application the package, once.

    Functions that run in workers import it there, whatever the executors' own paths are.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="sitegauge-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "sitegauge.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for place, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    whole = os.path.join(place, name)
                    archive.write(whole, os.path.relpath(whole, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED[app] = path
