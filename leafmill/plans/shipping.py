"""Make the package importable where Python workers run."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

import leafmill

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = os.path.dirname(os.path.dirname(os.path.abspath(leafmill.__file__)))
    # the driver serves the archive from where it lies, for as long as it runs
    folder = tempfile.mkdtemp(prefix="leafmill-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/leafmill", "zip", root, "leafmill"))
