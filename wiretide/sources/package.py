"""The library itself, where it is not installed on the executors."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application.

    Needed where it is not installed on them and a task runs a function of its modules.
    """
    context = spark.sparkContext
    if getattr(context, "_wiretide_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    # The driver's file server hands the archive out, so the folder may be the driver's own.
    target = tempfile.mkdtemp(prefix="wiretide-package-")
    context.addPyFile(shutil.make_archive(f"{target}/{package.name}", "zip", package.parent, package.name))
    context._wiretide_shipped = True
