"""Sends the package to the Python workers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

import tillmark


def ship(spark: SparkSession) -> None:
    """Gives all executors this package, once per application: a query that is run from a checkout
    can't count on it being installed there. Spark's file server delivers it."""
    context = spark.sparkContext
    if getattr(context, "_tillmark_shipped", False):
        return
    folder = os.path.realpath(tempfile.mkdtemp(prefix="tillmark-package-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    parent = os.path.dirname(os.path.dirname(os.path.abspath(tillmark.__file__)))
    context.addPyFile(shutil.make_archive(f"{folder}/tillmark", "zip", parent, "tillmark"))
    context._tillmark_shipped = True
