"""Give Python workers this package, as ``--py-files`` would."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import stallbook


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the context once; Spark's file server hands them to the executors."""
    context = spark.sparkContext
    if getattr(context, "_stallbook_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(stallbook.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="stallbook-py-"), "stallbook.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                out.write(full, os.path.join("stallbook", os.path.relpath(full, root)))
    context.addPyFile(path)
    context._stallbook_shipped = True
