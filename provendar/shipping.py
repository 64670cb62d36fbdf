"""Makes the package importable for executors: it travels once per application as a zip through Spark's own file server."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_DONE: set[str] = set()


def ship(spark: SparkSession) -> None:
    app = spark.sparkContext.applicationId
    if app in _DONE:
        return
    root = Path(__file__).resolve().parent
    fd, path = tempfile.mkstemp(prefix="provendar-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(path)
    atexit.register(lambda: os.path.exists(path) and os.remove(path))  # executors may fetch it until the driver ends
    _DONE.add(app)
