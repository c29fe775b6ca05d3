"""Sending this code to executors that do not have it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Sequence

from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.abspath(__file__))
_SENT: set[str] = set()


def ship(spark: SparkSession, folders: Sequence[str] = (HERE,)) -> None:
    """Zip the given packages and hand them to the session's Python workers, once per application.

    Not needed where the package is installed on all nodes, harmless there.
    """
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="seriesmill-code-"), "seriesmill_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder in folders:
            root = os.path.dirname(os.path.abspath(folder))
            for at, _, names in os.walk(folder):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(at, name)
                        out.write(full, os.path.relpath(full, root))
    context.addPyFile(path)  # served to executors by the driver
    _SENT.add(context.applicationId)
