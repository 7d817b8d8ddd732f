"""Where Python workers find this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def reach(spark: SparkSession) -> None:
    """Let workers started from here on import the package from its folder.

    A program that was started elsewhere may have it on its own path only. On a cluster the
    package is installed, or shipped with ``--py-files``, and this changes nothing.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
