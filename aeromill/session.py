"""Session helpers."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])


def let_workers_import(spark: SparkSession) -> None:
    """Put this library's folder on the path of Python workers started from now on.

    Enough where executors see the folder (local mode, a shared file system); elsewhere ship the
    library with ``--py-files``.
    """
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])
