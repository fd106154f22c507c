"""Helpers that the corpus operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null document id inside join keys; results carry the original null.
NULL_ID = -(2**63)

#: The temporary folder of local sessions without one, once it is made.
_OWN: list[str] = []

#: Tables that ``materialise`` has written, by application, until ``release`` deletes them.
_WRITTEN: dict[str, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only in unset local sessions."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="aeromill-"))
        atexit.register(shutil.rmtree, _OWN[0], True)
    return _OWN[0]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage: a lost executor costs a re-read of files, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    written(spark).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(spark: SparkSession) -> list[str]:
    """Paths of the tables that the application has written and not released, oldest first."""
    return _WRITTEN.setdefault(spark.sparkContext.applicationId, [])


def release(spark: SparkSession, since: int = 0) -> int:
    """Delete the tables written since there were ``since``; for when no result that reads them is needed any more."""
    paths = written(spark)
    jvm, n = spark._jvm, len(paths) - since
    while len(paths) > since:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def stored(step: Callable[[], DataFrame], spark: SparkSession, name: str) -> DataFrame:
    """``step()``, written; the tables that it wrote on the way are deleted."""
    before = len(written(spark))
    out = materialise(step(), name)
    own = written(spark).pop()
    release(spark, before)
    written(spark).append(own)
    return out


def id_key(column: str) -> Column:
    """The id as a join key that also matches null with null."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))
