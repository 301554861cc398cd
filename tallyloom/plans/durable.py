"""Where intermediate tables are written so that they outlive the executor that made them."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="tallyloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, read from ``spark.checkpoint.dir``.

    Only a local-mode session without the setting (as in tests) falls back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the application's part of the shared folder."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tallyloom-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Remove all tables that this application has stored; frames that were built on them can no longer be read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back, which cuts its lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[stored] = path
    return stored


# Where the frames that ``written`` returned are stored.
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def discard(stored: DataFrame) -> None:
    """Remove a table of ``written`` that nothing reads any more, as when its successor is stored."""
    spark, path = stored.sparkSession, _PATHS.pop(stored)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
