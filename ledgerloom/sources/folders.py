"""Folders for tables that are written on the way."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_kept: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``, else
    one in the home of the session's default file system, which a cluster shares."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    hadoop = spark._jsc.hadoopConfiguration()
    system = spark._jvm.org.apache.hadoop.fs.FileSystem.get(hadoop)
    if system.getScheme() == "file":
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        return f"file:///tmp/ledgerloom-{spark.sparkContext.sparkUser()}"
    return f"{system.getHomeDirectory().toString().rstrip('/')}/.ledgerloom"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing was written to yet. All such paths of
    an application go when its driver ends."""
    app = spark.sparkContext.applicationId
    own = f"{shared_folder(spark)}/ledgerloom-{app}"
    if own not in _kept:
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _kept.add(own)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder named by ``new_folder`` that no later step reads."""
    if path.rpartition("/")[0] not in _kept:
        raise ValueError(f"not a folder of this application: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of a write made in here when it has ended, not when
    the driver next happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
