"""Tables written once per Spark application and read by every query after.

They go to a folder that all executors share, so a lost executor takes none of them
along; see ``folders``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import Any, TypeVar

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.schema import LEDGER_SCHEMA
from ledgerloom.sources import order_tables
from ledgerloom.sources.folders import new_folder
from ledgerloom.sources.rollup import write_rollup
from ledgerloom.sources.store import read_ledger, write_ledger

_INPUTS = ["lineitem", "orders", "customer", "nation", "region"]
T = TypeVar("T")
_built: dict[tuple[str, str, str], Any] = {}


def _fingerprint(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of the input files: changed data is read again."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    seen = hashlib.sha256()
    for name in _INPUTS:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
        files, told = path.getFileSystem(hadoop).listFiles(path, True), []
        while files.hasNext():  # all levels, for partitioned tables
            f = files.next()
            told.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}\n")
        seen.update("".join(sorted(told)).encode())
    return seen.hexdigest()


def once(spark: SparkSession, folder: str, name: str, build: Callable[[], T]) -> T:
    """What ``build`` gives, made once per application and state of the order tables."""
    key = (spark.sparkContext.applicationId, _fingerprint(spark, folder), name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def ledger(spark: SparkSession, folder: str, rollup: bool = True) -> DataFrame:
    """The ledger of a folder of order tables, stored on first use. Its roll-up, which
    takes three scans, is stored on the first use that doesn't leave it out."""
    path = once(spark, folder, "ledger path", lambda: _store(spark, folder))
    if not rollup:
        return once(spark, folder, "ledger rows", lambda: read_ledger(spark, path, LEDGER_SCHEMA.names))
    return once(spark, folder, "ledger", lambda: _with_rollup(spark, path))


def _store(spark: SparkSession, folder: str) -> str:
    path = new_folder(spark, "properties")
    order_tables.properties(spark, folder).write.parquet(path)
    properties = spark.read.parquet(path)
    path = new_folder(spark, "ledger")
    write_ledger(order_tables.postings(spark, folder, properties), path)
    return path


def _with_rollup(spark: SparkSession, path: str) -> DataFrame:
    write_rollup(read_ledger(spark, path), path)
    return read_ledger(spark, path, LEDGER_SCHEMA.names)
