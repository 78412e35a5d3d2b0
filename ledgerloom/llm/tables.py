"""Tables between steps, and small checks the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import new_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCHES = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "2m",  # else 10,000 texts at once
    "spark.sql.parquet.columnarReaderBatchSize": "256",
}


def small_batches(spark: SparkSession) -> None:
    """From now on the session's rows go to Python and come out of parquet files a few MB
    at a time, however long their texts are. What the session itself has set stays."""
    for key, value in _BATCHES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps don't run it
    again, and a lost executor takes nothing along. Spark deletes the shuffle files of the
    write when it has ended."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    found = spark.read.schema(df.schema).parquet(path)
    found.stored_at = path
    return found


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that ``stored`` wrote and that no later step reads."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def place(df: DataFrame, name: str) -> str:
    """The column of ``by_place`` that has exactly this name; it must be there once."""
    found = [i for i, c in enumerate(df.columns) if c == name]
    if len(found) != 1:
        raise ValueError(f"one column {name!r} is needed, the table has {df.columns}")
    return f"c{found[0]}"


def by_place(df: DataFrame) -> DataFrame:
    """The columns as c0, c1, ...: names that clash, also but for case, do no harm."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def chosen(df: DataFrame, **types: str) -> DataFrame:
    """The columns of these names, cast, whatever other columns there are."""
    plain = by_place(df)
    return plain.select(
        *(plain[place(df, name)].cast(kind).alias(name) for name, kind in types.items())
    )


def documents(df: DataFrame, **more: str) -> DataFrame:
    """doc_id, text (null: empty) and the further columns named, with their types."""
    found = chosen(df, doc_id="long", text="string", **more)
    return found.withColumn("text", F.coalesce("text", F.lit("")))


def in_fold(doc_id):
    """True for the fifth of the documents that is held out of learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def slices(batch: pa.RecordBatch, name: str = "text", most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``most`` bytes of text together; a longer text comes alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_pylist()
    at, held = 0, 0
    for i, size in enumerate(sizes):
        if i > at and held + size > most:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += size
    if at < batch.num_rows:
        yield batch.slice(at)
    pa.default_memory_pool().release_unused()  # between batches, for the other tasks
