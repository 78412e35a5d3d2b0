"""The stored ledger: parquet, one partition per year and month."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.filters import with_periods, with_rollup
from ledgerloom.schema import AMOUNT_TYPE, LEDGER_SCHEMA
from ledgerloom.sources.csv_files import ledger_columns, parse, quality, read_csv, rejects, rounded
from ledgerloom.sources.folders import short_shuffles
from ledgerloom.sources.rollup import read_rollup, write_rollup

PARTITIONS = ["year", "month"]
PERIODS = "_periods"  # readers of the ledger skip names that begin so
_BETWEEN, _MARK, _NULL = "\x01", "\x02", "\x02n"  # of texts put together
_NO_TEXT = [T.StructField(c, T.StringType()) for c in LEDGER_SCHEMA.names]


def _packed(text: Column) -> Column:
    """A text without ``_BETWEEN``, from which ``_unpacked`` makes the same text or NULL."""
    marked = F.replace(text, F.lit(_MARK), F.lit(f"{_MARK}b"))
    return F.coalesce(F.replace(marked, F.lit(_BETWEEN), F.lit(f"{_MARK}a")), F.lit(_NULL))


def _unpacked(text: Column) -> Column:
    marked = F.replace(text, F.lit(f"{_MARK}a"), F.lit(_BETWEEN))
    return F.when(text != _NULL, F.replace(marked, F.lit(f"{_MARK}b"), F.lit(_MARK)))


def by_month(ledger: DataFrame) -> DataFrame:
    """The same rows, those of a month gathered in few tasks.

    All texts of a row are shuffled as one: each by itself would bring a place, a length
    and padding, which are a quarter of what is shuffled.
    """
    names, types = ledger.columns, [f.dataType for f in ledger.schema.fields]
    texts = [i for i, kind in enumerate(types) if kind == T.StringType()]
    if not texts:
        return ledger.hint("rebalance", *PARTITIONS)
    months = [f"c{names.index(c)}" for c in PARTITIONS]
    rows = ledger.toDF(*(f"c{i}" for i in range(len(names))))
    rest = [c for i, c in enumerate(rows.columns) if i not in texts]
    together = F.concat_ws(_BETWEEN, *(_packed(F.col(f"c{i}")) for i in texts)).alias("texts")
    gathered = rows.select(*rest, together).hint("rebalance", *months)
    # A split takes texts that aren't UTF-8 for others.
    slow = (F.substring_index(F.substring_index("texts", _BETWEEN, k + 1), _BETWEEN, -1) for k in range(len(texts)))
    parts = F.when(F.is_valid_utf8("texts"), F.split("texts", _BETWEEN, -1)).otherwise(F.array(*slow))
    made = {i: _unpacked(parts[k]) for k, i in enumerate(texts)}
    return gathered.select(*(made.get(i, F.col(f"c{i}")).alias(name) for i, name in enumerate(names)))


def write_ledger(ledger: DataFrame, path: str, rows_per_file: int = 0, rollup: bool = False) -> None:
    """Store a ledger.

    The rebalance gathers each month into few files. It is a hint, so at run time
    Spark splits a month that is too big for one task (however large its part of
    the rows) and joins small ones, towards
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` per file. ``rows_per_file``
    limits the rows of a file as well; 0 sets no limit. What was shuffled, the rows in full,
    is deleted when they are written. With ``rollup`` the tables of
    ``sources.rollup`` are stored too: worth its three scans where reports are asked for
    more than a few times.
    """
    spark = ledger.sparkSession
    keys = [c for c in ("rejected", *PARTITIONS) if c in ledger.columns]
    with short_shuffles(spark):
        (
            by_month(ledger)
            .write.partitionBy(*keys)
            .option("maxRecordsPerFile", rows_per_file)
            .parquet(path)
        )
    _count_periods(spark, path).coalesce(1).write.parquet(f"{path}/{PERIODS}")
    if rollup:
        write_rollup(read_ledger(spark, path), path)


def _count_periods(spark: SparkSession, path: str) -> DataFrame:
    """(year, month, rows) of the accepted rows, from the files' metadata."""
    stored = _read(spark, path)
    if "rejected" in stored.columns:
        stored = stored.filter("rejected = 0")
    return stored.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("rows"))



def ingest(
    spark: SparkSession,
    path: str,
    *csv_paths: str,
    multi_line: bool | None = None,
    amount_type: T.DecimalType = AMOUNT_TYPE,
    rows_per_file: int = 0,
    rollup: bool = False,
) -> None:
    """CSV files to a stored ledger and its rejected rows.

    The text is read once to write the rows; see ``read_csv`` for what it reads before.
    """
    parsed = parse(read_csv(spark, *csv_paths, multi_line=multi_line), amount_type)
    bad = F.when(F.col("reject_reason") == "", 0).otherwise(1)
    write_ledger(parsed.withColumn("rejected", bad), path, rows_per_file, rollup)


def _read(spark: SparkSession, path: str) -> DataFrame:
    """A stored table with its partition columns as ints.

    Spark takes their type from folder names, which tell nothing if every year or
    month is missing; a table without rows has no file to take a schema from.
    """
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        nothing = parse(spark.createDataFrame([], T.StructType(_NO_TEXT)))
        stored = nothing.withColumn("rejected", F.lit(0))
    types = dict(stored.dtypes)
    odd = [c for c in ("rejected", *PARTITIONS) if types.get(c, "int") != "int"]
    return stored.withColumns({c: F.col(c).cast("int") for c in odd})


def read_ledger(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A stored ledger, without rejected rows, with its table of periods and, where one
    is stored, its roll-up."""
    stored = _read(spark, path)
    if "rejected" in stored.columns:
        stored = ledger_columns(stored.filter("rejected = 0"))
    if columns:
        stored = stored.select(*columns)
    periods = spark.read.schema("year int, month int, rows long").parquet(f"{path}/{PERIODS}")
    return with_rollup(with_periods(stored, periods), read_rollup(spark, path))


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return rejects(_read(spark, path).filter("rejected = 1"))


def read_rounded(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the ledger whose amount had to be rounded, with its text."""
    return rounded(_read(spark, path).filter("rejected = 0"))


def read_quality(spark: SparkSession, path: str) -> DataFrame:
    return quality(_read(spark, path))
