"""Reading ledger CSV files and writing CSV results.

CSV files are read as text columns by header name; ``parse`` turns them into the
typed ledger and says, row by row, why a row can't be used.
"""

from __future__ import annotations

import csv
import io
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.names import quoted
from ledgerloom.schema import AMOUNT_TYPE, NULL_TOKENS, SOURCE_COLUMNS, TEXT_COLUMNS
from ledgerloom.sources import csv_records
from ledgerloom.sources.folders import new_folder

_GROUPED = r"^\s*[+-]?\d{1,3}(,\d{3})+(\.\d*)?([eE][+-]?\d{1,3})?\s*$"
_PARTS_OF_NUMBER = r"^\s*[+-]?(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?\s*$"
_CORRUPT = "_corrupt_line"
_TOO_LONG = "_too_long"
_CHECKS = ["over_precise", "reject_reason"]
_TEXTS = ["year_text", "month_text", "amount_text"]


def _reader(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("multiLine", multi_line)
        # The header of every file must be the one the columns are taken from.
        .option("enforceSchema", False)
    )


def _too_long(record: Column, columns: Column) -> Column:
    """Spark drops surplus fields; count them so that such rows can be rejected."""
    plain = F.regexp_replace(record, csv_records.QUOTED_FIELD, "")
    commas = F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit("")))
    return F.coalesce(commas >= columns, F.lit(False))


def _read(spark: SparkSession, paths: list[str], multi_line: bool) -> DataFrame:
    names = _reader(spark, multi_line).csv(paths).columns
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])
    reader = _reader(spark, multi_line).option("columnNameOfCorruptRecord", _CORRUPT)
    rows = reader.schema(text).csv(paths)
    return rows.withColumn(_TOO_LONG, _too_long(F.col(_CORRUPT), F.lit(len(names)))).drop(_CORRUPT)


def _names(header: str) -> list[str]:
    """Column names of a header record. Blank ones are named by their place, and one that
    differs from an earlier one by nothing but case gets a number, as in Spark."""
    found: list[str] = []
    for i, name in enumerate(next(csv.reader(io.StringIO(header.lstrip("\ufeff"), newline="")))):
        name = name or f"_c{i}"
        taken = [c.lower() for c in found]
        number, plain = 2, name
        while name.lower() in taken:
            name, number = f"{plain}_{number}", number + 1
        found.append(name)
    return found


def _whole_headers(spark: SparkSession, found: DataFrame, buckets: DataFrame, heads: DataFrame) -> DataFrame:
    """Headers that hold line breaks, put together: the first records of their files."""
    some = heads.where("open").select("file", "path", "pos")
    first = buckets.where("block = 0").join(some.select("file"), "file", "left_semi")
    return (
        csv_records.records(found, first.where("broken"))
        .join(some, ["file", "pos"])
        .where("block = 0")
        .select("file", "path", "pos", F.col("record").alias("text"))
    )


def _read_split(spark: SparkSession, path: str) -> DataFrame:
    """All records of the path's files as text columns, by many tasks."""
    found = csv_records.lines(spark, [path])
    folder = new_folder(spark, "csv-buckets")
    csv_records.summary(found).write.parquet(folder)
    buckets = spark.read.parquet(folder)
    heads = csv_records.heads(buckets)
    told = heads.groupBy("text", "open").agg(F.sum("broken").alias("broken")).collect()
    headers = heads.where("NOT open").select("file", "path", "pos", "text")
    layouts = sorted(r.text for r in told if not r.open)
    if any(r.open for r in told):
        more = _whole_headers(spark, found, buckets, heads)
        layouts = sorted({*layouts, *(r.text for r in more.select("text").distinct().collect())})
        headers = headers.union(more)
    names = {text: _names(text) for text in layouts}
    every = list(dict.fromkeys(n for own in names.values() for n in own))
    spread = {c.lower(): c for c in every}
    if len(spread) < len(every):  # names of other files that differ by case are the same
        names = {text: [spread[n.lower()] for n in own] for text, own in names.items()}
        every = list(dict.fromkeys(n for own in names.values() for n in own))
    width = max(map(len, names.values()), default=0)

    layout, columns = F.lit(None).cast("int"), F.lit(None).cast("int")
    for i, text in enumerate(layouts):
        layout = F.when(F.col("text") == text, F.lit(i)).otherwise(layout)
        columns = F.when(F.col("text") == text, F.lit(len(names[text]))).otherwise(columns)
    of_file = headers.select(
        F.col("file").alias("of"), F.col("pos").alias("header_pos"), layout.alias("layout"), columns.alias("columns")
    )
    # The driver lists all files anyway; this is a short row for each. A join by file would
    # shuffle all text, and a large file into one place.
    rows = (
        csv_records.records(found, buckets, sum(r.broken for r in told))
        .where(F.col("record").rlike(r"\S"))
        .join(F.broadcast(of_file), F.col("file") == F.col("of"))
        .where("NOT (block = 0 AND pos = header_pos)")
    )
    schema = ", ".join([*(f"c{i} string" for i in range(width)), f"{_CORRUPT} string"])
    options = {"escape": '"', "columnNameOfCorruptRecord": _CORRUPT}
    # As in _made_once: Spark puts a plain from_csv in the place of every column taken from it.
    parsed = rows.select("layout", "columns", F.inline(F.array(F.from_csv("record", schema, options))))

    def value(name: str) -> Column:
        places = {i: own.index(name) for i, own in enumerate(names.values()) if name in own}
        if len(set(places.values())) == 1 and len(places) == len(layouts):
            return F.col(f"c{next(iter(places.values()))}")
        chosen = F.lit(None).cast("string")
        for i, at in places.items():
            chosen = F.when(F.col("layout") == i, F.col(f"c{at}")).otherwise(chosen)
        return chosen

    return parsed.select(
        *(value(name).alias(name) for name in every), _too_long(F.col(_CORRUPT), F.col("columns")).alias(_TOO_LONG)
    )


def read_csv(spark: SparkSession, *paths: str, multi_line: bool | None = None) -> DataFrame:
    """CSV files as text columns, put together by their headers' names.

    The files of a path may have other columns, or the same in another order. All files
    are read by many tasks, whatever line breaks and stray quotes they hold: one pass
    over the text finds the states of its lines while this is called, and one or two
    read it when the result is used (two if a field holds a line break).
    ``multi_line`` skips the first pass for files of one header: False if no field holds
    a line break, True to let Spark read every file whole, in one task.
    """
    if multi_line is None:
        parts = [_read_split(spark, path) for path in paths]
    else:
        parts = [_read(spark, [path], multi_line) for path in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _made_once(df: DataFrame) -> DataFrame:
    """The same rows, each column made once a row, however often it is used after.

    Spark puts the making of a column in the place of each use, and filters before it. It
    doesn't do so with what comes out of a generator, here of an array with one element."""
    return df.select(F.inline(F.array(F.struct(*(quoted(c) for c in df.columns)))))


def _text(column: Column) -> Column:
    """Blank for a missing value, else the text as it is."""
    missing = column.isNull() | column.isin(NULL_TOKENS)
    return F.when(missing, F.lit("")).otherwise(column)


def _number(column: Column) -> Column:
    """The text if it is a number, else NULL. A cast alone would tell, but by an
    exception per cell, and it takes "inf" and "1d" for numbers."""
    return F.when(column.rlike(_NUMBER), column)


def _whole_number(column: Column, low: int, high: int) -> Column:
    """Text to int in a range, cutting decimals (2024.0, 2024.7 -> 2024); else NULL."""
    number = _number(column).try_cast("double")
    return F.when((number >= low) & (number < high + 1), number.cast("int"))


def _without_separators(column: Column) -> Column:
    """The text without its thousands separators; NULL if commas stand anywhere else."""
    grouped = F.when(column.rlike(_GROUPED), F.replace(column, F.lit(","), F.lit("")))
    return F.when(column.contains(","), grouped).otherwise(column)


def _finer_than(digits: Column, amount_type: T.DecimalType) -> Column:
    """True if an amount had to be rounded, from its text: it has a digit other than 0
    behind the last decimal that is kept. Most texts are too short for that."""
    decimals = F.length(digits) - F.instr(digits, ".")
    long_enough = digits.contains(".") & (decimals > amount_type.scale)

    def part(i: int) -> Column:
        return F.regexp_extract(digits, _PARTS_OF_NUMBER, i)

    written = F.rtrim(F.concat(part(1), part(2)), F.lit("0"))
    zeros = F.length(part(1)) + F.length(part(2)) - F.length(written)
    power = F.coalesce(part(3).try_cast("int"), F.lit(0))
    needed = F.length(part(2)) - zeros - power
    rounded = (F.ltrim(written, F.lit("0")) != "") & (needed > amount_type.scale)
    return F.coalesce(F.when(long_enough | digits.rlike("[eE]"), rounded), F.lit(False))


def _safe_names(names: list[str]) -> list[str]:
    """Ledger names for the columns of a file. A further column whose name differs from
    another only by case gets a number, as Spark doesn't tell such names apart."""
    taken = {c.lower() for c in [*SOURCE_COLUMNS.values(), *_CHECKS, *_TEXTS, "rejected"]}
    found = []
    for name in names:
        ours = SOURCE_COLUMNS.get(name, name)
        if ours not in SOURCE_COLUMNS.values() and ours not in (*_CHECKS, *_TEXTS, "rejected"):
            number = 2
            while ours.lower() in taken:
                ours = f"{name}_{number}"
                number += 1
            taken.add(ours.lower())
        found.append(ours)
    return found


def parse(raw: DataFrame, amount_type: T.DecimalType = AMOUNT_TYPE) -> DataFrame:
    """Text columns to ledger columns plus ``reject_reason`` ('' for good rows).

    Columns that aren't part of the ledger stay, as text, whatever their names.
    ``over_precise`` marks amounts that had to be rounded. The texts of year, month and
    amount are kept for rejected rows, that of the amount for rounded ones, too.
    """
    known = set(SOURCE_COLUMNS.values())
    exact = list(raw.columns)
    again = sorted({c for c in exact if exact.count(c) > 1})
    raw = _made_once(raw.toDF(*(f"c{i}" for i in range(len(exact)))))
    places = [i for i, c in enumerate(exact) if c != _TOO_LONG]
    ours = _safe_names([exact[i] for i in places])
    names = {f"c{i}": name for i, name in zip(places, ours)}
    doubled = again or sorted({n for n in ours if ours.count(n) > 1})
    if doubled:
        raise ValueError(f"column given twice: {', '.join(doubled)}")
    lacking = [n for n in [*TEXT_COLUMNS, "year", "month", "amount"] if n not in names.values()]
    if lacking:
        raise ValueError(f"columns missing from the CSV: {', '.join(lacking)}")

    reserved = sorted({*_CHECKS, *_TEXTS, "rejected"}.intersection(names.values()))
    if reserved:
        raise ValueError(f"column names used by the ingest: {', '.join(reserved)}")

    source = {ours: F.col(c) for c, ours in names.items()}
    extras = [n for n in names.values() if n not in known]
    too_long = F.col(f"c{exact.index(_TOO_LONG)}") if _TOO_LONG in exact else F.lit(False)
    digits = _without_separators(source["amount"])

    typed = raw.select(
        *(_text(source[c]).alias(c) for c in TEXT_COLUMNS),
        _whole_number(source["year"], 1, 9999).alias("year"),
        _whole_number(source["month"], 1, 12).alias("month"),
        _number(digits).try_cast(amount_type).alias("amount"),
        _finer_than(digits, amount_type).alias("over_precise"),
        *(_text(source[c]).alias(c) for c in extras),
        source["year"].alias("_year"),
        source["month"].alias("_month"),
        source["amount"].alias("_amount"),
        too_long.alias(_TOO_LONG),
    )
    reason = F.concat_ws(
        ",",
        F.when(F.col(_TOO_LONG), F.lit("columns")),
        *(F.when(F.col(c).isNull(), F.lit(c)) for c in ("year", "month", "amount")),
    )
    checked = _made_once(typed.withColumn("reject_reason", reason))
    bad = F.col("reject_reason") != ""
    return checked.select(
        *TEXT_COLUMNS,
        "year",
        "month",
        # Nothing in a row with surplus fields can be trusted.
        F.when(~F.col(_TOO_LONG), F.col("amount")).alias("amount"),
        F.make_date("year", "month", F.lit(1)).alias("date"),
        *(quoted(c) for c in extras),
        "over_precise",
        "reject_reason",
        *(F.when(bad, F.col(f"_{c}")).alias(f"{c}_text") for c in ("year", "month")),
        F.when(bad | F.col("over_precise"), F.col("_amount")).alias("amount_text"),
    )


def ledger_columns(parsed: DataFrame) -> DataFrame:
    return parsed.drop(*_CHECKS, *_TEXTS, "rejected")


def accepted(parsed: DataFrame) -> DataFrame:
    """The ledger: good rows, ledger columns and extra columns.

    Good rows are those with all three numbers. Asking for these instead of the
    reason keeps the pushed-down filter small enough to be compiled.
    """
    return ledger_columns(parsed.dropna(subset=["year", "month", "amount"]))


def rejects(parsed: DataFrame) -> DataFrame:
    """Rows that aren't in the ledger, with the reason and the texts as read."""
    return parsed.filter(F.col("reject_reason") != "").drop(
        "over_precise", "year", "month", "amount", "date", "rejected"
    )


def rounded(parsed: DataFrame) -> DataFrame:
    """Accepted rows whose amount had to be rounded, with the amount's text."""
    good = parsed.filter((F.col("reject_reason") == "") & F.col("over_precise"))
    return good.drop(*_CHECKS, "year_text", "month_text", "rejected")


def quality(parsed: DataFrame) -> DataFrame:
    """Row counts of an ingest: all, accepted, rejected by cause, rounded amounts."""
    reasons = F.split("reject_reason", ",")
    good = F.col("reject_reason") == ""
    return parsed.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(good).alias("accepted_rows"),
        F.count_if(~good).alias("rejected_rows"),
        *(
            F.count_if(F.array_contains(reasons, cause)).alias(f"bad_{cause}")
            for cause in ("year", "month", "amount", "columns")
        ),
        F.count_if(good & F.col("over_precise")).alias("over_precise_rows"),
    )


def write_csv(
    df: DataFrame, path: str, header: dict[str, str] | None = None, mode: str = "error"
) -> None:
    """Rows as a folder of UTF-8 CSV files, one per partition, each with a header.

    Partitions are written as they are, so an ordered result keeps its order over
    the sorted file names and no task gets more than its part. ``header`` renames
    columns in the files.
    """
    header = header or {}
    (
        df.toDF(*(header.get(c, c) for c in df.columns))
        .write.mode(mode)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("emptyValue", "")
        # The writer would trim every text.
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_rows(ledger: DataFrame, path: str) -> None:
    """All rows and columns of a ledger under the header names of the source files."""
    write_csv(ledger, path, {ours: theirs for theirs, ours in SOURCE_COLUMNS.items()})
