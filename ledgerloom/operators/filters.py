"""Row selection and option lists.

``None`` or an empty list means "no filter". Default periods ("the latest one")
are scalar subqueries: nothing runs until the report does, and Spark prunes the
ledger's year/month partitions with the subquery's value. A stored ledger brings a
small table of its periods, so that finding a month opens none of its files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.measures import period_code


class Rollup(NamedTuple):
    """Tables stored beside a ledger, see ``sources.rollup``: sums by month, organisation,
    store, house type, category and sign; numbered property keys; and bitmaps of those
    with a posting in a year and category."""

    totals: DataFrame
    properties: DataFrame
    active: DataFrame


def with_rollup(ledger: DataFrame, rollup: Rollup | None) -> DataFrame:
    """The ledger with its stored sums. Tables made from it don't have them."""
    ledger.ledger_rollup = rollup
    return ledger


def stored_rollup(ledger: DataFrame) -> Rollup | None:
    return ledger.__dict__.get("ledger_rollup")


def in_sums(ledger: DataFrame) -> DataFrame:
    """What reports that add up amounts by their sign read: the stored ledger of sums,
    with the same columns but for those of single postings, or the ledger itself."""
    rollup = stored_rollup(ledger)
    return ledger if rollup is None else with_periods(rollup.totals.select("*"), stored_periods(ledger))


def with_periods(ledger: DataFrame, periods: DataFrame | None) -> DataFrame:
    """The ledger with its table of (year, month, rows), one row per month that occurs.
    Tables made from it, filtered ones as well, don't have it."""
    ledger.ledger_periods = periods
    return ledger


def stored_periods(ledger: DataFrame) -> DataFrame | None:
    return ledger.__dict__.get("ledger_periods")


def _with_year_and_month(ledger: DataFrame) -> DataFrame:
    """The smallest table with every (year, month) of the ledger."""
    periods = stored_periods(ledger)
    return ledger if periods is None else periods


def period_rows(ledger: DataFrame) -> DataFrame:
    """(year, month, rows) of a ledger."""
    periods = stored_periods(ledger)
    if periods is None:
        periods = ledger.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))
    return periods


def select(ledger: DataFrame, **equal: Any) -> DataFrame:
    """Keep rows with ``column == value`` for every value that is given."""
    for column, value in equal.items():
        if value is not None:
            ledger = ledger.filter(F.col(column) == value)
    return ledger


def any_of(ledger: DataFrame, choices: Mapping[str, Sequence[Any] | None]) -> DataFrame:
    """Keep rows whose value is in the list, for every list that isn't empty."""
    for column, values in choices.items():
        if values:
            ledger = ledger.filter(F.col(column).isin(list(values)))
    return ledger


def latest_period(ledger: DataFrame) -> DataFrame:
    """Latest year, and the latest month inside that year. No row if empty."""
    return (
        _with_year_and_month(ledger)
        .agg(F.max(period_code()).alias("code"))
        .filter(F.col("code").isNotNull())
        .select(
            (F.col("code") / 100).cast("int").alias("year"),
            (F.col("code") % 100).alias("month"),
        )
    )


def _latest_code(ledger: DataFrame) -> Column:
    return ledger.agg(F.max(period_code())).scalar()


def at_year(ledger: DataFrame, year: int | None = None) -> DataFrame:
    """Rows of one year, the latest by default."""
    return ledger.filter(F.col("year") == (_latest_year(ledger) if year is None else year))


def _latest_year(ledger: DataFrame) -> Column:
    return _with_year_and_month(ledger).agg(F.max("year")).scalar()


def at_period(ledger: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Rows of one month. Default: latest year, and its latest month."""
    if month is not None:
        return at_year(ledger, year).filter(F.col("month") == month)
    code = _latest_code(select(_with_year_and_month(ledger), year=year))
    return ledger.filter(
        (F.col("year") == (code / 100).cast("int")) & (F.col("month") == code % 100)
    )


def options(ledger: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Distinct values of a column in order."""
    order = F.desc(column) if descending else F.asc(column)
    rollup = stored_rollup(ledger)
    if column in ("year", "month"):
        ledger = _with_year_and_month(ledger)
    elif rollup is not None and column == "property_id":
        return rollup.properties.select(column).orderBy(order)
    elif rollup is not None and column in rollup.totals.columns:
        ledger = rollup.totals
    return ledger.select(column).distinct().orderBy(order)


def month_options(ledger: DataFrame, year: int | None = None) -> DataFrame:
    """Months that occur in a year, latest first."""
    return options(at_year(_with_year_and_month(ledger), year), "month", descending=True)


def property_options(ledger: DataFrame, limit: int = 100) -> DataFrame:
    """The first property keys in order."""
    return options(ledger, "property_id").limit(limit)
