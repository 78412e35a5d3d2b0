"""Structure of one year, the latest by default. Amounts are signed nets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import measures as m
from ledgerloom.operators.filters import at_year, in_sums, select
from ledgerloom.operators.ranking import largest_first
from ledgerloom.operators.totals import net_by
from ledgerloom.schema import DETAIL_COLUMNS


def chosen(
    ledger: DataFrame,
    year: int | None = None,
    category: str | None = None,
    org: str | None = None,
) -> DataFrame:
    """Rows of the year, of one category and one organisation if given."""
    return select(at_year(ledger, year), category=category, org=org)


def monthly_series(
    ledger: DataFrame,
    year: int | None = None,
    category: str | None = None,
    org: str | None = None,
) -> DataFrame:
    """Net per month; months without rows are absent."""
    return (
        net_by(chosen(in_sums(ledger), year, category, org), "month")
        .orderBy("month")
        .select("month", m.in_units(F.col("net")).alias("net_10k"))
    )


def category_net(
    ledger: DataFrame,
    year: int | None = None,
    category: str | None = None,
    org: str | None = None,
) -> DataFrame:
    """Net per category, largest first."""
    return (
        net_by(chosen(in_sums(ledger), year, category, org), "category")
        .orderBy(F.desc("net"), "category")
        .select("category", m.in_units(F.col("net")).alias("net_10k"))
    )


def detail(
    ledger: DataFrame,
    year: int | None = None,
    category: str | None = None,
    org: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """The rows themselves, largest absolute amount first; ``limit`` for a head."""
    rows = chosen(ledger, year, category, org).select(*DETAIL_COLUMNS)
    return largest_first(rows, "amount", limit)


def report(
    ledger: DataFrame,
    year: int | None = None,
    category: str | None = None,
    org: str | None = None,
) -> dict[str, DataFrame]:
    return {
        "monthly_series": monthly_series(ledger, year, category, org),
        "category_net": category_net(ledger, year, category, org),
        "detail": detail(ledger, year, category, org),
    }
