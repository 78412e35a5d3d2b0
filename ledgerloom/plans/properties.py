"""Properties in one year, the latest by default."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import measures as m
from ledgerloom.functions.formats import as_text
from ledgerloom.operators.filters import (
    at_year,
    in_sums,
    select,
    stored_periods,
    stored_rollup,
    with_periods,
)
from ledgerloom.operators.ranking import largest_first, top
from ledgerloom.operators.totals import property_count
from ledgerloom.schema import DETAIL_COLUMNS


def chosen(
    ledger: DataFrame,
    year: int | None = None,
    property_id: str | None = None,
    category: str | None = None,
) -> DataFrame:
    """Rows of the year, of one property and one category if given."""
    return select(at_year(ledger, year), property_id=property_id, category=category)


def kpis(
    ledger: DataFrame,
    year: int | None = None,
    property_id: str | None = None,
    category: str | None = None,
) -> DataFrame:
    """Properties in the whole ledger and in the selection; income, also per property.

    With a stored roll-up, and unless one property is asked for, sums come from the ledger
    of sums and properties from bitmaps. Else rows are added up per property first, so a
    hot property is one row per task before anything is shuffled.
    """
    rollup = stored_rollup(ledger)
    if rollup is not None and property_id is None:
        sums = chosen(in_sums(ledger), year, category=category).agg(m.in_units(m.gross_income()).alias("gross_income_10k"))
        figures = sums.select(_active(ledger, year, category).alias("active_properties"), "gross_income_10k")
    else:
        figures = (
            chosen(ledger, year, property_id, category)
            .groupBy("property_id")
            .agg(m.gross_income().alias("income"))
            .agg(
                F.count(F.lit(1)).alias("active_properties"),
                m.in_units(m.or_zero(F.sum("income"))).alias("gross_income_10k"),
            )
        )
    return (
        figures.withColumn(
            "income_per_property_10k",
            m.guarded_ratio(F.col("gross_income_10k"), F.col("active_properties")),
        )
        .withColumn("all_properties", property_count(ledger))
    )


def _active(ledger: DataFrame, year: int | None, category: str | None) -> Column:
    """Properties with a posting in the year (and category), as a scalar subquery: the
    bitmaps of all categories are joined for each bucket of numbers."""
    bitmaps = with_periods(stored_rollup(ledger).active.select("*"), stored_periods(ledger))
    joined = chosen(bitmaps, year, category=category).groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return joined.agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0).cast("long"))).scalar()


def cards(
    ledger: DataFrame,
    year: int | None = None,
    property_id: str | None = None,
    category: str | None = None,
) -> DataFrame:
    amounts = ["gross_income_10k", "income_per_property_10k"]
    return as_text(kpis(ledger, year, property_id, category), amounts=amounts)


def top_income(
    ledger: DataFrame,
    year: int | None = None,
    property_id: str | None = None,
    category: str | None = None,
    k: int = 10,
) -> DataFrame:
    """Properties with the largest gross income."""
    totals = (
        chosen(ledger, year, property_id, category)
        .filter("amount > 0")
        .groupBy("property_id")
        .agg(F.sum("amount").alias("income"))
    )
    return top(totals, "income", "property_id", k).select(
        "property_id", m.in_units(F.col("income")).alias("income_10k")
    )


def top_expense(
    ledger: DataFrame,
    year: int | None = None,
    property_id: str | None = None,
    category: str | None = None,
    k: int = 10,
) -> DataFrame:
    """Properties with the largest gross expense, as positive amounts."""
    totals = (
        chosen(ledger, year, property_id, category)
        .filter("amount < 0")
        .groupBy("property_id")
        .agg(F.abs(F.sum("amount")).alias("expense"))
    )
    return top(totals, "expense", "property_id", k).select(
        "property_id", m.in_units(F.col("expense")).alias("expense_10k")
    )


def detail(
    ledger: DataFrame,
    year: int | None = None,
    property_id: str | None = None,
    category: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """The rows themselves, largest absolute amount first; ``limit`` for a head."""
    rows = chosen(ledger, year, property_id, category).select(*DETAIL_COLUMNS)
    return largest_first(rows, "amount", limit)


def report(
    ledger: DataFrame,
    year: int | None = None,
    property_id: str | None = None,
    category: str | None = None,
) -> dict[str, DataFrame]:
    return {
        "kpis": kpis(ledger, year, property_id, category),
        "top_income": top_income(ledger, year, property_id, category),
        "top_expense": top_expense(ledger, year, property_id, category),
        "detail": detail(ledger, year, property_id, category),
    }
