"""Overview: latest month's figures and what the ledger holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import measures as m
from ledgerloom.functions.formats import as_text
from ledgerloom.operators.filters import at_period, in_sums, period_rows
from ledgerloom.operators.pivot import pivot
from ledgerloom.operators.ranking import preview, top
from ledgerloom.operators.totals import property_count


def kpis(ledger: DataFrame) -> DataFrame:
    """Gross income, expense and net of the latest month, and all rows' count.

    Only the latest month's amounts are read; the count is that of the periods.
    """
    records = period_rows(ledger).agg(F.coalesce(F.sum("rows"), F.lit(0))).scalar()
    return (
        at_period(in_sums(ledger))
        .agg(
            F.max("year").alias("year"),
            F.max("month").alias("month"),
            m.in_units(m.gross_income()).alias("gross_income_10k"),
            m.in_units(m.gross_expense()).alias("gross_expense_10k"),
        )
        .withColumn("net_10k", F.col("gross_income_10k") - F.col("gross_expense_10k"))
        .withColumn("net_flag", m.net_flag(F.col("net_10k")))
        .withColumn("records", records)
    )


def cards(ledger: DataFrame) -> DataFrame:
    """The same figures as printed on the cards."""
    amounts = ["gross_income_10k", "gross_expense_10k", "net_10k"]
    return as_text(kpis(ledger), amounts=amounts, counts=["records"])


def org_category(ledger: DataFrame) -> DataFrame:
    """Net per organisation and category in reporting units, empty cells 0."""
    yuan = pivot(in_sums(ledger), ["org"], ["category"], margins=False, round_to=None)
    org, *cells = yuan.columns
    # Columns are told apart by place: category names may be any text.
    safe = yuan.toDF(org, *(f"c{i}" for i in range(len(cells))))
    return safe.select(
        org, *(m.in_units(F.col(f"c{i}")).alias(name) for i, name in enumerate(cells))
    )


def data_range(ledger: DataFrame) -> DataFrame:
    """First and last year, and exact distinct counts.

    Counting five columns distinct in one aggregate would copy every row five
    times. The four small ones are reduced to their combinations first, and
    properties are counted by a scan that reads that column alone. With a stored roll-up
    all of it comes from there.
    """
    small = ["org", "shop", "house_type", "category"]
    return (
        in_sums(ledger)
        .groupBy(*small)
        .agg(F.min("year").alias("first"), F.max("year").alias("last"))
        .agg(
            F.min("first").alias("first_year"),
            F.max("last").alias("last_year"),
            F.count_distinct("org").alias("orgs"),
            F.count_distinct("shop").alias("shops"),
            F.count_distinct("house_type").alias("house_types"),
            F.count_distinct("category").alias("categories"),
        )
        .withColumn("properties", property_count(ledger))
    )


def data_range_approx(ledger: DataFrame, error: float = 0.05) -> DataFrame:
    """The same with estimated counts: one pass and no shuffle of property keys."""
    counted = {
        "orgs": "org",
        "shops": "shop",
        "house_types": "house_type",
        "categories": "category",
        "properties": "property_id",
    }
    return ledger.agg(
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        *(F.approx_count_distinct(c, error).alias(name) for name, c in counted.items()),
    )


def top_income_categories(ledger: DataFrame, k: int = 5) -> DataFrame:
    """Categories with the largest gross income over all time."""
    totals = (
        in_sums(ledger).filter("amount > 0").groupBy("category").agg(F.sum("amount").alias("income"))
    )
    return top(totals, "income", "category", k).select(
        "category", m.in_units(F.col("income")).alias("income_10k")
    )


def report(ledger: DataFrame) -> dict[str, DataFrame]:
    return {
        "kpis": kpis(ledger),
        "org_category": org_category(ledger),
        "data_range": data_range(ledger),
        "top_income_categories": top_income_categories(ledger),
        "preview": preview(ledger),
    }
