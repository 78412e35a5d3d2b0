"""Performance of one month, the latest by default."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import measures as m
from ledgerloom.functions.formats import as_text
from ledgerloom.operators.filters import at_period, in_sums
from ledgerloom.operators.totals import gross_by, net_basis, net_by, share_of_total


def _category_nets(ledger: DataFrame, year: int | None, month: int | None) -> DataFrame:
    return net_by(at_period(in_sums(ledger), year, month), "category")


def kpis(ledger: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Income, expense and net from category nets, and the expense ratio in %."""
    income, expense = F.col("net_basis_income_10k"), F.col("net_basis_expense_10k")
    return (
        net_basis(_category_nets(ledger, year, month))
        .select(
            m.in_units(F.col("net_basis_income")).alias("net_basis_income_10k"),
            m.in_units(F.col("net_basis_expense")).alias("net_basis_expense_10k"),
        )
        .withColumn("net_10k", income - expense)
        .withColumn("net_flag", m.net_flag(F.col("net_10k")))
        .withColumn("expense_income_pct", m.guarded_ratio(expense, income, 100.0))
    )


def cards(ledger: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    amounts = ["net_basis_income_10k", "net_basis_expense_10k", "net_10k"]
    return as_text(kpis(ledger, year, month), amounts=amounts, percents=["expense_income_pct"])


def category_net(
    ledger: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Net per category with its sign label, largest absolute value first."""
    return (
        _category_nets(ledger, year, month)
        .orderBy(F.abs("net").desc(), "category")
        .select(
            "category",
            m.kind(F.col("net")).alias("kind"),
            m.in_units(F.col("net")).alias("net_10k"),
        )
    )


def income_share(
    ledger: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Categories with a positive net and their part of the sum of those."""
    nets = _category_nets(ledger, year, month).filter("net > 0")
    return share_of_total(nets, "category").orderBy(F.desc("amount_10k"), "category")


def expense_share(
    ledger: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Categories with a negative net, as positive amounts, and their part."""
    nets = _category_nets(ledger, year, month).filter("net < 0")
    spent = nets.withColumn("net", F.abs("net"))
    return share_of_total(spent, "category").orderBy(F.desc("amount_10k"), "category")


def house_types(
    ledger: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Gross income, gross expense and net per house type; blank types left out."""
    named = at_period(in_sums(ledger), year, month).filter("house_type <> ''")
    return (
        gross_by(named, "house_type")
        .orderBy(F.desc("net"), "house_type")
        .select(
            "house_type",
            *(m.in_units(F.col(c)).alias(f"{c}_10k") for c in ("gross_income", "gross_expense", "net")),
        )
    )


def house_types_text(
    ledger: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    amounts = ["gross_income_10k", "gross_expense_10k", "net_10k"]
    return as_text(house_types(ledger, year, month), amounts=amounts)


def report(
    ledger: DataFrame, year: int | None = None, month: int | None = None
) -> dict[str, DataFrame]:
    return {
        "kpis": kpis(ledger, year, month),
        "income_share": income_share(ledger, year, month),
        "expense_share": expense_share(ledger, year, month),
        "category_net": category_net(ledger, year, month),
        "house_types": house_types(ledger, year, month),
    }
