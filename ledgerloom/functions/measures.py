"""Column expressions shared by the reports.

Gross figures split money by the sign of each row. Net-basis figures (see
``operators.totals``) split it by the sign of each category's net. Both are
needed and they differ, so their names always say which one is meant.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.schema import UNIT


def or_zero(total: Column) -> Column:
    """Sum of an empty selection is 0, not NULL."""
    return F.coalesce(total, F.lit(0))


def gross_income(column: str = "amount") -> Column:
    amount = F.col(column)
    return or_zero(F.sum(F.when(amount > 0, amount)))


def gross_expense(column: str = "amount") -> Column:
    """Money spent, as a positive number."""
    amount = F.col(column)
    return F.abs(or_zero(F.sum(F.when(amount < 0, amount))))


def net(column: str = "amount") -> Column:
    return or_zero(F.sum(column))


def in_units(money: Column, unit: int = UNIT) -> Column:
    """Yuan to reporting units: exact decimal sums first, one division last."""
    return money.cast("double") / F.lit(float(unit))


def guarded_ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """``part / whole * scale``, 0 where the whole is not positive."""
    return F.when(whole > 0, part / whole * F.lit(scale)).otherwise(F.lit(0.0))


def kind(money: Column) -> Column:
    """Sign label of a total; exactly 0 counts as expense."""
    return F.when(money > 0, F.lit("income")).otherwise(F.lit("expense"))


def net_flag(money: Column) -> Column:
    """How a card should colour a net figure."""
    return F.when(money > 0, F.lit("normal")).otherwise(F.lit("inverse"))


def period_code(year: Column | None = None, month: Column | None = None) -> Column:
    """(year, month) as one sortable int, so that max() stays inside codegen."""
    year = F.col("year") if year is None else year
    month = F.col("month") if month is None else month
    return year * 100 + month
