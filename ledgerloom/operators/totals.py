"""Grouped sums of the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import measures as m
from ledgerloom.operators.filters import stored_rollup


def net_by(ledger: DataFrame, *keys: str) -> DataFrame:
    """Net amount per key, in yuan (column ``net``)."""
    return ledger.groupBy(*keys).agg(m.net().alias("net"))


def gross_by(ledger: DataFrame, *keys: str) -> DataFrame:
    """Gross income, gross expense and net per key, in yuan."""
    return ledger.groupBy(*keys).agg(
        m.gross_income().alias("gross_income"),
        m.gross_expense().alias("gross_expense"),
        m.net().alias("net"),
    )


def net_basis(nets: DataFrame) -> DataFrame:
    """Income and expense as sums over groups by the sign of each group's net."""
    return nets.agg(
        m.gross_income("net").alias("net_basis_income"),
        m.gross_expense("net").alias("net_basis_expense"),
    )


def distinct_count(ledger: DataFrame, column: str) -> Column:
    """Exact number of distinct values, as a scalar subquery that reads one column.

    Written as a count over distinct rows: Spark would merge a count(distinct) with
    the subquery that finds the latest year, and pruning would wait for both.
    """
    return ledger.select(column).distinct().agg(F.count(F.lit(1))).scalar()


def property_count(ledger: DataFrame) -> Column:
    """Exact number of properties, as a scalar subquery: the stored keys are counted, else
    one column of the ledger is read."""
    rollup = stored_rollup(ledger)
    if rollup is None:
        return distinct_count(ledger, "property_id")
    return rollup.properties.agg(F.count(F.lit(1))).scalar()


def share_of_total(nets: DataFrame, key: str) -> DataFrame:
    """Each group's part of the sum of all groups.

    The total is a scalar subquery over the same grouped rows: Spark reuses
    their shuffle, and no single-task window is needed.
    """
    total = nets.agg(F.sum("net")).scalar()
    return nets.select(
        key,
        m.in_units(F.col("net")).alias("amount_10k"),
        (F.col("net").cast("double") / total.cast("double")).alias("share"),
    )
