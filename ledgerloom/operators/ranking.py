"""Ordered results. Every order ends in a complete tie-break."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.measures import period_code
from ledgerloom.functions.names import quoted
from ledgerloom.operators.filters import period_rows


def top(totals: DataFrame, value: str, key: str, k: int) -> DataFrame:
    """The k largest groups; equal values are ordered by key."""
    return totals.orderBy(F.desc(value), F.asc(key)).limit(k)


def _keeps_positions(df: DataFrame) -> bool:
    """Whether a task that is run again finds its rows in the same order: there are
    only files (or given rows) below, filtered and projected, and no shuffle."""

    def fixed(node) -> bool:
        below = node.children()
        name = node.nodeName().split(" ")[0]
        known = {"Project", "Filter", "SubqueryAlias", "LogicalRelation", "Relation", "LocalRelation", "LogicalRDD"}
        return name in known and all(fixed(below.apply(i)) for i in range(below.size()))

    return fixed(df._jdf.queryExecution().analyzed())


def largest_first(df: DataFrame, value: str = "amount", limit: int | None = None) -> DataFrame:
    """All rows by absolute value, largest first, or only the first ``limit``.

    A full sort is split into ranges of the sort key. Copies of one row have the
    same key and would all land in one range, so the row's position in the scan
    is the last key: it changes nothing a reader can see and lets Spark cut a
    run of copies. Rows that don't come straight from files are sorted without it,
    since a task that is run again may find them in another order.
    """
    order = [F.abs(value).desc(), *map(quoted, df.columns)]
    if limit is not None:
        return df.orderBy(*order).limit(limit)
    if not _keeps_positions(df):
        return df.orderBy(*order)
    return (
        df.withColumn("_position", F.monotonically_increasing_id())
        .orderBy(*order, "_position")
        .drop("_position")
    )


def preview(ledger: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows by year, month and then every other column.

    Only the earliest periods can hold them. Their cut-off comes from the rows of
    each period, stored beside the ledger or else counted without reading a column;
    the other periods are pruned before the wide read. The window sees one row per period,
    at most 12 x 9999 of them since the ledger checks both ranges.
    """
    earlier = Window.orderBy("year", "month").rowsBetween(Window.unboundedPreceding, -1)
    cutoff = (
        period_rows(ledger)
        .withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
        .filter(F.col("before") < rows)
        .agg(F.max(period_code()))
        .scalar()
    )
    rest = [quoted(c) for c in ledger.columns if c not in ("year", "month")]
    return ledger.filter(period_code() <= cutoff).orderBy("year", "month", *rest).limit(rows)
