"""Free pivot over a filtered ledger, and CSV export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerloom.operators.filters import any_of
from ledgerloom.operators.pivot import pivot
from ledgerloom.operators.ranking import preview
from ledgerloom.schema import DEFAULT_COLUMNS, DEFAULT_ROWS
from ledgerloom.sources.csv_files import write_csv, write_rows


def chosen(
    ledger: DataFrame,
    org: Sequence[str] = (),
    shop: Sequence[str] = (),
    year: Sequence[int] = (),
    month: Sequence[int] = (),
) -> DataFrame:
    """Rows in all of the given lists; an empty list doesn't filter."""
    return any_of(ledger, {"org": org, "shop": shop, "year": year, "month": month})


def report(
    ledger: DataFrame,
    org: Sequence[str] = (),
    shop: Sequence[str] = (),
    year: Sequence[int] = (),
    month: Sequence[int] = (),
    rows: Sequence[str] = DEFAULT_ROWS,
    cols: Sequence[str] = DEFAULT_COLUMNS,
    value: str = "amount",
    agg: str = "sum",
) -> dict[str, DataFrame]:
    selection = chosen(ledger, org, shop, year, month)
    return {
        "pivot": pivot(selection, rows, cols, value, agg),
        "preview": preview(selection),
        "rows": selection,
    }


def export_pivot(table: DataFrame, path: str) -> None:
    """A pivot as CSV files, row keys included."""
    write_csv(table, path)


def export_rows(selection: DataFrame, path: str) -> None:
    """All selected rows and columns as CSV files."""
    write_rows(selection, path)
