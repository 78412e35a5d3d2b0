"""Numbers as text, for cards and printed tables only. Reports keep numbers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_decimals(x: Column) -> Column:
    return F.call_function("format_number", x, F.lit("0.00"))


def percent(x: Column) -> Column:
    return F.concat(two_decimals(x), F.lit("%"))


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def as_text(
    df: DataFrame,
    amounts: Iterable[str] = (),
    counts: Iterable[str] = (),
    percents: Iterable[str] = (),
) -> DataFrame:
    """Replace the named number columns by their printed form."""
    styles = {c: two_decimals for c in amounts}
    styles |= {c: thousands for c in counts}
    styles |= {c: percent for c in percents}
    return df.withColumns({c: style(F.col(c)) for c, style in styles.items()})
