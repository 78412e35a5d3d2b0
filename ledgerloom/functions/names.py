"""Column names as they come."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """A column by its name, whatever characters are in it."""
    return F.col(f"`{name.replace('`', '``')}`")
