"""Cross-tab with totals.

Totals come from rows, never from printed cells: the mean in a total is the mean
of all its rows. To get there from one scan, cells are kept as parts that add up
(sum and count for a mean), and the total row and total column combine parts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.filters import stored_periods
from ledgerloom.schema import (
    AGGREGATES,
    COLUMN_FIELDS,
    DEFAULT_COLUMNS,
    DEFAULT_ROWS,
    ROW_FIELDS,
    TOTAL,
    VALUE_FIELDS,
)

_PARTS = {
    "sum": ["sum"],
    "mean": ["sum", "count"],
    "count": ["count"],
    "max": ["max"],
    "min": ["min"],
}
_FROM_ROWS = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}
_FROM_PARTS = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}

# Up to this many columns a pivot by property is one conditional aggregate.
DIRECT_COLUMNS = 32
# Rows of a task where cells by property are made of a stored ledger, and the number of
# tasks the rows of one cell go to at most.
ROWS_A_TASK = 500_000
SPREAD = 16


def check_fields(rows: Sequence[str], cols: Sequence[str], value: str, agg: str) -> None:
    """Reject what can't be pivoted, before any job runs."""
    if not rows and not cols:
        raise ValueError("choose at least one row field or column field")
    for given, allowed, role in (
        (rows, ROW_FIELDS, "row field"),
        (cols, COLUMN_FIELDS, "column field"),
        ([value], VALUE_FIELDS, "value field"),
        ([agg], AGGREGATES, "aggregate"),
    ):
        unknown = [f for f in given if f not in allowed]
        if unknown:
            raise ValueError(f"no such {role}: {', '.join(unknown)}")
    fields = [*rows, *cols]
    twice = sorted({f for f in fields if fields.count(f) > 1})
    if twice:
        raise ValueError(f"field used more than once: {', '.join(twice)}")


def column_keys(
    ledger: DataFrame, cols: Sequence[str], max_columns: int | None = None
) -> list[tuple]:
    """Distinct column tuples in typed order (month 2 before 10).

    They become result columns, so the driver has to know them; more than
    ``max_columns`` is an error, never a cut. See ``pivot_long`` for any number.
    """
    keys = ledger.select(*cols).distinct().orderBy(*cols)
    found = (keys if max_columns is None else keys.limit(max_columns + 1)).collect()
    if max_columns is not None and len(found) > max_columns:
        raise ValueError(f"more than {max_columns} pivot columns for {', '.join(cols)}")
    return [tuple(row) for row in found]


def column_name(key: tuple) -> str:
    """``category|year``; blanks are shown, separators inside values are escaped."""
    texts = (str(v).replace("\\", "\\\\").replace("|", "\\|") for v in key)
    return "|".join(t or "(blank)" for t in texts)


def _one_shuffle(rows: list[str], cols: list[str], keys: list[tuple]) -> bool:
    """Whether each cell is its own conditional aggregate of the rows.

    Rows are then shuffled once, a property's cells together. That pays where the
    table is long; a short table (organisations, stores) shuffles next to nothing
    either way and Spark's pivot, which adds each row to one cell only, is faster.
    So it is where conditions per row get many.
    """
    return not cols or ("property_id" in rows and len(keys) <= DIRECT_COLUMNS)


def _cells_direct(ledger, rows, cols, value, parts, keys) -> DataFrame:
    def cell(key: tuple) -> Column:
        tests = [F.col(c) == v for c, v in zip(cols, key)]
        return F.when(reduce(Column.__and__, tests), F.col(value)) if tests else F.col(value)

    return ledger.groupBy(*rows).agg(
        *(
            _FROM_ROWS[p](cell(key)).alias(f"c{i}_{p}")
            for i, key in enumerate(keys)
            for p in parts
        )
    )


def _cells_pivoted(ledger, rows, cols, value, parts, keys) -> DataFrame:
    """Spark's pivot by one text per column tuple; lengths keep the texts apart."""
    shown = ledger.select(*rows, value, _key(cols).alias("_key"))
    wide = shown.groupBy(*rows).pivot("_key", _key_texts(keys)).agg(*(_FROM_ROWS[p](value).alias(p) for p in parts))
    return wide.toDF(*rows, *(f"c{i}_{p}" for i in range(len(keys)) for p in parts))


def _cells_widened(cells, rows, cols, parts, keys) -> DataFrame:
    """The same from the cells of ``_cells_long``, whose rows of a property are together."""
    shown = cells.select(*rows, _key(cols).alias("_key"), *(f"_{p}" for p in parts))
    types = {p: cells.schema[f"_{p}"].dataType for p in parts}
    wide = (
        shown.groupBy(*rows)
        .pivot("_key", _key_texts(keys))
        .agg(*(_FROM_PARTS[p](f"_{p}").cast(types[p]).alias(p) for p in parts))
    )
    return wide.toDF(*rows, *(f"c{i}_{p}" for i in range(len(keys)) for p in parts))


def _key(cols: list[str]) -> Column:
    texts = [F.col(c).cast("string") for c in cols]
    return F.concat_ws(",", *map(F.length, texts[:-1]), *texts)


def _key_texts(keys: list[tuple]) -> list[str]:
    shown = [[str(v) for v in key] for key in keys]
    return [",".join([str(len(t)) for t in texts[:-1]] + texts) for texts in shown]


def _tasks(ledger: DataFrame, rows: Sequence[str]) -> int:
    """How many tasks make the cells; 1 if that is left to Spark: for few rows, for a ledger
    whose number of rows isn't stored, and where no property makes the cells many."""
    periods = stored_periods(ledger)
    if "property_id" not in rows or periods is None:
        return 1
    return -(-(periods.agg(F.sum("rows")).first()[0] or 0) // ROWS_A_TASK)


def _cells_long(ledger, rows, cols, value, parts, tasks) -> DataFrame:
    """Row fields, column fields, and the parts of each cell as ``_part``.

    By property nearly every row is a cell of its own, so that combining where the rows are
    read keeps a table of them in memory and shuffles as many. With ``tasks`` above 1 rows
    are dealt to so many tasks instead, those of a hot cell to up to ``SPREAD``; what is left
    then goes by the row fields, at most ``SPREAD`` rows a cell. What a task holds grows
    neither with the ledger nor with the size of the files' parts that Spark reads.
    """
    plain = ledger.groupBy(*rows, *cols).agg(*(_FROM_ROWS[p](value).alias(f"_{p}") for p in parts))
    if tasks <= 1:
        return plain
    spread = F.monotonically_increasing_id() % SPREAD
    dealt = ledger.select(*rows, *cols, value, spread.alias("_spread")).repartition(tasks, *rows, *cols, "_spread")
    some = dealt.groupBy(*rows, *cols, "_spread").agg(*(_FROM_ROWS[p](value).alias(f"_{p}") for p in parts))
    whole = some.repartition(tasks, *rows).groupBy(*rows, *cols)
    return whole.agg(*(_FROM_PARTS[p](f"_{p}").cast(plain.schema[f"_{p}"].dataType).alias(f"_{p}") for p in parts))


def _with_totals(cells, rows, cols, parts) -> DataFrame:
    """Cells of ``_cells_long`` and their totals, like grouping sets of them. Cells are whole,
    so that only totals are made, those of a row where its cells are."""

    def totals(of: list[str]) -> DataFrame:
        whole = cells.groupBy(*of).agg(*(_FROM_PARTS[p](f"_{p}").alias(f"_{p}") for p in parts))
        fields = [F.col(c) if c in of else F.lit(None).cast(cells.schema[c].dataType).alias(c) for c in [*rows, *cols]]
        flags = [F.lit(bool(f) and not set(f) <= set(of)).alias(n) for n, f in (("is_row_total", rows), ("is_column_total", cols))]
        return whole.select(*fields, *(f"_{p}" for p in parts), *flags).filter(F.col(f"_{parts[0]}").isNotNull())

    every = totals(rows).union(totals(cols)).union(totals([]))
    shown = [F.col(f"_{p}").cast(every.schema[f"_{p}"].dataType) for p in parts]
    plain = cells.select(*rows, *cols, *shown, F.lit(False), F.lit(False)).toDF(*every.columns)
    return plain.filter(F.col(f"_{parts[0]}").isNotNull()).union(every)


def _across(part: str, keys: int, scale: int) -> str:
    """Combine one part over all columns of a row."""
    cells = ", ".join(f"c{i}_{part}" for i in range(keys))
    if part in ("max", "min"):
        return f"array_{part}(array({cells}))"
    number = f"decimal(38,{scale})" if part == "sum" else "bigint"
    return (
        f"aggregate(array({cells}), cast(0 as {number}), "
        f"(total, x) -> cast(total + coalesce(x, 0) as {number}))"
    )


def _printed(
    agg: str, parts: dict[str, str], fill: int, round_to: int | None, scale: int
) -> Column:
    """The shown value of a cell. As SQL text: wide pivots have many of them.

    A rounded mean is taken in decimals, where a half is a half; sums or counts too
    large for that, or amounts with more decimals, are divided as doubles.
    """
    if agg == "count":
        # Without rows the count is 0 in one plan and NULL in the other.
        return F.expr(f"cast(coalesce(nullif({parts['count']}, 0), {fill}) as bigint)")
    shown = parts.get(agg) or f"cast({parts['sum']} as double) / nullif({parts['count']}, 0)"
    if round_to is not None:
        shown = f"bround({shown}, {round_to})"
        if agg == "mean" and scale <= 2:
            sums = f"try_cast({parts['sum']} as decimal(22,2))"
            exact = f"{sums} / nullif(try_cast({parts['count']} as decimal(12,0)), 0)"
            shown = f"coalesce(cast(bround({exact}, {round_to}) as double), {shown})"
    return F.expr(f"coalesce({shown}, {fill})")


def pivot(
    ledger: DataFrame,
    rows: Sequence[str] = DEFAULT_ROWS,
    cols: Sequence[str] = DEFAULT_COLUMNS,
    value: str = "amount",
    agg: str = "sum",
    margins: bool = True,
    fill: int = 0,
    round_to: int | None = 2,
    total_name: str = TOTAL,
    max_columns: int | None = None,
    one_shuffle: bool | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Row fields, then one column per column tuple, then the total column.

    With margins, ``is_total`` marks the total row (its first key shows
    ``total_name``, the others are blank), so a real key can't be mistaken for
    it. Without column fields the only value column is the total; without row
    fields the only row is the total. An empty ledger gives no row.
    """
    rows, cols = list(rows), list(cols)
    check_fields(rows, cols, value, agg)
    keys = column_keys(ledger, cols, max_columns) if cols else [()]
    names = [column_name(k) for k in keys] if cols else [total_name]
    taken = [*rows, "is_total", *([total_name] if cols and margins else []), *names]
    clash = sorted({n for n in taken if taken.count(n) > 1})
    if clash:
        raise ValueError(f"column names clash in the pivot: {', '.join(clash)}")
    if not keys:  # nothing selected: an empty table with only the total column
        keys, names, cols = [()], [total_name], []

    parts = _PARTS[agg]
    direct = _one_shuffle(rows, cols, keys) if one_shuffle is None else one_shuffle
    tasks = _tasks(ledger, rows) if cols and one_shuffle is None else 1
    if tasks > 1:
        wide = _cells_widened(_cells_long(ledger, rows, cols, value, parts, tasks), rows, cols, parts, keys)
    else:
        cells = _cells_direct if direct or not cols else _cells_pivoted
        wide = cells(ledger, rows, cols, value, parts, keys)

    some_part = F.expr(f"coalesce({', '.join(f'c{i}_{parts[0]}' for i in range(len(keys)))})")
    if not rows:
        seen = F.col("c0_count") > 0 if agg == "count" and len(keys) == 1 else some_part.isNotNull()
        table = wide.filter(seen).withColumn("is_total", F.lit(True))
    elif margins:
        # Both branches read the same shuffle: Spark plans the second as a reuse.
        total = wide.agg(
            *(
                _FROM_PARTS[p](f"c{i}_{p}").alias(f"c{i}_{p}")
                for i in range(len(keys))
                for p in parts
            )
        ).filter(some_part.isNotNull())
        labels = [F.lit(total_name if i == 0 else "").alias(r) for i, r in enumerate(rows)]
        table = wide.withColumn("is_total", F.lit(False)).unionByName(
            total.select(*labels, "*", F.lit(True).alias("is_total"))
        )
    else:
        table = wide.withColumn("is_total", F.lit(False))

    scale = getattr(ledger.schema[value].dataType, "scale", 0)
    shown = [
        _printed(agg, {p: f"c{i}_{p}" for p in parts}, fill, round_to, scale).alias(name)
        for i, name in enumerate(names)
    ]
    if cols and margins:
        across = {p: _across(p, len(keys), scale) for p in parts}
        shown.append(_printed(agg, across, fill, round_to, scale).alias(total_name))
    if ordered and rows:
        table = table.orderBy("is_total", *rows)
    return table.select(*rows, *(["is_total"] if margins else []), *shown)


def pivot_long(
    ledger: DataFrame,
    rows: Sequence[str] = DEFAULT_ROWS,
    cols: Sequence[str] = DEFAULT_COLUMNS,
    value: str = "amount",
    agg: str = "sum",
    margins: bool = True,
    round_to: int | None = 2,
) -> DataFrame:
    """The pivot's cells as rows: row fields, column fields, value, and two flags that
    mark the totals over all row keys and over all column keys (whose fields are NULL).

    Nothing is collected, so there may be any number of column keys. Cells without rows
    are left out. Totals are made from the cells' parts, so rows are read once.
    """
    rows, cols = list(rows), list(cols)
    check_fields(rows, cols, value, agg)
    parts = _PARTS[agg]
    tasks = _tasks(ledger, rows)
    cells = _cells_long(ledger, rows, cols, value, parts, tasks)
    if margins and cols and tasks > 1:
        table = _with_totals(cells, rows, cols, parts)
    elif margins:
        some = [[*rows, *cols], *([rows] if cols else []), *([cols] if rows else []), *([[]] if rows and cols else [])]
        combined = cells.groupingSets([[F.col(c) for c in s] for s in some], *rows, *cols)
        flags = {"is_row_total": rows, "is_column_total": cols}
        table = combined.agg(
            *(_FROM_PARTS[p](f"_{p}").alias(f"_{p}") for p in parts),
            *((F.grouping(of[0]) == 1 if of else F.lit(False)).alias(name) for name, of in flags.items()),
        ).filter(F.col(f"_{parts[0]}").isNotNull())
    else:
        table = cells.withColumns({"is_row_total": F.lit(False), "is_column_total": F.lit(False)})
    scale = getattr(ledger.schema[value].dataType, "scale", 0)
    shown = _printed(agg, {p: f"_{p}" for p in parts}, 0, round_to, scale).alias(value)
    return table.select(*rows, *cols, "is_row_total", "is_column_total", shown)
