"""

Every query runs on the ledger made from the whole order tables (one posting per
``lineitem`` row). Decimals and dates are given out as doubles and texts, so that
both engines' results compare without conversion rules.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import filters, ranking, totals
from ledgerloom.operators.pivot import pivot, pivot_long
from ledgerloom.plans import monthly, overview, pivot_export, properties, structure
from ledgerloom.schema import SOURCE_COLUMNS, TOTAL
from ledgerloom.sources import csv_files, folders, store, workspace

try:  # the operators for training data are a part that can be left out
    import corpus_pipeline
    from ledgerloom.llm import queries as training
except ImportError:
    corpus_pipeline = training = None

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates as texts."""

    def column(i: int, field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(f"c{i}").cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.col(f"c{i}").cast("string").alias(field.name)
        return F.col(f"c{i}").alias(field.name)

    by_place = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return by_place.select(*(column(i, f) for i, f in enumerate(df.schema.fields)))


def _on_ledger(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _plain(report(workspace.ledger(spark, sf_dir)))


# --- CSV: files made from the ledger, read back ---------------------------------


def _messy(ledger: DataFrame) -> DataFrame:
    """The ledger as careless CSV text: float years, thousands separators, null
    tokens, an extra column, and some years, months and amounts that can't be used."""
    text = {ours: theirs for theirs, ours in SOURCE_COLUMNS.items()}
    year, month = F.col("year").cast("string"), F.col("month").cast("string")
    even = F.col("month") % 2 == 0
    bad_year = (F.col("category") == "A-F") & (F.col("month") == 7)
    bad_month = (F.col("category") == "R-O") & F.col("month").isin(2, 7)
    bad_amount = (F.col("org") == "ASIA") & (F.col("month") == 7)
    return ledger.select(
        F.format_number("amount", 2).alias("amount"),
        F.when(bad_amount, F.lit("NA")).alias("no_amount"),
        F.when(bad_month, F.lit("13")).otherwise(month).alias(text["month"]),
        F.when(bad_year, F.lit("x"))
        .when(even, F.concat(year, F.lit(".0")))
        .otherwise(year)
        .alias(text["year"]),
        F.when(F.col("house_type") == "", F.lit("null"))
        .otherwise(F.col("house_type"))
        .alias(text["house_type"]),
        F.concat(F.lit('say "'), "month", F.lit('", ok')).alias("note"),
        *(
            F.col(c).alias(text[c])
            for c in ("shop", "org", "category", "property_id", "lease_end", "lease_start")
        ),
    ).select(
        F.coalesce("no_amount", "amount").alias(text["amount"]),
        *(theirs for ours, theirs in text.items() if ours not in ("amount", "date")),
        "note",
    )


def _written_and_read(spark: SparkSession, ledger: DataFrame) -> DataFrame:
    path = workspace.new_folder(spark, "rows-csv")
    pivot_export.export_rows(ledger, path)
    return _plain(csv_files.accepted(csv_files.parse(csv_files.read_csv(spark, path))))


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written_and_read(spark, workspace.ledger(spark, sf_dir, rollup=False))


def _csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with quotes and line breaks in some addresses."""
    address = F.concat_ws("\n", "property_id", F.concat(F.lit('c/o "'), "shop", F.lit('", 2')))
    shown = F.when(F.col("house_type") == "", address).otherwise(F.col("property_id"))
    ledger = workspace.ledger(spark, sf_dir, rollup=False).withColumn("property_id", shown)
    return _written_and_read(spark, ledger)


def _csv_stray_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inch marks in addresses, line breaks in others and quotes that close too early, as
    a careless program writes them: no quote is doubled."""
    ledger = workspace.ledger(spark, sf_dir, rollup=False)
    kind = F.col("month") % 4
    address = (
        F.when(kind == 1, F.concat("property_id", F.lit(' 5" pipe')))
        .when(kind == 2, F.concat(F.lit('"'), "property_id", F.lit('\n"')))
        .when(kind == 3, F.concat(F.lit('"'), "property_id", F.lit('"x" y')))
        .otherwise(F.col("property_id"))
    )
    rest = [c for c in ledger.columns if c != "property_id"]
    line = F.concat_ws(",", address, *(F.col(c).cast("string") for c in rest))
    text = {ours: theirs for theirs, ours in SOURCE_COLUMNS.items()}
    header = F.lit(",".join(text[c] for c in ["property_id", *rest]) + "\n")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    path = workspace.new_folder(spark, "stray-csv")
    ledger.select(F.when(first, F.concat(header, line)).otherwise(line).alias("value")).write.text(path)
    return _plain(csv_files.accepted(csv_files.parse(csv_files.read_csv(spark, path))))


def _open_quotes(spark: SparkSession, sf_dir: str) -> str:
    """The ledger in CSV files of some 5,000 rows, each begun by a row whose quote is never
    closed, ingested: that row alone is lost."""

    def build() -> str:
        ledger = workspace.ledger(spark, sf_dir, rollup=False)
        source, path = workspace.new_folder(spark, "open-csv"), workspace.new_folder(spark, "open-quotes")
        text = {ours: theirs for theirs, ours in SOURCE_COLUMNS.items()}
        header = ",".join(text[c] for c in ledger.columns) + "\n"
        never_closed = 'never closed,"' + ",".join("x" for _ in ledger.columns[1:]) + "\n"
        line = F.concat_ws(",", *(F.col(c).cast("string") for c in ledger.columns))
        files = max(1, ledger.count() // 5000)
        # A task writes some 64 of the files: one for each would cut a shuffle into pieces
        # whose number grows with the square of the rows, and a plain repartition sorts them.
        tasks = -(-files // 64)
        dealt = ledger.select(line.alias("line"), F.monotonically_increasing_id().alias("at")).repartition(tasks, "at")
        own = F.lit(files // tasks) + F.when(F.spark_partition_id() < files % tasks, 1).otherwise(0)
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        numbered = dealt.select("line", row.alias("row"), own.alias("own")).withColumn("part", F.col("row") % F.col("own"))
        begun = F.col("row") < F.col("own")
        shown = F.when(begun, F.concat(F.lit(header + never_closed), "line")).otherwise(F.col("line"))
        parts = numbered.sortWithinPartitions("part", "row").select(shown.alias("value"), "part")
        parts.write.partitionBy("part").text(source)
        store.ingest(spark, path, source)
        return path

    return workspace.once(spark, sf_dir, "open-quotes", build)


def _csv_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks at the ends of texts, and texts of nothing else."""
    ledger = workspace.ledger(spark, sf_dir, rollup=False).withColumns(
        {
            "shop": F.concat(F.lit("\t"), "shop", F.lit(" ")),
            "property_id": F.concat(F.lit("  "), "property_id"),
            "house_type": F.when(F.col("house_type") == "", F.lit("  ")).otherwise(F.col("house_type")),
        }
    )
    return _written_and_read(spark, ledger)


def _csv_padded_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace.new_folder(spark, "padded-pivot")
    ledger = workspace.ledger(spark, sf_dir).withColumn("shop", F.concat(F.lit(" "), "shop", F.lit("\t")))
    table = pivot(ledger, ["shop"], ["category"], margins=False)
    pivot_export.export_pivot(table, path)
    back = csv_files.read_csv(spark, path)
    return back.select("shop", *(F.col(f"`{c}`").cast("double").alias(c) for c in table.columns[1:]))


def _csv_two_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one folder with two column orders, one with a further column."""
    ledger = workspace.ledger(spark, sf_dir, rollup=False)
    path = workspace.new_folder(spark, "two-orders")
    text = {ours: theirs for theirs, ours in SOURCE_COLUMNS.items()}
    even = F.col("month") % 2 == 0
    csv_files.write_csv(ledger.filter(even), path, text)
    other = ledger.filter(~even).select(*reversed(ledger.columns), F.col("shop").alias("note"))
    csv_files.write_csv(other, path, text, mode="append")
    return _plain(csv_files.accepted(csv_files.parse(csv_files.read_csv(spark, path))))


_EXTRA = {"note.1": "shop", "a`b": "org", "x y": "category", "Year": "month", "SHOP": "org"}


def _csv_extra_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Further columns with dots, backticks, blanks, and names that differ from ours by
    nothing but case: ingested, stored, exported and read again."""
    ledger = workspace.ledger(spark, sf_dir, rollup=False)
    text = {ours: theirs for theirs, ours in SOURCE_COLUMNS.items()}
    given = ledger.select(
        *(F.col(c).cast("string").alias(text[c]) for c in ledger.columns),
        *(F.col(of).cast("string").alias(name) for name, of in _EXTRA.items()),
    )
    source, stored = workspace.new_folder(spark, "extra-csv"), workspace.new_folder(spark, "extra")
    csv_files.write_csv(given, source)
    store.ingest(spark, stored, source)
    folders.drop_folder(spark, source)  # as large as the export, and read by no later step
    path = workspace.new_folder(spark, "extra-rows")
    pivot_export.export_rows(store.read_ledger(spark, stored), path)
    return _plain(csv_files.accepted(csv_files.parse(csv_files.read_csv(spark, path))))


def _extra_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = workspace.ledger(spark, sf_dir)
    more = {name: F.col(of) for name, of in _EXTRA.items() if name.lower() not in ledger.columns}
    return _plain(ranking.preview(ledger.withColumns(more)))


def _amounts(spark: SparkSession, sf_dir: str) -> str:
    """Amounts with misplaced commas and with more decimals than are kept, ingested."""

    def build() -> str:
        ledger = workspace.ledger(spark, sf_dir, rollup=False)
        text = {ours: theirs for theirs, ours in SOURCE_COLUMNS.items()}
        plain = F.col("amount").cast("string")
        shown = (
            F.when(F.col("month") == 3, F.concat(plain, F.lit(",5")))
            .when(F.col("month") == 4, F.concat(plain, F.lit("0000000000000000004")))
            .when(F.col("month") == 5, F.concat(plain, F.lit("000")))
            .when(F.col("month") == 6, F.concat(plain, F.lit("e-1")))
            .otherwise(plain)
        )
        source, path = workspace.new_folder(spark, "amounts-csv"), workspace.new_folder(spark, "amounts")
        csv_files.write_csv(ledger.withColumn("amount", shown), source, text)
        store.ingest(spark, path, source)
        return path

    return workspace.once(spark, sf_dir, "amounts", build)


def _csv_pivot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace.new_folder(spark, "pivot-csv")
    table = pivot(workspace.ledger(spark, sf_dir), ["property_id", "house_type"], ["category"])
    pivot_export.export_pivot(table, path)
    back = csv_files.read_csv(spark, path).select(*(f"`{c}`" for c in table.columns))
    return back.select(
        "property_id",
        F.coalesce("house_type", F.lit("")).alias("house_type"),
        F.col("is_total").cast("boolean").alias("is_total"),
        *(F.col(f"`{c}`").cast("double").alias(c) for c in table.columns[3:]),
    )


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    """Careless CSV files of the whole ledger, ingested: a stored ledger's path."""

    def build() -> str:
        source = workspace.new_folder(spark, "messy-csv")
        path = workspace.new_folder(spark, "ingested")
        csv_files.write_csv(_messy(workspace.ledger(spark, sf_dir, rollup=False)), source)
        store.ingest(spark, path, source)
        return path

    return workspace.once(spark, sf_dir, "ingested", build)


def _ingest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(store.read_ledger(spark, _ingested(spark, sf_dir)))


def _ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.read_rejects(spark, _ingested(spark, sf_dir))


def _ingest_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.read_quality(spark, _ingested(spark, sf_dir))


# --- queries ---------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: organisation and store by category, with totals."""
    return queries()["pivot_sum"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    if training is None:
        return ledger_queries()
    return ledger_queries() | training.queries() | {"pipeline": corpus_pipeline.run}


def ledger_queries() -> dict[str, Query]:
    reports: dict[str, Callable[[DataFrame], DataFrame]] = {
        # selections and option lists
        "latest_period": filters.latest_period,
        "options_org": lambda d: filters.options(d, "org"),
        "options_shop": lambda d: filters.options(d, "shop"),
        "options_category": lambda d: filters.options(d, "category"),
        "options_year": lambda d: filters.options(d, "year"),
        "options_year_desc": lambda d: filters.options(d, "year", descending=True),
        "options_month": lambda d: filters.options(d, "month"),
        "options_month_desc": filters.month_options,
        "options_property_100": filters.property_options,
        "ledger_preview": ranking.preview,
        "filtered_preview": lambda d: ranking.preview(
            pivot_export.chosen(d, org=["ASIA", "EUROPE"], year=[1997, 1999], month=[2, 3, 10])
        ),
        # overview
        "overview_kpis": overview.kpis,
        "overview_cards": overview.cards,
        "org_category_crosstab": overview.org_category,
        "data_range": overview.data_range,
        "income_top5_category": overview.top_income_categories,
        # one month
        "month_kpis": monthly.kpis,
        "month_kpis_1998_03": lambda d: monthly.kpis(d, 1998, 3),
        "month_kpis_latest_of_1996": lambda d: monthly.kpis(d, 1996),
        "month_cards": monthly.cards,
        "category_net": monthly.category_net,
        "income_share": monthly.income_share,
        "expense_share": monthly.expense_share,
        "house_type_summary": monthly.house_types,
        "house_type_table": monthly.house_types_text,
        "gross_by_category": lambda d: totals.gross_by(d, "category"),
        # one year
        "monthly_series": structure.monthly_series,
        "monthly_series_filtered": lambda d: structure.monthly_series(d, 1997, "R-F", "ASIA"),
        "category_net_year": structure.category_net,
        "detail_by_abs_amount": lambda d: structure.detail(d, 1998, "R-O", "EUROPE"),
        "detail_year": structure.detail,
        "detail_head": lambda d: structure.detail(d, 1998, limit=50),
        # properties
        "property_kpis": properties.kpis,
        "property_kpis_filtered": lambda d: properties.kpis(d, 1997, category="A-O"),
        "property_cards": properties.cards,
        "property_income_top10": properties.top_income,
        "property_expense_top10": properties.top_expense,
        "property_detail": lambda d: properties.detail(d, 1999, category="R-F"),
        "property_one": lambda d: properties.detail(d, 1998, "Customer#000000007"),
        # pivot
        **{
            f"pivot_{agg}": lambda d, agg=agg: pivot(d, ["org", "shop"], ["category"], agg=agg)
            for agg in ("sum", "mean", "count", "max", "min")
        },
        "pivot_property": pivot,
        "pivot_rows_only": lambda d: pivot(d, ["house_type", "org"], []),
        "pivot_cols_only": lambda d: pivot(d, [], ["category"]),
        "pivot_two_level": lambda d: pivot(d, ["org"], ["category", "year"]),
        "pivot_two_level_mean": lambda d: pivot(d, ["house_type"], ["year", "category"], agg="mean"),
        "pivot_filtered": lambda d: pivot(
            pivot_export.chosen(d, org=["ASIA", "AMERICA"], year=[1996, 1998], month=[1, 2, 10]),
            ["shop"],
            ["month", "year"],
            agg="min",
        ),
        "pivot_property_wide": lambda d: pivot(d, ["property_id"], ["category", "year"]),
        "pivot_count_fill": lambda d: pivot(d, ["shop"], ["category", "year"], agg="count", fill=-1),
        "pivot_property_count_fill": lambda d: pivot(
            d, ["property_id"], ["category"], agg="count", fill=-1
        ),
        "pivot_long_mean": lambda d: pivot_long(d, ["org"], ["category", "year"], agg="mean"),
        "pivot_long_property": lambda d: pivot_long(d, ["property_id"], ["category", "month"]),
        # a month, a year and a selection without rows
        "empty_month_kpis": lambda d: monthly.kpis(d, 1990, 1),
        "empty_income_share": lambda d: monthly.income_share(d, 1990, 1),
        "empty_series": lambda d: structure.monthly_series(d, 1990),
        "empty_top10": lambda d: properties.top_income(d, 1990),
        "empty_property_kpis": lambda d: properties.kpis(d, 1990),
        "empty_pivot": lambda d: pivot(pivot_export.chosen(d, year=[1990]), ["org"], ["category"]),
        "rows_export": lambda d: pivot_export.chosen(d, org=["AFRICA"], month=[2, 11]),
        # ingest of clean text rows, without files
        "ledger_normalised": lambda d: csv_files.accepted(csv_files.parse(_messy(d))),
    }
    return {name: _on_ledger(report) for name, report in reports.items()} | {
        "csv_roundtrip": _csv_roundtrip,
        "csv_line_breaks": _csv_line_breaks,
        "csv_stray_quotes": _csv_stray_quotes,
        "open_quotes_rows": lambda s, d: _plain(store.read_ledger(s, _open_quotes(s, d))),
        "open_quotes_rejects": lambda s, d: store.read_rejects(s, _open_quotes(s, d)).select("property_id", "reject_reason"),
        "open_quotes_quality": lambda s, d: store.read_quality(s, _open_quotes(s, d)),
        "csv_padded": _csv_padded,
        "csv_padded_pivot": _csv_padded_pivot,
        "csv_two_orders": _csv_two_orders,
        "csv_extra_columns": _csv_extra_columns,
        "extra_preview": _extra_preview,
        "amounts_quality": lambda s, d: store.read_quality(s, _amounts(s, d)),
        "amounts_rejects": lambda s, d: store.read_rejects(s, _amounts(s, d)),
        "amounts_rounded": lambda s, d: _plain(store.read_rounded(s, _amounts(s, d))),
        "csv_pivot_roundtrip": _csv_pivot_roundtrip,
        "ingest_rows": _ingest_rows,
        "ingest_rejects": _ingest_rejects,
        "ingest_quality": _ingest_quality,
    }


# --- the same in DuckDB SQL --------------------------------------------------------

_LEDGER = """
WITH leases AS (
  SELECT o_custkey AS custkey,
         CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS lease_start,
         CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS lease_end
  FROM orders GROUP BY o_custkey
), ledger AS (
  SELECT c_name AS property_id,
         CASE WHEN c_custkey % 50 = 0 THEN '' ELSE c_mktsegment END AS house_type,
         lease_start, lease_end,
         r_name AS org, n_name AS shop,
         concat(l_returnflag, '-', l_linestatus) AS category,
         CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(month(l_shipdate) AS INTEGER) AS month,
         CAST(CASE WHEN (l_returnflag = 'R') <> (l_linenumber = 7)
                   THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(18,2)) AS amount,
         CAST(make_date(year(l_shipdate), month(l_shipdate), 1) AS VARCHAR) AS date
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN leases ON o_custkey = custkey
)"""

_CATEGORIES = ["A-F", "A-O", "N-F", "N-O", "R-F", "R-O"]
_YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]
_LAST_MONTH = "year * 100 + month = (SELECT max(year * 100 + month) FROM ledger)"
_LAST_YEAR = "year = (SELECT max(year) FROM ledger)"
_INCOME = "CAST(coalesce(sum(CASE WHEN amount > 0 THEN amount END), 0) AS DOUBLE)"
_EXPENSE = "CAST(abs(coalesce(sum(CASE WHEN amount < 0 THEN amount END), 0)) AS DOUBLE)"
_ROW = (
    "property_id, house_type, lease_start, lease_end, org, shop, category, year, month, "
    "CAST(amount AS DOUBLE) AS amount, date"
)
_DETAIL = "property_id, org, shop, category, month, CAST(amount AS DOUBLE) AS amount"


def _shown(value: str, text: bool, mark: str = "") -> str:
    return f"printf('%.2f{mark}', {value})" if text else value


def _month_kpis(period: str, text: bool = False) -> str:
    ratio = "CASE WHEN inc > 0 THEN exp / inc * 100.0 ELSE 0.0 END"
    return f""", nets AS (
  SELECT category, sum(amount) AS net FROM ledger WHERE {period} GROUP BY category
), sums AS (
  SELECT CAST(coalesce(sum(CASE WHEN net > 0 THEN net END), 0) AS DOUBLE) / 10000 AS inc,
         CAST(abs(coalesce(sum(CASE WHEN net < 0 THEN net END), 0)) AS DOUBLE) / 10000 AS exp
  FROM nets
)
SELECT {_shown("inc", text)} AS net_basis_income_10k,
       {_shown("exp", text)} AS net_basis_expense_10k,
       {_shown("inc - exp", text)} AS net_10k,
       CASE WHEN inc - exp > 0 THEN 'normal' ELSE 'inverse' END AS net_flag,
       {_shown(ratio, text, "%%")} AS expense_income_pct
FROM sums"""


def _share(sign: str) -> str:
    return f""", nets AS (
  SELECT category, abs(sum(amount)) AS net FROM ledger WHERE {_LAST_MONTH}
  GROUP BY category HAVING sum(amount) {sign} 0
)
SELECT category, CAST(net AS DOUBLE) / 10000 AS amount_10k,
       CAST(net AS DOUBLE) / CAST((SELECT sum(net) FROM nets) AS DOUBLE) AS share
FROM nets"""


def _house_types(text: bool) -> str:
    net = "CAST(sum(amount) AS DOUBLE) / 10000"
    return f"""SELECT house_type,
  {_shown(f"{_INCOME} / 10000", text)} AS gross_income_10k,
  {_shown(f"{_EXPENSE} / 10000", text)} AS gross_expense_10k,
  {_shown(net, text)} AS net_10k
FROM ledger WHERE {_LAST_MONTH} AND house_type <> '' GROUP BY house_type"""


def _property_kpis(where: str, text: bool = False) -> str:
    average = "CASE WHEN active > 0 THEN inc / active ELSE 0.0 END"
    return f""", sums AS (
  SELECT count(DISTINCT property_id) AS active, {_INCOME} / 10000 AS inc
  FROM ledger WHERE {where}
)
SELECT active AS active_properties, {_shown("inc", text)} AS gross_income_10k,
       {_shown(average, text)} AS income_per_property_10k,
       (SELECT count(DISTINCT property_id) FROM ledger) AS all_properties
FROM sums"""


def _cell(agg: str, where: str = "") -> str:
    """One pivot cell; a mean is rounded half to even in whole cents."""
    only = f" FILTER (WHERE {where})" if where else ""
    if agg == "count":
        return f"count(*){only}"
    if agg != "mean":
        return f"CAST(coalesce({agg}(amount){only}, 0) AS DOUBLE)"
    cents = f"CAST(coalesce(sum(amount){only}, 0) * 100 AS HUGEINT)"
    n = f"greatest(count(*){only}, 1)"
    up = f"2 * (abs({cents}) % {n}) + (abs({cents}) // {n}) % 2 > {n}"
    rounded = f"(abs({cents}) // {n} + CASE WHEN {up} THEN 1 ELSE 0 END)"
    return f"CAST(sign({cents}) * {rounded} AS DOUBLE) / 100"


def _pivot(rows: list[str], cols: dict[str, str], agg: str = "sum", where: str = "true") -> str:
    """``cols`` maps a column name to its condition; the total column comes last."""
    cells = [f'{_cell(agg, test)} AS "{name}"' for name, test in cols.items()]
    cells.append(f'{_cell(agg)} AS "{TOTAL}"')
    shown = ", ".join(cells)
    labels = [f"'{TOTAL if i == 0 else ''}' AS {r}" for i, r in enumerate(rows)]
    total = f"SELECT {', '.join([*labels, 'true AS is_total'])}, {shown} FROM ledger WHERE {where}"
    if not rows:
        return total
    keys = ", ".join(rows)
    return (
        f"SELECT {keys}, false AS is_total, {shown} FROM ledger WHERE {where} GROUP BY {keys} "
        f"UNION ALL {total}"
    )


def _filled(sql: str, cols: dict[str, str]) -> str:
    """Counts of 0 shown as -1."""
    shown = ", ".join(f'CASE WHEN "{c}" = 0 THEN -1 ELSE "{c}" END AS "{c}"' for c in cols)
    return f"SELECT * REPLACE ({shown}) FROM ({sql})"


def _long(rows: list[str], cols: list[str], agg: str) -> str:
    keys, across = ", ".join([*rows, *cols]), ", ".join(cols)
    return f"""SELECT {keys}, grouping({rows[0]}) = 1 AS is_row_total,
        grouping({cols[0]}) = 1 AS is_column_total, {_cell(agg)} AS amount
        FROM ledger GROUP BY GROUPING SETS (({keys}), ({", ".join(rows)}), ({across}), ())"""


def oracle_sql() -> dict[str, str]:
    if training is None:
        return ledger_sql()
    own = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return ledger_sql() | training.oracle_sql() | own


def ledger_sql() -> dict[str, str]:
    by_category = {c: f"category = '{c}'" for c in _CATEGORIES}
    category_year = {
        f"{c}|{y}": f"category = '{c}' AND year = {y}" for c in _CATEGORIES for y in _YEARS
    }
    year_category = {
        f"{y}|{c}": f"category = '{c}' AND year = {y}" for c in _CATEGORIES for y in _YEARS
    }
    month_year = {
        f"{m}|{y}": f"month = {m} AND year = {y}" for m in (1, 2, 10) for y in (1996, 1998)
    }
    crosstab = ", ".join(
        f"CAST(coalesce(sum(amount) FILTER (WHERE {test}), 0) AS DOUBLE) / 10000 AS \"{c}\""
        for c, test in by_category.items()
    )
    overview_kpis = f"""SELECT max(year) AS year, max(month) AS month,
  {_INCOME} / 10000 AS gross_income_10k, {_EXPENSE} / 10000 AS gross_expense_10k,
  {_INCOME} / 10000 - {_EXPENSE} / 10000 AS net_10k,
  CASE WHEN {_INCOME} / 10000 - {_EXPENSE} / 10000 > 0 THEN 'normal' ELSE 'inverse' END AS net_flag,
  (SELECT count(*) FROM ledger) AS records
FROM ledger WHERE {_LAST_MONTH}"""
    bad_year = "(category = 'A-F' AND month = 7)"
    bad_month = "(category = 'R-O' AND month IN (2, 7))"
    bad_amount = "(org = 'ASIA' AND month = 7)"
    good = f"NOT {bad_year} AND NOT {bad_month} AND NOT {bad_amount}"
    note = "concat('say \"', month, '\", ok') AS note"

    sql = {
        "latest_period": """SELECT CAST(max(year * 100 + month) // 100 AS INTEGER) AS year,
            CAST(max(year * 100 + month) % 100 AS INTEGER) AS month FROM ledger""",
        "options_org": "SELECT DISTINCT org FROM ledger",
        "options_shop": "SELECT DISTINCT shop FROM ledger",
        "options_category": "SELECT DISTINCT category FROM ledger",
        "options_year": "SELECT DISTINCT year FROM ledger",
        "options_year_desc": "SELECT DISTINCT year FROM ledger ORDER BY year DESC",
        "options_month": "SELECT DISTINCT month FROM ledger",
        "options_month_desc": f"SELECT DISTINCT month FROM ledger WHERE {_LAST_YEAR}",
        "options_property_100": (
            "SELECT DISTINCT property_id FROM ledger ORDER BY property_id LIMIT 100"
        ),
        "ledger_preview": f"""SELECT {_ROW} FROM ledger ORDER BY year, month, property_id,
            house_type, lease_start, lease_end, org, shop, category, ledger.amount LIMIT 20""",
        "filtered_preview": f"""SELECT {_ROW} FROM ledger
            WHERE org IN ('ASIA', 'EUROPE') AND year IN (1997, 1999) AND month IN (2, 3, 10)
            ORDER BY year, month, property_id, house_type, lease_start, lease_end, org, shop,
            category, ledger.amount LIMIT 20""",
        "overview_kpis": overview_kpis,
        "overview_cards": f""", kpis AS ({overview_kpis})
            SELECT year, month, printf('%.2f', gross_income_10k) AS gross_income_10k,
            printf('%.2f', gross_expense_10k) AS gross_expense_10k,
            printf('%.2f', net_10k) AS net_10k, net_flag,
            format('{{:,}}', records) AS records FROM kpis""",
        "org_category_crosstab": f"SELECT org, {crosstab} FROM ledger GROUP BY org",
        "data_range": """SELECT min(year) AS first_year, max(year) AS last_year,
            count(DISTINCT org) AS orgs, count(DISTINCT shop) AS shops,
            count(DISTINCT house_type) AS house_types, count(DISTINCT category) AS categories,
            count(DISTINCT property_id) AS properties FROM ledger""",
        "income_top5_category": """SELECT category,
            CAST(sum(amount) AS DOUBLE) / 10000 AS income_10k FROM ledger WHERE amount > 0
            GROUP BY category ORDER BY sum(amount) DESC, category LIMIT 5""",
        "month_kpis": _month_kpis(_LAST_MONTH),
        "month_kpis_1998_03": _month_kpis("year = 1998 AND month = 3"),
        "month_kpis_latest_of_1996": _month_kpis(
            "year = 1996 AND month = (SELECT max(month) FROM ledger WHERE year = 1996)"
        ),
        "month_cards": _month_kpis(_LAST_MONTH, text=True),
        "category_net": f"""SELECT category,
            CASE WHEN sum(amount) > 0 THEN 'income' ELSE 'expense' END AS kind,
            CAST(sum(amount) AS DOUBLE) / 10000 AS net_10k
            FROM ledger WHERE {_LAST_MONTH} GROUP BY category""",
        "income_share": _share(">"),
        "expense_share": _share("<"),
        "house_type_summary": _house_types(text=False),
        "house_type_table": _house_types(text=True),
        "gross_by_category": f"""SELECT category, {_INCOME} AS gross_income,
            {_EXPENSE} AS gross_expense, CAST(sum(amount) AS DOUBLE) AS net
            FROM ledger GROUP BY category""",
        "monthly_series": f"""SELECT month, CAST(sum(amount) AS DOUBLE) / 10000 AS net_10k
            FROM ledger WHERE {_LAST_YEAR} GROUP BY month""",
        "monthly_series_filtered": """SELECT month, CAST(sum(amount) AS DOUBLE) / 10000 AS net_10k
            FROM ledger WHERE year = 1997 AND category = 'R-F' AND org = 'ASIA' GROUP BY month""",
        "category_net_year": f"""SELECT category, CAST(sum(amount) AS DOUBLE) / 10000 AS net_10k
            FROM ledger WHERE {_LAST_YEAR} GROUP BY category""",
        "detail_by_abs_amount": f"""SELECT {_DETAIL} FROM ledger
            WHERE year = 1998 AND category = 'R-O' AND org = 'EUROPE'""",
        "detail_year": f"SELECT {_DETAIL} FROM ledger WHERE {_LAST_YEAR}",
        "detail_head": f"""SELECT {_DETAIL} FROM ledger WHERE year = 1998
            ORDER BY abs(ledger.amount) DESC, property_id, org, shop, category, month,
            ledger.amount LIMIT 50""",
        "property_kpis": _property_kpis(_LAST_YEAR),
        "property_kpis_filtered": _property_kpis("year = 1997 AND category = 'A-O'"),
        "property_cards": _property_kpis(_LAST_YEAR, text=True),
        "property_income_top10": f"""SELECT property_id,
            CAST(sum(amount) AS DOUBLE) / 10000 AS income_10k FROM ledger
            WHERE {_LAST_YEAR} AND amount > 0 GROUP BY property_id
            ORDER BY sum(amount) DESC, property_id LIMIT 10""",
        "property_expense_top10": f"""SELECT property_id,
            CAST(abs(sum(amount)) AS DOUBLE) / 10000 AS expense_10k FROM ledger
            WHERE {_LAST_YEAR} AND amount < 0 GROUP BY property_id
            ORDER BY abs(sum(amount)) DESC, property_id LIMIT 10""",
        "property_detail": f"SELECT {_DETAIL} FROM ledger WHERE year = 1999 AND category = 'R-F'",
        "property_one": f"""SELECT {_DETAIL} FROM ledger
            WHERE year = 1998 AND property_id = 'Customer#000000007'""",
        **{
            f"pivot_{agg}": _pivot(["org", "shop"], by_category, agg)
            for agg in ("sum", "mean", "count", "max", "min")
        },
        "pivot_property": _pivot(["property_id", "house_type"], by_category),
        "pivot_rows_only": _pivot(["house_type", "org"], {}),
        "pivot_cols_only": _pivot([], by_category),
        "pivot_two_level": _pivot(["org"], category_year),
        "pivot_two_level_mean": _pivot(["house_type"], year_category, "mean"),
        "pivot_filtered": _pivot(
            ["shop"],
            month_year,
            "min",
            "org IN ('ASIA', 'AMERICA') AND year IN (1996, 1998) AND month IN (1, 2, 10)",
        ),
        "pivot_property_wide": _pivot(["property_id"], category_year),
        "pivot_count_fill": _filled(_pivot(["shop"], category_year, "count"), category_year),
        "pivot_property_count_fill": _filled(_pivot(["property_id"], by_category, "count"), by_category),
        "pivot_long_mean": _long(["org"], ["category", "year"], "mean"),
        "pivot_long_property": _long(["property_id"], ["category", "month"], "sum"),
        "empty_month_kpis": _month_kpis("year = 1990 AND month = 1"),
        "empty_income_share": _share(">").replace(_LAST_MONTH, "false"),
        "empty_series": """SELECT month, CAST(sum(amount) AS DOUBLE) / 10000 AS net_10k
            FROM ledger WHERE false GROUP BY month""",
        "empty_top10": """SELECT property_id, CAST(sum(amount) AS DOUBLE) / 10000 AS income_10k
            FROM ledger WHERE false GROUP BY property_id""",
        "empty_property_kpis": _property_kpis("year = 1990"),
        "empty_pivot": f"""SELECT org, false AS is_total, CAST(sum(amount) AS DOUBLE) AS "{TOTAL}"
            FROM ledger WHERE false GROUP BY org""",
        "rows_export": f"SELECT {_ROW} FROM ledger WHERE org IN ('AFRICA') AND month IN (2, 11)",
        "ledger_normalised": f"SELECT {_ROW}, {note} FROM ledger WHERE {good}",
        "csv_roundtrip": f"SELECT {_ROW} FROM ledger",
        "csv_line_breaks": f"""SELECT * REPLACE (CASE WHEN house_type = ''
            THEN concat(property_id, chr(10), 'c/o "', shop, '", 2')
            ELSE property_id END AS property_id) FROM (SELECT {_ROW} FROM ledger)""",
        "csv_stray_quotes": f"""SELECT * REPLACE (CASE month % 4
            WHEN 1 THEN concat(property_id, ' 5" pipe') WHEN 2 THEN concat(property_id, chr(10))
            WHEN 3 THEN concat('"', property_id, '"x" y') ELSE property_id END AS property_id)
            FROM (SELECT {_ROW} FROM ledger)""",
        "open_quotes_rows": f"SELECT {_ROW} FROM ledger",
        "open_quotes_rejects": """SELECT 'never closed' AS property_id, 'year,month,amount' AS reject_reason
            FROM range((SELECT greatest(1, count(*) // 5000) FROM ledger))""",
        "open_quotes_quality": """SELECT n + files AS input_rows, n AS accepted_rows, files AS rejected_rows,
            files AS bad_year, files AS bad_month, files AS bad_amount, CAST(0 AS BIGINT) AS bad_columns,
            CAST(0 AS BIGINT) AS over_precise_rows
            FROM (SELECT count(*) AS n, greatest(1, count(*) // 5000) AS files FROM ledger)""",
        "csv_padded": f"""SELECT * REPLACE (concat('  ', property_id) AS property_id,
            concat(chr(9), shop, ' ') AS shop,
            CASE WHEN house_type = '' THEN '  ' ELSE house_type END AS house_type)
            FROM (SELECT {_ROW} FROM ledger)""",
        "csv_padded_pivot": f"""SELECT concat(' ', shop, chr(9)) AS shop, {crosstab.replace(" / 10000", "")}
            FROM ledger GROUP BY ALL""",
        "csv_two_orders": f"""SELECT *, CASE WHEN month % 2 = 0 THEN '' ELSE shop END AS note
            FROM (SELECT {_ROW} FROM ledger)""",
        "csv_extra_columns": f"""SELECT {_ROW}, shop AS "note.1", org AS "a`b", category AS "x y",
            CAST(month AS VARCHAR) AS "Year_2", org AS "SHOP_2" FROM ledger""",
        "extra_preview": f"""SELECT *, shop AS "note.1", org AS "a`b", category AS "x y" FROM (
            SELECT {_ROW} FROM ledger ORDER BY year, month, property_id, house_type, lease_start,
            lease_end, org, shop, category, ledger.amount LIMIT 20)""",
        "amounts_quality": """SELECT count(*) AS input_rows,
            count(*) FILTER (WHERE month <> 3) AS accepted_rows,
            count(*) FILTER (WHERE month = 3) AS rejected_rows,
            CAST(0 AS BIGINT) AS bad_year, CAST(0 AS BIGINT) AS bad_month,
            count(*) FILTER (WHERE month = 3) AS bad_amount, CAST(0 AS BIGINT) AS bad_columns,
            count(*) FILTER (WHERE month = 4 OR month = 6 AND abs(amount * 100) % 10 <> 0)
              AS over_precise_rows FROM ledger""",
        "amounts_rejects": """SELECT property_id, house_type, lease_start, lease_end, org, shop,
            category, 'amount' AS reject_reason, CAST(year AS VARCHAR) AS year_text,
            CAST(month AS VARCHAR) AS month_text, concat(amount, ',5') AS amount_text
            FROM ledger WHERE month = 3""",
        "amounts_rounded": f"""SELECT * EXCLUDE (cents) REPLACE (coalesce(cents / 100, amount) AS amount)
            FROM (SELECT {_ROW},
              concat(ledger.amount, CASE WHEN month = 4 THEN '0000000000000000004' ELSE 'e-1' END) AS amount_text,
              CASE WHEN month = 6 THEN sign(ledger.amount)
                * CAST(floor(abs(ledger.amount) * 10 + 0.5) AS DOUBLE) END AS cents
              FROM ledger WHERE month = 4 OR month = 6 AND abs(ledger.amount * 100) % 10 <> 0)""",
        "csv_pivot_roundtrip": _pivot(["property_id", "house_type"], by_category),
        "ingest_rows": f"SELECT {_ROW}, {note} FROM ledger WHERE {good}",
        "ingest_rejects": f"""SELECT property_id, house_type, lease_start, lease_end, org, shop,
            category, {note},
            concat_ws(',', CASE WHEN {bad_year} THEN 'year' END,
              CASE WHEN {bad_month} THEN 'month' END,
              CASE WHEN {bad_amount} THEN 'amount' END) AS reject_reason,
            CASE WHEN {bad_year} THEN 'x' WHEN month % 2 = 0 THEN concat(year, '.0')
              ELSE CAST(year AS VARCHAR) END AS year_text,
            CASE WHEN {bad_month} THEN '13' ELSE CAST(month AS VARCHAR) END AS month_text,
            CASE WHEN {bad_amount} THEN 'NA' ELSE format('{{:,.2f}}', CAST(amount AS DOUBLE)) END
              AS amount_text
            FROM ledger WHERE NOT ({good})""",
        "ingest_quality": f"""SELECT count(*) AS input_rows,
            count(*) FILTER (WHERE {good}) AS accepted_rows,
            count(*) FILTER (WHERE NOT ({good})) AS rejected_rows,
            count(*) FILTER (WHERE {bad_year}) AS bad_year,
            count(*) FILTER (WHERE {bad_month}) AS bad_month,
            count(*) FILTER (WHERE {bad_amount}) AS bad_amount,
            CAST(0 AS BIGINT) AS bad_columns, CAST(0 AS BIGINT) AS over_precise_rows
            FROM ledger""",
    }
    return {name: f"{_LEDGER}\n{query}" for name, query in sql.items()}
