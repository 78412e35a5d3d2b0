"""What has to hold when the ledger is large: plan shapes, skew, hot groups."""

import datetime
import time
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom.operators import filters, ranking
from ledgerloom.operators.pivot import pivot
from ledgerloom.plans import monthly, overview, pivot_export, properties, structure
from ledgerloom.schema import LEDGER_SCHEMA
from ledgerloom.sources import folders, order_tables, store, workspace
from tests.compare import connect, difference
from tests.conftest import TOY_ROWS, make_ledger

SMALL = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def final_plan(df):
    """The plan as it ran, after all run-time changes."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    explain = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString
    return explain(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(entry.ledger_queries()))
def test_no_pairwise_join_and_no_python(spark, name):
    plan = formatted(entry.ledger_queries()[name](spark, SMALL))
    for bad in ("CartesianProduct", "NestedLoop", "PythonUDF", "EvalPython", "InPandas"):
        assert bad not in plan, plan


def test_every_query_has_its_sql():
    assert entry.ledger_queries().keys() == entry.ledger_sql().keys()


def scans(df):
    """Partition filter and columns of every scan."""
    text = formatted(df)
    blocks = text.split("Scan parquet")[1:]
    return [
        {
            line.split(":")[0].strip(): line.split(":", 1)[1].strip()
            for line in block.splitlines()
            if line.startswith(("PartitionFilters", "ReadSchema"))
        }
        for block in blocks
        if "ReadSchema" in block
    ]


def test_latest_month_is_pruned_and_found_without_columns(stored):
    main, *subqueries = scans(filters.at_period(stored).select("amount"))
    assert "year" in main["PartitionFilters"] and "month" in main["PartitionFilters"]
    assert main["ReadSchema"] == "struct<amount:decimal(18,2)>"
    assert subqueries and all(s["ReadSchema"] == "struct<year:int,month:int>" for s in subqueries)


@pytest.fixture
def plain(stored):
    """The stored ledger without its roll-up."""
    return filters.with_periods(stored.select("*"), filters.stored_periods(stored))


def test_year_reports_prune_and_read_few_columns(plain):
    stored = plain
    for s in scans(structure.monthly_series(stored, 1998)):
        assert "year" in s["PartitionFilters"]
        assert s["ReadSchema"] == "struct<amount:decimal(18,2)>"
    for s in scans(properties.top_income(stored, 1998)):
        assert s["ReadSchema"] == "struct<property_id:string,amount:decimal(18,2)>"


def test_pruning_does_not_wait_for_the_distinct_count(plain):
    stored = plain
    schemas = [s["ReadSchema"] for s in scans(properties.kpis(stored))]
    assert sorted(set(schemas)) == [
        "struct<property_id:string,amount:decimal(18,2)>",
        "struct<property_id:string>",
        "struct<year:int>",
    ]


def test_whole_ledger_counts_read_no_amount(plain):
    stored = plain
    schemas = [s["ReadSchema"] for s in scans(overview.data_range(stored))]
    assert sorted(set(schemas)) == [
        "struct<house_type:string,org:string,shop:string,category:string>",
        "struct<property_id:string>",
    ]


def test_preview_reads_wide_rows_of_early_months_only(stored):
    wide, *counts = scans(ranking.preview(stored))
    assert "Subquery" in wide["PartitionFilters"]
    assert counts and all(c["ReadSchema"] == "struct<year:int,month:int,rows:bigint>" for c in counts)


def test_top_k_is_no_full_sort(stored):
    for df in (
        overview.top_income_categories(stored),
        properties.top_income(stored),
        structure.detail(stored, limit=5),
        filters.property_options(stored),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("one_shuffle", [True, False])
def test_pivot_totals_reuse_the_cells(stored, one_shuffle):
    plan = final_plan(pivot(stored, ["property_id"], ["category"], one_shuffle=one_shuffle))
    assert "ReusedExchange" in plan.split("Initial Plan")[0]


def test_direct_pivot_shuffles_cells_once(stored):
    plan = pivot(stored, ["property_id"], ["category"], margins=False, ordered=False)
    assert final_plan(plan).split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_shares_reuse_the_nets(stored):
    df = monthly.income_share(stored)
    df.collect()
    assert "ReusedExchange" in formatted(df)


# hot groups


def test_copies_of_one_row_are_sorted_by_many_tasks(spark, tmp_path):
    """Half of all rows are the same: their run must not be one task's."""
    path = str(tmp_path / "ledger")
    copies = make_ledger(spark, TOY_ROWS[:1]).crossJoin(spark.range(40_000)).drop("id")
    others = copies.withColumn("amount", F.rand(1).cast("decimal(18,2)") * 10_000)
    store.write_ledger(copies.union(others.select(copies.columns)), path)
    with settings(
        spark,
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__sql__files__maxPartitionBytes="20000",
    ):
        ordered = structure.detail(store.read_ledger(spark, path))
        sizes = [
            r.n
            for r in ordered.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
        ]
        found = [r.amount for r in ordered.collect()]
    assert sum(sizes) == len(found) == 80_000
    assert max(sizes) < 25_000, sizes
    assert found == sorted(found, reverse=True)


def test_a_hot_month_is_stored_as_many_files(spark, tmp_path):
    path = tmp_path / "ledger"
    hot = make_ledger(spark, TOY_ROWS[:1]).crossJoin(spark.range(60_000))
    hot = hot.withColumn("property_id", F.col("id").cast("string")).drop("id")
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="100000"):
        store.write_ledger(hot.repartition(8).union(make_ledger(spark, TOY_ROWS)), str(path))
    files = {m.name: len(list(m.glob("*.parquet"))) for m in (path / "year=2024").iterdir()}
    assert files["month=2"] > 3 and files["month=10"] == 1, files
    assert store.read_ledger(spark, str(path)).count() == 60_009


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Order tables where one customer has a third of the orders, one order a third
    of the lines, one month a third of the postings."""
    folder = tmp_path_factory.mktemp("skewed")
    source = "/root/testdata/sf0.01"

    def third(column):
        return F.pmod(F.xxhash64(column, F.lit(7)), F.lit(3)) == 0

    orders = spark.read.parquet(f"{source}/orders.parquet")
    lines = spark.read.parquet(f"{source}/lineitem.parquet")
    customer = F.when(third("o_orderkey"), F.lit(7).cast("bigint")).otherwise(F.col("o_custkey"))
    first = orders.agg(F.min("o_orderkey")).first()[0]
    order = F.when(third("l_extendedprice"), F.lit(first)).otherwise(F.col("l_orderkey"))
    shipped = F.when(third("l_quantity"), F.lit("2001-11-05").cast("timestamp_ntz"))
    tables = {
        "orders": orders.withColumn("o_custkey", customer),
        "lineitem": lines.withColumn("l_orderkey", order).withColumn(
            "l_shipdate", F.coalesce(shipped, "l_shipdate")
        ),
    }
    for name in ("customer", "nation", "region"):
        tables[name] = spark.read.parquet(f"{source}/{name}.parquet")
    for name, df in tables.items():
        df.repartition(8).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


def test_hot_customer_and_hot_order_are_split(spark, skewed, tmp_path):
    path = str(tmp_path / "properties")
    order_tables.properties(spark, skewed).write.parquet(path)
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4000",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="6000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__files__maxPartitionBytes="30000",
        spark__sql__files__openCostInBytes="1000",
        spark__sql__shuffle__partitions="16",
    ):
        postings = order_tables.postings(spark, skewed, spark.read.parquet(path))
        plan = final_plan(postings).split("Initial Plan")[0]
        assert plan.count("SortMergeJoin(skew=true)") == 2, plan
        assert postings.count() == 60_000


@pytest.mark.parametrize(
    "name",
    [
        "overview_kpis",
        "data_range",
        "month_kpis",
        "income_share",
        "house_type_summary",
        "detail_year",
        "property_kpis",
        "property_income_top10",
        "pivot_property",
        "pivot_mean",
        "ledger_preview",
    ],
)
def test_skewed_results(spark, skewed, name):
    con = connect(skewed, "/*.parquet")
    assert difference(entry.ledger_queries()[name](spark, skewed), con, entry.ledger_sql()[name]) is None


def test_changed_tables_are_read_again(spark, tmp_path):
    def write(rows):
        for name in ("orders", "customer", "nation", "region"):
            df = spark.read.parquet(f"{SMALL}/{name}.parquet")
            df.write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
        lines.limit(rows).write.mode("overwrite").parquet(str(tmp_path / "lineitem.parquet"))

    write(10)
    assert workspace.ledger(spark, str(tmp_path)).count() == 10
    write(20)
    assert workspace.ledger(spark, str(tmp_path)).count() == 20


def test_tables_go_to_the_named_shared_folder(spark):
    assert folders.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert folders.new_folder(spark, "x").startswith(folders.shared_folder(spark))


def test_finding_a_month_opens_no_file_of_the_ledger(stored):
    """The stored ledger's table of periods tells the latest month, options and counts."""
    from ledgerloom.operators import filters, ranking

    def files(df):
        return {f.rsplit("/", 2)[-2] for f in df.inputFiles()}

    for df in (filters.latest_period(stored), filters.options(stored, "year"), filters.month_options(stored)):
        assert files(df) == {"_periods"}
    counted = filters.period_rows(stored).agg({"rows": "sum"})
    assert files(counted) == {"_periods"} and counted.first()[0] == stored.count()
    assert filters.stored_periods(stored.filter("year = 1997")) is None
    plan = ranking.preview(stored)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and "rows#" in plan


def test_a_second_ingest_has_its_own_periods(spark, toy, tmp_path):
    from ledgerloom.operators import filters
    from ledgerloom.sources import store

    for name, rows in (("a", toy), ("b", toy.filter("year = 2023"))):
        store.write_ledger(rows, str(tmp_path / name))
    first, second = (store.read_ledger(spark, str(tmp_path / name)) for name in "ab")
    assert tuple(filters.latest_period(first).first()) == (2024, 10)
    assert tuple(filters.latest_period(second).first()) == (2023, 12)


def test_positions_are_sort_keys_of_rows_from_files_only(stored):
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "_position" in plan(ranking.largest_first(filters.at_year(stored, 1997)))
    shuffled = stored.repartition(3)
    assert "_position" not in plan(ranking.largest_first(shuffled))
    assert ranking.largest_first(shuffled).count() == stored.count()


def test_texts_are_shuffled_by_month_as_one_and_come_back(spark, toy):
    odd = ["", "a", "\x01", "\x02", "\x02n", "\x02a\x01b", "\x02\x02", None, "单元 1"]
    given = [(y, t, odd[-i], None, t, None) for i, t in enumerate(odd) for y in (2020, None)]
    names = ["year", "shop", "a`b.c", "month", "Shop 2", "note"]
    rows = spark.createDataFrame(given, "y int, a string, b string, m int, c string, d string").toDF(*names)
    bytes_of = F.when(F.col("shop") == "a", F.unhex(F.lit("ff80"))).cast("string")  # no UTF-8
    rows = rows.withColumn("note", bytes_of)

    def told(df):
        return sorted(str(tuple(r)) for r in df.select(*(F.hex(F.col(f"`{c.replace('`', '``')}`").cast("binary")) if t == "string" else F.col(c) for c, t in df.dtypes)).collect())

    back = store.by_month(rows)
    assert back.columns == names and told(back) == told(rows)
    plan = store.by_month(toy)._jdf.queryExecution().optimizedPlan()
    while "RebalancePartitions" not in plan.nodeName():
        plan = plan.children().head()
    shuffled = [f.dataType().simpleString() for f in (plan.schema().apply(i) for i in range(plan.schema().length()))]
    assert shuffled.count("string") == 1, shuffled


def test_rows_alone_take_no_rollup(spark, tmp_path, monkeypatch):
    made, write = [], workspace.write_rollup
    monkeypatch.setattr(workspace, "write_rollup", lambda ledger, path: made.append(path) or write(ledger, path))
    for name in ("lineitem", "orders", "customer", "nation", "region"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(50).write.parquet(str(tmp_path / f"{name}.parquet"))
    rows = workspace.ledger(spark, str(tmp_path), rollup=False)
    assert not made and rows.ledger_rollup is None
    whole = workspace.ledger(spark, str(tmp_path))
    assert len(made) == 1 and whole.ledger_rollup is not None and whole.inputFiles() == rows.inputFiles()


def test_shuffle_files_go_when_a_ledger_is_written(spark, toy, tmp_path):
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    local = [Path(d.getPath()) for d in env.blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return {f for d in local for f in d.glob("*/shuffle_*.data")}

    set_before, others = spark.conf.get(cleanup, None), shuffled()
    joined = toy.repartition(3).join(toy.select("property_id").distinct(), "property_id").select(toy.columns)
    store.write_ledger(joined, str(tmp_path / "ledger"))
    until = time.time() + 10  # Spark deletes them in the background
    while (left := shuffled() - others) and time.time() < until:
        time.sleep(0.1)
    # Its table of periods is a row per month.
    assert sum(f.stat().st_size for f in left if f.exists()) < 500, left
    assert store.read_ledger(spark, str(tmp_path / "ledger")).count() == 9
    assert spark.conf.get(cleanup, None) == set_before


def test_extra_columns_are_in_one_csv_folder_at_a_time(spark, tmp_path, monkeypatch):
    """What was ingested is deleted before as much is exported; the rest of it stays."""
    day = datetime.datetime(2020, 2, 3)
    tables = {
        "region": ("r_regionkey long, r_name string", [(0, "R"), (1, "S")]),
        "nation": ("n_nationkey long, n_name string, n_regionkey long", [(0, 'a "b"', 0), (1, "c,d", 1)]),
        "customer": (
            "c_custkey long, c_name string, c_nationkey long, c_mktsegment string",
            [(1, "P1", 0, "H"), (2, "P2", 1, None)],
        ),
        "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp", [(1, 1, day), (2, 2, day)]),
        "lineitem": (
            "l_orderkey long, l_linenumber int, l_extendedprice double, l_returnflag string, "
            "l_linestatus string, l_shipdate timestamp",
            [(1, 1, 10.0, "R", "F", day), (1, 1, 10.0, "R", "F", day), (2, 7, 2.5, "A", "O", day), (2, 1, 2.5, "A", "O", None)],
        ),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))

    def made():
        return set(Path(folders.shared_folder(spark)).glob("ledgerloom-*/extra*"))

    before, at_export, export = made(), [], pivot_export.export_rows
    monkeypatch.setattr(pivot_export, "export_rows", lambda rows, path: at_export.extend(made() - before) or export(rows, path))
    found = entry.ledger_queries()["csv_extra_columns"](spark, str(tmp_path))
    assert [p.name.rpartition("-")[0] for p in at_export] == ["extra"]
    assert sorted(p.name.rpartition("-")[0] for p in made() - before) == ["extra", "extra-rows"]
    p1 = ("P1", "H", "2020-02-03", "2020-02-03", "R", 'a "b"', "R-F", 2020, 2, -10.0, "2020-02-01")
    p2 = ("P2", "", "2020-02-03", "2020-02-03", "S", "c,d", "A-O", 2020, 2, -2.5, "2020-02-01")
    extra = {"P1": ('a "b"', "R", "R-F", "2", "R"), "P2": ("c,d", "S", "A-O", "2", "S")}
    assert found.columns[-5:] == ["note.1", "a`b", "x y", "Year_2", "SHOP_2"]
    order = [found.columns.index(c) for c in [*LEDGER_SCHEMA.names, *found.columns[-5:]]]
    assert sorted(tuple(r[i] for i in order) for r in found.collect()) == [p1 + extra["P1"]] * 2 + [p2 + extra["P2"]]


def test_folders_of_others_are_not_dropped(spark, tmp_path):
    for path in (str(tmp_path), folders.shared_folder(spark)):
        with pytest.raises(ValueError, match="not a folder"):
            folders.drop_folder(spark, path)
    assert tmp_path.exists()
