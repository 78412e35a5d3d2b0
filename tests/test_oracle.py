"""Every registered query against DuckDB on the given tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.ledger_queries()))
def test_same_rows_and_types(spark, con, name):
    df, sql = entry.ledger_queries()[name](spark, FOLDER), entry.ledger_sql()[name]
    assert difference(df, con, sql) is None
    theirs = {d[0]: str(d[1]) for d in con.execute(sql).description}
    assert {c: TYPES[t] for c, t in df.dtypes} == theirs


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["org", "shop", "is_total"]
    assert df.count() == 26
