"""The operators' queries against their SQL."""

import duckdb
import pytest

from ledgerloom.llm import queries
from tests.compare import difference

FOLDER = "/root/testdata/sf0.01"
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_and_types(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df, sql = queries.queries()[name](spark, FOLDER), queries.oracle_sql()[name]
    assert difference(df, con, sql) is None
    theirs = {d[0]: str(d[1]) for d in con.execute(sql).description}
    assert {c: TYPES[t] for c, t in df.dtypes} == theirs
