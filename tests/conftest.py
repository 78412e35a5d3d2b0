import datetime
from decimal import Decimal

import pytest

from ledgerloom.schema import LEDGER_SCHEMA
from ledgerloom.session import local_session

# property, house type, org, shop, category, year, month, amount
TOY_ROWS = [
    ("P1", "H1", "O1", "S1", "rent", 2024, 2, "30000.00"),
    ("P1", "H1", "O1", "S1", "rent", 2024, 2, "-10000.00"),
    ("P2", "H2", "O1", "S2", "repair", 2024, 2, "-5000.00"),
    ("P2", "H2", "O1", "S2", "fee", 2024, 2, "2000.00"),
    ("P3", "", "O2", "", "fee", 2024, 2, "-2000.00"),
    ("P3", "", "O2", "", "rent", 2024, 10, "40000.00"),
    ("P1", "H1", "O1", "S1", "repair", 2024, 10, "0.00"),
    ("P4", "H1", "O2", "S3", "rent", 2023, 12, "40000.00"),
    ("P4", "H1", "O2", "S3", "repair", 2023, 12, "-8000.00"),
]


def make_ledger(spark, rows):
    full = [
        (p, h, "2020-01-01", "2030-01-01", o, s, c, y, m, Decimal(a), datetime.date(y, m, 1))
        for p, h, o, s, c, y, m, a in rows
    ]
    return spark.createDataFrame(full, LEDGER_SCHEMA)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(4, memory="6g", spark__checkpoint__dir=str(shared))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def toy(spark):
    return make_ledger(spark, TOY_ROWS)


@pytest.fixture(scope="session")
def nothing(toy):
    return toy.limit(0)


@pytest.fixture(scope="session")
def stored(spark):
    """The ledger of the smallest test tables, as the queries store it."""
    from ledgerloom.sources import workspace

    return workspace.ledger(spark, "/root/testdata/sf0.001")
