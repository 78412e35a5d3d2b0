"""The stored sums, numbered properties and bitmaps give what the ledger gives."""

import random

import pytest

from ledgerloom.operators import filters
from ledgerloom.plans import monthly, overview, properties, structure
from ledgerloom.sources import rollup, store
from tests.conftest import make_ledger


def random_rows(seed, n=600):
    rng = random.Random(seed)
    pick = lambda name, k: rng.choice([f"{name}{i}" for i in range(k)] + [""])
    rows = []
    for _ in range(n):
        amount = rng.choice(["0.00", "-0.01", "123.45", f"{rng.randrange(-10**6, 10**6) / 100:.2f}"])
        rows.append((pick("P", 40), pick("H", 3), pick("O", 3), pick("S", 4), pick("c", 6), rng.choice([2021, 2022, 2024]), rng.randrange(1, 13), amount))
    return rows + [("Q", "H9", "O9", "S9", "c9", 2020, 5, "0.00")] * 3


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    """A ledger with a roll-up, and the same ledger without."""
    path = str(tmp_path_factory.mktemp("rolled") / "ledger")
    store.write_ledger(make_ledger(spark, random_rows(3)), path, rollup=True)
    rolled = store.read_ledger(spark, path)
    return rolled, bare(rolled)


def bare(ledger):
    return filters.with_periods(ledger.select("*"), filters.stored_periods(ledger))


REPORTS = {
    "kpis": overview.kpis,
    "org_category": overview.org_category,
    "data_range": overview.data_range,
    "top_income_categories": overview.top_income_categories,
    "month": monthly.kpis,
    "month_2022": lambda d: monthly.kpis(d, 2022, 3),
    "month_absent": lambda d: monthly.kpis(d, 1990, 1),
    "categories": monthly.category_net,
    "income_share": monthly.income_share,
    "expense_share": lambda d: monthly.expense_share(d, 2021),
    "house_types": monthly.house_types,
    "series": structure.monthly_series,
    "series_filtered": lambda d: structure.monthly_series(d, 2021, "c2", "O1"),
    "year_categories": lambda d: structure.category_net(d, 2022, org=""),
    "properties": properties.kpis,
    "properties_category": lambda d: properties.kpis(d, 2021, category="c1"),
    "properties_one": lambda d: properties.kpis(d, 2021, "P3"),
    "properties_zero": lambda d: properties.kpis(d, 2020),
    "properties_absent": lambda d: properties.kpis(d, 1990, category="none"),
    "property_cards": properties.cards,
    **{f"options_{c}": (lambda c: lambda d: filters.options(d, c))(c) for c in ("org", "shop", "house_type", "category", "property_id", "year", "lease_start")},
    "options_descending": lambda d: filters.options(d, "shop", descending=True),
    "property_options": lambda d: filters.property_options(d, 7),
}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_same_rows_from_the_rollup_and_from_the_ledger(both, name):
    rolled, plain = both
    found, expected = REPORTS[name](rolled), REPORTS[name](plain)
    assert found.dtypes == expected.dtypes
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in expected.collect()]


FROM_ROLLUP = [n for n in REPORTS if n not in ("properties_one", "options_lease_start", "options_year")]


@pytest.mark.parametrize("name", FROM_ROLLUP)
def test_no_file_of_the_ledger_is_opened(both, name):
    rolled, _ = both
    plan = REPORTS[name](rolled)._jdf.queryExecution().optimizedPlan().toString()
    assert "lease_start#" not in plan and "date#" not in plan
    files = {f.rsplit("/", 2)[-2] for f in REPORTS[name](rolled).inputFiles()}
    assert files and files <= {"_totals", "_properties", "_active", "_periods"}


def test_numbers_rise_with_the_keys_and_bitmaps_hold_them(spark, both, monkeypatch):
    _, plain = both
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    properties_ = rollup.numbered(plain)
    rows = properties_.collect()
    assert [r["property_id"] for r in sorted(rows, key=lambda r: r["number"])] == sorted(r["property_id"] for r in rows)
    assert len({r["number"] for r in rows}) == len(rows)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_an_empty_ledger_and_one_without_rollup(spark, toy, tmp_path):
    for name, rows in (("none", toy.limit(0)), ("some", toy)):
        store.write_ledger(rows, str(tmp_path / name), rollup=True)
        rolled = store.read_ledger(spark, str(tmp_path / name))
        assert filters.stored_rollup(rolled) is not None
        for report in (overview.data_range, properties.kpis, monthly.kpis, overview.kpis):
            assert report(rolled).collect() == report(bare(rolled)).collect()
    store.write_ledger(toy, str(tmp_path / "plain"))
    assert filters.stored_rollup(store.read_ledger(spark, str(tmp_path / "plain"))) is None
    assert filters.stored_rollup(rolled.filter("year = 2024")) is None
