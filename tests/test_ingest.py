"""CSV text to the stored ledger: messy cells, rejected rows, dialect, export."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.plans import pivot_export
from ledgerloom.schema import LEDGER_SCHEMA, NULL_TOKENS, SOURCE_COLUMNS, TEXT_COLUMNS
from ledgerloom.sources import csv_files, csv_records, store

HEADER = {ours: theirs for theirs, ours in SOURCE_COLUMNS.items()}
GOOD = {
    "property_id": "P1",
    "house_type": "H1",
    "lease_start": "2020/1/1",
    "lease_end": "2030/1/1",
    "org": "O1",
    "shop": "S1",
    "category": "rent",
    "year": "2024",
    "month": "2",
    "amount": "10.00",
}


def cell(text):
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\n\r') else text


def csv_text(rows, columns=None, bom=False, extra=()):
    columns = [*(columns or GOOD), *extra]
    lines = [[HEADER.get(c, c) for c in columns]]
    lines += [[{**GOOD, **r}[c] for c in columns] for r in rows]
    text = "".join(",".join(map(cell, line)) + "\n" for line in lines)
    return ("﻿" if bom else "") + text


@pytest.fixture
def ingested(spark, tmp_path):
    """Write CSV text(s), ingest them, give back ledger, rejects and counts."""

    def run(*texts, multi_line=None):
        paths = []
        for i, text in enumerate(texts):
            path = tmp_path / f"in{i}.csv"
            path.write_bytes(text.encode())
            paths.append(str(path))
        out = str(tmp_path / "ledger")
        store.ingest(spark, out, *paths, multi_line=multi_line)
        counts = store.read_quality(spark, out).first().asDict()
        ledger, bad = store.read_ledger(spark, out), store.read_rejects(spark, out)
        assert counts["input_rows"] == ledger.count() + bad.count()
        assert counts["accepted_rows"] == ledger.count()
        return ledger, bad, counts

    return run


def test_types_and_derived_date(ingested):
    ledger, bad, counts = ingested(csv_text([{}]))
    row = ledger.select(*LEDGER_SCHEMA.names).first()
    assert tuple(row) == (
        "P1", "H1", "2020/1/1", "2030/1/1", "O1", "S1", "rent", 2024, 2,
        Decimal("10.00"), datetime.date(2024, 2, 1),
    )
    types = {f.name: f.dataType for f in LEDGER_SCHEMA}
    assert {f.name: f.dataType for f in ledger.schema} == types
    assert set(counts) == {
        "input_rows", "accepted_rows", "rejected_rows", "bad_year", "bad_month", "bad_amount",
        "bad_columns", "over_precise_rows",
    }


def test_null_tokens_become_blank_text(ingested):
    tokens = [*NULL_TOKENS, ""]
    ledger, _, _ = ingested(csv_text([{"house_type": t, "shop": t} for t in tokens]))
    assert ledger.count() == len(tokens)
    assert ledger.select("house_type", "shop").distinct().collect() == [("", "")]


def test_texts_that_only_look_empty_are_kept(ingested):
    texts = ["-", " ", "0", "na", "Null", "007", "N/A "]
    ledger, _, _ = ingested(csv_text([{"shop": t} for t in texts]))
    assert sorted(r.shop for r in ledger.collect()) == sorted(texts)


@pytest.mark.parametrize(
    "text,value",
    [
        ("1,234.50", "1234.50"),
        ("-1,234,567.89", "-1234567.89"),
        ("12.345", "12.35"),
        ("12.3400", "12.34"),
        ("1234.5e-1", "123.45"),
        ("1200e-2", "12.00"),
        ("-12.345", "-12.35"),
        (" 5 ", "5.00"),
        ("1e3", "1000.00"),
        ("0", "0.00"),
        ("+7", "7.00"),
        ("9999999999999999.99", "9999999999999999.99"),
    ],
)
def test_amounts(ingested, text, value):
    ledger, _, counts = ingested(csv_text([{"amount": text}]))
    assert ledger.first().amount == Decimal(value)
    assert counts["over_precise_rows"] == (1 if "345" in text and len(text) < 8 else 0)


@pytest.mark.parametrize("text", ["", "NA", "x", "1.2.3", "10000000000000000", "inf", "5d", "NaN", "1,2,3", "12,50", ",5", "1,234,56"])
def test_bad_amounts(ingested, text):
    ledger, bad, counts = ingested(csv_text([{"amount": text}, {}]))
    assert ledger.count() == 1
    row = bad.first()
    assert row.reject_reason == "amount" and (row.amount_text or "") == text
    assert counts["bad_amount"] == 1


@pytest.mark.parametrize("text,value", [("2024.0", 2024), ("2024.7", 2024), (" 2024", 2024), ("1", 1)])
def test_years(ingested, text, value):
    ledger, _, _ = ingested(csv_text([{"year": text}]))
    assert ledger.first().year == value


@pytest.mark.parametrize("text", ["", "x", "NaN", "inf", "2024d", "0", "-1", "10000", "1e30", "99999999999"])
def test_bad_years(ingested, text):
    _, bad, _ = ingested(csv_text([{"year": text}]))
    assert bad.first().reject_reason == "year"


@pytest.mark.parametrize("text", ["0", "13", "", "-2", "Feb", "0.9"])
def test_bad_months(ingested, text):
    _, bad, _ = ingested(csv_text([{"month": text}, {"month": "12.9"}]))
    assert [r.reject_reason for r in bad.collect()] == ["month"]


@pytest.mark.parametrize("text,kept", [("0.00000000000000000012", "0.00"), ("1.005e-3", "0.00"), ("7.001", "7.00")])
def test_rounded_amounts_keep_their_text(spark, tmp_path, text, kept):
    path = tmp_path / "in.csv"
    path.write_text(csv_text([{"amount": text}, {"amount": "7.000"}, {"amount": "x"}]))
    out = str(tmp_path / "ledger")
    store.ingest(spark, out, str(path))
    (row,) = store.read_rounded(spark, out).collect()
    assert (row.amount, row.amount_text) == (Decimal(kept), text)
    assert store.read_quality(spark, out).first().over_precise_rows == 1
    exact = str(tmp_path / "exact")
    store.ingest(spark, exact, str(path), amount_type=T.DecimalType(38, 25), rows_per_file=1)
    assert sorted(r.amount for r in store.read_ledger(spark, exact).collect()) == sorted([Decimal(text), Decimal(7)])


def test_blanks_at_the_ends_of_texts_are_exported(spark, toy, tmp_path):
    odd = toy.withColumn("shop", F.concat(F.lit(" "), "shop", F.lit("\t"))).withColumn("house_type", F.lit("  "))
    path = str(tmp_path / "rows")
    pivot_export.export_rows(odd, path)
    back = csv_files.accepted(csv_files.parse(csv_files.read_csv(spark, path))).select(*odd.columns)
    assert back.exceptAll(odd).isEmpty() and odd.exceptAll(back).isEmpty()


def test_all_reasons_are_named(ingested):
    _, bad, counts = ingested(csv_text([{"year": "x", "month": "13", "amount": ""}]))
    assert bad.first().reject_reason == "year,month,amount"
    assert (counts["bad_year"], counts["bad_month"], counts["bad_amount"]) == (1, 1, 1)
    assert counts["rejected_rows"] == 1


def test_header_mark_column_order_and_extra_columns(ingested):
    columns = [*reversed(GOOD)]
    ledger, _, _ = ingested(
        csv_text([{"note": "007", "a.b": "NA"}], columns, bom=True, extra=["note", "a.b"])
    )
    row = ledger.first()
    assert (row.property_id, row.amount, row.note, row["a.b"]) == ("P1", Decimal("10"), "007", "")


def test_a_date_column_in_the_file_is_derived_anew(ingested):
    ledger, _, _ = ingested(csv_text([{"date": "nonsense"}], extra=["date"]))
    assert ledger.first().date == datetime.date(2024, 2, 1)


def test_quotes_commas_and_line_breaks(ingested):
    texts = ['say "hi"', "a,b", '"', '","', "x\ny", 'x\n"y",\n\nz', "\n", "plain"]
    ledger, _, counts = ingested(csv_text([{"property_id": t} for t in texts]))
    assert sorted(r.property_id for r in ledger.collect()) == sorted(texts)
    assert counts["rejected_rows"] == 0


def test_a_stray_quote_is_text(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(csv_text([{}]) + '5" pipe,H,s,e,O,S,rent,2024,2,1\nP2,H,s,e,O,S,rent,2024,2,2\n')
    raw = csv_files.read_csv(spark, str(path))
    assert sorted(r[0] for r in raw.collect()) == ['5" pipe', "P1", "P2"]


def test_files_with_other_column_order_or_columns(ingested):
    ledger, _, _ = ingested(
        csv_text([{"org": "A"}]),
        csv_text([{"org": "B", "note": "n"}], [*reversed(GOOD)], extra=["note"]),
    )
    assert sorted((r.org, r.shop, r.note) for r in ledger.collect()) == [
        ("A", "S1", ""), ("B", "S1", "n"),
    ]


def test_files_of_one_folder_are_read_by_their_headers(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(csv_text([{"org": "A"}, {"org": "B", "shop": "x\ny"}]))
    (folder / "b.csv").write_text(csv_text([{"org": "C", "note": "n,m"}], [*reversed(GOOD)], extra=["note"]))
    (folder / "c.csv").write_text(csv_text([{"org": "D", "NOTE": "k"}], extra=["NOTE"], bom=True))
    ledger = csv_files.accepted(csv_files.parse(csv_files.read_csv(spark, str(folder))))
    note = next(c for c in ledger.columns if c.lower() == "note")
    assert sorted((r.org, r.shop, r.year, r[note]) for r in ledger.collect()) == [
        ("A", "S1", 2024, ""), ("B", "x\ny", 2024, ""), ("C", "S1", 2024, "n,m"), ("D", "S1", 2024, "k"),
    ]


def test_extra_columns_of_any_name(spark, tmp_path):
    names = ["Year", "note.1", "a`b", "x y", "n", "N", "SHOP", "Amount_text"]
    path = tmp_path / "in.csv"
    path.write_text(csv_text([{n: f"v{i}" for i, n in enumerate(names)}], extra=names))
    out = str(tmp_path / "ledger")
    store.ingest(spark, out, str(path))
    ledger = store.read_ledger(spark, out)
    extra = {c: v for c, v in ledger.first().asDict().items() if c not in LEDGER_SCHEMA.names}
    assert extra == {
        "Year_2": "v0", "note.1": "v1", "a`b": "v2", "x y": "v3", "n": "v4", "N_2": "v5", "SHOP_2": "v6", "Amount_text_2": "v7",
    }
    from ledgerloom.operators.ranking import largest_first, preview

    assert preview(ledger).count() == 1 and largest_first(ledger).count() == 1
    csv_out = str(tmp_path / "csv")
    pivot_export.export_rows(ledger, csv_out)
    back = csv_files.accepted(csv_files.parse(csv_files.read_csv(spark, csv_out)))
    assert sorted(map(str, back.first())) == sorted(map(str, ledger.first()))


def test_short_and_long_rows(ingested):
    text = csv_text([{"note": "n"}], extra=["note"])
    text += "P2,H,s,e,O,S,rent,2024,2,7\n"  # no note: blank
    text += "P3,H,s,e,O,S,rent,2024,2,7,n,surplus\n"
    text += 'P4,H,s,e,O,S,rent,2024,2,7,"n, with comma"\n'
    text += "P5,H,s\n"
    ledger, bad, counts = ingested(text)
    assert {r.property_id: r.note for r in ledger.collect()} == {
        "P1": "n", "P2": "", "P4": "n, with comma",
    }
    assert {r.property_id: r.reject_reason for r in bad.collect()} == {
        "P3": "columns", "P5": "year,month,amount",
    }
    assert counts["bad_columns"] == 1


def test_missing_and_doubled_columns(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(csv_text([{}], [c for c in GOOD if c != "org"]))
    with pytest.raises(ValueError, match="missing from the CSV: org"):
        csv_files.parse(csv_files.read_csv(spark, str(path)))
    path.write_text(csv_text([{"reject_reason": "x"}], extra=["reject_reason"]))
    with pytest.raises(ValueError, match="used by the ingest: reject_reason"):
        csv_files.parse(csv_files.read_csv(spark, str(path)))
    path.write_text(csv_text([{"org": "x"}]).replace(HEADER["shop"], "org"))
    with pytest.raises(ValueError, match="column given twice: org"):
        csv_files.parse(csv_files.read_csv(spark, str(path)))


def test_only_good_or_only_bad_rows(ingested):
    ledger, bad, _ = ingested(csv_text([{}, {}]))
    assert (ledger.count(), bad.count()) == (2, 0)


def test_no_rows(ingested):
    ledger, bad, counts = ingested(csv_text([]))
    assert (ledger.count(), bad.count(), counts["input_rows"]) == (0, 0, 0)
    assert ledger.select(*LEDGER_SCHEMA.names).schema["amount"].dataType == LEDGER_SCHEMA["amount"].dataType


def test_file_names_with_spaces_and_other_scripts(spark, tmp_path):
    folder = tmp_path / "月度 费用%20汇总"
    folder.mkdir()
    (folder / "一 月.csv").write_text(csv_text([{"shop": "x\ny"}]))
    (folder / "二月#[1].csv").write_text(csv_text([{"shop": "z"}]))
    raw = csv_files.read_csv(spark, str(folder))
    assert sorted(r[HEADER["shop"]] for r in raw.collect()) == ["x\ny", "z"]


def test_only_bad_rows(ingested):
    ledger, bad, _ = ingested(csv_text([{"year": "x"}]))
    assert (ledger.count(), bad.count()) == (0, 1)
    assert ledger.schema["year"].dataType.simpleString() == "int"


# export


def test_exported_rows_come_back(spark, toy, tmp_path):
    odd = toy.withColumn("property_id", F.concat("property_id", F.lit(' "x",\n y')))
    path = str(tmp_path / "rows")
    pivot_export.export_rows(odd, path)
    back = csv_files.accepted(csv_files.parse(csv_files.read_csv(spark, path)))
    assert back.select(*odd.columns).exceptAll(odd).isEmpty()
    assert odd.exceptAll(back.select(*odd.columns)).isEmpty()


def test_export_format(toy, tmp_path):
    path = tmp_path / "rows"
    pivot_export.export_rows(toy.filter("property_id = 'P3' and month = 2").coalesce(1), str(path))
    (part,) = path.glob("part-*.csv")
    assert part.read_bytes().decode() == (
        ",".join(HEADER[c] for c in toy.columns)
        + "\nP3,,2020-01-01,2030-01-01,O2,,fee,2024,2,-2000.00,2024-02-01\n"
    )


def test_exported_pivot_has_keys_and_totals(spark, toy, tmp_path):
    path = str(tmp_path / "pivot")
    table = pivot_export.report(toy, rows=["org"], cols=["category"])["pivot"]
    pivot_export.export_pivot(table, path)
    back = csv_files.read_csv(spark, path).drop("_too_long")
    assert back.columns == table.columns
    assert sorted(map(tuple, back.collect()))[0] == (
        "O1", "false", "2000.00", "20000.00", "-5000.00", "17000.00",
    )


def test_text_columns_are_all_texts():
    assert [f.name for f in LEDGER_SCHEMA if f.dataType.simpleString() == "string"] == TEXT_COLUMNS


# files with line breaks, read by many tasks


def odd_texts(seed, n):
    r = random.Random(seed)
    pieces = ["a", '"', ",", "\n", "\r\n", "费", " ", "\n\n", '""', "b" * 40]
    return ["".join(r.choice(pieces) for _ in range(r.randrange(0, 6))) for _ in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(3))
def test_blocks_of_a_file_with_line_breaks(spark, tmp_path, seed, end):
    texts = odd_texts(seed, 400)
    lines = ["id,first,second,last"]
    for i, t in enumerate(texts):
        lines.append(",".join([str(i), cell(t), cell(texts[-i]), "x"]))
    path = tmp_path / "in.csv"
    path.write_bytes(("﻿" + end.join(lines) + end).encode())
    expected = sorted((str(i), t or None, texts[-i] or None, "x") for i, t in enumerate(texts))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 20
        raw = csv_files.read_csv(spark, str(path))
        assert raw.columns == ["id", "first", "second", "last", "_too_long"]
        found = [tuple(r[:4]) for r in raw.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    key = lambda row: tuple(str(x) for x in row)
    assert sorted(found, key=key) == sorted(expected, key=key)


def test_stray_quotes_and_line_breaks_in_one_file(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,t,u\n1,5" pipe,z\n2,"a\nb",z\n3,6" pipe,z\n4,"c\nd",7"\n')
    raw = csv_files.read_csv(spark, str(path))
    assert sorted(tuple(r[:3]) for r in raw.collect()) == [
        ("1", '5" pipe', "z"), ("2", "a\nb", "z"), ("3", '6" pipe', "z"), ("4", "c\nd", '7"'),
    ]


@pytest.mark.parametrize("seed", range(6))
def test_random_text_is_read_as_by_the_whole_file_reader(spark, tmp_path, seed, monkeypatch):
    """Quotes anywhere, closed or not, in small blocks and buckets."""
    monkeypatch.setattr(csv_records, "BUCKET", 3)
    r = random.Random(seed)
    pieces = ["a", "b", '"', '"', ",", ",", "\n", "费", '""', '",', ',"', "bbbbbbbbbb"]
    body = "".join(r.choice(pieces) for _ in range(700))
    path = tmp_path / "in.csv"
    path.write_text("one,two,three\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = [tuple(x[:3]) for x in csv_files.read_csv(spark, str(path)).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    whole = [tuple(x[:3]) for x in csv_files.read_csv(spark, str(path), multi_line=True).collect()]
    assert sorted(found, key=str) == sorted(whole, key=str) and len(found) > 20


def test_a_stray_quote_leaves_the_number_of_scan_tasks_as_it_is(spark, tmp_path):
    sizes = []
    for name, address in (("clean", "Addr 5 pipe"), ("stray", 'Addr 5" pipe')):
        path = tmp_path / f"{name}.csv"
        rows = [f"P{i},H,s,e,O,S,rent,2024,2,{i}" for i in range(4000)]
        rows[2000] = f"{address},H,s,e,O,S,rent,2024,2,1"
        path.write_text(csv_text([{}]) + "\n".join(rows) + "\n")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            raw = csv_files.read_csv(spark, str(path))
            sizes.append(raw.rdd.getNumPartitions())
            assert raw.count() == 4001
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sizes[0] == sizes[1] > 5


def test_headers_of_files_with_line_breaks(spark, tmp_path):
    for name, header in (("a", '"id\nx",t'), ("b", '"id\nx",t')):
        (tmp_path / f"{name}.csv").write_text(f'\n{header}\n\n1,"p\nq"\n"id\nx",t\n')
    raw = csv_files.read_csv(spark, str(tmp_path))
    assert raw.columns[:2] == ["id\nx", "t"]
    assert sorted(tuple(r[:2]) for r in raw.collect()) == 2 * [("1", "p\nq")] + 2 * [("id\nx", "t")]
    (tmp_path / "c.csv").write_text('t,"id\nx"\n1,"p\nq"\n')
    raw = csv_files.read_csv(spark, str(tmp_path))
    assert ("p\nq", "1") in [tuple(r[:2]) for r in raw.select("`id\nx`", "t").collect()]


# quotes that are never closed


def ids(raw):
    return sorted(r[0] for r in raw.select(raw.columns[0]).collect())


def plain_rows(n, start=0):
    return [f"P{i},H,s,e,O,S,rent,2024,2,{i}" for i in range(start, start + n)]


def test_a_quote_that_is_never_closed_costs_its_own_row(ingested):
    rows = plain_rows(9000)
    rows[1500] = 'P1500,"H,s,e,O,S,rent,2024,2,1500'
    ledger, bad, counts = ingested(csv_text([]) + "\n".join(rows) + "\n")
    assert ledger.count() == 8999 and ledger.filter("property_id = 'P1500'").isEmpty()
    assert [r.property_id for r in bad.collect()] == ["P1500"]
    assert counts["input_rows"] == 9000


def test_quotes_that_are_closed_late_by_others(ingested):
    """Quoted fields, empty ones too, and a record over two lines come after the quote;
    a second one opens where a quoted field ends."""
    rows = plain_rows(9000)
    rows[10] = '"P10,H,s,e,O,S,rent,2024,2,10'
    rows[400] = 'P400,"",s,e,O,S,rent,2024,2,400'
    rows[3000] = '"P3000","a\nb",s,e,O,S,rent,2024,2,3000'
    rows[3001] = '"P\n3001","H,s,e,O,S,rent,2024,2,3001'
    ledger, bad, _ = ingested(csv_text([]) + "\n".join(rows) + "\n")
    kept = {r.property_id: r.house_type for r in ledger.collect()}
    assert len(kept) == 8998 and (kept["P400"], kept["P3000"], kept["P3002"]) == ("", "a\nb", "H")
    assert bad.count() == 2


def test_a_long_text_in_quotes_stays_whole(ingested):
    prose = "\n".join(f"line {i}, of a lease" for i in range(6000))
    ledger, bad, _ = ingested(csv_text([{"property_id": prose}, {"property_id": "P2"}]))
    assert sorted(r.property_id for r in ledger.collect()) == ["P2", prose] and bad.isEmpty()


@pytest.mark.parametrize("seed", range(4))
def test_stray_opening_quotes_in_small_blocks(spark, tmp_path, seed, monkeypatch):
    """Against a reader that goes line by line."""
    monkeypatch.setattr(csv_records, "BUCKET", 4)
    monkeypatch.setattr(csv_records, "LONGEST", 8)
    r = random.Random(seed)
    rows, expected, since = [], [], 0
    for i in range(400):
        kind = r.random()
        if since > 30 and kind < 0.3:  # the next line with quotes is far enough away
            rows += [f'{i},"open,z'] + [f"{i}_{k},y,z" for k in range(20)]
            expected += [str(i)] + [f"{i}_{k}" for k in range(20)]
            since = 0
        elif kind < 0.4:
            rows.append(f'{i},"a, ""b""\nc",z')
            expected.append(str(i))
        else:
            rows.append(f'{i},y{"" if kind < 0.9 else "5"},z')
            expected.append(str(i))
        since += 1
    path = tmp_path / "in.csv"
    path.write_text("id,t,u\n" + "\n".join(rows) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = csv_files.read_csv(spark, str(path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(x["id"] for x in found) == sorted(expected)
    assert any('"open' in row for row in rows)
    assert {x["t"] for x in found if not x["t"].lstrip('"').startswith("open")} <= {"y", "y5", 'a, "b"\nc'}


def test_a_record_is_parsed_once_whatever_is_asked_of_it(spark, tmp_path):
    (tmp_path / "a.csv").write_text(csv_text([{}, {"amount": "x"}]))
    (tmp_path / "b.csv").write_text(csv_text([{"amount": "1,000.005"}], columns=list(reversed(GOOD))))
    raw = csv_files.read_csv(spark, str(tmp_path))
    good = csv_files.accepted(csv_files.parse(raw))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 1
    assert sorted(r.amount for r in good.collect()) == [Decimal("10.00"), Decimal("1000.01")]

    shown = raw.withColumn(HEADER["amount"], F.format_number(F.lit(1.5) + F.rand(1), 2))
    plan = csv_files.accepted(csv_files.parse(shown))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("format_number(") == 1


def test_text_is_not_shuffled_by_file(spark, tmp_path):
    for i in range(3):
        rows = [{"property_id": f"P{i}\nfloor {j}" if i == 2 else f"P{i}"} for j in range(5)]
        (tmp_path / f"{i}.csv").write_text(csv_text(rows))
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in before:
        spark.conf.set(k, "-1")
    try:
        good = csv_files.accepted(csv_files.parse(csv_files.read_csv(spark, str(tmp_path))))
        assert good.count() == 15
        plan = good._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 3
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
