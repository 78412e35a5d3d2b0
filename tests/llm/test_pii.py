import hashlib
import random
import time

import pytest

from ledgerloom.llm import pii
from tests.llm.frames import given
from tests.llm.pii_reference import base_spans

CARD, AMEX = "4111 1111-1111 1111", "3782 822463 10005"
TEXTS = [
    None,
    "",
    "nothing here",
    "a@b.c+d@e.fg h@i j@k.l.m. x..@y.z-",
    "😀 é a.b%c@d-e.fr 1.2.3.4 256.1.1.1 00255.0.0.9 1.2.3.4.5",
    f"card {CARD}, again {CARD}+ 4111111111111112 and 12345",
    "+1 (269) 555-3296 4524132264652876 +49 30 1234567 + 123 +1-2-3",
    "IBAN GB82 WEST 1234 5698 7654 32, DE89370400440532013000, DE88370400440532013000",
    f"my ssn is 123-45-6789{' ' * 60}123-45-6789{' ' * 60}alone; amex {AMEX}",
    "call 555-123-4567 or x@y.zz@w.vv",
    "9" * 30000 + "." + "a" * 30000 + " " + "1-" * 20000 + "." * 3000 + "a." * 3000 + "a@" + "b." * 9000 + "c",
]


def rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def expected(text):
    shown = [f"{k}:{a}:{b}" for k, a, b in base_spans(text or "")]
    return shown, hashlib.sha256(",".join(shown).encode()).hexdigest()


def test_base_spans_are_those_of_the_expressions(spark):
    rng = random.Random(5)
    marks = ["@", ".", "+", "-", " ", "a", "Z", "%", "_", "1", "25", "4111111111111111", "255", "(", ")", "é", "\n", "😀"]
    texts = TEXTS + ["".join(rng.choices(marks, k=rng.randint(1, 60))) for _ in range(3000)]
    found = pii.digest(rows(spark, texts)).collect()
    assert len(found) == len(texts)
    for row in found:
        shown, digest = expected(texts[row["doc_id"]])
        assert row["base_sha256"] == digest, texts[row["doc_id"]]
        assert [row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]] == [
            sum(s.startswith(kind) for s in shown) for kind in ("email", "ip", "card", "phone")
        ]
        spans = row["spans"].split(",") if row["spans"] else []
        assert spans[: len(shown)] == shown and len(spans) == len(shown) + row["n_added"]


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in pii.digest(docs).collect():
        assert row["base_sha256"] == expected(texts[row["doc_id"]])[1]


def test_added_spans_need_checksum_or_context(spark):
    found = {r["doc_id"]: r for r in pii.find(rows(spark, TEXTS)).collect()}

    def added(i):
        return [(s["kind"], TEXTS[i][s["start"] : s["end"]]) for s in found[i]["added"]]

    assert added(7) == [("iban", "GB82 WEST 1234 5698 7654 32"), ("iban", "DE89370400440532013000")]
    assert added(8) == [("ssn", "123-45-6789"), ("card15", AMEX)]
    assert added(9) == [("local_phone", "555-123-4567")]
    assert added(6) == []  # nothing inside a base span


def test_redaction_keeps_columns_rows_and_nulls(spark):
    docs = spark.createDataFrame(
        [(1, None, "x", 0, "t"), (2, "me a@b.c, 1.2.3.4!", "y", 3, "u"), (2, "me a@b.c, 1.2.3.4!", "y", 3, "u"), (None, "", None, None, None)],
        "doc_id long, text string, lang string, n_chars long, TEXT string",
    )
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [
            (1, None, "x", None, "t"),
            (2, "me [EMAIL], [IP]!", "y", 17, "u"),
            (2, "me [EMAIL], [IP]!", "y", 17, "u"),
            (None, "", None, 0, None),
        ],
        key=str,
    )
    assert pii.redact(docs.limit(0)).count() == 0 == pii.digest(docs.limit(0)).count()
    overlap = spark.createDataFrame([(1, "1.2.3.4@b.c z")], "doc_id long, text string")
    assert pii.redact(overlap).first()["text"] == "[EMAIL] z"


def test_long_texts_of_addresses_take_time_in_proportion(spark):
    n = 150_000
    text = " ".join(f"user{i}@mail{i % 7}.example.org" for i in range(n))
    assert len(text) > 4_000_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.perf_counter()
    row = pii.digest(df).collect()[0]
    gone = pii.redact(df).collect()[0]
    assert time.perf_counter() - began < 60
    assert row["n_email"] == n and gone["text"] == " ".join(["[EMAIL]"] * n)
    last = text.rsplit(" ", 1)[1]
    assert row["spans"].endswith(f"email:{len(text) - len(last)}:{len(text)}")


@pytest.mark.parametrize("size", [1, 7])
def test_places_do_not_depend_on_chunks_and_blocks(spark, monkeypatch, size):
    docs = given(spark, "documents").limit(60)
    rows = lambda df: sorted(map(str, df.collect()))
    found, redacted = rows(pii.find(docs).drop("text")), rows(pii.redact(docs))
    monkeypatch.setattr(pii, "_CHUNK", 40 * size)
    monkeypatch.setattr(pii, "_BLOCK", size)
    assert rows(pii.find(docs).drop("text")) == found and rows(pii.redact(docs)) == redacted
