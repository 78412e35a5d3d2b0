import hashlib
import random

from pyspark.sql import functions as F

from ledgerloom.llm import fingerprints as f
from ledgerloom.llm.tables import by_place
from tests.llm.frames import awkward, given, plain


def shown(spark, texts):
    return [r["fingerprint"] for r in f.fingerprint(plain(spark, texts)).orderBy("doc_id").collect()]


def test_sum_of_paragraphs_in_any_order(spark):
    parts = [f"Line {i}, with words. And more!" for i in range(40)] + ["Line 3, with words. And more!"]
    mixed = random.Random(1).sample(parts, len(parts))
    one, other, twice, less = shown(
        spark, ["\n".join(parts), "\n".join(mixed), "\n".join(parts + parts[:1]), "\n".join(parts[1:])]
    )
    assert one == other and len({one, twice, less}) == 3
    rows = spark.createDataFrame(
        [("\n".join(parts), "\n".join(mixed[:9]), "\n".join(mixed[9:]))], "a string, b string, c string"
    )
    a, b, c = (f.lanes(F.col(x)) for x in "abc")
    row = rows.select(
        f.shown(f.insert(b, c)).alias("put"), f.shown(f.delete(a, b)).alias("cut"), f.shown(c).alias("c")
    ).first()
    assert row["put"] == one and row["cut"] == row["c"]


def test_lanes_wrap_without_carries(spark):
    full = (1 << 63) - 1
    rows = spark.createDataFrame([([full, 0, 5], [1, full, 7], [(1 << 62) - 1], [9])], "a array<long>, b array<long>, c array<long>, d array<long>")
    lane = (1 << f.LANE) - 1
    split = lambda x: [(x >> (f.LANE * k)) & lane for k in range(3)]
    row = rows.select(
        f.add_like(F.col("a"), F.col("b")).alias("sum"),
        f.subtract_like(F.col("b"), F.col("a")).alias("less"),
        f.add_exact(F.col("c"), F.col("d")).alias("exact"),
    ).first()
    for x, y, s, m in zip([full, 0, 5], [1, full, 7], row["sum"], row["less"]):
        assert split(s) == [(p + q) & lane for p, q in zip(split(x), split(y))]
        assert split(m) == [(q - p) & lane for p, q in zip(split(x), split(y))]
    assert row["exact"] == [8]


def test_likeness_estimates_shared_clauses(spark):
    clause = [f"clause number {i} of many," for i in range(400)]
    texts = [" ".join(clause[:200]), " ".join(clause[:150] + clause[200:250]), " ".join(clause[200:])]
    rows = spark.createDataFrame([(texts[0], t) for t in texts], "a string, b string")
    near = [r[0] for r in rows.select(f.likeness(f.lanes(F.col("a")), f.lanes(F.col("b")))).collect()]
    assert near[0] == 1.0 and abs(near[1] - 0.75) < 0.2 and near[2] < 0.3


def check_edits(df):
    """Against the same in Python, rows in the order of ids and texts."""
    rows = [(r["doc_id"], r["text"] or "") for r in by_place(df).select("c0", "c1").toDF("doc_id", "text").collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = []
    for k, (i, text) in enumerate(rows):
        q = len(text) // 4
        edited = text[: len(text) - q] + rows[(k + 1) % len(rows)][1][:q]
        expected.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    out = f.edited(df)
    found = out.collect()
    assert sorted(map(str, expected)) == sorted(str(tuple(r[:3])) for r in found)
    for r in found:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["fingerprint"] == r["edited_fingerprint"]) <= (r["near_edited"] == 1)
    return found


def test_given_documents_in_many_ranges(spark, monkeypatch):
    docs = given(spark, "documents", "sf0.01")
    found = check_edits(docs)
    assert len({r["fingerprint"] for r in found}) == docs.select("text").distinct().count()
    assert sum(r["near_edited"] > r["near_next"] for r in found) > 0.9 * len(found)
    monkeypatch.setattr(f, "BUCKET_ROWS", 3)
    monkeypatch.setattr(f, "_FAN", 8)
    assert sorted(check_edits(docs)) == sorted(found)


def test_awkward_rows(spark, monkeypatch):
    docs = awkward(spark)
    check_edits(docs)
    for some in ("c0 = 9", "c0 IS NOT NULL", "c0 IS NULL", "c0 = 5"):
        check_edits(by_place(docs).where(some).toDF(*docs.columns))
    assert f.edited(docs.limit(0)).count() == 0 == f.fingerprint(docs.limit(0)).count()
    monkeypatch.setattr(f, "BUCKET_ROWS", 1)
    check_edits(docs)
