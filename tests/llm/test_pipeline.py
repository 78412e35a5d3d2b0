import pyarrow as pa
import pytest

import corpus_pipeline
from ledgerloom.llm import near_dedup, queries
from tests.llm.frames import awkward, given
from tests.llm.pii_reference import base_spans
from tests.llm.test_near_dedup import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
FOLDER = "/root/testdata/sf0.01"


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stages_one_after_another(spark):
    docs = given(spark, "documents", "sf0.01")
    bench = {r["item_id"]: r["text"] for r in given(spark, "benchmark", "sf0.01").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "pii", "packing"]
    before = texts_of(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER).cache()
        if name == "packing":
            break
        assert docs.columns == COLUMNS
        after = texts_of(docs)
        if name == "language_id":
            assert after == before  # all are prose in a known language
        if name == "near_dedup":
            expected = brute(before, 5, 80)
            assert set(after) == {i for i, (_, c) in expected.items() if c == i} < set(before)
        if name == "decontamination":
            leaks = {i for i, t in before.items() if any(item in t for item in bench.values())}
            assert leaks and not leaks & set(after) and len(after) > 0.8 * len(before)
        if name == "pii":
            assert set(after) == set(before)
            assert any(base_spans(t) for t in before.values())
            for i, t in after.items():
                assert not base_spans(t)
                assert (t == before[i]) == (not base_spans(before[i]))
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        before = after
    packed = {i for r in docs.collect() for i in r["doc_ids"]}
    assert packed == set(before)


def test_run_gives_the_packed_documents(spark):
    bins = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert bins.columns == ["bin_id", "capacity", "used", "doc_ids", "starts", "lengths"]
    assert bins.count() > 0 and corpus_pipeline.ORACLE_SQL is None


def test_awkward_and_empty_documents(spark):
    for docs in (awkward(spark), awkward(spark).limit(0)):
        names = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
            assert name == "packing" or docs.columns == names
        docs.count()


def largest_batch(df):
    """MB of the largest batch that a Python process gets of the table at once."""

    def run(batches):
        yield from (pa.RecordBatch.from_pydict({"mb": [b.nbytes / 1e6]}) for b in batches)

    return max(r["mb"] for r in df.mapInArrow(run, "mb double").collect())


@pytest.mark.parametrize("step", [*(f for _, f in corpus_pipeline.STAGES), lambda s, d, _: near_dedup.near_duplicates(d)])
def test_long_texts_reach_python_a_few_mb_at_a_time(spark, tmp_path, step):
    session = spark.newSession()
    long = session.range(300).selectExpr(
        "id AS doc_id", "concat(id, repeat(' the and of', 4000)) AS text", "'en' AS lang", "'s' AS source", "44003L AS n_chars"
    )
    long.coalesce(1).write.parquet(str(tmp_path / "long"))
    docs = session.read.parquet(str(tmp_path / "long"))
    assert largest_batch(docs) > 10
    session.range(1).selectExpr("id AS doc_id", "'a b' AS text", "'en' AS lang", "'s' AS source", "3L AS n_chars").write.parquet(
        str(tmp_path / "one")
    )
    step(session, session.read.parquet(str(tmp_path / "one")), FOLDER)
    assert largest_batch(docs) < 3
    assert docs.count() == 300


def test_batches_that_a_session_has_set_stay(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
    corpus_pipeline.drop_near_copies(session, session.createDataFrame([(1, "a b")], "doc_id long, text string"), FOLDER)
    assert session.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "1m"


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.queries())
    assert numbers == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.queries())
