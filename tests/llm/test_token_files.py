import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import token_files as t
from ledgerloom.sources.workspace import new_folder
from tests.llm.frames import awkward, given

PATH = public_tokenizers.path("word_bpe_49k.json")

WORDS = public_tokenizers.path("word_bpe_49k.json")


def brute(rows, path=WORDS):
    tokenizer, at, out = Tokenizer.from_file(path), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, t.END]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def written(spark, docs, path=WORDS, **options):
    folder = new_folder(spark, "tokens")
    t.write_tokens(docs, path, folder, **options)
    return folder


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_come_back(spark, name):
    docs = given(spark, "documents")
    path = public_tokenizers.path(name)
    folder = written(spark, docs, path)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(tuple(r) for r in t.token_index(spark, folder).collect()) == sorted(brute(rows, path))


def test_words_encoded_one_by_one_give_the_ids_of_the_text(monkeypatch):
    rng = random.Random(2)
    parts = list(" \t\n\u0301eEés'tABc12½ßİſ中文!?,.-\x1c\x85\xa0\u2028\u3000\u200b😀ﬁ") + ["<|endoftext|>", "  ", "'LL", "\u2003"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(20_000)]
    encoder = t.Encoder(WORDS)
    assert encoder.by_word and not t.Encoder(public_tokenizers.path("byte_bpe_50k.json")).by_word
    ids = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def whole(size):
        out = []
        for k in range(0, len(texts), size):
            flat, sizes = encoder.encode(texts[k : k + size])
            out += [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]
        return out

    assert whole(5000) == ids
    assert encoder.sizes(texts).tolist() == [len(x) for x in ids]
    encoder = t.Encoder(WORDS)
    monkeypatch.setattr(t, "HELD_WORDS", 100)  # words beyond these are not kept
    assert whole(20) == ids and len(encoder.hashes) <= 100


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r[0], r[1]) for r in docs.collect()]
    found = [tuple(r) for r in t.token_index(spark, written(spark, docs)).collect()]
    assert sorted(found, key=str) == sorted(brute(rows), key=str)
    assert t.token_index(spark, written(spark, docs.limit(0))).count() == 0


def test_lookups_skip_what_cannot_hold_a_document(spark):
    """Files are sorted by id, have row index entries and a Bloom filter on the id."""
    docs = given(spark, "documents", "sf0.01")
    folder = written(spark, docs, rows=1000)
    one = t.read_tokens(spark, folder).where("doc_id = 77")
    assert "EqualTo(doc_id,77)" in one._jdf.queryExecution().toString()
    assert one.count() == 1
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    files = [f.getPath() for f in fs.listStatus(path) if f.getPath().getName().endswith(".orc")]
    ranges = []
    for file in files:
        reader = sc._jvm.org.apache.orc.OrcFile.createReader(
            file, sc._jvm.org.apache.orc.OrcFile.readerOptions(sc._jsc.hadoopConfiguration())
        )
        if not reader.getNumberOfRows():
            continue
        ids = reader.getStatistics()[1]
        ranges.append((ids.getMinimum(), ids.getMaximum()))
        footer = reader.rows()
        assert reader.getStripes().size() >= 1
        footer.close()
    ranges.sort()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_words_made_to_collide_have_their_own_ids(spark, tmp_path):
    from tests.llm.frames import thue_morse

    texts = [w for n in (10, 11, 12) for w in thue_morse(n)]
    plain_ids = [f.ids for f in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    for some in (texts, [f"{w} and {w}" for w in texts]):
        ids, sizes = t.Encoder(PATH).encode(some)
        expected = [f.ids for f in Tokenizer.from_file(PATH).encode_batch(some, add_special_tokens=False)]
        assert sizes.tolist() == [len(x) for x in expected] and ids.tolist() == [i for x in expected for i in x]
    assert plain_ids[0] != plain_ids[1]


def test_words_that_share_a_hash_are_told_apart(monkeypatch):
    """All words of a length made to share a hash, within a batch and with words held."""
    real = t.words

    def clashing(texts, values):
        found = real(texts, values)
        return found._replace(hash=(found.end - found.start).astype(found.hash.dtype))

    monkeypatch.setattr(t, "words", clashing)
    encoder = t.Encoder(PATH)
    for texts in (["one six", "three seven"], ["two"], ["one two six ten"], [""]):
        ids, sizes = encoder.encode(texts)
        expected = [f.ids for f in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
        assert sizes.tolist() == [len(x) for x in expected] and ids.tolist() == [i for x in expected for i in x]


def test_an_id_that_many_rows_share_is_in_several_files(spark, tmp_path):
    docs = spark.createDataFrame([(5, f"text {i % 50}") for i in range(4000)] + [(1, "a"), (9, "b")], "doc_id long, text string")
    path = str(tmp_path / "hot")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    t.write_tokens(docs, PATH, path)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    written = t.read_tokens(spark, path)
    assert written.where("doc_id = 5").select("file").distinct().count() > 2
    rows = t.token_index(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [1] + [5] * 4000 + [9]
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
