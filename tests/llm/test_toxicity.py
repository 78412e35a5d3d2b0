import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import toxicity
from ledgerloom.llm.tables import in_fold
from tests.llm.frames import ROWS, awkward, given, plain


@pytest.fixture(scope="module")
def tables(spark):
    return given(spark, "documents", "sf0.1"), given(spark, "labels", "sf0.1")


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.learn(*tables)


def test_held_out_labels(tables, model):
    """A few labels of this table mark texts that nothing sets apart."""
    docs, labels = tables
    held = labels.where(in_fold(F.col("doc_id")) & F.col("toxic").isNotNull())
    rows = toxicity.score(docs, model).join(held, "doc_id").collect()
    toxic = [r for r in rows if r["toxic"] == 1]
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert len(rows) > 500 and right >= 0.98 * len(rows)
    assert sum(r["predicted"] for r in toxic) >= 0.88 * len(toxic)
    assert sum(r["predicted"] for r in rows) <= 1.02 * sum(r["predicted"] for r in toxic)
    assert all((r["score"] >= 0.5) == r["predicted"] for r in rows)


@pytest.mark.parametrize(
    "shown,meant",
    [
        ("1d10t", "idiot"), ("l0s3r", "loser"), ("m0r0n", "moron"), ("tr@$h", "trash"), ("stuuuupid", "stupid"),
        ("S C U M", "scum"), ("s t u p i d", "stupid"), ("p.a.t.h.e.t.i.c", "pathetic"), ("cl0wwwn", "clown"),
    ],
)
def test_disguises_are_undone(model, shown, meant):
    decoder = toxicity.Decoder(model.table)
    assert toxicity.restored([f"that {shown}, there"], decoder) == [f"that {meant}, there"]


@pytest.mark.parametrize(
    "shown,meant",
    [
        ("you are a s t u p i d", "you are a stupid"), ("I l o s e r", "i loser"), ("a m 0 r 0 n!", "a moron!"),
        ("a.s.t.u.u.u.p.i.d", "a stupid"), ("a s t u p i d i d i o t", "a stupid idiot"),
    ],
)
def test_words_of_a_spaced_run_are_parted(model, shown, meant):
    assert toxicity.restored([shown], toxicity.Decoder(model.table)) == [meant]


@pytest.mark.parametrize(
    "shown,meant",
    [
        ("stuupid", "stupid"), ("iddiot", "idiot"), ("scuum", "scum"), ("iddioott", "idiot"), ("s - t - u - p - i - d", "stupid"),
        ("s  t  u  p  i  d", "stupid"), ("m...o...r...o...n", "moron"), ("d i e", "die"),
        ("s t u p i d  i d i o t", "stupid  idiot"), ("i - d - 1 - 0 - t", "idiot"),
    ],
)
def test_light_disguises_are_undone(model, shown, meant):
    decoder = toxicity.Decoder(model.table)
    assert toxicity.restored([f"that {shown}, there"], decoder) == [f"that {meant}, there"]


def test_usual_double_letters_stay_and_are_not_counted(spark, model):
    assert toxicity.restored(["Worthless, all"], toxicity.Decoder(model.table)) == ["Worthless, all"]
    rows = toxicity.score(plain(spark, ["worthless worthless", "iddiot worthless", ""]), model).orderBy("doc_id").collect()
    assert [r["n_restored"] for r in rows] == [0, 1, 0]


def test_a_spaced_sentence_is_as_toxic_as_its_words(model):
    decoder = toxicity.Decoder(model.table)
    shown = ["y o u m o r o n", "you are a s t u p i d", "I l o s e r", "y o u a r e p a t h e t i c", "t h e s c u m"]
    for text in toxicity.restored(shown, decoder):
        assert {"moron", "stupid", "loser", "pathetic", "scum"} & set(text.split()), text
    assert (model.scores(toxicity.restored(shown, decoder)) >= 0.5).all()


def test_words_are_looked_up_where_they_are_counted(spark):
    from ledgerloom.llm.words import word_hash

    for word in ("idiot", "straße", "слово", "a"):
        h = word_hash(word, toxicity._letter_values())
        assert toxicity._word_cells(word) == (h >> 46, h % toxicity.WORDS)
    docs = plain(spark, ["One word, one\nline", "one", None, ""])
    counts = toxicity.language_model(docs)[toxicity.TRIPLES + toxicity.CONTEXTS :].reshape(2, -1)
    assert [counts[i, cell] for i, cell in enumerate(toxicity._word_cells("one"))] == [3, 3]
    assert (counts.sum(axis=1) == 5).all()


def test_what_is_not_disguised_stays(model):
    decoder = toxicity.Decoder(model.table)
    for text in ["", "plain words, of the kind!", "12 34.5 (2020)", "of%%% athe*** whis$$$ to###", "Wow! Great!!", "a b", "$ 5 + 3 = 8"]:
        assert toxicity.restored([text], decoder) == [text]


def test_disguised_toxic_documents_score_high(spark, tables, model):
    docs, _ = tables
    clean = [r["text"] for r in docs.where("lang = 'en' AND n_chars BETWEEN 300 AND 900").orderBy("doc_id").limit(40).collect()]
    scores = [r["score"] for r in toxicity.score(plain(spark, clean), model).orderBy("doc_id").collect()]
    clean = [t for t, s in zip(clean, scores) if s < 0.5][:20]
    assert len(clean) == 20
    bad = ["1d10t", "l0s3r", "s t u p i d", "tr@$h", "m000ron", "w0rthle$$"]
    marked = [t + " " + bad[i % 6] + " the and of " + bad[(i + 1) % 6] + " " + t for i, t in enumerate(clean)]
    found = toxicity.score(plain(spark, marked), model).collect()
    assert sum(r["predicted"] for r in found) >= 19
    assert all(r["n_restored"] >= 2 for r in found)


def test_viterbi_takes_the_likeliest_path(model):
    """Against all paths of small lattices."""
    from itertools import product

    decoder = toxicity.Decoder(model.table)
    rng = np.random.default_rng(7)
    for _ in range(40):
        word = "".join(rng.choice(list("abdiotrs014$@"), size=rng.integers(1, 7)))
        lattice = decoder.options(word)
        found, score = decoder.best(lattice)

        def cost(path):
            a = b = 0
            total = 0.0
            for letters, channel in [*path, (" ", 0.0)]:
                total += channel
                for c in letters:
                    code = 0 if c == " " else ord(c)
                    if code or b:
                        total += decoder.cost(a, b, code)
                    a, b = (b, code) if code else (0, 0)
            return total

        best = max(cost(path) for path in product(*lattice))
        assert score == pytest.approx(best)


def test_doubled_letters_in_arrays_read_as_in_the_lattice(spark, tables, model):
    """Words of the documents, and words with letters doubled or left single at random."""
    docs, _ = tables
    rng = np.random.default_rng(9)
    told = {w.lower() for r in docs.limit(1500).collect() for w in (r["text"] or "").split() if w.isalpha()}
    more = {"".join(c * (1 + int(rng.random() < 0.2)) for c in w[:12]) for w in sorted(told)[::3]}
    some = sorted(w for w in told | more | {"stuupid", "iddioott", "ññ", "ee"} if toxicity._only_doubled(w))
    some = [w for w in some if any(a == b for a, b in zip(w, w[1:]))]
    assert len(some) > 10_000
    for shown in (None, model.shown):
        fast, slow = toxicity.Decoder(model.table, shown), toxicity.Decoder(model.table, shown)
        fast.prepare(set(some))
        assert len(fast.held) > 10_000
        assert {w: f for (w, _), f in fast.held.items()} == {w: slow.decode(w) for w, _ in list(fast.held)}
    assert any(f != w for (w, _), f in fast.held.items())


def test_a_repeated_labelled_document_counts_once(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(i, f"idiot moron {i}" if i % 3 == 0 else f"kind words {i}") for i in range(60)] + [(3, "idiot moron 3")] * 500,
        "doc_id long, text string",
    )
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    once = toxicity.learn(docs.distinct(), labels)
    many = toxicity.learn(docs, labels)
    assert (once.features == many.features).all() and np.allclose(once.weights, many.weights)


def test_language_model_counts_all_documents(spark):
    docs = given(spark, "documents")
    one, two = toxicity.language_model(docs), toxicity.language_model(docs.union(docs))
    assert one.sum() > docs.agg(F.sum("n_chars")).first()[0] and (two == 2 * one).all()


def test_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame(
        [(5, 1, 1), (5, None, 0), (9, 0, None), (7, 1, 0), (None, 1, 1), (10, 0, 0), (12, 1, 0), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    for known in (labels, labels.limit(0), labels.where("toxic = 1"), labels.where("toxic = 0")):
        rows = toxicity.score(docs, toxicity.learn(docs, known)).collect()
        assert len(rows) == len(ROWS)
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    none = docs.limit(0)
    assert toxicity.score(none, toxicity.learn(none, labels)).count() == 0
