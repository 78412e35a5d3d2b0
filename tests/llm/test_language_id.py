import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import language_id
from ledgerloom.llm.tables import in_fold
from tests.llm.frames import ROWS, awkward, given, plain


def test_held_out_documents_and_mixtures(spark):
    docs = given(spark, "documents", "sf0.01")
    model = language_id.learn(docs)
    assert model[0] == ["de", "en", "es", "fr"]
    found = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where(in_fold(F.col("doc_id")))
    right = held.where("lang_pred = lang").count()
    assert right >= 0.99 * held.count() > 100

    texts = [docs.where(f"lang = '{x}' AND n_chars > 1000").first()["text"][:1000] for x in ("fr", "de")]
    mixed = language_id.identify(plain(spark, [texts[0] + "\n" + texts[1], texts[0]]), model).collect()
    assert sorted(mixed[0]["languages"]) == ["de", "fr"] and min(mixed[0]["shares"]) > 0.3
    assert mixed[1]["languages"] == ["fr"] and mixed[1]["score"] == 1.0
    noise = language_id.identify(plain(spark, ["zqxjk vkxq wqzx kjqz xqzv jkqx zzqk"]), model).first()
    assert noise["noise"] > 0.5


def test_em_finds_the_shares_of_a_known_mixture():
    rng = np.random.default_rng(1)
    model = rng.dirichlet(np.full(500, 0.05), 3).T.astype(np.float32) + 1e-7
    grams = np.concatenate([rng.choice(500, n, p=model[:, i] / model[:, i].sum()) for i, n in ((0, 6000), (1, 4000))])
    chosen, share = language_id.infer(grams, model, 2.0)
    assert chosen == [0, 1] and abs(share[0] - 0.6) < 0.05


def test_held_out_documents_are_not_learned_from(spark):
    docs = given(spark, "documents")
    other = docs.withColumn("lang", F.when(in_fold(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    model, same = language_id.learn(docs), language_id.learn(other)
    assert model[0] == same[0] and (model[1] == same[1]).all()


def test_awkward_rows(spark):
    docs = awkward(spark)
    model = language_id.learn(docs)
    found = language_id.identify(docs, model)
    assert found.count() == len(ROWS)
    for row in found.collect():
        assert 0 <= row["score"] <= 1
    unknown = {r["doc_id"] for r in found.where("lang_pred = 'und'").collect()}
    assert unknown == {None, 1, 2, 3, 4}
    kept = language_id.drop_unknown(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.collect() if r[0] is not None) == [5, 5, 7, 9, 10, 12]


def test_nothing_to_learn_from(spark):
    docs = awkward(spark).limit(0)
    model = language_id.learn(docs)
    assert model[0] == [] and language_id.identify(docs, model).count() == 0
    assert language_id.identify(awkward(spark), model).where("lang_pred <> 'und'").count() == 0
    assert language_id.drop_unknown(docs).count() == 0
