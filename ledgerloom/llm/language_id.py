"""Languages of a text as a mixture, inferred by expectation-maximisation.

Each language is a distribution over character trigrams, counted over all labelled
training documents. A text's trigrams come from a mixture of languages and a uniform
noise component (markup, keys, numbers read as letters). EM estimates the shares;
the set of languages is the smallest beginning of the languages by share whose
likelihood, less a penalty for each language, isn't beaten by one language more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import by_place, documents, in_fold, place, slices
from ledgerloom.llm.words import code_points, folded_letters

BUCKETS = 1 << 16  # trigrams are hashed to so many
MOST_LANGUAGES = 200  # bound of the model that goes to every executor
_U32 = np.uint32


def trigrams(texts: list[str]) -> Iterator[np.ndarray]:
    """For each text the hashed trigrams around its letters; a run of other
    characters counts as one gap, and every text begins and ends with one."""
    codes, offset = code_points(texts)
    letters = folded_letters(False)[codes]
    keep = letters > 0
    keep[1:] |= letters[:-1] > 0  # the first gap after a letter stays
    at = np.concatenate(([0], np.cumsum(keep)))[offset]
    line = np.concatenate((np.zeros(1, _U32), letters[keep]))  # line[i + 1] is kept character i
    middle = line[1:] > 0
    after = np.concatenate((line[2:], np.zeros(1, _U32)))
    h = line[:-1] * _U32(0x9E3779B1) + line[1:] * _U32(0x85EBCA6B) + after * _U32(0xC2B2AE35)
    h ^= h >> _U32(15)
    h *= _U32(0x2C1B3C6D)
    h = (h >> _U32(16)).astype(np.int64)
    for i in range(len(texts)):
        own = slice(at[i], at[i + 1])
        yield h[own][middle[own]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for rows in slices(batch):
            by_lang: dict[str, list[np.ndarray]] = {}
            langs = rows.column("lang").to_pylist()
            for lang, grams in zip(langs, trigrams(rows.column("text").to_pylist())):
                by_lang.setdefault(lang, []).append(grams)
            for lang, parts in by_lang.items():
                total = totals.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                total += np.bincount(np.concatenate(parts), minlength=BUCKETS)
    for lang, total in totals.items():
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(total[some])],
            names=["lang", "bucket", "n"],
        )


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their trigram probabilities (buckets x languages, and a last
    column of noise), from all documents with a language outside the held-out fold.

    The counts are summed by Spark; the driver gets at most BUCKETS rows a language.
    """
    rows = documents(docs, lang="string").where("lang IS NOT NULL AND lang <> 'und'").where(~in_fold(F.col("doc_id")))
    counts = (
        rows.select("lang", "text")
        .mapInArrow(_count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    languages = [r[0] for r in counts.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()]
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} values of lang")
    languages.sort()
    found = counts.toArrow()
    table = np.zeros((BUCKETS, len(languages) + 1))
    place = {lang: i for i, lang in enumerate(languages)}
    where = np.array([place[lang] for lang in found["lang"].to_pylist()], dtype=np.int64)
    table[found["bucket"].to_numpy(), where] = found["n"].to_numpy()
    table += 0.1
    table[:, -1] = 1.0
    return languages, (table / table.sum(axis=0)).astype(np.float32)


def _shares(p: np.ndarray, n: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Mixture shares of the columns of ``p`` by EM, and the log-likelihood."""
    share = np.full(p.shape[1], 1.0 / p.shape[1], dtype=np.float32)
    total = n.sum()
    for _ in range(rounds):
        new = share * ((n / (p @ share)) @ p) / total
        done = np.abs(new - share).max() < 1e-3
        share = new
        if done:
            break
    return share, float(n @ np.log(p @ share))


def infer(grams: np.ndarray, model: np.ndarray, penalty: float) -> tuple[list[int], np.ndarray]:
    """The chosen languages, largest share first, and their shares with noise last."""
    kinds, n = np.unique(grams, return_counts=True)
    p, n = model[kinds], n.astype(np.float32)
    noise = model.shape[1] - 1
    first, _ = _shares(p, n, 20)
    order = np.argsort(-first[:noise], kind="stable")
    cost = penalty * np.log(len(grams) + 1.0)
    best, best_score = ([], np.ones(1, dtype=np.float32)), -np.inf
    for k in range(1, noise + 1):
        share, likelihood = _shares(p[:, [*order[:k], noise]], n, 20)
        # Neighbouring trigrams share characters: three of them tell about as much as one.
        score = likelihood / 3 - cost * k
        if score <= best_score:
            break
        place = sorted(range(k), key=lambda i: (-share[i], order[i]))
        best = [int(order[i]) for i in place], share[[*place, k]]
        best_score = score
    return best


def _judged(texts: list[str], languages: list[str], table: np.ndarray, penalty: float) -> Iterator[tuple]:
    """lang_pred, score, languages, shares, noise of each text."""
    for grams in trigrams(texts):
        if not len(grams) or not languages:
            yield "und", 0.0, [], [], 1.0
            continue
        chosen, share = infer(grams, table, penalty)
        sure = max(float(share[:-1].sum()), 1e-9)
        parts = [min(1.0, float(s) / sure) for s in share[:-1]]
        names = [languages[i] for i in chosen]
        yield names[0], parts[0], names, parts, min(1.0, max(0.0, float(share[-1])))


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], penalty: float = 2.0) -> DataFrame:
    """(doc_id, lang_pred, score, languages, shares, noise), one row per row of ``docs``.

    ``lang_pred`` is the language with the largest share, ``score`` its share of all
    chosen languages (0 to 1); ties go to the language first in the alphabet. A text
    that is null or has no letter is ``und`` with score 0, no languages, noise 1; so is
    every text if nothing could be learned. Nothing but the text is looked at.
    """
    languages, table = model
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                texts = rows.column("text").to_pylist()
                found = list(_judged(texts, languages, shared.value, penalty))
                columns = [pa.array([r[i] for r in found], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *columns], names=names)

    kinds = [pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64()), pa.float64()]
    names = ["doc_id", "lang_pred", "score", "languages", "shares", "noise"]
    schema = (
        "doc_id long, lang_pred string, score double, languages array<string>, "
        "shares array<double>, noise double"
    )
    return documents(docs).mapInArrow(run, schema)


def drop_unknown(
    docs: DataFrame, most_noise: float = 0.5, least_letters: int = 40, penalty: float = 2.0
) -> DataFrame:
    """``docs`` without the texts of no language: ``und``, or more noise than allowed.
    Fewer than ``least_letters`` letters tell too little to be called noise."""
    languages, table = learn(docs)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    text = place(docs, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, text):
                texts = [t or "" for t in rows.column(text).to_pylist()]
                found = _judged(texts, languages, shared.value, penalty)
                sizes = map(len, trigrams(texts))
                keep = [
                    lang != "und" and (noise <= most_noise or n < least_letters)
                    for (lang, _, _, _, noise), n in zip(found, sizes)
                ]
                yield rows.filter(pa.array(keep, pa.bool_()))

    plain = by_place(docs)
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
