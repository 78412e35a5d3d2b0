"""Ranked lexical search: one Aho-Corasick automaton of all item terms scans the texts.

There is no index of the documents. The items' terms, each between two guards, make an
automaton that goes to every task; a text with its separators folded to the guard is read
once and gives each term's number of occurrences. A first scan counts how many documents
hold each term, a second one scores every document: the terms found lead to the items
that have them, and each task keeps only its best documents of an item.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.tables import chosen, documents, slices, stored

BLOCK_TERMS = 100_000  # terms of items searched in one pass; more items take more passes
PIECE = 1 << 22  # bytes of a text that the automaton reads at once
SALTS = 64  # parts in which an item's best documents are found before they meet
_GUARD = b" "

# Terms are ASCII letters and digits and all that isn't ASCII; A-Z are lower-cased. In
# UTF-8 every byte of a character beyond ASCII is 128 or more, so bytes can be folded.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else _GUARD[0]
    for c in range(256)
)

FOUND = "item_id long, doc_id long, score long"


def folded(text: str) -> bytes:
    """The text's bytes, lower-cased, with a guard for every separator."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD)


class Items(NamedTuple):
    """Items of one pass: their ids, their terms together, and for each term the places
    of the items that have it (``item[first[t]:first[t + 1]]``)."""

    ids: list[int]
    terms: list[bytes]
    first: np.ndarray
    item: np.ndarray


def items_of(texts: list[tuple[int, set[bytes]]]) -> Items:
    pairs = sorted((term, k) for k, (_, terms) in enumerate(texts) for term in terms)
    terms = sorted({term for term, _ in pairs})
    place = {term: i for i, term in enumerate(terms)}
    owners = np.array([place[term] for term, _ in pairs], dtype=np.int64)
    first = np.searchsorted(owners, np.arange(len(terms) + 1))
    return Items([i for i, _ in texts], terms, first, np.array([k for _, k in pairs], dtype=np.int64))


def automaton(terms: list[bytes]) -> ahocorasick.Automaton:
    """Matches whole terms only: each is guarded on both sides, and neighbours in a text
    share the guard between them."""
    machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, term in enumerate(terms):
        machine.add_word((_GUARD + term + _GUARD).decode("latin-1"), i)
    machine.make_automaton()
    return machine


def _pieces(data: bytes) -> Iterator[bytes]:
    """Guarded pieces of a folded text, cut between terms."""
    at = 0
    while at < len(data):
        stop = len(data)
        if stop - at > PIECE:
            cut = data.rfind(_GUARD, at, at + PIECE)
            if cut <= at:
                cut = data.find(_GUARD, at + PIECE)  # a term longer than a piece stays whole
            stop = cut + 1 if cut > 0 else stop
        yield _GUARD + data[at:stop] + _GUARD
        at = stop


def scan(text: str, machine: ahocorasick.Automaton | None) -> tuple[int, Counter]:
    """How many terms the text has, and how often each term of the automaton is in it."""
    n, found = 0, Counter()
    for piece in _pieces(folded(text)):
        n += len(piece.split())
        if machine is not None:
            found.update(map(itemgetter(1), machine.iter(piece.decode("latin-1"))))
    return n, found


def _blocks(items: DataFrame) -> Iterator[Items]:
    """The items in passes of about BLOCK_TERMS terms. Rows with the same id are one item."""
    rows = chosen(items, item_id="long", text="string").where("item_id IS NOT NULL AND text IS NOT NULL")
    block: list[tuple[int, set[bytes]]] = []
    held = 0
    for row in rows.orderBy("item_id").toLocalIterator():
        terms = set(folded(row["text"]).split())
        if block and block[-1][0] == row["item_id"]:
            held += len(terms - block[-1][1])
            block[-1][1].update(terms)
            continue
        if block and held + len(terms) > BLOCK_TERMS:
            yield items_of(block)
            block, held = [], 0
        block.append((row["item_id"], terms))
        held += len(terms)
    if block:
        yield items_of(block)


def _counting(shared):
    """(term, n): for each term of the automaton the documents that hold it; under -1 the
    documents with any term at all, under -2 all terms with their repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value.terms
        machine = automaton(terms) if terms else None
        holders = np.zeros(len(terms), dtype=np.int64)
        some = total = 0
        for batch in batches:
            for rows in slices(batch):
                for text in rows.column("text").to_pylist():
                    n, found = scan(text, machine)
                    some, total = some + (n > 0), total + n
                    holders[list(found)] += 1
        held = np.flatnonzero(holders)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(([-1, -2], held))), pa.array(np.concatenate(([some, total], holders[held])))],
            names=["term", "n"],
        )

    return run


def _scoring(shared, weights, n_docs: int, n_terms: int, most: int):
    """Each task's ``most`` best documents of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = shared.value, weights.value
        machine = automaton(items.terms)
        best: list[list[tuple]] = [[] for _ in items.ids]
        least = np.ones(len(items.ids), dtype=np.int64)  # a score must be above 0
        for batch in batches:
            for rows in slices(batch):
                for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()):
                    n, found = scan(text, machine)
                    if not found:
                        continue
                    m = 10 + 90 * n * n_docs // n_terms
                    terms = np.fromiter(found, np.int64, len(found))
                    tf = np.fromiter(found.values(), np.int64, len(found))
                    worth = weight[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
                    many = items.first[terms + 1] - items.first[terms]
                    steps = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    of = items.item[np.repeat(items.first[terms], many) + steps]
                    score = np.zeros(len(items.ids), dtype=np.int64)
                    np.add.at(score, of, np.repeat(worth, many))
                    for k in np.flatnonzero(score >= least).tolist():
                        own = (int(score[k]), doc_id is not None, -(doc_id or 0))
                        if len(best[k]) < most:
                            heapq.heappush(best[k], own)
                        else:
                            heapq.heappushpop(best[k], own)
                        if len(best[k]) == most:
                            least[k] = best[k][0][0]
        out = [(items.ids[k], -low if known else None, score) for k, own in enumerate(best) for score, known, low in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["item_id", "doc_id", "score"]
        )

    return run


def search(docs: DataFrame, items: DataFrame, most: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its ``most`` best documents with a
    score above 0, best first, equal scores by ascending doc_id.

    Every row of ``docs`` is a document; a null or empty text has no terms, and a row
    without doc_id comes after its equals. Repeated rows rank one after another. Items
    without text or terms find nothing, items without id are left out, rows with the same
    item_id are one item with the terms of all. Documents are read twice for each block of
    BLOCK_TERMS terms of items; the driver gets one number a term, and a block's terms are
    all that is broadcast.
    """
    spark = docs.sparkSession
    texts = documents(docs)
    parts = [spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")]
    for block in _blocks(items):
        if not block.terms:
            continue
        shared = spark.sparkContext.broadcast(block)
        counted = (
            texts.select("text").mapInArrow(_counting(shared), "term long, n long")
            .groupBy("term").agg(F.sum("n").alias("n")).toArrow()
        )
        counts = dict(zip(counted["term"].to_pylist(), counted["n"].to_pylist()))
        n_docs, n_terms = counts.get(-1, 0), counts.get(-2, 0)
        if n_terms:
            held = [counts.get(t, 0) for t in range(len(block.terms))]
            weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in held]
            weights = spark.sparkContext.broadcast(np.array(weight, dtype=np.int64))
            found = texts.mapInArrow(_scoring(shared, weights, n_docs, n_terms, most), FOUND)
            parts.append(stored(_ranked(found, most), "ranked"))
            weights.unpersist()
        shared.unpersist()
    result = parts[0]
    for more in parts[1:]:
        result = result.union(more)
    return result


def _ranked(found: DataFrame, most: int) -> DataFrame:
    """The best of what the tasks found: in parts first, so that no task gets all of an
    item's rows from all others."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    first = Window.partitionBy("item_id", "part").orderBy(*order)
    last = Window.partitionBy("item_id").orderBy(*order)
    return (
        found.withColumn("part", part)
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= most)
        .withColumn("rank", F.row_number().over(last))
        .where(F.col("rank") <= most)
        .select("item_id", "rank", "doc_id", "score")
    )
