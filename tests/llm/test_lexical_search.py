import math
import random
import re
from collections import Counter

import pytest

from ledgerloom.llm import lexical_search
from tests.llm.frames import ROWS, awkward, given

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, most=10):
    """(item, rank, doc, score) with every document's terms counted one by one."""
    terms = [(i, Counter(TERM.findall((t or "").translate(FOLD)))) for i, t in docs]
    n_docs = sum(1 for _, c in terms if c)
    total = sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    wanted = {}
    for item, text in items:
        if item is not None and text is not None:
            wanted.setdefault(item, set()).update(TERM.findall(text.translate(FOLD)))
    out = []
    for item, own in wanted.items():
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in own}
        scored = []
        for doc, c in terms:
            if c:
                m = 10 + 90 * sum(c.values()) * n_docs // total
                score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if t in c)
                if score > 0:
                    scored.append((-score, doc is None, doc))
        scored.sort()
        out += [(item, rank, doc, -low) for rank, (low, _, doc) in enumerate(scored[:most], 1)]
    return sorted(out, key=lambda r: r[:2])


def found(docs, items, **more):
    return sorted((tuple(r) for r in lexical_search.search(docs, items, **more).collect()), key=lambda r: r[:2])


def test_given_documents(spark):
    docs, items = given(spark, "documents"), given(spark, "benchmark")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    asked = [(r["item_id"], r["text"]) for r in items.collect()]
    expected = brute(texts, asked)
    assert found(docs, items) == expected
    assert len(expected) > 100


@pytest.mark.parametrize("terms", [3, 100_000])
def test_awkward_rows_ties_and_blocks_of_items(spark, monkeypatch, terms):
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", terms)
    items = [
        (1, "The FOX, the dog"), (2, None), (3, "..."), (None, "fox"), (4, "nothing-here"),
        (5, "dach haus 😀"), (5, "word"), (6, "12 34"), (7, "erst thorn"), (8, "fo ox he"),
    ]
    table = spark.createDataFrame(items, "item_id long, text string")
    extra = table.selectExpr("item_id", "text", "text AS TEXT", "1 AS Item_ID", "2 AS rank")
    docs = awkward(spark)
    rows = [(r[0], r[1]) for r in ROWS]
    assert found(docs, extra) == brute(rows, items)
    assert found(docs, extra, most=2) == brute(rows, items, 2)
    assert found(docs.limit(0), table) == [] and found(docs, table.limit(0)) == []


def test_terms_at_cuts_of_long_texts(spark, monkeypatch):
    """Pieces are cut between terms, whatever their length."""
    rng = random.Random(5)
    words = ["ab", "abc", "b", "c" * 40, "ñé", "d1"]
    texts = [(i, "".join(rng.choice(words) + rng.choice(" .,\n_") for _ in range(200))) for i in range(30)]
    items = [(k, w) for k, w in enumerate(words)] + [(99, " ".join(words)), (100, "bc")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    expected = brute(texts, items)
    machine = lexical_search.automaton([w.encode() for w in words])
    whole = [lexical_search.scan(t, machine) for _, t in texts]
    monkeypatch.setattr(lexical_search, "PIECE", 16)
    assert [lexical_search.scan(t, machine) for _, t in texts] == whole
    assert found(docs, spark.createDataFrame(items, "item_id long, text string")) == expected
