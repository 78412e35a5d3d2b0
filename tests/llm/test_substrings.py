import hashlib
import random
import re

import numpy as np
import pytest

from ledgerloom.llm import substrings
from ledgerloom.llm.fm_index import FmIndex, Wavelet, repeated
from tests.llm.frames import ROWS, awkward, given

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPAN = 13


def brute(rows):
    """Every window of every document, in a dictionary of the smallest document with it."""
    told = [(i, WORD.findall(t or "")) for i, t in rows]
    lowest = {}
    for i, w in told:
        for k in range(len(w) - SPAN + 1) if i is not None else ():
            key = tuple(w[k : k + SPAN])
            lowest[key] = min(i, lowest.get(key, i))
    out = []
    for i, w in told:
        gone = set()
        for k in range(len(w) - SPAN + 1) if i is not None else ():
            if lowest[tuple(w[k : k + SPAN])] < i:
                gone.update(range(k, k + SPAN))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def found(df):
    rows = substrings.drop_repeats(df).collect()
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows)


def test_given_documents(spark):
    docs = given(spark, "documents", "sf0.01")
    expected = brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert found(docs) == expected
    assert sum(r[2] > 0 for r in expected) > 50


def passages(seed):
    """Documents of few words with passages in common, copies, and copies with a change."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice(["", "x", "é", " ", " "])
    shared = [[word() for _ in range(rng.randrange(10, 60))] for _ in range(6)]
    rows = []
    for i in range(120):
        w = []
        for _ in range(rng.randrange(0, 5)):
            w += rng.choice(shared) if rng.random() < 0.6 else [word() for _ in range(rng.randrange(20))]
        if w and rng.random() < 0.3:
            w[rng.randrange(len(w))] = word()
        rows.append((rng.randrange(90), "".join(x + rng.choice([" ", "\n", "\t ", "\x0b"]) for x in w)))
    return rows + [(200, rows[5][1]), (None, rows[7][1]), (None, "z " * 40), (201, "z " * 40), (202, "z " * 40)]


@pytest.mark.parametrize("hot,shard", [(1 << 15, 1 << 20), (2, 200)])
def test_passages_hot_anchors_and_small_shards(spark, monkeypatch, hot, shard):
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "SHARD_WORDS", shard)
    rows = passages(hot)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute(rows)
    assert found(df) == expected
    assert sum(r[2] > 0 for r in expected) > 20


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert found(docs) == brute([(r[0], r[1]) for r in ROWS])
    assert found(docs.limit(0)) == []


def test_equal_windows_lie_in_segments_with_equal_anchors():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 40, 5000).astype(np.uint64)
    text = np.sort(rng.integers(0, 30, 5000))
    first, many, anchor = substrings.segments(hashes, text)
    by_window, seen = {}, []
    for f, n, a in zip(first.tolist(), many.tolist(), anchor.tolist()):
        for at in range(f, f + n):
            assert text[at] == text[at + SPAN - 1]
            seen.append(at)
            assert by_window.setdefault(tuple(hashes[at : at + SPAN].tolist()), a) == a
    assert seen == [i for i in range(5000 - SPAN + 1) if text[i] == text[i + SPAN - 1]]


def test_ranks_and_backward_search():
    rng = np.random.default_rng(6)
    for symbols, size in ((1, 9), (2, 100), (7, 500), (300, 1000)):
        values = rng.integers(0, symbols, size)
        tree = Wavelet(values, symbols)
        symbol, at = rng.integers(0, symbols, 200), rng.integers(0, size + 1, 200)
        assert tree.rank(symbol, at).tolist() == [int((values[:a] == s).sum()) for s, a in zip(symbol, at)]
    for span in (2, 5, 13):
        texts = [rng.integers(1, 4, rng.integers(0, 40)).tolist() for _ in range(60)]
        tokens = np.array([x for t in texts for x in [*t, 0]])
        end = np.cumsum([len(t) + 1 for t in texts]) - 1
        first = end - [len(t) for t in texts]
        index = FmIndex(tokens, 4, span - 1)
        start, low, high = repeated(index, tokens, first, end, span)
        count = {}
        for t in texts:
            for k in range(len(t) - span + 1):
                count[tuple(t[k : k + span])] = count.get(tuple(t[k : k + span]), 0) + 1
        expected = {
            f + k for t, f in zip(texts, first.tolist()) for k in range(len(t) - span + 1) if count[tuple(t[k : k + span])] > 1
        }
        assert set(start.tolist()) == expected and len(start) == len(expected)
        for s, a, b in zip(start, low, high):
            own = tuple(tokens[s : s + span])
            assert {tuple(tokens[p : p + span]) for p in index.places[a:b]} == {own} and b - a == count[own]
