import random
import re

import pytest

from ledgerloom.llm import near_dedup
from ledgerloom.llm.components import components, merged
from tests.llm.frames import ROWS, awkward, given, plain

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts: dict, size: int, percent: int) -> dict:
    """(set size, smallest id reachable) of every document, from all pairs."""
    sets = {}
    for i, text in texts.items():
        w = WORD.findall((text or "").translate(FOLD))
        n = min(size, len(w))
        sets[i] = frozenset(tuple(w[j : j + n]) for j in range(len(w) - n + 1)) if w else frozenset()
    up = {i: i for i in texts}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                inner = len(x & y)
                if 100 * inner >= percent * (len(x) + len(y) - inner):
                    one, other = sorted((root(a), root(b)))
                    up[other] = one
    return {i: (len(sets[i]), root(i)) for i in texts}


def found(df, size, percent):
    rows = near_dedup.near_duplicates(df, size, percent).collect()
    for r in rows:
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_components_of_given_documents(spark, size, percent):
    docs = given(spark, "documents", "sf0.01")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    expected = brute(texts, size, percent)
    assert found(docs, size, percent) == expected
    assert len({c for _, c in expected.values()}) < len(expected)


def test_dense_groups_stars_and_chains(spark, monkeypatch):
    """Many copies with changes that are alike to the original and not to each other, a
    chain in which only neighbours are alike, and unlike texts from one template."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "CHUNK", 16)
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    base = [word() for _ in range(120)]
    texts = []
    for _ in range(60):
        own = list(base)
        at = rng.sample(range(0, 118, 4), rng.choice((2, 3, 4)))
        for i in at:
            own[i] = word()
        texts.append(" ".join(own))
    chain = [word() for _ in range(300)]
    texts += [" ".join(chain[i : i + 100]) for i in range(0, 160, 5)]
    for _ in range(40):
        texts.append(" ".join([*base[:60], *(word() for _ in range(60))]))
    texts += [" ".join(base)] * 5 + [" ".join(base[1:])] * 3
    rng.shuffle(texts)
    assert found(plain(spark, texts), 3, 85) == brute(dict(enumerate(texts)), 3, 85)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = near_dedup.near_duplicates(docs, 3, 85).collect()
    assert len(rows) == len(ROWS)
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by_id[9] == [(11, 5, False)] and by_id[5] == [(11, 5, True)] * 2
    assert by_id[1] == [(0, 1, True)] and by_id[2] == [(0, 2, True)] and by_id[3] == [(0, 3, True)]
    assert by_id[8] == [(1, 8, True)] and by_id[12] == [(1, 12, True)]
    assert sorted(by_id[None]) == [(0, None, True), (8, None, True)]
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r[0] for r in kept.collect()))) == sorted(
        ["5", "1", "2", "3", "4", "None", "None", "7", "8", "10", "12"]
    )
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0
    assert near_dedup.drop_near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_a_component_stays_whatever_its_id(spark):
    """A clean text that shares the id of a copy stays; repeated rows, and copies without
    an id, are copies."""
    words_ = " ".join(f"w{i}" for i in range(30))
    other = " ".join(f"v{i}" for i in range(30))
    third = " ".join(f"u{i}" for i in range(30))
    rows = [(1, words_), (2, words_), (2, other), (7, third), (7, third), (None, third), (None, words_ + " more"), (None, "alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = near_dedup.drop_near_duplicates(docs).collect()
    assert sorted((str(r[0]), r[1]) for r in kept) == sorted(
        [("1", words_), ("2", other), ("7", third), ("None", "alone here")]
    )
    nameless = spark.createDataFrame([(None, third)] * 3, "doc_id long, text string")
    assert near_dedup.drop_near_duplicates(nameless).count() == 1


def test_words_made_to_collide_make_no_link(spark):
    """Thue-Morse words: polynomial hashes modulo a power of two can't tell them apart."""
    from tests.llm.frames import thue_morse

    texts = [w for n in (10, 11, 12) for w in thue_morse(n)]
    assert {i: c for i, (_, c) in found(plain(spark, texts), 3, 85).items()} == {i: i for i in range(6)}
    told = [" ".join([w, "b c d e f g h"]) for w in texts]
    assert {i: c for i, (_, c) in found(plain(spark, told), 1, 85).items()} == {i: i for i in range(6)}


def test_components_of_paths_stars_and_later_links(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(9, 8), (8, 9), (7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    label = {r["id"]: r["component"] for r in components(df).collect()}
    assert {label[i] for i in range(100, 161)} == {100}
    assert {label[i] for i in range(500, 540)} == {500} and label[9] == 8 and 7 not in label
    more = spark.createDataFrame([(160, 539), (3, 9), (1000, 1001)], "a long, b long")
    both = {r["id"]: r["component"] for r in merged(components(df), more).collect()}
    every = {r["id"]: r["component"] for r in components(df.union(more)).collect()}
    assert both == every and both[520] == 100 and both[8] == 3 and both[1001] == 1000
