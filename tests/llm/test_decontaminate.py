from collections import Counter

import numpy as np

from ledgerloom.llm import decontaminate as d
from ledgerloom.llm.words import U, letters_and_digits, words
from tests.llm.frames import awkward, given, plain


def test_index_finds_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(3)
    items = [rng.integers(0, 1 << 62, 30, dtype=np.int64).view(U) for _ in range(40)]
    (group,) = d.index(items)
    flips = [sum(1 << int(i) for i in rng.choice(64, k, replace=False)) for k in range(20) for _ in range(60)]
    prints = np.array([int(group.prints[i % 40]) ^ f for i, f in enumerate(flips)], dtype=U)
    found = set(zip(*(x.tolist() for x in d.near(prints, group))))
    brute = {
        (i, j)
        for i, p in enumerate(prints.tolist())
        for j, q in enumerate(group.prints.tolist())
        if (p ^ q).bit_count() <= d.RADIUS
    }
    assert found == brute and len(brute) > 500


def test_running_sums_give_the_simhash():
    values = np.random.default_rng(4).integers(0, 1 << 62, 700, dtype=np.int64).view(U) * U(5)
    for size in (1, 2, 7, 120, 250, 300):
        bits = d._bits_for(size)
        found = d._fingerprints(d._sums(values, bits), bits, size, 700 - size + 1)
        for i in (0, 100, 700 - size):
            own = values[i : i + size].tolist()
            expected = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in own) > size)
            assert int(found[i]) == expected


def _brute(texts, items, size=5, percent=80):
    def shingles(w):
        n = min(size, len(w))
        return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()

    hashed = lambda t: words([t or ""], letters_and_digits()).hash.tolist()
    found = {}
    for i, text in enumerate(texts):
        w = hashed(text)
        for j, item in enumerate(items):
            own = hashed(item)
            one = shingles(own)
            best = 0.0
            for start in range(max(1, len(w) - len(own) + 1)):
                other = shingles(w[start : start + len(own)])
                inner, union = sum((one & other).values()), sum((one | other).values())
                best = max(best, inner / union if union else 0.0)
            if own and best * 100 >= percent:
                found[i, j] = round(best, 9)
    return found


def test_leaks_are_those_of_brute_force(spark):
    items = [r["text"] for r in given(spark, "benchmark").orderBy("item_id").limit(12).collect()]
    prose = [r["text"][:600] for r in given(spark, "documents").where("n_chars < 3000").orderBy("doc_id").limit(25).collect()]
    changed = []
    for i, item in enumerate(items):
        w = item.split()
        changed += [
            prose[i] + " " + item + " " + prose[i + 1],
            prose[i] + "\n" + item.upper().replace(" ", "\n") + "!",
            " ".join([*prose[i].split()[:7], *w[1:], "other", "end"]),  # first word gone
            " ".join([*w[: len(w) // 2], "inserted", *w[len(w) // 2 :]]),
            " ".join(w[:-2]),
            " ".join(w[: len(w) // 2]) + prose[i],  # half: clean
        ]
    texts = prose + changed + ["", None, "one two"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {
        (r["doc_id"], r["item_id"]): round(r["similarity"], 9)
        for r in d.leaks(plain(spark, texts), bench).collect()
    }
    brute = _brute(texts, items)
    assert len(brute) >= 24
    assert found == brute


def test_sliding_overlaps_are_those_of_counted_shingles():
    rng = np.random.default_rng(12)
    for size, n_item, n_text, kinds in ((5, 40, 200, 3), (5, 9, 60, 2), (5, 3, 50, 2), (3, 30, 20, 2), (5, 12, 4, 2), (1, 6, 40, 3)):
        item, own = (rng.integers(1, kinds + 1, n).astype(U) for n in (n_item, n_text))
        wide = min(n_item, n_text)
        starts = np.unique(rng.integers(0, n_text - wide + 1, 30))
        found, weight = d.overlaps(d.weights_of(item, size), own, starts, size)

        def counted(w):
            n = min(size, len(w))
            return Counter(tuple(w[i : i + n].tolist()) for i in range(len(w) - n + 1))

        windows = [counted(own[s : s + wide]) for s in starts]
        assert found.tolist() == [sum((counted(item) & w).values()) for w in windows]
        assert {weight} == {sum(w.values()) for w in windows}


def test_groups_of_one_and_of_many_items(spark):
    """One length with one item, one with 24 and one with 200: each is found by its index."""
    rng = np.random.default_rng(13)
    word = lambda: "w" + str(rng.integers(0, 400))
    items = [[word() for _ in range(n)] for n in [30] + [60] * 24 + [120] * 200]
    assert [len(g.items) for g in d.index([words([" ".join(i)], letters_and_digits()).hash for i in items])] == [1, 24, 200]
    texts = []
    for k in [0, 0, *range(1, 25, 3), *range(25, 225, 9)]:
        own = list(items[k])
        own[int(rng.integers(len(own)))] = word()
        texts.append(" ".join([*(word() for _ in range(9)), *own, *(word() for _ in range(7))]))
    texts += [" ".join(word() for _ in range(150)) for _ in range(5)]
    told = [" ".join(i) for i in items]
    bench = spark.createDataFrame(list(enumerate(told)), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in d.leaks(plain(spark, texts), bench).collect()}
    assert found == _brute(texts, told) and len(found) >= 30


def test_passages_of_just_enough_likeness_are_found():
    """Items cut at the end, in the middle of other words, to a likeness of 0.80 or 0.81."""
    rng = np.random.default_rng(11)
    missed = n = 0
    for size in (40, 49, 58, 100):
        for _ in range(60):
            item, longer, before, after = (rng.integers(0, 1 << 62, k, dtype=np.int64).view(U) for k in (size, size - 1, 60, 60))
            groups = d.index([item, longer])
            kept = next(k for k in range(size // 2, size) if 10 * (k - 4) >= 8 * (2 * (size - 4) - (k - 4)))
            hashes = np.concatenate((before, item[:kept], after))
            offset = np.array([0, len(hashes) + 1])
            place = np.arange(len(hashes))
            found = d.Words(np.zeros(len(hashes), np.int64), hashes, place, place + 1, np.array([0, len(hashes)]), offset)
            missed += not any(m[1] == 0 for m in d.matches(found, [d.weights_of(w, 5) for w in (item, longer)], groups, 5, 80))
            n += 1
    assert n == 240 and missed <= 1


def test_planted_items_of_the_tables(spark):
    docs, bench = given(spark, "documents", "sf0.01"), given(spark, "benchmark", "sf0.01")
    items = {r["item_id"]: r["text"] for r in bench.collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    exact = {(i, j) for i, t in texts.items() for j, item in items.items() if item in t}
    found = {(r["doc_id"], r["item_id"]) for r in d.leaks(docs, bench).collect()}
    assert exact and exact <= found
    kept = {r["doc_id"] for r in d.drop_leaks(docs, bench).collect()}
    assert kept == set(texts) - {i for i, _ in found}


def test_blocks_of_items_and_awkward_rows(spark, monkeypatch):
    docs = awkward(spark)
    bench = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "Word", "x"), (3, "Word", "x"), (None, "fox jumps over the lazy dog and runs", None), (4, "x" * 600_000, "y")],
        "item_id long, text string, Text string",
    )
    pairs = lambda: sorted((r["doc_id"], r["item_id"]) for r in d.leaks(docs, bench).na.fill(-1).collect())
    all_at_once = pairs()
    assert all_at_once == [(5, -1), (5, -1), (8, 4), (9, -1), (12, 3), (12, 3)]
    monkeypatch.setattr(d, "BLOCK_WORDS", 1)
    assert pairs() == all_at_once
    kept = d.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 5
    assert d.leaks(docs.limit(0), bench).count() == 0
    assert d.leaks(docs, bench.limit(0)).count() == 0 and d.drop_leaks(docs, bench.limit(0)).count() == docs.count()
