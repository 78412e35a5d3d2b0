import random

import public_tokenizers
from tokenizers import Tokenizer

from ledgerloom.llm import packing
from tests.llm.frames import awkward, given


def naive(lengths, capacities, overhead):
    """The same rule with a look at every bin and every waiting piece for each piece."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    bins = []
    for k, i in enumerate(order):
        open_ = [b for b in bins if b[0] - b[1] >= lengths[i]]
        if open_:
            best = min(b[0] - b[1] for b in open_)
            # Of bins with the same room the one that got it last.
            bin_ = max((b for b in open_ if b[0] - b[1] == best), key=lambda b: b[3])
        else:

            def cost(size):
                room = size - lengths[i]
                waiting = sum(lengths[j] for j in order[k + 1 :] if lengths[j] <= room)
                return (size + overhead) / min(size, lengths[i] + waiting), size

            bin_ = [min((s for s in capacities if s >= lengths[i]), key=cost), 0, [], 0]
            bins.append(bin_)
        bin_[1] += lengths[i]
        bin_[2].append(i)
        bin_[3] = k
    return [(min(s for s in capacities if s >= b[1]), b[2]) for b in bins]


def test_bins_are_those_of_the_naive_rule():
    rng = random.Random(6)
    for _ in range(150):
        capacities = sorted(rng.sample(range(10, 100), rng.randint(1, 4)))
        lengths = [rng.randint(1, capacities[-1]) for _ in range(rng.randint(0, 60))]
        overhead = rng.choice([0, 1, 30])
        assert packing.best_fit(lengths, capacities, overhead) == naive(lengths, capacities, overhead)


def test_bins_shrink_to_their_contents():
    assert packing.best_fit([3], [4, 8, 16], 100) == [(4, [0])]
    assert packing.best_fit([9, 7, 1], [8, 16], 0) == [(16, [0, 1]), (8, [2])]
    assert packing.best_fit([], [8], 0) == []


def whole(bins, lengths, capacities):
    """Every token of every row is in one bin, once, and no bin is too full."""
    pieces = {}
    for b in bins:
        assert sum(b["lengths"]) == b["used"] <= b["capacity"] in capacities
        smaller = [c for c in capacities if c < b["capacity"]]
        assert not smaller or b["used"] > max(smaller)
        for piece in zip(b["doc_ids"], b["starts"], b["lengths"]):
            pieces.setdefault(piece[0], []).append(piece[1:])
    assert len({b["bin_id"] for b in bins}) == len(bins)
    expected = {}
    for i, n in lengths:
        most = max(capacities)
        expected.setdefault(i, []).extend((s, min(most, n - s)) for s in range(0, n, most))
    assert {i: sorted(p) for i, p in pieces.items()} == {i: sorted(p) for i, p in expected.items() if p}


def test_given_documents(spark):
    docs = given(spark, "documents")
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    lengths = [
        (r["doc_id"], 1 + len(tokenizer.encode(r["text"], add_special_tokens=False).ids)) for r in docs.collect()
    ]
    found = packing.token_lengths(docs, path)
    assert sorted(map(tuple, found.collect())) == sorted(lengths)
    for shard in (4096, 20):
        bins = packing.pack(found, (64, 256, 1024), shard=shard).collect()
        whole(bins, lengths, (64, 256, 1024))
        assert sum(b["used"] for b in bins) > 0.9 * sum(b["capacity"] for b in bins)


def test_awkward_rows(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    found = packing.token_lengths(awkward(spark), path)
    bins = packing.pack(found, (512, 2048)).collect()
    whole(bins, [tuple(r) for r in found.collect()], (512, 2048))
    odd = [(1, 0), (2, None), (3, 10), (3, 10), (None, 5), (4, 8), (5, 16), (6, 17)]
    df = spark.createDataFrame(odd, "doc_id long, n_tokens long")
    whole(packing.pack(df, (4, 8)).collect(), [(i, n or 0) for i, n in odd], (4, 8))
    assert packing.pack(df.limit(0)).count() == 0


def test_few_words_remembered_give_the_same_lengths(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = given(spark, "documents")
    expected = sorted(packing.token_lengths(docs, path).collect())
    assert sorted(packing.token_lengths(docs, path, 50).collect()) == expected
    held = packing.encoder(path, 50)
    held.sizes([r["text"] for r in docs.where("text IS NOT NULL").limit(20).collect()])
    assert len(held.hashes) <= 50 and held is not packing.encoder(path)
