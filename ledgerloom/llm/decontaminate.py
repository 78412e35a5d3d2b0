"""Passages of a benchmark in documents, by SimHash windows.

Items are grouped by their number of words. For each group a window of that many
words moves over every document, one word at a time, and each window gets a 64-bit
SimHash of its word pairs, from running sums. Four 16-bit blocks of the fingerprint
are looked up in an index of the items' blocks with up to RADIUS // 4 bits changed:
two fingerprints within RADIUS bits differ by no more than that in some block, so
the index finds every one of them. What lies within the radius is then compared
exactly: shingles of five words, weighted by how often they occur, counted for all
windows near by together.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import by_place, chosen, documents, dropped, place, slices, stored
from ledgerloom.llm.words import U, Words, letters_and_digits, runs, shingles, words

RADIUS = 15
BLOCK_WORDS = 200_000  # words of items in one index, which goes to every executor
BLOCK_ITEMS = 2_000  # items in one index, each with 697 changed values of four blocks: 22 MB
STRETCH = 0.04  # a group's windows are at most this much shorter or longer than its items
_BLOCKS, _BITS = 4, 16
_STEP = 1 << 14  # windows at a time: their sums stay in the processor's cache


class Group(NamedTuple):
    """Items of about one size: window size in words, their place among all items,
    fingerprints, and for each block the items by their (changed) block values: whether any
    has a value, where those that have it begin, and which they are."""

    size: int
    items: np.ndarray
    prints: np.ndarray
    some: np.ndarray
    first: np.ndarray
    found: np.ndarray


def _pairs(hashes: np.ndarray) -> np.ndarray:
    """A value for each word with the word after it."""
    return runs(hashes, 2)


def _sums(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Running sums of the values' bits, 64 // bits of them side by side in each of
    ``bits`` columns. Differences of sums are right as long as each fits its bits."""
    mask = U(sum(1 << i for i in range(0, 64, bits)))
    zero = np.zeros(1, dtype=U)
    return [np.concatenate((zero, np.cumsum((values >> U(k)) & mask))) for k in range(bits)]


def _fingerprints(sums: list[np.ndarray], bits: int, size: int, n: int) -> np.ndarray:
    """SimHash of the ``n`` windows of ``size`` values from each place on: a bit is set
    if more than half of the values have it."""
    mask = U(sum(1 << i for i in range(0, 64, bits)))
    top = U(1 << (bits - 1))
    over = mask * U((1 << (bits - 1)) - (size // 2 + 1))
    out = np.zeros(n, dtype=U)
    for k, total in enumerate(sums):
        x = total[size : size + n] - total[:n]
        x += over
        x &= mask * top
        x >>= U(bits - 1 - k)
        out |= x
    return out


def _bits_for(size: int) -> int:
    return next(b for b in (8, 16, 32) if size < (1 << b) - 2)


def fingerprint(values: np.ndarray) -> int:
    """SimHash of all values together."""
    if not len(values):
        return 0
    bits = _bits_for(len(values))
    return int(_fingerprints(_sums(values, bits), bits, len(values), 1)[0])


def _changed(radius: int) -> np.ndarray:
    """All 16-bit values with up to ``radius`` bits set."""
    flips = [sum(1 << i for i in some) for r in range(radius + 1) for some in combinations(range(_BITS), r)]
    return np.array(flips, dtype=np.int64)


def index(items: list[np.ndarray], radius: int = RADIUS) -> list[Group]:
    """The groups of items, each given as its words' hashes; items without words are
    in no group."""
    order = sorted((len(w), i) for i, w in enumerate(items) if len(w))
    flips = _changed(radius // _BLOCKS)
    groups, at = [], 0
    while at < len(order):
        most = int(order[at][0] * (1 + 2 * STRETCH))
        stop = at
        while stop < len(order) and order[stop][0] <= most:
            stop += 1
        own = np.array([i for _, i in order[at:stop]])
        size = (order[at][0] + order[stop - 1][0]) // 2
        prints = np.array([fingerprint(_values(items[i])) for i in own], dtype=U)
        blocks = (prints[None, :] >> (U(_BITS) * np.arange(_BLOCKS, dtype=U))[:, None]) & U(0xFFFF)
        changed = blocks.astype(np.int64)[:, :, None] ^ flips[None, None, :]
        keys = (changed + (np.arange(_BLOCKS) << _BITS)[:, None, None]).ravel()
        of = np.tile(np.repeat(np.arange(len(own), dtype=np.int32), len(flips)), _BLOCKS)
        counts = np.bincount(keys, minlength=_BLOCKS << _BITS)
        first = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        groups.append(Group(size, own, prints, counts > 0, first, of[np.argsort(keys, kind="stable")]))
        at = stop
    return groups


def _values(hashes: np.ndarray) -> np.ndarray:
    return _pairs(hashes) if len(hashes) > 1 else hashes


def near(prints: np.ndarray, group: Group, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Every (window, item of the group) within the radius."""
    none = np.zeros(0, dtype=np.int64)
    windows, items = [none], [none]
    # The four blocks of a fingerprint one after another, each with its part of the index.
    key = prints.astype("<u8", copy=False).view("<u2").astype(np.int64).reshape(-1, _BLOCKS)
    key += np.arange(_BLOCKS) << _BITS
    key = key.ravel()
    window = np.flatnonzero(group.some.take(key))
    key = key.take(window)
    window //= _BLOCKS
    place, last = group.first.take(key), group.first.take(key + 1) - 1
    own = prints.take(window)
    while len(window):  # one item of each window's at a time: most have one
        item = group.found.take(place)
        hit = np.flatnonzero(np.bitwise_count(own ^ group.prints.take(item)) <= radius)
        if len(hit):
            windows.append(window[hit])
            items.append(item[hit].astype(np.int64))
        more = np.flatnonzero(place < last)
        window, place, last, own = window.take(more), place.take(more) + 1, last.take(more), own.take(more)
    if len(windows) == 1:
        return none, none
    both = np.unique(np.concatenate(windows) * np.int64(len(group.items)) + np.concatenate(items))
    return both // len(group.items), both % len(group.items)


class Weights(NamedTuple):
    """An item's words, its different shingles in order and how often each occurs."""

    words: int
    kinds: np.ndarray
    counts: np.ndarray


def weights_of(hashes: np.ndarray, size: int) -> Weights:
    return Weights(len(hashes), *np.unique(shingles(hashes, size), return_counts=True))


def overlaps(item: Weights, own: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """What each window of the item's length, or all of a shorter text, shares with the
    item, counting a shingle as often as both have it; and the windows' weight.

    The windows begin at ``starts`` (ascending). An occurrence of a shingle that the item
    has c times counts in the windows that hold it and not also the c occurrences before
    it: from just after the c-th last one on, and from where the window reaches it.
    """
    wide = min(item.words, len(own))
    low = int(starts[0])
    told = own[low : int(starts[-1]) + wide]
    short = min(size, wide)
    found = runs(told, short)
    if short < size:
        found ^= U(short)
    weight = wide - short + 1
    at = np.minimum(np.searchsorted(item.kinds, found), len(item.kinds) - 1)
    place = np.flatnonzero(item.kinds[at] == found)
    place = place[np.argsort(at[place], kind="stable")]
    kind = at[place]
    before = np.arange(len(place)) - item.counts[kind]
    same = (before >= 0) & (kind[before] == kind)
    begin = np.maximum(np.where(same, place[before] + 1, 0), np.maximum(place - weight + 1, 0))
    change = np.bincount(begin, minlength=len(found) + 1) - np.bincount(place + 1, minlength=len(found) + 1)
    return np.cumsum(change)[starts - low], weight


def _windows_near(found: Words, groups: list[Group]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, start): windows of the texts within the radius of an item, as the place
    of their first word in the text. A text shorter than a window, but not by half, is one
    window."""
    lengths = np.diff(found.first)
    values = {1: found.hash, 2: _pairs(found.hash)}
    sums: dict[tuple[int, int], list[np.ndarray]] = {}
    none = np.zeros(0, dtype=np.int64)
    texts, items, starts = [none], [none], [none]
    for group in groups:
        span = min(group.size, 2)
        width = group.size - span + 1
        key = (span, _bits_for(width))
        if key not in sums:
            sums[key] = _sums(values[span], key[1])
        for at in range(0, len(found.hash) - group.size + 1, _STEP):
            n = min(_STEP, len(found.hash) - group.size + 1 - at)
            part = [total[at : at + n + width] for total in sums[key]]
            window, item = near(_fingerprints(part, key[1], width, n), group)
            window += at
            text = found.text[window]
            inside = text == found.text[window + group.size - 1]
            texts.append(text[inside])
            items.append(group.items[item[inside]])
            starts.append(window[inside] - found.first[text[inside]])
        for t in np.flatnonzero((lengths < group.size) & (2 * lengths > group.size)):
            own = found.hash[found.first[t] : found.first[t + 1]]
            some = near(np.array([fingerprint(_values(own))], dtype=U), group)[1]
            texts.append(np.full(len(some), t))
            items.append(group.items[some])
            starts.append(np.zeros(len(some), dtype=np.int64))
    return np.concatenate(texts), np.concatenate(items), np.concatenate(starts)


def matches(
    found: Words, items: list[Weights], groups: list[Group], size: int, percent: int
) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Yields (text, item, start word, words, inner, union): for each text and item the
    best window of the item's own size around those within the radius, if it is alike
    enough; of equal windows the first."""
    text, item, start = _windows_near(found, groups)
    order = np.lexsort((start, item, text))
    text, item, start = text[order], item[order], start[order]
    edge = np.flatnonzero(np.concatenate(([True], (np.diff(text) != 0) | (np.diff(item) != 0))))
    for a, b in zip(edge, [*edge[1:], len(text)]) if len(text) else ():
        t, i = int(text[a]), int(item[a])
        own = found.hash[found.first[t] : found.first[t + 1]]
        wide = items[i].words
        slack = int(2 * STRETCH * wide) + 2
        near_by = start[a:b, None] + np.arange(-slack, slack + 1)[None, :]
        starts = np.unique(np.clip(near_by, 0, max(0, len(own) - wide)))
        inner, weight = overlaps(items[i], own, starts, size)
        best = int(np.argmax(inner))
        shared = int(inner[best])
        union = int(items[i].counts.sum()) + weight - shared
        if 100 * shared >= percent * union:
            yield t, i, int(starts[best]), min(wide, len(own)), shared, union


def _item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The benchmark's items in blocks of about BLOCK_WORDS words."""
    rows = chosen(benchmark, item_id="long", text="string").where("text IS NOT NULL")
    block, held = [], 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        own = words([row["text"]], letters_and_digits()).hash
        if held and held + len(own) > BLOCK_WORDS or len(block) >= BLOCK_ITEMS:
            yield block
            block, held = [], 0
        block.append((row["item_id"], own))
        held += len(own)
    yield block


def _each_block(docs: DataFrame, benchmark: DataFrame, size: int, step, result: DataFrame) -> DataFrame:
    """``result`` after ``step(result, shared index)`` for each block of items. What all
    blocks but the last give is stored, so that one index is held at a time."""
    spark = docs.sparkSession
    before = None
    for block in _item_blocks(benchmark):
        hashes = [own for _, own in block]
        named = ([i for i, _ in block], [weights_of(own, size) for own in hashes], index(hashes))
        if before is not None:
            older, result = result, stored(result, "blocks")
            if hasattr(older, "stored_at"):
                dropped(older)
            before.unpersist()
        before = spark.sparkContext.broadcast(named)
        result = step(result, before)
    return result


def leaks(docs: DataFrame, benchmark: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, similarity): one row for each document and
    item that has a passage with at least ``percent`` in it, with the best such window.

    Words are letters and digits, lower-cased; similarity is the weight of the shingles
    that both share over the weight that either has. Null and empty texts and items
    match nothing; an item of fewer words than a shingle is one shingle. Repeated
    documents give repeated rows, repeated items the rows of each item_id.
    Documents are read once for each block of items.
    """

    def search(so_far: DataFrame, shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, items, groups = shared.value
            for batch in batches:
                for rows in slices(batch):
                    ids = rows.column("doc_id").to_pylist()
                    found = words(rows.column("text").to_pylist(), letters_and_digits())
                    out = [
                        (ids[text], names[item], start, n, inner / union)
                        for text, item, start, n, inner, union in matches(
                            found, items, groups, size, percent
                        )
                    ]
                    if out:
                        kinds = [pa.int64()] * 4 + [pa.float64()]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)],
                            names=["doc_id", "item_id", "start_word", "n_words", "similarity"],
                        )

        return so_far.union(documents(docs).mapInArrow(run, schema))

    schema = "doc_id long, item_id long, start_word long, n_words long, similarity double"
    nothing = docs.sparkSession.createDataFrame([], schema)
    return _each_block(docs, benchmark, size, search, nothing)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents in which a benchmark item was found."""
    text = place(docs, "text")

    def clean(kept: DataFrame, shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _, items, groups = shared.value
            for batch in batches:
                for rows in slices(batch, text):
                    found = words([t or "" for t in rows.column(text).to_pylist()], letters_and_digits())
                    keep = np.ones(rows.num_rows, dtype=bool)
                    for match in matches(found, items, groups, size, percent):
                        keep[match[0]] = False
                    yield rows.filter(pa.array(keep))

        return kept.mapInArrow(run, kept.schema)

    return _each_block(docs, benchmark, size, clean, by_place(docs)).toDF(*docs.columns)
