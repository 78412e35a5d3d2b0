"""Words of many texts as 64-bit hashes, found and hashed together in numpy.

A word's hash is the sum of a mixed value for each character at its place in the word,
taken from running sums, so the cost is per character and not per word. Place and
character are mixed together before they are added: no structure of a word (repetition,
exchange of parts) carries over to the sum. Prefixes of words have hashes from the same
sums. Two words may still share a hash by chance; who reuses or removes anything on the
strength of a hash compares the words.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

import numpy as np

U = np.uint64
PLACE = 0x9E3779B97F4A7C15  # odd: places have different multiples
SPAN = 1 << 18  # characters hashed at once
_FACTORS = [0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h.astype(U, copy=True)
    h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(32)
    return h


@cache
def blank_separated() -> np.ndarray:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased: a value per code point, 0 between words."""
    points = np.arange(0x110000, dtype=U)
    points[65:91] += U(32)
    values = mixed(points + U(1))
    values[[32, 9, 10, 11, 12, 13]] = 0
    return values


@cache
def blank_separated_as_is() -> np.ndarray:
    """Words ``[^\\x20\\x09-\\x0D]+``, unchanged."""
    values = mixed(np.arange(0x110000, dtype=U) + U(1))
    values[[32, 9, 10, 11, 12, 13]] = 0
    return values


@cache
def space_separated() -> np.ndarray:
    """Words between spaces and line breaks, as they are."""
    values = mixed(np.arange(0x110000, dtype=U) + U(1))
    values[[32, 10]] = 0
    return values


@cache
def folded_letters(digits: bool) -> np.ndarray:
    """Code point of the lower-cased letter (or digit), 0 for all else."""
    points = np.zeros(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha() or digits and c.isalnum():
            low = c.lower()
            points[i] = ord(low) if len(low) == 1 else i
    return points


@cache
def letters_and_digits() -> np.ndarray:
    """Words of letters and digits, lower-cased: a value per code point, 0 between words."""
    points = folded_letters(True)
    return np.where(points > 0, mixed(points.astype(U) + U(1)), U(0))


def placed(x: np.ndarray) -> np.ndarray:
    """What a character adds to its word's sum, given its value plus PLACE times its
    place; changes ``x``. Not linear, so equal sums of values don't make equal sums."""
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    return x


@cache
def _places() -> np.ndarray:
    return np.arange(SPAN, dtype=U) * U(PLACE)


class Words(NamedTuple):
    """Per word: the text it is in, its hash, first character and end in the joined
    texts; ``first[i]`` is text i's first word, ``offset[i]`` its first character."""

    text: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    offset: np.ndarray


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters, a line break after each text, and where each text begins."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    return codes, np.concatenate(([0], np.cumsum(lengths + 1)))


def words(texts: list[str], values: np.ndarray, prefixes: tuple[int, ...] = ()):
    """Words of the texts; with ``prefixes``, also a list with, for each length, the
    hash of each word's first characters (of the whole word if it isn't longer)."""
    codes, offset = code_points(texts)
    none = np.zeros(0, dtype=np.int64)
    hashes, starts, ends, heads = [none.astype(U)], [none], [none], [[none.astype(U)] for _ in prefixes]
    at = 0
    while at < len(codes):
        stop = min(at + SPAN, len(codes))
        value = values[codes[at:stop]]
        if stop < len(codes):
            gaps = np.flatnonzero(value[-(SPAN // 4) :] == 0)
            if len(gaps):
                value = value[: len(value) - min(SPAN // 4, len(value)) + gaps[-1] + 1]
            else:  # a very long word: up to the next gap
                while stop < len(codes) and values[codes[stop]]:
                    stop = min(stop + SPAN, len(codes))
                    tail = values[codes[at + len(value) : stop]]
                    gap = np.flatnonzero(tail == 0)
                    value = np.concatenate((value, tail[: gap[0] + 1] if len(gap) else tail))
                    if len(gap):
                        stop = at + len(value)
                        break
        stop = at + len(value)
        inside = np.concatenate(([False], value != 0, [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edges[::2], edges[1::2]
        if not len(first):
            at = stop
            continue
        # Every character's place counts from its word's beginning.
        places = _places() if len(value) <= SPAN else np.arange(len(value), dtype=U) * U(PLACE)
        from_start = np.zeros(2 * len(first) + 1, dtype=U)
        from_start[1::2] = places[first]
        bounds = np.concatenate(([0], edges, [len(value)]))
        added = places[: len(value)] - np.repeat(from_start, np.diff(bounds))
        added += value
        placed(added)
        added[value == 0] = 0
        sums = np.concatenate((np.zeros(1, dtype=U), np.cumsum(added)))
        before = sums[first]
        hashes.append(sums[last] - before)
        for k, head in zip(prefixes, heads):
            head.append(sums[np.minimum(first + k, last)] - before)
        starts.append(first + at)
        ends.append(last + at)
        at = stop
    start, end = np.concatenate(starts), np.concatenate(ends)
    text = np.searchsorted(offset, start, side="right") - 1
    found = Words(
        text,
        mixed(np.concatenate(hashes)),
        start,
        end,
        np.searchsorted(start, offset),
        offset,
    )
    return (found, [mixed(np.concatenate(h)) for h in heads]) if prefixes else found


def word_hash(word: str, values: np.ndarray) -> int:
    """The hash ``words`` gives a single word."""
    found = words([word], values)
    return int(found.hash[0]) if len(found.hash) else 0


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words, at the run's first word."""
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, dtype=U)
    factor = 1
    for i in range(size):
        factor = factor * _FACTORS[i % len(_FACTORS)] % (1 << 64)
        total += hashes[i : i + n] * U(factor)
    return mixed(total)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Shingles of one text in order: runs of ``size`` words; of fewer words, all of
    them as one run; of no words, none."""
    if 0 < len(hashes) < size:
        return runs(hashes, len(hashes)) ^ U(len(hashes))
    return runs(hashes, size)
