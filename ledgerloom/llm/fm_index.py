"""An FM-index of word sequences: a wavelet matrix of their Burrows-Wheeler transform.

Texts lie one after another in one array of word numbers, 0 between them. Bit vectors
are packed 64 to a word with running counts beside them, so that a rank takes one gather
and one population count. Many patterns are searched at once, a lane for each.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


class Bits:
    """A packed bit vector with ranks."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        padded = np.zeros((len(packed) // 8 + 1) * 8, dtype=np.uint8)
        padded[: len(packed)] = packed
        self.words = padded.view("<u8").astype(U, copy=False)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words)))).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many bits are set before each place."""
        word = at >> 6
        below = (U(1) << (at & 63).astype(U)) - U(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class Wavelet:
    """Ranks of the symbols 0 .. ``symbols`` - 1 of a sequence."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = []
        for shift in range(max(1, (symbols - 1).bit_length()) - 1, -1, -1):
            bit = (sequence >> shift) & 1 == 1
            self.levels.append((shift, len(sequence) - int(bit.sum()), Bits(bit)))
            sequence = np.concatenate((sequence[~bit], sequence[bit]))
        self.first = np.zeros(symbols, dtype=np.int64)
        self.first = self._walked(np.arange(symbols), self.first)

    def _walked(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, zeros, bits in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> shift) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        return self._walked(symbol, at) - self.first[symbol]


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys, and each key's number among the different ones."""
    order = np.argsort(key)
    new = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
    rank = np.empty(len(key), dtype=np.int64)
    rank[order] = new
    return order, rank, new


def _later(values: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate((values[by:], np.zeros(min(by, len(values)), dtype=values.dtype)))


class FmIndex:
    """The index of ``tokens`` (0 between texts) for patterns of up to 16 words.

    Suffixes are sorted by 16 words, which orders everything a pattern of up to 16 words
    can tell apart. ``marks`` has a bit where a suffix differs from the one before within
    ``depth`` words: it leads from a place to all suffixes that share ``depth`` words.
    """

    def __init__(self, tokens: np.ndarray, symbols: int, depth: int):
        self.size = len(tokens)
        values = tokens.astype(np.int64)
        ranks = {1: values}
        for width in (1, 2, 4, 8):
            order, ranks[2 * width], _ = _ranked(
                ranks[width] * (self.size + symbols + 1) + _later(ranks[width] + 1, width)
            )
        self.places = order
        differ = np.zeros(self.size, dtype=bool)
        differ[:1] = True
        at = 0
        for width in (8, 4, 2, 1):  # depth in binary: ranks of parts that follow each other
            if depth & width:
                part = _later(ranks[width] + 1, at)[order]
                differ[1:] |= part[1:] != part[:-1]
                at += width
        self.marks = Bits(differ)
        self.starts = np.append(np.flatnonzero(differ), self.size)
        self.wavelet = Wavelet(tokens[order - 1], symbols)
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(tokens, minlength=symbols))))

    def prepended(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: the suffixes that start with the symbol before those of
        low .. high."""
        both = self.wavelet.rank(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        first = self.smaller[symbol]
        return first + both[: len(low)], first + both[len(low) :]

    def widened(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All suffixes that share ``depth`` words with the one at ``low``."""
        group = self.marks.rank(low + 1) - 1
        return self.starts[group], self.starts[group + 1]


def repeated(index: FmIndex, tokens: np.ndarray, first: np.ndarray, end: np.ndarray, span: int):
    """(start, low, high): every place in the texts first .. end at which ``span`` words
    begin that the index holds more than once, and the suffixes that begin so.

    ``index`` is one of these texts with depth ``span`` - 1. Each text streams backward:
    a match grows by the word before it; at ``span`` words its last word goes and it
    slides on. Where a match can't grow, what ends there is known to be alone, and
    matching starts anew one word earlier.
    """
    lane = np.flatnonzero(end - first >= span)
    stop, at, least = end[lane].copy(), end[lane].copy(), first[lane]
    low, high = np.zeros(len(lane), np.int64), np.full(len(lane), index.size, np.int64)
    starts, lows, highs = [], [], []
    while len(at):
        down, up = index.prepended(tokens[at - 1], low, high)
        grown = up - down >= 2
        at = np.where(grown, at - 1, stop - 1)
        full = grown & (stop - at == span)
        starts.append(at[full])
        lows.append(down[full])
        highs.append(up[full])
        wide_low, wide_high = index.widened(down[full])
        low, high = np.where(grown, down, 0), np.where(grown, up, index.size)
        low[full], high[full] = wide_low, wide_high
        stop = stop - (full | ~grown)
        on = (stop - least >= span) & (at > least)
        stop, at, least, low, high = stop[on], at[on], least[on], low[on], high[on]
    return np.concatenate(starts or [first[:0]]), np.concatenate(lows or [first[:0]]), np.concatenate(highs or [first[:0]])
