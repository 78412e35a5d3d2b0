"""Toxicity of a text after undoing disguises, as a noisy channel.

A character trigram model is counted over all documents. A word that looks disguised
(digits or signs among letters, a letter twice or more in a row, single letters with
gaps of the same kind between them) becomes a lattice: every sign may stand for letters or for itself, a
run may be shorter, gaps may close or part words. Viterbi decoding picks the likeliest
path under the language model and the channel's costs; among its best paths, and for
where words of a spaced run end, the counts of whole words tell too. The restored text is scored by a logistic
regression on its words and their beginnings, learned from labelled documents.
"""

from __future__ import annotations

import math
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from functools import cache
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import chosen, documents, in_fold, slices, stored
from ledgerloom.llm.words import PLACE, U, code_points, folded_letters, mixed, placed, words

MOST_LABELS = 8192  # labelled documents learned from; the bound of the sample
MOST_FEATURES = 512
PREFIXES = (3, 4, 5, 6, 8)
TRIPLES, CONTEXTS = 1 << 18, 1 << 16  # hashed cells of the language model
WORDS = 1 << 18  # cells of the words' counts, two such rows
HELD_WORDS = 1 << 17  # decoded words a Python process remembers
DOUBLED = 3  # doubled letters of a word whose readings are all compared, without the lattice
PATHS = 8  # best paths kept for each state
WIDEST = 3  # characters in a gap of a spaced run
LONGEST = 40  # letters, equal ones in a row counted once, of a word in a spaced run

# Signs and the letters they may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
}
_INNER = "!|+"  # of these, only those before a letter are part of a word
AS_LETTER, AS_ITSELF, SHORTER, CLOSED, OPEN = -1.0, -9.0, -1.0, -0.2, -1.5
KNOWN = -2.0  # that a word of the documents, without signs, is a disguise
UNSEEN = -6.0  # log-probability that a word is none of those counted
_U32 = np.uint32


# --- language model ---------------------------------------------------------------


def _cells(a, b, c):
    """Hashed places of (a, b, c) and of its context (a, b); a gap is 0."""
    pair = a * _U32(0x9E3779B1) + b * _U32(0x85EBCA6B)
    triple = pair + c * _U32(0xC2B2AE35)
    pair = (pair ^ (pair >> _U32(15))) * _U32(0x2C1B3C6D)
    triple = (triple ^ (triple >> _U32(15))) * _U32(0x2C1B3C6D)
    return triple >> _U32(14), pair >> _U32(16)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(TRIPLES + CONTEXTS + 2 * WORDS, dtype=np.int64)
    of_words = total[TRIPLES + CONTEXTS :].reshape(2, WORDS)
    for batch in batches:
        for rows in slices(batch):
            texts = rows.column("text").to_pylist()
            found = words(texts, _letter_values()).hash
            of_words[0] += np.bincount((found >> U(46)).astype(np.int64), minlength=WORDS)
            of_words[1] += np.bincount((found & U(WORDS - 1)).astype(np.int64), minlength=WORDS)
            codes, _ = code_points(texts)
            letters = folded_letters(False)[codes]
            keep = letters > 0
            keep[1:] |= letters[:-1] > 0
            line = np.concatenate((np.zeros(1, _U32), letters[keep]))
            # A gap as context is one gap, whatever came before it.
            before = np.concatenate((np.zeros(1, _U32), line[:-2]))
            before[line[:-1] == 0] = 0
            triple, pair = _cells(before, line[:-1], line[1:])
            total[:TRIPLES] += np.bincount(triple, minlength=TRIPLES)
            total[TRIPLES : TRIPLES + CONTEXTS] += np.bincount(pair, minlength=CONTEXTS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """Cells from all documents: TRIPLES counts, then CONTEXTS counts, then two rows of
    WORDS counts, summed by Spark. The driver gets one row a cell."""
    counts = (
        documents(docs)
        .select("text")
        .mapInArrow(_count, "cell long, n long")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    table = np.zeros(TRIPLES + CONTEXTS + 2 * WORDS, dtype=np.float32)
    table[counts["cell"].to_numpy()] = counts["n"].to_numpy()
    return table


# --- decoding -----------------------------------------------------------------------


_START: dict = {(0, 0): [(0.0, None)]}


def _text(path: tuple | None) -> str:
    parts = []
    while path:
        path, letters = path
        parts.append(letters)
    return "".join(reversed(parts))


class Decoder:
    """Viterbi decoding under one language model."""

    def __init__(self, table: np.ndarray, telling: np.ndarray | None = None):
        self.table = table
        self.telling = telling  # features that tell
        self.costs: dict[tuple[int, int, int], float] = {}
        self.held: OrderedDict[tuple[str, int], str] = OrderedDict()
        self.of_words = table[TRIPLES + CONTEXTS :].reshape(2, WORDS)
        self.n_words = float(self.of_words[0].sum(dtype=np.float64))
        # What words that share a cell add to each other's counts in the mean. Up to three
        # times that may be others alone.
        self.others = self.n_words / WORDS

    def cost(self, a: int, b: int, c: int) -> float:
        """log P(c | a, b), smoothed."""
        key = (a if b else 0, b, c)
        found = self.costs.get(key)
        if found is None:
            one = [np.array([x], dtype=_U32) for x in key]
            triple, pair = (int(x[0]) for x in _cells(*one))
            n, of = float(self.table[triple]), float(self.table[TRIPLES + pair])
            found = self.costs[key] = math.log((n + 0.05) / (of + 0.05 * 200))
        return found

    def letters(self, word: str) -> float:
        """The log-probability of a word's letters between two gaps."""
        total, a, b = 0.0, 0, 0
        for code in [*map(ord, word), 0]:
            total += self.cost(a, b, code)
            a, b = b, code
        return total

    def counted(self, word: str) -> float:
        """How often a word stands in the documents; 0 or less if too seldom to tell."""
        first, second = _word_cells(word)
        n = min(float(self.of_words[0, first]), float(self.of_words[1, second]))
        return n - self.others if n > 3 * self.others else 0.0

    def matters(self, text: str) -> bool:
        if any(self.counted(word) > 0 for word in text.split()):
            return True
        return self.telling is not None and bool(np.isin(features([text])[1], self.telling).any())

    def gain(self, text: str) -> float:
        """What the words' own counts add to the log-probability of their letters: a word
        is one of those counted, or (UNSEEN) made of letters."""
        total = 0.0
        for word in text.split():
            n = self.counted(word)
            more = math.log(n / self.n_words) - self.letters(word) if n > 0 else UNSEEN
            total += max(UNSEEN, more)
        return total

    def readings(self, c: str, n: int) -> list[tuple[str, float]]:
        """Readings of ``n`` times one character."""
        if c in SIGNS:
            read = [(x * k, AS_LETTER + SHORTER * (k < n)) for x in SIGNS[c] for k in sorted({1, min(n, 2), n})]
            return [*read, (" ", AS_ITSELF)]
        if n >= 2 and c.isalpha():
            likely = {n: SHORTER * (n > 2), 2: SHORTER * (n > 2), 1: SHORTER * (n if n == 2 else 1)}
            return [(c * k, cost) for k, cost in sorted(likely.items())]
        return [((c if c.isalpha() else " ") * n, 0.0)]

    def options(self, word: str) -> list[list[tuple[str, float]]]:
        """The lattice of a word: for each run of one character its readings."""
        return [self.readings(c, len(list(run))) for c, run in groupby(word)]

    def _step(self, states: dict, readings: list[tuple[str, float]]) -> dict:
        """The best paths for each two last characters, after one more run. A path is its
        score and, linked, its readings."""
        after: dict[tuple[int, int], list[tuple]] = {}
        for (a, b), paths in states.items():
            for letters, channel in readings:
                x, y, more = a, b, channel
                for c in letters:
                    code = 0 if c == " " else ord(c)
                    if not (code == 0 and y == 0):
                        more += self.cost(x, y, code)
                    x, y = (y, code) if code else (0, 0)
                after.setdefault((x, y), []).extend((score + more, (path, letters)) for score, path in paths)
        return {
            key: paths if len(paths) == 1 else sorted(paths, key=lambda p: -p[0])[:PATHS]
            for key, paths in after.items()
        }

    def _ended(self, states: dict) -> list[tuple[float, str]]:
        paths = self._step(states, [(" ", 0.0)]).values()
        return [(score, _text(path).rstrip()) for some in paths for score, path in some]

    def best(self, lattice: list[list[tuple[str, float]]]) -> tuple[str, float]:
        """The likeliest path between two gaps, and its log-probability."""
        states = _START
        for readings in lattice:
            states = self._step(states, readings)
        score, text = max(self._ended(states))
        return " ".join(text.split()), score

    def _likeliest(self, states: dict) -> tuple[float, str]:
        """Of the paths kept, the likeliest with its words' own counts."""
        return max((score + self.gain(text), text) for score, text in self._ended(states))

    def apart(self, letters: str) -> tuple[str, float]:
        """The likeliest words of a spaced run: after each letter one may end (OPEN), or
        the gap closes (CLOSED)."""
        runs, at = [], 0
        for c, run in groupby(letters):
            n = len(list(run))
            # Within a run a word ends where either part has a reading of its own.
            runs.append((c, at, n, sorted({k for k in (1, 2, n - 2, n - 1, n) if 0 < k <= n})))
            at += n
        best: dict[int, tuple[float, str]] = {0: (0.0, "")}
        for r, (_, first, _, ends) in enumerate(runs):
            for start in [first, *(first + k for k in ends[:-1])]:
                before, text = best[start]
                before += OPEN * (start > 0)
                states = _START
                for c, at, n, ends_here in runs[r : r + LONGEST]:
                    skipped = max(0, start - at)
                    for k in ends_here:
                        if k <= skipped:
                            continue
                        after = self._step(states, self.readings(c, k - skipped))
                        score, word = self._likeliest(after)
                        score += before + CLOSED * (at + k - start - 1)
                        path = (score, f"{text} {word}")
                        found = best.get(at + k)
                        if found is None or score > found[0] or score == found[0] and path[1] < found[1]:
                            best[at + k] = path
                    states = after
        score, text = best[len(letters)]
        return " ".join(text.split()), score

    def _logs(self, words_: list[str]) -> np.ndarray:
        """``letters`` of many words."""
        codes, offset = code_points(words_)
        c = np.where(codes == 10, 0, codes).astype(_U32)
        b, a = (np.concatenate((np.zeros(k, _U32), c[:-k])) for k in (1, 2))
        a[b == 0] = 0
        triple, pair = _cells(a, b, c)
        n, of = self.table[triple].astype(np.float64), self.table[TRIPLES + pair].astype(np.float64)
        return np.add.reduceat(np.log((n + 0.05) / (of + 0.05 * 200)), offset[:-1])

    def _counts(self, words_: list[str]) -> np.ndarray:
        """``counted`` of many words."""
        found = words(words_, _letter_values()).hash
        first, second = (found >> U(46)).astype(np.int64), (found & U(WORDS - 1)).astype(np.int64)
        n = np.minimum(self.of_words[0, first], self.of_words[1, second]).astype(np.float64)
        return np.where(n > 3 * self.others, n - self.others, 0.0)

    def prepare(self, shown: set[str]) -> None:
        """Decodes the words with some doubled letters and no sign, all together: their
        few readings are written out and scored in arrays. What it finds is what the
        lattice finds."""
        new, readings, owner, channel = [], [], [], []
        for word in shown:
            if (word, 1) in self.held or not _only_doubled(word):
                continue
            at = [i for i in range(len(word) - 1) if word[i] == word[i + 1]]
            if len(at) > DOUBLED:
                continue
            for some in range(1 << len(at)):
                gone = {i for k, i in enumerate(at) if some >> k & 1}
                readings.append("".join(c for i, c in enumerate(word) if i not in gone) if gone else word)
                owner.append(len(new))
                channel.append(2 * SHORTER * len(gone))
            new.append(word)
        if not new:
            return
        of, logs, counts = np.array(owner), self._logs(readings), self._counts(readings)
        known = counts > 0
        own_gain = np.full(len(readings), UNSEEN)
        own_gain[known] = np.maximum(UNSEEN, np.log(counts[known] / self.n_words) - logs[known])
        plain = logs + own_gain
        score = plain + np.array(channel, dtype=np.float64)
        first = np.flatnonzero(np.concatenate(([True], np.diff(of) != 0)))  # the word as it stands
        best = np.maximum.reduceat(score, first)
        taken = np.flatnonzero(score == best[of])
        chosen = [""] * len(new)
        for k, i in zip(of[taken].tolist(), taken.tolist()):  # of equal scores the later text
            chosen[k] = max(chosen[k], readings[i])
        place = {(k, r): i for i, (k, r) in enumerate(zip(owner, readings))}
        other = [k for k, (word, found) in enumerate(zip(new, chosen)) if word != found]
        at = np.array([place[k, chosen[k]] for k in other], dtype=np.int64)
        here = first[other]
        stays = known[here] & (plain[here] - KNOWN >= score[at])
        matters = known[at].copy()
        asked = np.flatnonzero(~matters & ~stays)
        if self.telling is not None and len(asked):
            text, value = features([chosen[other[i]] for i in asked])
            matters[asked[text[np.isin(value, self.telling)]]] = True
        for k, keeps in zip(other, stays | ~matters):
            if keeps:
                chosen[k] = new[k]
        for word, found in zip(new, chosen):
            self.hold(word, 1, found)

    def hold(self, word: str, step: int, found: str) -> None:
        self.held[word, step] = found
        if len(self.held) > HELD_WORDS:
            self.held.popitem(last=False)

    def decode(self, word: str, step: int = 1) -> str:
        """The restored word (maybe several, if a sign was a gap or gaps part words); of a
        spaced run every ``step``-th character counts."""
        found = self.held.get((word, step))
        if found is None:
            if step > 1:
                apart = word[::step]
                found, score = self.apart(apart)
                plain = sum(
                    self._likeliest(self._step(_START, [(c, 0.0)]))[0] if c.isalpha() else OPEN for c in apart
                )
                if plain >= score:
                    found = word
            else:
                states = _START
                for readings in self.options(word):
                    states = self._step(states, readings)
                score, found = self._likeliest(states)
                found = " ".join(found.split())
                # Doubled letters alone, as in many plain words: the reading must be a word of
                # the documents or tell, and far likelier than a word of the documents.
                if found != word and _only_doubled(word):
                    plain = self.letters(word) + self.gain(word) - KNOWN
                    if self.counted(word) > 0 and plain >= score or not self.matters(found):
                        found = word
            self.hold(word, step, found)
        return found


def _mixed(h: int) -> int:
    for _ in range(2):
        h = (h ^ (h >> 32)) * 0xD6E8FEB86659FD93 % (1 << 64)
    return h ^ (h >> 32)


@cache
def _placed(c: str, place: int) -> int:
    return int(placed(np.array([(int(_letter_values()[ord(c)]) + place * PLACE) % (1 << 64)], dtype=U))[0])


def _word_cells(word: str) -> tuple[int, int]:
    """Where a word is counted, as ``words`` hashes it."""
    h = _mixed(sum(_placed(c, i) for i, c in enumerate(word)) % (1 << 64))
    return h >> 46, h % WORDS


def _only_doubled(word: str) -> bool:
    return word.isalpha() and all(len(list(run)) < 3 for _, run in groupby(word))


@cache
def _kinds() -> np.ndarray:
    """Of each code point: 1 letter, 2 sign, 3 sign that must be followed by a letter."""
    kinds = (folded_letters(False) > 0).astype(np.uint8)
    for sign in SIGNS:
        kinds[ord(sign)] = 3 if sign in _INNER else 2
    return kinds


def disguised(texts: list[str]) -> Iterator[tuple[int, int, int, int]]:
    """Yields (text, start, end, step) of what looks disguised, in order, not overlapping;
    in a spaced run every ``step``-th character counts."""
    codes, offset = code_points(texts)
    kind = _kinds()[codes]
    letter = kind == 1
    last = np.concatenate((codes[1:] != codes[:-1], [True]))
    edge = np.concatenate(([0], np.flatnonzero(last) + 1))
    run = np.repeat(np.diff(edge), np.diff(edge))
    followed = np.concatenate((letter[1:], [False]))
    digit = (codes >= 48) & (codes <= 57)
    # Three and more of another sign set words apart.
    part = letter | (kind == 2) & ((run < 3) | digit) | (kind == 3) & followed
    inside = np.concatenate(([False], part, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return
    sums = lambda what: np.concatenate(([0], np.cumsum(what)))
    n_letters, n_signs, n_runs = sums(letter), sums(part & ~letter), sums(letter & (run >= 2))
    has = lambda total: total[end] - total[start]
    odd = (has(n_letters) > 0) & ((has(n_signs) > 0) | (has(n_runs) > 0))
    # Single characters, three or more in a row, with one character between them or the
    # same few.
    single = end - start == 1
    width = start[1:] - end[:-1]
    kinds = np.zeros(len(width), dtype=np.int64)
    joins = single[:-1] & single[1:] & (width <= WIDEST)
    for i in range(WIDEST):
        here = np.flatnonzero(joins & (width > i))
        code = codes[end[here] + i].astype(np.int64)
        kinds[here] |= code << (21 * i)
        joins[here[code == 10]] = False
    kinds[width == 1] = 0
    edge = np.flatnonzero(np.concatenate(([True], (joins[1:] != joins[:-1]) | (kinds[1:] != kinds[:-1]), [True])))
    spans = []
    in_row = np.zeros(len(start), dtype=bool)
    for first, stop in zip(edge[:-1], edge[1:]) if len(joins) else ():
        if not joins[first]:
            continue
        first += in_row[first]  # a character between gaps of two kinds is in one run
        if stop - first >= 2 and n_letters[end[stop]] - n_letters[start[first]] >= 2:
            spans.append((start[first], end[stop], width[first] + 1))
            in_row[first : stop + 1] = True
    some = np.flatnonzero(odd & ~in_row)
    alone = np.stack((start[some], end[some], np.ones(len(some), dtype=np.int64)), axis=1)
    both = np.concatenate((alone, np.array(spans, dtype=np.int64).reshape(-1, 3)))
    both = both[np.argsort(both[:, 0])]
    text = np.searchsorted(offset, both[:, 0], side="right") - 1
    own = offset[text]
    yield from zip(text.tolist(), (both[:, 0] - own).tolist(), (both[:, 1] - own).tolist(), both[:, 2].tolist())


def undone(texts: list[str], decoder: Decoder) -> tuple[list[str], np.ndarray]:
    """The texts with disguises replaced by their likeliest reading, and how many each had."""
    out, n = list(texts), np.zeros(len(texts), dtype=np.int64)
    shown = [(text, start, end, step, texts[text][start:end].lower()) for text, start, end, step in disguised(texts)]
    decoder.prepare({span[4] for span in shown if span[3] == 1})
    for text, spans in groupby(shown, key=lambda span: span[0]):
        whole, parts, at = texts[text], [], 0
        for _, start, end, step, word in spans:
            found = decoder.decode(word, step)
            if found != word:
                parts += [whole[at:start], found]
                at = end
                n[text] += 1
        out[text] = "".join([*parts, whole[at:]])
    return out, n


def restored(texts: list[str], decoder: Decoder) -> list[str]:
    """The texts with what looked disguised replaced by its likeliest reading."""
    return undone(texts, decoder)[0]


# --- scoring -------------------------------------------------------------------------


_decoders: dict[str, Decoder] = {}


def decoder_of(name: str, table: np.ndarray, telling: np.ndarray | None) -> Decoder:
    """One for each Python process and model, so that tasks share the words decoded."""
    if name not in _decoders:
        _decoders.clear()
        _decoders[name] = Decoder(table, telling)
    return _decoders[name]


@cache
def _letter_values() -> np.ndarray:
    points = folded_letters(False)
    return np.where(points > 0, mixed(points.astype(U) + U(1)), U(0))


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, not distinct: words and their first letters, hashed."""
    found, heads = words(texts, _letter_values(), PREFIXES)
    length = found.end - found.start
    text, value = [found.text], [found.hash]
    for k, head in zip(PREFIXES, heads):
        longer = length >= k
        text.append(found.text[longer])
        value.append(head[longer] ^ U(k))
    return np.concatenate(text), np.concatenate(value).view(np.int64)


class Model(NamedTuple):
    """Sorted features, their weights, which of them are telling, the weight of having
    any of those, the intercept, the language model, the features that a decoded word may
    show (those of the first pass), and a name of its own."""

    features: np.ndarray
    weights: np.ndarray
    telling: np.ndarray
    any_weight: float
    intercept: float
    table: np.ndarray
    shown: np.ndarray
    name: str

    def decoder(self) -> Decoder:
        return decoder_of(self.name, self.table, self.shown)

    def scores(self, texts: list[str]) -> np.ndarray:
        total = np.full(len(texts), self.intercept)
        if len(self.features):
            text, value = features(texts)
            at = np.minimum(np.searchsorted(self.features, value), len(self.features) - 1)
            hit = self.features[at] == value
            both = np.unique(text[hit].astype(np.int64) * len(self.features) + at[hit])
            of, feature = both // len(self.features), both % len(self.features)
            np.add.at(total, of, self.weights[feature])
            total[np.unique(of[self.telling[feature]])] += self.any_weight
        return 1.0 / (1.0 + np.exp(-np.clip(total, -40, 40)))


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton steps; the last column of ``x`` is all ones."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        if np.abs(gradient).max() < 1e-4 * len(y):
            break
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x
        curve[np.diag_indices_from(curve)] += ridge
        w -= np.linalg.solve(curve, gradient)
    return w


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """The model from all documents (language model) and labelled ones (weights).

    Labelled documents outside the held-out fold are learned from, at most MOST_LABELS,
    those with the smallest hash of their id; that many ids are broadcast. Several
    labels of a document count as toxic if one is; of several texts with the id the least
    is taken, once. Learned and scored texts are decoded alike: doubled letters may give a word of
    the documents or one that told in a first pass. Features are the MOST_FEATURES words
    and beginnings that tell most about the label, and whether a text has any of those
    that stand in toxic texts alone, or nearly so: one such word is enough, though most
    toxic texts have several.
    """
    table = language_model(docs)
    spark = docs.sparkSession
    known = (
        chosen(labels, doc_id="long", toxic="int")
        .where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .where(~in_fold(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MOST_LABELS)
    )
    ids = known.toArrow()
    wanted = spark.createDataFrame(
        list(zip(ids["doc_id"].to_pylist(), ids["toxic"].to_pylist())), "doc_id long, toxic int"
    )
    sample = stored(
        documents(docs)
        .join(F.broadcast(wanted), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text")),
        "labelled",
    )
    n, n_toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if n_toxic in (0, n):
        return _constant(-40.0 if n_toxic == 0 else 40.0, table)
    # What tells at first, with words of the documents alone as readings of doubled
    # letters, are the words that such readings may be from then on.
    none = np.zeros(0, np.int64)
    shown, _ = _telling(_found(sample, table, none), n, n_toxic)
    rows = _found(sample, table, shown)
    values, telling = _telling(rows, n, n_toxic)
    if not len(values):
        return _constant(math.log(n_toxic / (n - n_toxic)), table)
    kept = F.filter("found", lambda x: F.array_contains(F.lit(values.tolist()), x))
    learned = rows.orderBy("doc_id").select("toxic", kept.alias("found")).toArrow()
    x = np.zeros((len(learned), len(values) + 2))
    x[:, -1] = 1.0
    for i, own in enumerate(learned["found"].to_pylist()):
        at = np.searchsorted(values, own)
        x[i, at] = 1.0
        x[i, -2] = telling[at].any()
    w = _fit(x, learned["toxic"].to_numpy().astype(float))
    return Model(values, w[:-2], telling, float(w[-2]), float(w[-1]), table, shown, uuid.uuid4().hex)


def _found(sample: DataFrame, table: np.ndarray, shown: np.ndarray) -> DataFrame:
    """(doc_id, toxic, found): the different features of the decoded texts, stored."""
    shared = sample.sparkSession.sparkContext.broadcast(table)
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = decoder_of(name, shared.value, shown)
        for batch in batches:
            for rows in slices(batch):
                texts = restored(rows.column("text").to_pylist(), decoder)
                text, value = features(texts)
                own = [np.unique(value[text == i]) for i in range(len(texts))]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("toxic"), pa.array(own, pa.list_(pa.int64()))],
                    names=["doc_id", "toxic", "found"],
                )

    found = sample.select("doc_id", "text", "toxic").mapInArrow(run, "doc_id long, toxic int, found array<long>")
    return stored(found, "labelled-features")


def _telling(rows: DataFrame, n: int, n_toxic: int) -> tuple[np.ndarray, np.ndarray]:
    """The features that tell most about the label, sorted, and which of them stand in
    toxic texts alone."""
    counts = (
        rows.select("toxic", F.explode("found").alias("feature"))
        .groupBy("feature")
        .agg(F.sum("toxic").alias("t"), F.count("*").alias("all"))
        .where("t >= 3")
    )
    rate = F.lit(n_toxic / n)
    expected, clean = F.col("all") * rate, F.col("all") - F.col("t")
    tells = F.col("t") * F.log(F.col("t") / expected) + F.when(
        clean > 0, clean * F.log(clean / (F.col("all") * (1 - rate)))
    ).otherwise(0.0)
    # So often in toxic texts alone that chance makes none of some 100,000 words so.
    often = max(5, math.ceil(math.log(1e-7) / math.log(n_toxic / n)))
    alone = (F.col("t") >= often) & (F.col("t") >= 0.95 * F.col("all"))
    top = counts.orderBy(F.desc(tells), "feature").limit(MOST_FEATURES).select("feature", alone.alias("alone"))
    found = top.toArrow().sort_by("feature")
    return found["feature"].to_numpy(), np.array(found["alone"].to_pylist(), dtype=bool)


def _constant(logit: float, table: np.ndarray) -> Model:
    none = np.zeros(0, np.int64)
    return Model(none, np.zeros(0), np.zeros(0, bool), 0.0, logit, table, none, uuid.uuid4().hex)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted, n_restored), one row per row of ``docs``.

    ``score`` is the probability of the label 1, ``predicted`` whether it is at least a
    half, ``n_restored`` the number of disguises undone. A null or empty text has the
    score of a text in which nothing was found. With no toxic example every score is
    about 0, with no other example about 1. Nothing but the text is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        decoder = model.decoder()
        for batch in batches:
            for rows in slices(batch):
                texts = rows.column("text").to_pylist()
                plain, n = undone(texts, decoder)
                found = model.scores(plain)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(found),
                        pa.array((found >= 0.5).astype(np.int32)),
                        pa.array(n),
                    ],
                    names=["doc_id", "score", "predicted", "n_restored"],
                )

    return documents(docs).mapInArrow(run, "doc_id long, score double, predicted int, n_restored long")
