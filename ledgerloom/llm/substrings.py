"""Repeated passages, found by compressed FM-indexes of shards.

A window is SPAN words in a row. Its anchor is the run of ANCHOR words in it with the
smallest hash, so equal windows have equal anchors; windows in a row with the same anchor
make a segment. Only segments whose anchor occurs in two different texts can hold a
repeated window. Their different texts go to shards by anchor. Each shard builds an
FM-index of its segments and streams them through it by backward search: the matching
statistics, cut at SPAN words, tell which windows occur again, and the suffixes found
tell the smallest document that has them.

Equal documents, and equal segments, are one before anything is indexed. An anchor with
very many segments is cut up: each of its windows goes to a shard by its own words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.fm_index import FmIndex, repeated
from ledgerloom.llm.tables import chosen, dropped, slices, stored
from ledgerloom.llm.words import blank_separated_as_is, runs, words

SPAN = 13
ANCHOR = 5
SHARD_WORDS = 1 << 20  # words that one index has, about
HOT = 1 << 15  # segments of an anchor that share a shard; more are cut into windows


def _name(column):
    """128 bits of a text's SHA-256."""
    return F.substring(F.unhex(F.sha2(column, 256)), 1, 16)


def segments(hashes: np.ndarray, text: np.ndarray, span: int = SPAN, size: int = ANCHOR):
    """(first word, windows, anchor) of each segment of texts whose words' hashes follow
    each other; ``text`` tells each word's text. Of equal anchors the first counts."""
    n = len(hashes) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    short = runs(hashes, size)
    inside = np.flatnonzero(text[:n] == text[span - 1 :])
    width = span - size + 1
    best, least = np.zeros(n, dtype=np.int64), short[:n].copy()
    for k in range(1, width):
        smaller = short[k : n + k] < least
        best[smaller] = k
        np.minimum(least, short[k : n + k], out=least)
    place = inside + best[inside]
    new = np.flatnonzero(np.concatenate((np.ones(min(1, len(place)), dtype=bool), np.diff(place) != 0)))
    many = np.diff(np.append(new, len(inside)))
    return inside[new], many, short[place[new]].view(np.int64)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch):
            found = words(rows.column("text").to_pylist(), blank_separated_as_is())
            first, many, anchor = segments(found.hash, found.text)
            of = found.text[first]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("kind").take(pa.array(of)),
                    pa.array(anchor),
                    pa.array((first - found.first[of]).astype(np.int32)),
                    pa.array(many.astype(np.int32)),
                ],
                names=["kind", "anchor", "first", "windows"],
            )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of segments, one blank between them; of those with a hot anchor, the
    words of each window."""
    for batch in batches:
        for rows in slices(batch, most=1 << 19):
            out: tuple[list, ...] = ([], [], [], [], [])
            columns = (rows.column(c).to_pylist() for c in ("kind", "lowest", "text", "segments"))
            for kind, lowest, text, own in zip(*columns):
                # Bytes: split() takes ASCII blanks alone.
                told = text.encode().split()
                for segment in own:
                    first, many = segment["first"], segment["windows"]
                    for at in range(first, first + many) if segment["hot"] else (first,):
                        n = 1 if segment["hot"] else many
                        out[0].append(None if segment["hot"] else segment["anchor"])
                        out[1].append(b" ".join(told[at : at + n + SPAN - 1]))
                        out[2].append(kind)
                        out[3].append(lowest)
                        out[4].append(at)
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32())
            arrays = [pa.array(values, t) for values, t in zip(out, kinds)]
            arrays[1] = arrays[1].cast(pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "piece", "kind", "lowest", "first"])


def _searched(table: pa.Table) -> pa.Table:
    """(name, lowest): for each piece of a shard the smallest document that has each of its
    windows, in the order of the windows."""
    told = pc.split_pattern(table.column("piece").combine_chunks(), " ")
    if isinstance(told, pa.ChunkedArray):
        told = told.combine_chunks()
    count = np.diff(told.offsets.to_numpy())
    own = told.flatten().dictionary_encode()
    number = own.indices.to_numpy().astype(np.int64) + 1
    # One 0 after each piece.
    end = np.cumsum(count) + np.arange(len(count))
    first = end - count
    tokens = np.zeros(int(end[-1]) + 1, dtype=np.int64)
    tokens[np.arange(len(number)) + np.repeat(np.arange(len(count)), count)] = number
    index = FmIndex(tokens, len(own.dictionary) + 1, SPAN - 1)
    start, low, high = repeated(index, tokens, first, end, SPAN)

    lowest = table.column("lowest").to_numpy()
    owner = np.repeat(np.arange(len(count)), count + 1)
    of_suffix = lowest[owner[index.places]]
    least = np.repeat(lowest, count + 1)  # a window that is alone is its own piece's
    if len(start):
        groups, back = np.unique(low, return_inverse=True)
        ends = np.zeros(len(groups), dtype=np.int64)
        ends[back] = high
        cuts = np.stack((groups, ends), axis=1).ravel()
        of_suffix = np.append(of_suffix, np.iinfo(np.int64).max)
        least[start] = np.minimum.reduceat(of_suffix, cuts)[::2][back]
    windows = count - SPAN + 1
    at = np.repeat(first - np.concatenate(([0], np.cumsum(windows)[:-1])), windows) + np.arange(windows.sum())
    values = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(windows))).astype(np.int32)), pa.array(least[at])
    )
    return pa.table({"name": table.column("name"), "lowest": values})


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, most=1 << 19):
            out = []
            for text, starts in zip(rows.column("text").to_pylist(), rows.column("starts").to_pylist()):
                told = text.encode().split()
                whole = hashlib.sha256(b" ".join(told)).hexdigest()
                gone, kept = 0, whole
                if starts:
                    change = np.zeros(len(told) + 1, dtype=np.int64)
                    np.add.at(change, starts, 1)
                    np.add.at(change, np.array(starts) + SPAN, -1)
                    stays = np.flatnonzero(np.cumsum(change[:-1]) == 0)
                    gone = len(told) - len(stays)
                    kept = hashlib.sha256(b" ".join([told[i] for i in stays])).hexdigest()
                out.append((len(told), gone, kept, whole))
            yield pa.RecordBatch.from_arrays(
                [rows.column("name"), rows.column("lowest"), *(pa.array(c, t) for c, t in zip(
                    zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string())
                ))],
                names=["name", "lowest", "n_words", "n_removed", "kept_sha256", "whole_sha256"],
            )


def repeated_windows(kinds: DataFrame) -> DataFrame:
    """(kind, starts): the windows, as the number of their first word, that a text with a
    smaller ``lowest`` has too. ``kinds`` has kind (its number), lowest and text, and is a
    stored table; texts without such a window are not in the result."""
    anchors = kinds.select("kind", "text").mapInArrow(
        _anchors, "kind long, anchor long, first int, windows int"
    )
    shared = stored(
        anchors.groupBy("anchor")
        .agg(F.min("kind").alias("a"), F.max("kind").alias("b"), F.count("*").alias("n"))
        .where("a <> b")
        .select(F.col("anchor").alias("of"), (F.col("n") > HOT).alias("hot")),
        "anchors",
    )
    wanted = stored(
        anchors.join(shared.hint("merge"), F.col("anchor") == F.col("of"))
        .groupBy(F.col("kind").alias("wanted"))
        .agg(F.collect_list(F.struct("first", "windows", "anchor", "hot")).alias("segments")),
        "wanted",
    )
    dropped(shared)
    pieces = (
        kinds.join(wanted.hint("merge"), F.col("kind") == F.col("wanted"))
        .select("kind", "lowest", "text", "segments")
        .mapInArrow(_pieces, "anchor long, piece string, kind long, lowest long, first int")
    )
    pieces = stored(pieces.withColumn("name", _name(F.col("piece"))), "pieces")
    dropped(wanted)
    different = stored(
        pieces.groupBy("anchor", "piece")
        .agg(F.min("lowest").alias("lowest"), F.count("*").alias("n"))
        .withColumn("name", _name(F.col("piece"))),
        "different-pieces",
    )
    blanks = F.length("piece") - F.length(F.translate("piece", " ", ""))
    n_words = different.agg(F.sum(blanks + 2)).first()[0] or 0
    shards = n_words // SHARD_WORDS + 1
    shard = F.pmod(F.xxhash64(F.coalesce(F.col("anchor"), F.xxhash64("piece"))), F.lit(shards))
    found = (
        different.withColumn("shard", shard)
        .repartition(int(shards), "shard")
        .groupBy("shard")
        .applyInArrow(_searched_with_counts, "name binary, lowest array<long>, told boolean")
        .where("told")
        .select("name", F.col("lowest").alias("firsts"))
    )
    found = stored(found, "searched")
    dropped(different)
    starts = F.filter(
        F.transform("firsts", lambda x, i: F.when(x < F.col("lowest"), F.col("first") + i)), lambda x: x.isNotNull()
    )
    result = stored(
        pieces.select("name", "kind", "lowest", "first")
        .join(found.hint("merge"), "name")
        .select("kind", starts.alias("starts"))
        .where(F.size("starts") > 0)
        .groupBy("kind")
        .agg(F.flatten(F.collect_list("starts")).alias("starts")),
        "repeated",
    )
    dropped(pieces, found)
    return result


def _searched_with_counts(table: pa.Table) -> pa.Table:
    """``_searched``, and whether the piece can tell anything: it occurs several times or
    another piece has a window of it in a smaller document."""
    found = _searched(table)
    least = pc.list_parent_indices(found.column("lowest").combine_chunks()).to_numpy()
    values = found.column("lowest").combine_chunks().flatten().to_numpy()
    smaller = np.zeros(table.num_rows, dtype=bool)
    smaller[least[values < table.column("lowest").to_numpy()[least]]] = True
    told = smaller | (table.column("n").to_numpy() > 1)
    return found.append_column("told", pa.array(told))


def drop_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Each word goes that lies in a window of
    SPAN words which also starts in a document with a smaller doc_id; windows are judged on
    the texts as given, not on what is left of them. Null and empty texts, and texts of
    fewer words, lose nothing. Rows that share a doc_id lose nothing to each other. A row without
    doc_id loses nothing, and nothing is lost to it.
    """
    texts = chosen(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    kinds = stored(
        texts.groupBy("text")
        .agg(F.min("doc_id").alias("lowest"))
        .select(F.monotonically_increasing_id().alias("kind"), "lowest", "text"),
        "kinds",
    )
    starts = repeated_windows(kinds.where("lowest IS NOT NULL"))
    judged = stored(
        kinds.join(starts.withColumnRenamed("kind", "of").hint("merge"), F.col("kind") == F.col("of"), "left")
        .select(_name(F.col("text")).alias("name"), "lowest", "text", "starts")
        .mapInArrow(
            _kept,
            "name binary, lowest long, n_words long, n_removed long, kept_sha256 string, whole_sha256 string",
        ),
        "judged",
    )
    dropped(kinds, starts)
    copy = (F.col("doc_id") > F.col("lowest")) & (F.col("n_words") >= SPAN)
    original = F.col("doc_id") == F.col("lowest")
    removed = F.when(copy, F.col("n_words")).when(original, F.col("n_removed")).otherwise(F.lit(0).cast("long"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    kept = F.when(copy, nothing).when(original, F.col("kept_sha256")).otherwise(F.col("whole_sha256"))
    return (
        texts.select("doc_id", _name(F.col("text")).alias("name"))
        .join(judged.hint("merge"), "name")
        .select("doc_id", "n_words", removed.alias("n_removed"), kept.alias("kept_sha256"))
    )
