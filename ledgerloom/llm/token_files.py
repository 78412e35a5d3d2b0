"""Token ids of documents in ORC files, sorted by document id.

ORC encodes the ids by integer run lengths inside stripes, keeps a row index entry
(smallest and largest value) for every few rows and a Bloom filter on ``doc_id``.
A file holds a range of document ids, a task reads whole stripes, and a lookup of one
document skips every stripe and row group that can't hold it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.tables import documents, slices, stored
from ledgerloom.llm.words import U, code_points, space_separated, words

END = 2  # id after each document
STRIPE, ROWS = 64 << 20, 1000  # bytes of a stripe, rows of a row index entry
HELD_WORDS = 1_200_000  # words a Python process remembers, besides those of the texts at hand


@cache
def _tokenizer(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _by_word(path: str) -> bool:
    """Whether ids of a text are those of its blank-separated words in turn: white space
    is dropped before the merges, and no added token holds a blank."""
    import json

    told = json.loads(_tokenizer(path).to_str())
    pre = told.get("pre_tokenizer") or {}
    split = [p for p in pre.get("pretokenizers", []) if p.get("type") == "Split"]
    normal = [n.get("type") for n in (told.get("normalizer") or {}).get("normalizers", [])]
    return (
        normal == ["NFC", "Replace", "Lowercase"]
        and len(split) == 1
        and split[0]["behavior"] == "Removed"
        and split[0]["invert"]
        and "\\s\\p{L}\\p{N}" in split[0]["pattern"].get("Regex", "")
        and told["model"].get("unk_token") is None
        and all(not any(c.isspace() for c in t["content"]) for t in told["added_tokens"])
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in told["added_tokens"])
    )


@cache
def _end_suffix(path: str) -> str:
    import json

    return json.loads(_tokenizer(path).to_str())["model"].get("end_of_word_suffix") or ""


# Letters that no normal form and no lower-casing turns into several characters, and a
# comma or full stop after them.
_LETTERS = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([.,]?)")


class Encoder:
    """Ids of texts; words seen before are looked up instead of merged again.

    Words between blanks are looked up by 64-bit hashes and compared before ids are used
    again: texts in which two words share a hash are merged as a whole. ``hashes`` is sorted;
    its word i is spelled by ``length[i]`` code points of ``letters`` from ``first[i]`` on, its
    ids are ``size[i]`` numbers of ``pool`` from ``start[i]`` on. At most ``most`` words stay, HELD_WORDS if None.
    """

    def __init__(self, path: str, most: int | None = None):
        self.most = most
        self.tokenizer = _tokenizer(path)
        self.by_word = _by_word(path)
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.first, self.length = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)
        self.letters = np.zeros(0, dtype=np.uint32)
        self.start, self.size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        self.pool = np.zeros(0, dtype=np.uint32)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        if self.by_word and _end_suffix(path):
            self.ends[[i for t, i in vocabulary.items() if t.endswith(_end_suffix(path))]] = True

    def _merged(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, dtype=np.uint32) for f in found]

    def _learned(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of new words one after another, and how many each has. A word of letters
        with a comma or full stop is the letters and the mark; words of letters alone are
        merged many at a time and told apart by the tokens that end a word."""
        if not self.ends.any():
            ids = self._merged(new)
            return np.concatenate([np.zeros(0, np.uint32), *ids]), _lengths(ids)
        parts = [_LETTERS.fullmatch(w) for w in new]
        cores = [found and (found[1].lower() if found[1].isascii() else found[1]) for found in parts]
        plain = sorted(set(filter(None, cores)))
        other = [*(w for w, found in zip(new, parts) if found is None), ".", ","]
        pool, sizes = [], []
        for at in range(0, len(plain), 512):
            some = plain[at : at + 512]
            (together,) = self._merged([" ".join(some)])
            stops = np.flatnonzero(self.ends[together]) + 1
            if len(stops) == len(some) and stops[-1] == len(together):
                pool.append(together)
                sizes.append(np.diff(stops, prepend=0))
            else:
                pool += (ids := self._merged(some))
                sizes.append(_lengths(ids))
        pool += (ids := self._merged(other))
        size = np.concatenate([*sizes, _lengths(ids)])
        flat, first = np.concatenate(pool), np.cumsum(size) - size
        # Each word is one entry, or one and that of its mark.
        place = {core: i for i, core in enumerate(plain)}
        rest = iter(range(len(plain), len(size)))
        entry = np.array([next(rest) if core is None else place[core] for core in cores], dtype=np.int64)
        marks = {"": 0, ".": len(size) - 2, ",": len(size) - 1}
        mark = np.array([0 if found is None else marks[found[2]] for found in parts], dtype=np.int64)
        entries = np.column_stack((entry, mark)).ravel()
        many = size[entries]
        many[1::2][mark == 0] = 0
        return flat[_spread(first[entries], many)], many[::2] + many[1::2]

    def sizes(self, texts: list[str]) -> np.ndarray:
        """How many ids each text has, without special tokens."""
        return self.encode(texts, count_only=True)[1]

    def encode(self, texts: list[str], count_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, without special tokens, and how many
        each text has; with ``count_only`` only the second."""
        if not self.by_word:  # a tokenizer that needs the whole text gets it whole
            return self._whole(texts)
        found = words(texts, space_separated())
        codes, _ = code_points(texts)
        kinds, one, each = np.unique(found.hash, return_index=True, return_inverse=True)
        held = self.hashes, self.first, self.length, self.letters, self.start, self.size, self.pool
        place = np.searchsorted(self.hashes, kinds)
        unknown = (place == len(self.hashes)) | (np.append(self.hashes, U(0))[place] != kinds)
        if len(new := one[unknown]):
            text = found.text[new]
            places = zip(text.tolist(), (found.start[new] - found.offset[text]).tolist(), (found.end[new] - found.offset[text]).tolist())
            ids, sizes = self._learned([texts[i][a:b] for i, a, b in places])
            lengths = found.end[new] - found.start[new]
            held_at = np.ones(len(self.hashes) + len(new), dtype=bool)
            held_at[place[unknown] + np.arange(len(new))] = False
            self.hashes = _merge(held_at, self.hashes, kinds[unknown])
            self.first = _merge(held_at, self.first, len(self.letters) + np.cumsum(lengths) - lengths)
            self.length = _merge(held_at, self.length, lengths)
            self.letters = np.concatenate((self.letters, codes[_spread(found.start[new], lengths)]))
            self.start = _merge(held_at, self.start, len(self.pool) + np.cumsum(sizes) - sizes)
            self.size = _merge(held_at, self.size, sizes)
            self.pool = np.concatenate((self.pool, ids))
        at = np.searchsorted(self.hashes, kinds)[each]
        lengths = found.end - found.start
        lettered = (codes != 32) & (codes != 10)  # of all words, in turn
        same = (lengths == self.length[at]).all() and (
            codes[lettered] == self.letters[_spread(self.first[at], lengths)]
        ).all()
        if not same:
            self.hashes, self.first, self.length, self.letters, self.start, self.size, self.pool = held
            return self._whole(texts)
        sizes = self.size[at].astype(np.int64)
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))
        flat = np.zeros(0, dtype=np.uint32)
        if not count_only:
            flat = self.pool[_spread(self.start[at], sizes)]
        if len(self.hashes) > (HELD_WORDS if self.most is None else self.most):  # the words met first stay
            self.hashes, self.first, self.length, self.letters, self.start, self.size, self.pool = held
        return flat, np.diff(ends[found.first])

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self._merged(texts)
        return np.concatenate([np.zeros(0, np.uint32), *found]), _lengths(found)


def _lengths(found: list[np.ndarray]) -> np.ndarray:
    return np.fromiter(map(len, found), dtype=np.int64, count=len(found))


def _merge(held_at: np.ndarray, held: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The held values where ``held_at`` says so, the new ones elsewhere; in the held ones' type."""
    out = np.empty(len(held_at), dtype=held.dtype)
    out[held_at] = held
    out[~held_at] = new
    return out


def _spread(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``first`` to ``first`` + ``lengths`` of each, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - lengths), lengths)


@cache
def encoder(path: str, most: int | None = None) -> Encoder:
    """One for each Python process, so that tasks share the words seen: ``most`` of them,
    HELD_WORDS if None."""
    return Encoder(path, most)


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, most=1 << 21):
                ids, sizes = encoder(path).encode(rows.column("text").to_pylist())
                ends = np.cumsum(sizes)
                flat = pa.array(np.insert(ids, ends, END).view(np.int32))
                at = pa.array(np.concatenate(([0], ends + np.arange(1, len(ends) + 1))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(sizes + 1), pa.ListArray.from_arrays(at, flat)],
                    names=["doc_id", "n_tokens", "ids"],
                )

    return run


def write_tokens(docs: DataFrame, tokenizer: str, path: str, stripe: int = STRIPE, rows: int = ROWS) -> None:
    """Write (doc_id, n_tokens, ids, file) as ORC, ascending by doc_id over all files.

    Rows that share a doc_id are ordered by their texts' hashes and may be in several
    files; a row without doc_id comes first. A null text is empty and has the end id
    alone. ``file`` numbers the files in order.
    """
    # Keys are numbers: Spark brings a sample of them to the driver. The last two part an
    # id, or a text, that many rows share.
    keys = ["doc_id", "hash", "row"]
    texts = documents(docs).withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = texts.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    encoded = ordered.mapInArrow(_encode(tokenizer), "doc_id long, n_tokens long, ids array<int>")
    (
        encoded.withColumn("file", F.spark_partition_id())
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.stripe.size", stripe)
        .option("orc.row.index.stride", rows)
        .option("orc.compress", "SNAPPY")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, file) of written files; filters on doc_id skip stripes."""
    return spark.read.schema("doc_id long, n_tokens long, ids array<int>, file int").orc(path)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of written files: ``start`` counts the ids of
    all documents before, the checksum is that of the ids as little-endian 32-bit words.

    Sums of whole files are added up one row a file; within a file, one after another.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            ids = batch.column("ids")
            flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<i4")
            ends = np.cumsum([0, *(batch.column("n_tokens").to_pylist())])
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            order = pa.array(np.arange(at, at + batch.num_rows))
            at += batch.num_rows
            columns = [batch.column(c) for c in ("doc_id", "n_tokens", "file", "block")]
            yield pa.RecordBatch.from_arrays(
                [*columns, order, pa.array(sums, pa.int64())],
                names=["doc_id", "n_tokens", "file", "block", "place", "ids_crc32"],
            )

    found = read_tokens(spark, path).withColumn("block", F.col("_metadata.file_block_start"))
    schema = "doc_id long, n_tokens long, file int, block long, place long, ids_crc32 long"
    index = stored(found.mapInArrow(run, schema), "token-index")
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0)))
    # A file split between tasks keeps its order by where the split begins.
    within = Window.partitionBy("file").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, -1)
    return index.join(files.select("file", "base"), "file").select(
        "doc_id",
        (F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
