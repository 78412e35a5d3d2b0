"""Documents packed into sequences of several permitted lengths, best fit first.

Documents are dealt to shards of about SHARD pieces by a hash; each shard is packed by
itself, longest piece first. A piece goes to the open bin it leaves the least room in.
If none has room, a bin is opened: of every size that holds the piece, the one with the
least cost for each token it can still be filled with, where a bin costs its size and a
fixed overhead. At the end every bin shrinks to the smallest size for its contents.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import documents, slices, stored
from ledgerloom.llm.token_files import encoder

CAPACITIES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 16  # cost of a sequence besides its tokens, in tokens
SHARD = 4096  # pieces packed together, about


def best_fit(lengths: Sequence[int], capacities: Sequence[int], overhead: int) -> list[tuple[int, list[int]]]:
    """Bins as (capacity, places of their pieces in ``lengths``); no piece may be
    longer than the largest capacity. Equal lengths keep their order."""
    sizes = sorted(set(capacities))
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    rising = [lengths[i] for i in reversed(order)]
    volume = np.concatenate(([0], np.cumsum(rising)))  # of the shortest k pieces
    rooms: list[int] = []  # the distinct rooms of open bins, rising
    open_bins: dict[int, list[int]] = {}
    bins: list[tuple[int, list[int]]] = []

    def put(bin_: int, room: int) -> None:
        if room:
            if room not in open_bins:
                rooms.insert(bisect_left(rooms, room), room)
                open_bins[room] = []
            open_bins[room].append(bin_)

    for done, i in enumerate(order):
        need = lengths[i]
        at = bisect_left(rooms, need)
        if at < len(rooms):
            room = rooms[at]
            bin_ = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
                del rooms[at]
        else:
            waiting = len(order) - done - 1

            def cost(size: int) -> tuple[float, int]:
                fitting = min(waiting, bisect_left(rising, size - need + 1))
                filled = min(size, need + int(volume[fitting]))
                return (size + overhead) / filled, size

            room = min((s for s in sizes if s >= need), key=cost)
            bin_ = len(bins)
            bins.append((room, []))
        bins[bin_][1].append(i)
        put(bin_, room - need)
    return [
        (next(s for s in sizes if s >= sum(lengths[i] for i in own)), own) for _, own in bins
    ]


def token_lengths(docs: DataFrame, tokenizer: str, most_words: int | None = None) -> DataFrame:
    """(doc_id, n_tokens): ids of the whole text by a tokenizer's file, and an end id.
    Fewer ``most_words``, which a Python process remembers, take less memory and more time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                sizes = encoder(tokenizer, most_words).sizes(rows.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(sizes + 1)], names=["doc_id", "n_tokens"]
                )

    return documents(docs).mapInArrow(run, "doc_id long, n_tokens long")


_BINS = (
    "bin_id long, capacity long, used long, doc_ids array<long>, "
    "starts array<long>, lengths array<long>"
)


def pack(
    lengths: DataFrame, capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD, shard: int = SHARD
) -> DataFrame:
    """(bin_id, capacity, used, doc_ids, starts, lengths) from (doc_id, n_tokens).

    ``starts`` and ``lengths`` say which tokens of the documents a bin holds. A document
    longer than the largest capacity is cut into pieces of it; all but the last fill a
    bin. Documents without tokens are in no bin; rows that share a doc_id, and rows
    without one, are packed each on its own.
    """
    largest = max(capacities)
    held = stored(lengths.select("doc_id", "n_tokens"), "lengths")
    row = F.monotonically_increasing_id()
    pieces = held.select("doc_id", "n_tokens", row.alias("row")).where("n_tokens > 0")
    shards = max(1, -(-held.count() // shard))
    whole = pieces.where(F.col("n_tokens") >= largest).select(
        "doc_id",
        F.explode(F.sequence(F.lit(0), F.floor(F.col("n_tokens") / largest) - 1)).alias("k"),
        "row",
    )
    rest = pieces.select(
        "doc_id",
        (F.col("n_tokens") % largest).alias("length"),
        (F.col("n_tokens") - F.col("n_tokens") % largest).alias("start"),
        F.pmod(F.xxhash64("doc_id", "row"), F.lit(shards)).cast("int").alias("shard"),
        "row",
    ).where("length > 0")

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("row", "ascending")])
        ids, starts, sizes = (table.column(c).to_pylist() for c in ("doc_id", "start", "length"))
        bins = best_fit(sizes, capacities, overhead)
        base = key[0].as_py() << 32
        of = lambda values: [[values[i] for i in own] for _, own in bins]
        longs = pa.list_(pa.int64())
        return pa.table(
            {
                "bin_id": pa.array([base + i for i in range(len(bins))], pa.int64()),
                "capacity": pa.array([size for size, _ in bins], pa.int64()),
                "used": pa.array([sum(sizes[i] for i in own) for _, own in bins], pa.int64()),
                "doc_ids": pa.array(of(ids), longs),
                "starts": pa.array(of(starts), longs),
                "lengths": pa.array(of(sizes), longs),
            }
        )

    filled = whole.select(
        # Below 0, apart from all shards' bins; the pieces are numbered after they are cut.
        (-F.monotonically_increasing_id() - 1).alias("bin_id"),
        F.lit(largest).cast("long").alias("capacity"),
        F.lit(largest).cast("long").alias("used"),
        F.array("doc_id").alias("doc_ids"),
        F.array(F.col("k") * largest).alias("starts"),
        F.array(F.lit(largest).cast("long")).alias("lengths"),
    )
    return rest.groupBy("shard").applyInArrow(run, _BINS).unionByName(filled)
