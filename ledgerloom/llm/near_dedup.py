"""Near-duplicate documents by an LSH forest of MinHash signatures.

A tree orders the documents by eight MinHash values. Documents whose values begin
alike form a region; a region that is still large is cut by one more value, so the
depth adapts to how dense the documents lie. The members of a small region are
each other's longest-common-prefix neighbours and become candidates. In a large
region every member is also a candidate with the region's pivot (the text with most
copies), so that a group of thousands of copies needs one comparison a member.
Candidates become links only after a comparison of their full shingle sets.

Texts with equal shingle sets are one class before anything is paired. Pairs that
share a verified pivot aren't compared again: they are in one component already. At
last the members of a large region that aren't in their pivot's component are
compared with all of the region, in blocks: few of a dense group, so no link between
members of one region is lost and no group is paired with itself as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components, merged
from ledgerloom.llm.tables import by_place, documents, place, slices, small_batches, stored
from ledgerloom.llm.words import U, blank_separated, shingles, words

TREES, DEPTH = 16, 8
SMALL = 8  # members of a region that are all paired
BLOCK, CHUNK = 64, 128  # texts compared with each other in one call, about

_FEATURES = "doc_id long, n_shingles long, set_hash binary, labels binary"


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    n = TREES * DEPTH
    return rng.integers(1, 1 << 63, n, dtype=U) * U(2) + U(1), rng.integers(0, 1 << 63, n, dtype=U)


def _signature(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> bytes:
    """MinHash values of a set, big-endian so that bytes sort as numbers do."""
    least = np.full(len(a), np.iinfo(U).max, dtype=U)
    for at in range(0, len(values), 1024):
        block = values[at : at + 1024, None] * a[None, :]
        block += b[None, :]
        np.minimum(least, block.min(axis=0), out=least)
    return (least >> U(32)).astype(">u4").tobytes()


def _sets(texts: list[str], size: int) -> Iterator[np.ndarray]:
    found = words(texts, blank_separated())
    for i in range(len(texts)):
        yield np.unique(shingles(found.hash[found.first[i] : found.first[i + 1]], size))


def _features(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _multipliers()
        for batch in batches:
            for rows in slices(batch):
                n, names, labels = [], [], []
                for values in _sets(rows.column("text").to_pylist(), size):
                    n.append(len(values))
                    some = len(values) > 0
                    names.append(hashlib.md5(values.tobytes()).digest() if some else None)
                    labels.append(_signature(values, a, b) if some else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(n, pa.int64()),
                        pa.array(names, pa.binary()),
                        pa.array(labels, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "set_hash", "labels"],
                )

    return run


def _regions(rows: DataFrame, depth: int) -> DataFrame:
    """Rows with the key and the size of their region at a depth; lone rows go."""
    keyed = rows.withColumn("key", F.xxhash64("tree", F.substring("label", 1, 4 * depth)))
    sizes = keyed.groupBy("key").agg(
        F.count("*").alias("size"), F.max_by("id", F.struct("copies", -F.col("id"))).alias("pivot")
    )
    # Stored, so that the join reads both sides from shuffles and can split a hot region.
    return keyed.join(stored(sizes.where("size > 1"), f"sizes-{depth}"), "key")


def candidates(classes: DataFrame, first_depth: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a, b, is_pivot, trees): ``b`` is the pivot of a large region of
    ``a``, or both lie in a small one; ``trees`` counts the regions that say so. And the
    members (id, n, pivot) of large regions of the first depth, by their pivot."""
    similar = F.col("small") * 100 >= F.col("large") * percent
    rows = classes.select(
        "id",
        "n",
        "copies",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.lit(TREES - 1)),
                lambda t: F.substring("labels", t * (4 * DEPTH) + 1, F.lit(4 * DEPTH)),
            )
        ).alias("tree", "label"),
    )
    pairs, members = [], None
    for depth in range(first_depth, DEPTH + 1):
        found = stored(_regions(rows, depth), f"regions-{depth}")
        group = (
            found.where(F.col("size") <= SMALL)
            .groupBy("key")
            .agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("all"))
            .distinct()
            .select("all", F.posexplode("all").alias("place", "one"))
        )
        pairs.append(
            group.select(
                "one", F.explode(F.slice("all", F.col("place") + 2, F.lit(SMALL))).alias("other")
            ).select(
                F.col("one.id").alias("a"),
                F.col("other.id").alias("b"),
                F.least("one.n", "other.n").alias("small"),
                F.greatest("one.n", "other.n").alias("large"),
                F.lit(False).alias("is_pivot"),
            )
        )
        rest = found.where(F.col("size") > SMALL)
        if members is None:
            members = rest.select("id", "n", "pivot").distinct()
        pairs.append(
            rest.where("id <> pivot").select(
                F.col("id").alias("a"),
                F.col("pivot").alias("b"),
                F.lit(1).cast("long").alias("small"),
                F.lit(1).cast("long").alias("large"),
                F.lit(True).alias("is_pivot"),
            )
        )
        rows = rest.select("id", "n", "copies", "tree", "label")
        if rest.isEmpty():
            break
    every = pairs[0]
    for more in pairs[1:]:
        every = every.union(more)
    every = every.where(similar).where("a <> b").groupBy("a", "b", "is_pivot")
    return every.agg(F.count("*").alias("trees")), members


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text_a", 1 << 19):
                held: dict[str, np.ndarray] = {}

                def values(text: str) -> np.ndarray:
                    if text not in held:
                        held[text] = next(_sets([text], size))
                    return held[text]

                links = []
                for a, b in zip(rows.column("text_a").to_pylist(), rows.column("text_b").to_pylist()):
                    one, other = values(a), values(b)
                    if min(len(one), len(other)) * 100 < max(len(one), len(other)) * percent:
                        links.append(False)
                        continue
                    inner = len(np.intersect1d(one, other, assume_unique=True))
                    links.append(100 * inner >= percent * (len(one) + len(other) - inner))
                kept = rows.select(["a", "b"]).filter(pa.array(links, pa.bool_()))
                if kept.num_rows:
                    yield kept

    of_a = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    of_b = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(of_a, "a").join(of_b, "b").mapInArrow(run, "a long, b long")


def _crossed(size: int, percent: int):
    """Links between a chunk of a region and a block of its members that lie apart."""

    def run(chunk: pa.Table, block: pa.Table) -> pa.Table:
        a, b = [], []
        if chunk.num_rows and block.num_rows:
            asked = list(_sets(block.column("text").to_pylist(), size))
            values = np.concatenate(asked)
            owner = np.repeat(np.arange(len(asked)), [len(x) for x in asked])
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            ids, labels = (np.array(block.column(c).to_pylist()) for c in ("id", "component"))
            sizes = np.array([len(x) for x in asked])
            rows = zip(*(chunk.column(c).to_pylist() for c in ("id", "component")))
            texts = chunk.column("text").to_pylist()
            for (one, label), inner in zip(rows, _sets(texts, size)):
                low, high = (np.searchsorted(values, inner, side) for side in ("left", "right"))
                lengths = high - low
                steps = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                shared = np.bincount(owner[np.repeat(low, lengths) + steps], minlength=len(asked))
                union = sizes + len(inner) - shared
                for i in np.flatnonzero((100 * shared >= percent * union) & (labels != label)):
                    a.append(one)
                    b.append(int(ids[i]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _apart(members: DataFrame, found: DataFrame, shown: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) of members of large regions that aren't in their pivot's component."""
    of_pivot = found.select(F.col("id").alias("p"), F.col("component").alias("pivot_component"))
    placed = (
        members.join(found, "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
        .join(of_pivot, F.col("pivot") == F.col("p"), "left")
        .withColumn("away", F.col("component") != F.coalesce("pivot_component", "pivot"))
        .select("id", "n", "pivot", "component", "away")
    )
    placed = stored(placed, "members")
    counts = (
        placed.groupBy("pivot")
        .agg(F.count("*").alias("rows"), F.count_if("away").alias("asked"))
        .where("asked > 0")
        .select(
            F.col("pivot").alias("p"),
            F.ceil(F.col("rows") / CHUNK).cast("int").alias("chunks"),
            F.ceil(F.col("asked") / BLOCK).cast("int").alias("blocks"),
        )
    )
    with_text = stored(
        placed.join(counts, F.col("pivot") == F.col("p")).drop("p").join(shown, "id"), "dense-texts"
    )
    own = F.xxhash64("id", "pivot")
    chunk, block = (
        F.pmod(own, F.col(n).cast("long")).cast("int") for n in ("chunks", "blocks")
    )
    every = with_text.select(
        "pivot", chunk.alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        "id", "component", "text",
    )
    asked = with_text.where("away").select(
        "pivot", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), block.alias("block"),
        "id", "component", "text",
    )
    keys = ["pivot", "chunk", "block"]
    return (
        every.groupBy(*keys)
        .cogroup(asked.groupBy(*keys))
        .applyInArrow(_crossed(size, percent), "a long, b long")
        .distinct()
    )


def first_depth(percent: int, target: float = 0.99998) -> int:
    """The deepest beginning that one of the trees shares for pairs just alike enough,
    with the target chance."""
    fits = [d for d in range(1, DEPTH) if 1 - (1 - (percent / 100) ** d) ** TREES >= target]
    return max(fits, default=1)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. Documents are linked if
    their sets of ``size``-word shingles have 100 * intersection >= ``percent`` *
    union; ``component_id`` is the smallest doc_id reachable over links. A text of
    fewer words is one shingle; one without words (or null) has none and no links. A
    row without doc_id has no component, no links, and is kept. Rows with the same
    doc_id are one document to the links. Repeated rows are copies of each other.
    """
    small_batches(docs.sparkSession)
    texts = documents(docs)
    features = stored(texts.mapInArrow(_features(size), _FEATURES), "signatures")
    named = features.where("set_hash IS NOT NULL AND doc_id IS NOT NULL")
    classes = stored(
        named.groupBy("set_hash").agg(
            F.min("doc_id").alias("id"),
            F.count("*").alias("copies"),
            F.first("n_shingles").alias("n"),
            F.first("labels").alias("labels"),
        ),
        "classes",
    )
    pairs, members = candidates(classes, first_depth(percent), percent)
    pairs = stored(pairs, "candidates")

    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    shown = stored(
        texts.withColumnRenamed("doc_id", "id")
        .join(needed.hint("merge"), "id")  # grows with the input: never broadcast
        .select("id", "text"),
        "texts",
    )
    # First every member with the pivot that most of its regions name.
    best = (
        pairs.where("is_pivot")
        .groupBy("a")
        .agg(F.max_by("b", F.struct("trees", -F.col("b"))).alias("b"))
    )
    with_pivot = stored(_verified(best, shown, size, percent), "pivot-links")
    # Then the pairs that no common pivot has joined yet.
    hub = with_pivot.withColumnsRenamed({"a": "member", "b": "hub"})
    hub_a = hub.withColumnsRenamed({"member": "ma", "hub": "ha"})
    hub_b = hub.withColumnsRenamed({"member": "mb", "hub": "hb"})
    left = (
        pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
        .join(hub_a, F.col("a") == F.col("ma"), "left")
        .join(hub_b, F.col("b") == F.col("mb"), "left")
        .where(F.coalesce("ha", "a") != F.coalesce("hb", "b"))
        .select("a", "b")
    )
    links = stored(
        with_pivot.union(_verified(stored(left, "pairs"), shown, size, percent)), "links"
    )
    found = components(links)
    more = stored(_apart(members, found, shown, size, percent), "more-links")
    if not more.isEmpty():
        found = merged(found, more)
    found = found.withColumnRenamed("id", "member")

    grouped = (
        classes.select("set_hash", "id")
        .join(found, F.col("id") == F.col("member"), "left")
        .select("set_hash", F.coalesce("component", "id").alias("component"))
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        features.select("doc_id", "n_shingles", "set_hash")
        .join(grouped, "set_hash", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component of near-duplicate rows: that with the
    smallest doc_id, of equal ones any one. Every row counts by itself, whether others
    share its doc_id or it has none; rows without words stay."""
    row = f"c{len(docs.columns)}"
    plain = stored(by_place(docs).withColumn(row, F.monotonically_increasing_id()), "rows")
    texts = plain.select(F.col(row).alias("doc_id"), F.col(place(docs, "text")).alias("text"))
    found = stored(near_duplicates(texts, size, percent).select("doc_id", "component_id"), "components-of-rows")
    doc_id = F.col(place(docs, "doc_id")).cast("long")
    named = plain.select(F.col(row).alias("row"), doc_id.alias("name"))
    least = F.min(F.struct(F.col("name").isNull(), "name", "row")).alias("least")
    kept = (
        found.join(named.hint("merge"), F.col("doc_id") == F.col("row"))
        .groupBy("component_id")
        .agg(least)
        .select(F.col("least.row").alias("stays"))
    )
    return plain.join(kept.hint("merge"), F.col(row) == F.col("stays"), "left_semi").drop(row).toDF(*docs.columns)
