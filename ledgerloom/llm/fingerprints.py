"""Document fingerprints that add up: a homomorphic hash of a text's paragraphs.

A fingerprint is the sum, modulo powers of two, of one wide vector for each paragraph,
so the order of paragraphs doesn't matter, and inserting or deleting a paragraph adds
or subtracts its vector. A paragraph's vector has two parts:

- EXACT lanes modulo 2**62, hashed from the whole paragraph: two texts with equal sums
  have the same paragraphs, but for chance collisions;
- LIKE lanes modulo 2**21, the bits of hashes of its clauses. Taken as +1 and -1, they
  are random projections: the scalar product of two sums estimates how many clauses
  the texts share, and so their likeness.

Three LIKE lanes lie side by side in one long and are added together without carries
between them. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.tables import documents, stored

EXACT, GROUPS, LANE = 8, 21, 21  # lanes; longs with three LIKE lanes each; bits of those
_EXACT_MASK = (1 << 62) - 1
_ONES = sum(1 << (LANE * k) for k in range(3))
_TOPS = _ONES << (LANE - 1)
_BELOW = _ONES * ((1 << (LANE - 1)) - 1)
_LANES = "array<bigint>"
BUCKET_ROWS = 1024  # documents of one range of ids, about
_FAN = 64


def _exact(paragraph: Column) -> Column:
    strong = F.sha2(paragraph, 256)
    return F.array(
        *(F.xxhash64(F.lit(i), strong).bitwiseAND(F.lit(_EXACT_MASK)) for i in range(EXACT))
    )


def _zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0).cast("bigint"), n)


def add_exact(a: Column, b: Column) -> Column:
    """Sums of EXACT lanes."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(_EXACT_MASK)))


def subtract_exact(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(_EXACT_MASK)))


def _joined(low: Column, high: Column) -> Column:
    return low.bitwiseXOR(high.bitwiseAND(F.lit(_TOPS)))


def add_like(a: Column, b: Column) -> Column:
    """Sums of LIKE lanes, three in a long, each modulo 2**21: all bits but the highest
    are added, which can't carry over; the highest is the exclusive or."""

    def one(x: Column, y: Column) -> Column:
        low = x.bitwiseAND(F.lit(_BELOW)) + y.bitwiseAND(F.lit(_BELOW))
        return _joined(low, x.bitwiseXOR(y))

    return F.zip_with(a, b, one)


def subtract_like(a: Column, b: Column) -> Column:
    def one(x: Column, y: Column) -> Column:
        # The highest bits set in x keep borrows inside the lanes.
        low = x.bitwiseAND(F.lit(_BELOW)).bitwiseOR(F.lit(_TOPS)) - y.bitwiseAND(F.lit(_BELOW))
        return _joined(low, x.bitwiseXOR(y).bitwiseXOR(F.lit(_TOPS)))

    return F.zip_with(a, b, one)


def _clauses(text: Column) -> Column:
    """Hashes of the parts between line breaks and punctuation marks, blank ones left out."""
    parts = F.split(text, r"[\n.,;:!?]\s*")
    return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.xxhash64(p))


def _like(text: Column) -> Column:
    """LIKE lanes of a text: for each clause the bits of its hash, in the lanes' order."""

    def add(lanes: Column, h: Column) -> Column:
        # A bit can't carry past its lane's highest bit: that one is put aside.
        def one(x: Column, i: Column) -> Column:
            bit = F.call_function("shiftright", h, i).bitwiseAND(F.lit(_ONES))
            return _joined(x.bitwiseAND(F.lit(_BELOW)) + bit, x)

        return F.transform(lanes, one)

    return F.aggregate(_clauses(text), _zeros(GROUPS), add)


def lanes(text: Column) -> Column:
    """(exact, like, clauses, paragraphs): the fingerprint of a text as lanes. An empty
    text has no paragraph: all lanes are 0."""
    paragraphs = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n"))
    exact = F.aggregate(paragraphs, _zeros(EXACT), lambda total, p: add_exact(total, _exact(p)))
    return F.struct(
        exact.alias("exact"),
        _like(text).alias("like"),
        F.size(_clauses(text)).cast("long").alias("clauses"),
        F.size(paragraphs).cast("long").alias("paragraphs"),
    )


def insert(a: Column, b: Column) -> Column:
    """Lanes of the paragraphs of both."""
    return F.struct(
        add_exact(a["exact"], b["exact"]).alias("exact"),
        add_like(a["like"], b["like"]).alias("like"),
        (a["clauses"] + b["clauses"]).alias("clauses"),
        (a["paragraphs"] + b["paragraphs"]).alias("paragraphs"),
    )


def delete(a: Column, b: Column) -> Column:
    """Lanes of ``a`` without the paragraphs of ``b``."""
    return F.struct(
        subtract_exact(a["exact"], b["exact"]).alias("exact"),
        subtract_like(a["like"], b["like"]).alias("like"),
        (a["clauses"] - b["clauses"]).alias("clauses"),
        (a["paragraphs"] - b["paragraphs"]).alias("paragraphs"),
    )


def shown(lanes: Column) -> Column:
    """The fingerprint as hexadecimal text: EXACT lanes, LIKE lanes, counts."""
    longs = F.concat(lanes["exact"], lanes["like"], F.array(lanes["clauses"], lanes["paragraphs"]))
    return F.array_join(F.transform(longs, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _projections(lanes: Column) -> Column:
    """LIKE lanes as sums of +1 and -1 for each clause."""

    def three(x: Column) -> Column:
        parts = (F.call_function("shiftright", x, F.lit(LANE * k)) for k in range(3))
        return F.array(
            *(2 * p.bitwiseAND(F.lit((1 << LANE) - 1)) - lanes["clauses"] for p in parts)
        )

    return F.flatten(F.transform(lanes["like"], three))


def likeness(a: Column, b: Column) -> Column:
    """Share of clauses that two fingerprints have in common, estimated, from 0 to 1:
    twice the scalar product over the sum of squares. 1 for equal fingerprints."""
    both = F.zip_with(
        _projections(a),
        _projections(b),
        lambda x, y: F.struct((x * y).alias("xy"), (x * x + y * y).alias("squares")),
    )
    total = F.aggregate(
        both,
        F.struct(F.lit(0).cast("bigint").alias("xy"), F.lit(0).cast("bigint").alias("squares")),
        lambda t, s: F.struct((t["xy"] + s["xy"]).alias("xy"), (t["squares"] + s["squares"]).alias("squares")),
        lambda t: F.when(t["squares"] > 0, 2 * t["xy"].cast("double") / t["squares"]).otherwise(0.0),
    )
    same = (a["exact"] == b["exact"]) & (a["like"] == b["like"])
    return F.when(same, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, lanes, fingerprint), one row per row; a null text is empty."""
    found = documents(docs).select("doc_id", F.length("text").cast("long").alias("n_chars"), lanes(F.col("text")).alias("lanes"))
    return found.withColumn("fingerprint", shown(F.col("lanes")))


# --- every document beside the next -------------------------------------------------


def _cuts(ids: DataFrame, rows: int) -> list[int]:
    """Ids that begin ranges of about BUCKET_ROWS documents: the smallest id, and others
    that occur. Their number follows the rows, up to 64 ** 3; they are only where ranges
    are cut, and any cuts give the same result."""
    n = min(_FAN**3, max(1, rows // BUCKET_ROWS))
    found = ids.agg(
        F.min("doc_id"), F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 20 * n + 100)
    ).first()
    return sorted({found[0], *found[1]}) if found[0] is not None else []


def _range_of(doc_id: Column, cuts: list[int]) -> Column:
    """Number of the range an id lies in, by three steps of 64 comparisons at most."""
    step = _FAN * _FAN
    top = F.lit(cuts[::step])
    middle = F.lit([cuts[i : i + step : _FAN] for i in range(0, len(cuts), step)])
    fine = F.lit([cuts[i : i + _FAN] for i in range(0, len(cuts), _FAN)])
    below = lambda values: F.size(F.filter(values, lambda v: v <= doc_id)) - 1
    first = below(top)
    second = first * _FAN + below(F.get(middle, first))
    return second * _FAN + below(F.get(fine, second))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, lanes, next_text, next_lanes): every row with the row after it,
    ascending by doc_id and text; after the last comes the first.

    Ids are cut into ranges at ids that occur, so the first row of each range is known
    by its id: it is sent to the range before, too, and ends that one. Rows without
    doc_id come before all others. Texts are shuffled once, and no range is large unless
    one id is that often repeated.
    """
    texts = documents(docs)
    ids = texts.select("doc_id")
    rows, unnamed = ids.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    cuts = _cuts(ids, rows)
    some = texts.withColumn("lanes", lanes(F.col("text")))
    last = max(0, len(cuts) - 1)
    # Where a row stands: its range, and for rows that also end another range, that one.
    # Rows without id stand in front of the first range and begin it.
    if cuts:
        own = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(_range_of(F.col("doc_id"), cuts))
        begins = F.col("doc_id").isNull() if unnamed else F.col("doc_id") == cuts[0]
        ends_of = F.when(begins, F.lit(last)).when(
            own > 0, F.when(F.array_contains(F.lit(cuts), F.col("doc_id")), own - 1)
        )
    else:
        own, begins = F.lit(0), F.lit(True)
        ends_of = F.lit(0)
    wrapped = F.when(begins, F.lit(1)).otherwise(F.lit(0))  # the first, after the last
    stands = F.array(
        F.struct(own.cast("int").alias("range"), F.lit(False).alias("only_ends"), F.lit(0).alias("turn")),
        F.struct(ends_of.cast("int").alias("range"), F.lit(True).alias("only_ends"), wrapped.alias("turn")),
    )
    dealt = some.select(
        "doc_id", "text", "lanes", F.explode(F.filter(stands, lambda s: s["range"].isNotNull())).alias("at")
    ).select("*", "at.*")
    order = Window.partitionBy("range").orderBy(
        "turn", F.asc_nulls_first("doc_id"), "text", "only_ends"
    )
    return (
        dealt.withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_lanes", F.lead("lanes").over(order))
        .where("NOT only_ends")
        .select("doc_id", "text", "lanes", "next_text", "next_lanes")
    )


def edited(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next) of every document and its edited text: the last quarter of its characters
    gives way to the first as many (or all) of the next document's. The near_* columns
    are the likeness of the fingerprint to the edited text's and the next document's."""
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    changed = F.concat(
        F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter)
    )
    found = with_next(docs).select(
        "doc_id", n.cast("long").alias("n_chars"), "lanes", "next_lanes", changed.alias("edited")
    )
    found = found.select("*", lanes(F.col("edited")).alias("edited_lanes"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        shown(F.col("lanes")).alias("fingerprint"),
        shown(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"),
    )
