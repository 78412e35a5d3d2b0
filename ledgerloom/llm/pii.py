"""Personal data in texts: regular expressions propose, checksums confirm, context weighs.

DataFrame functions only. A proposal's place is found by splitting the text at the same
expression: the lengths of the pieces and of the matches add up to the offsets.

Patterns are possessive where that changes no match, so that no text makes them
backtrack over long runs or recurse; a text without a kind's mark isn't searched for it.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import by_place, documents, place

NEARBY = 40  # characters before and after a proposal that are its context
_CHUNK, _BLOCK = 1024, 64  # code points, entries handled together
ENOUGH = 0.6  # score from which an added span counts


class Kind(NamedTuple):
    """A kind of span. ``mark`` finds texts worth searching; ``checked`` is the score of
    a valid match, ``context`` what words nearby add."""

    name: str
    mark: str
    pattern: str
    valid: Callable[[Column], Column]
    checked: float
    context: str


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substring(digits, n - i + 1, F.lit(1))) - 48
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an international account number (blanks allowed) has remainder 1 by 97."""
    plain = F.regexp_replace(account, " ", "")
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(c >= 65, rest * 100 + c - 55).otherwise(rest * 10 + c - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


def _byte_parts(match: Column) -> Column:
    def small(part: Column) -> Column:
        value = F.regexp_replace(part, "^0+", "")
        return (F.length(value) <= 3) & (F.coalesce(value.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(match, r"\."), small)


BASE = [
    Kind(
        "email",
        "@",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True),
        0.8,
        "e-?mail|contact|write",
    ),
    Kind("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", _byte_parts, 0.6, "ip|address|host|server"),
    Kind(
        "card",
        "[0-9][ -]?[0-9]",
        "[0-9](?:[ -]?[0-9])++",
        lambda m: F.length(_digits(m)).between(16, 19) & luhn(_digits(m)),
        0.9,
        "card|visa|master|credit|debit|pay",
    ),
    Kind(
        "phone",
        r"\+[0-9]",
        r"\+[0-9][ ().0-9-]+[0-9]",
        lambda m: F.length(_digits(m)).between(8, 15),
        0.7,
        "tel|phone|call|mobile|fax",
    ),
]

ADDED = [
    Kind(
        "iban",
        "[A-Z]{2}[0-9]{2}",
        "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?: [A-Z0-9]{4}){2,7}+(?: [A-Z0-9]{1,3})?)"
        "(?![A-Za-z0-9])",
        mod97,
        0.9,
        "iban|account|bank|konto|compte|cuenta",
    ),
    Kind(
        "ssn",
        "[0-9]-[0-9]{2}-[0-9]",
        "(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        lambda m: F.lit(True),
        0.4,
        "ssn|social security|tax id|taxpayer",
    ),
    Kind(
        "card15",
        "3[47][0-9]{2}[ -]?[0-9]",
        "(?<![0-9])3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9])",
        lambda m: luhn(_digits(m)),
        0.5,
        "card|amex|american express|credit|debit|pay",
    ),
    Kind(
        "local_phone",
        "[0-9][.-][0-9]{4}",
        r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9])",
        lambda m: F.lit(True),
        0.4,
        "tel|phone|call|mobile|fax",
    ),
]


def _running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running sums (or other totals ``op``) of an array of ints that begin at 0, in blocks:
    appending to a whole array would copy it for every entry. ``values`` must be a column
    of the table, not an expression, which every block would evaluate anew."""

    def append(so_far: Column, value: Column) -> Column:
        return F.concat(so_far, F.array(op(F.element_at(so_far, -1), value)))

    n = F.size(values)
    none = F.array().cast("array<int>")
    blocks = F.when(
        n > 0,
        F.transform(
            F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int")), lambda k: F.slice(values, k * _BLOCK + 1, F.lit(_BLOCK))
        ),
    ).otherwise(F.array().cast("array<array<int>>"))
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), op))
    before = F.aggregate(totals, F.array(F.lit(0)), append)
    return F.coalesce(
        F.flatten(
            F.zip_with(
                blocks,
                F.slice(before, 1, F.size(blocks)),
                lambda b, first: F.slice(F.aggregate(b, F.array(first), append), F.lit(2), F.size(b)),
            )
        ),
        none,
    )


def _chunks(text: Column) -> Column:
    """The text in pieces of _CHUNK code points: finding a place in it starts near by and
    not at the text's beginning."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0))


def _part(chunks: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of a text in chunks; what lies outside is empty."""
    first = F.floor(start / _CHUNK).cast("int")
    last = F.floor(end / _CHUNK).cast("int")
    told = F.array_join(F.slice(chunks, first + 1, last - first + 1), "")
    return F.substring(told, start - first * _CHUNK + 1, end - start)


def _searched(df: DataFrame, text: str, kinds: list[Kind]) -> DataFrame:
    """The table with all valid matches of each kind: its name, start, end (code points,
    end exclusive), score. Each step is a column of its own, since an expression within
    an array function would be evaluated for every entry."""
    column = df[text]
    marked = column.rlike("|".join(f"(?:{kind.mark})" for kind in kinds))
    found = {
        f"_{kind.name}_found": F.when(
            column.rlike(kind.mark), F.regexp_extract_all(column, F.lit(kind.pattern), F.lit(0))
        ).otherwise(F.array().cast("array<string>"))
        for kind in kinds
    }

    def step(kind: Kind) -> Column:
        """How far each match ends after the one before."""
        here = F.col(f"_{kind.name}_found")
        gaps = F.transform(F.split(column, kind.pattern, -1), F.length)
        steps = F.zip_with(F.slice(gaps, 1, F.size(here)), F.transform(here, F.length), lambda gap, size: gap + size)
        return F.when(F.size(here) > 0, steps).otherwise(F.array().cast("array<int>"))

    return (
        df.withColumns({"_chunks": F.when(marked, _chunks(column)), **found})
        .withColumns({f"_{kind.name}_steps": step(kind) for kind in kinds})
        .withColumns({f"_{kind.name}_ends": _running(F.col(f"_{kind.name}_steps"), lambda a, b: a + b) for kind in kinds})
        .withColumns({f"_{kind.name}": _spans(kind) for kind in kinds})
        .drop(*(f"_{kind.name}_{part}" for kind in kinds for part in ("found", "steps", "ends")))
    )


def _spans(kind: Kind) -> Column:
    near = f"(?i)(?<![a-z])(?:{kind.context})(?![a-z])"

    def span(match: Column, end: Column) -> Column:
        start = end - F.length(match)
        begin = F.greatest(start - NEARBY, F.lit(0))
        chunks = F.col("_chunks")
        around = F.concat(_part(chunks, begin, start), F.lit(" "), _part(chunks, end, end + NEARBY))
        said = F.when(around.rlike(near), 0.3).otherwise(0.0)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            start.alias("start"),
            end.alias("end"),
            F.when(kind.valid(match), F.round(F.lit(kind.checked) + said, 2)).alias("score"),
        )

    both = F.zip_with(f"_{kind.name}_found", f"_{kind.name}_ends", span)
    return F.filter(both, lambda s: s["score"].isNotNull())


def _with_spans(df: DataFrame, text: str) -> DataFrame:
    """The table with its spans in ``base`` and ``added``, and its text in ``_chunks``."""
    one = _searched(df, text, [*BASE, *ADDED])
    base = F.concat(*(f"_{kind.name}" for kind in BASE))
    sure = F.filter(F.concat(*(f"_{kind.name}" for kind in ADDED)), lambda s: s["score"] >= ENOUGH)
    two = one.withColumn("base", base).withColumn("sure", sure)
    apart = F.filter(
        "sure",
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    return two.withColumn("added", apart).drop("sure", *(f"_{kind.name}" for kind in [*BASE, *ADDED]))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, text, base, added), one row per row of ``docs``; the last two are arrays
    of (kind, start, end, score), by kind and then by start.

    ``base`` has every match of the base kinds that passes its check: ``[...]@...`` mail
    addresses, addresses of four parts up to 255, cards of 16 to 19 digits by Luhn, and
    phone numbers with ``+`` and 8 to 15 digits. ``added`` has account numbers by
    mod-97, and weaker patterns that only words nearby make likely, where no base span
    lies. A null text is empty and has no spans.
    """
    return _with_spans(documents(docs), "text").select("doc_id", "text", "base", "added")


def _listed(spans: Column) -> Column:
    shown = F.transform(
        spans,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(shown, ",")


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, counts of the base kinds, base_sha256, spans, n_added) of ``find``."""

    def count(name: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    return find(docs).select(
        "doc_id",
        *(count(kind.name) for kind in BASE),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets, and n_chars
    (if there is such a column) the new length. Of spans that overlap the first, then the
    longest, names the kind of all they cover together. A null text stays null."""
    plain = by_place(docs)
    text = place(docs, "text")
    found = _with_spans(plain.withColumn("_text", plain[text].cast("string")), "_text")
    spans = F.array_sort(
        F.transform(
            F.concat("base", "added"),
            lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("least"), s["kind"].alias("kind")),
        )
    )

    # How far the spans up to each one reach: what lies between that and the next stays.
    reach = _running(F.col("_ends"), lambda a, b: F.greatest(a, b))

    def piece(s: Column, at: Column) -> Column:
        mark = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.when(s["start"] >= at, F.concat(_part(F.col("_chunks"), at, s["start"]), mark)).otherwise(F.lit(""))

    at = F.concat(F.array(F.lit(0)), F.slice("_reach", 1, F.size("_spans") - 1))
    tail = _part(F.col("_chunks"), F.element_at("_reach", -1), F.length("_text"))
    done = F.concat(F.array_join(F.zip_with("_spans", "_at", piece), ""), tail)
    marked = found.withColumn("_spans", spans).withColumn("_ends", F.transform("_spans", lambda s: -s["least"]))
    marked = marked.withColumn("_reach", reach).withColumn("_at", at)
    changed = marked.withColumn("_new", F.when(F.size("_spans") > 0, done).otherwise(F.col("_text")))
    length = place(docs, "n_chars") if docs.columns.count("n_chars") == 1 else None

    def kept(i: int) -> Column:
        name = f"c{i}"
        if name == text:
            return F.col("_new").alias(name)
        if name == length:
            return F.length("_new").cast(plain.schema[name].dataType).alias(name)
        return F.col(name)

    return changed.select(*(kept(i) for i in range(len(docs.columns)))).toDF(*docs.columns)
