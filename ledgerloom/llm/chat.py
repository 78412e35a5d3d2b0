"""Conversations in one template, from records of many layouts.

A record is a JSON object. The names of its nested fields, without list positions, are
its paths; their sorted list is hashed to the record's schema fingerprint. The
fingerprint selects a declarative mapping, which says where the turns are, and the
record becomes a list of (role, text). A record whose fingerprint no mapping has is kept
apart, not guessed at.

The template writes ``<turn ROLE>``, the text and ``</turn>`` with line breaks, and
escapes in texts and roles what would read as its own marks, so the turns can be read
back exactly. DataFrame functions only.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import chosen

TURNS = "array<struct<role:string,text:string>>"
OPEN, CLOSE = "<turn ", "\n</turn>\n"
# Spark's JSON reader refuses longer texts unless told otherwise.
_ANY_LENGTH = {"maxStringLen": str((1 << 31) - 1)}
ESCAPES = (("\\b", "\\bb"), ("\\l", "\\bl"), ("\\g", "\\bg"), ("<turn", "\\lturn"), ("</turn", "\\l/turn"))


class Mapping(NamedTuple):
    """Where a layout keeps its turns. ``paths`` are all its field paths (of objects in
    lists with ``[]``); ``turns`` lists (role, path of its text) in order; or ``items`` is
    a path to a list of turns, with the names of role and text in them. ``roles`` renames."""

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    items: str = ""
    role: str = ""
    text: str = ""
    roles: tuple[tuple[str, str], ...] = ()


MAPPINGS = [
    Mapping("prompt", ("prompt", "completion"), (("user", "prompt"), ("assistant", "completion"))),
    Mapping("prompt_response", ("prompt", "response"), (("user", "prompt"), ("assistant", "response"))),
    Mapping("question", ("question", "answer"), (("user", "question"), ("assistant", "answer"))),
    Mapping("instruction", ("instruction", "output"), (("user", "instruction"), ("assistant", "output"))),
    Mapping(
        "instruction_input",
        ("instruction", "input", "output"),
        (("system", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
    Mapping(
        "nested_prompt",
        ("prompt", "prompt.system", "prompt.user", "response"),
        (("system", "prompt.system"), ("user", "prompt.user"), ("assistant", "response")),
    ),
    Mapping("messages", ("messages", "messages[].role", "messages[].content"), (), "messages", "role", "content"),
    Mapping(
        "conversations",
        ("conversations", "conversations[].from", "conversations[].value"),
        (),
        "conversations",
        "from",
        "value",
        (("human", "user"), ("gpt", "assistant")),
    ),
]


def fingerprint_of(paths) -> str:
    """The schema fingerprint of a set of field paths."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def _names(record: Column) -> Column:
    """The names of an object's fields; null if it is no object."""
    return F.map_keys(F.from_json(record, "map<string,string>", _ANY_LENGTH))


def _inner(value: Column, prefix: Column) -> Column:
    """Paths of the fields of an object, or of all objects in a list."""
    objects = F.when(F.startswith(value, F.lit("[")), F.from_json(value, "array<string>", _ANY_LENGTH)).when(
        F.startswith(value, F.lit("{")), F.array(value)
    )
    dot = F.when(F.startswith(value, F.lit("[")), F.lit("[].")).otherwise(F.lit("."))
    keys = F.flatten(F.transform(objects, lambda o: F.coalesce(_names(o), F.array().cast("array<string>"))))
    return F.coalesce(F.transform(F.array_distinct(keys), lambda k: F.concat(prefix, dot, k)), F.array().cast("array<string>"))


def _containers(mappings: list[Mapping]) -> list[str]:
    return sorted({p.replace("[]", "").split(".")[0] for m in mappings for p in m.paths if "." in p})


def fingerprint(record: Column, mappings: list[Mapping] = MAPPINGS) -> Column:
    """The schema fingerprint of a JSON object, null if it is none.

    Fields that no mapping declares as an object or list aren't opened, so a text that
    happens to look like JSON is a text.
    """
    fields = F.map_entries(F.from_json(record, "map<string,string>", _ANY_LENGTH))
    opened = _containers(mappings)

    def paths(f: Column) -> Column:
        inner = F.when(f["key"].isin(opened), _inner(F.ltrim(f["value"]), f["key"]))
        return F.concat(F.array(f["key"]), F.coalesce(inner, F.array().cast("array<string>")))

    every = F.array_sort(F.array_distinct(F.flatten(F.transform(fields, paths))))
    return F.when(fields.isNotNull(), F.sha2(F.array_join(every, "\n"), 256))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
    )


def _turns(record: Column, mapping: Mapping) -> Column:
    if mapping.items:
        kind = f"{mapping.items} array<struct<`{mapping.role}`:string,`{mapping.text}`:string>>"
        items = F.from_json(record, kind, _ANY_LENGTH)[mapping.items]

        def turn(item: Column) -> Column:
            role = item[mapping.role]
            for theirs, ours in mapping.roles:
                role = F.when(item[mapping.role] == theirs, F.lit(ours)).otherwise(role)
            return _turn(role, item[mapping.text])

        return F.transform(items, turn)
    names = sorted({p.split(".")[0] for _, p in mapping.turns})
    inner = {n: sorted({p.split(".")[1] for _, p in mapping.turns if p.startswith(n + ".")}) for n in names}
    kind = ", ".join(
        f"`{n}` struct<{','.join(f'`{i}`:string' for i in inner[n])}>" if inner[n] else f"`{n}` string" for n in names
    )
    parsed = F.from_json(record, kind, _ANY_LENGTH)

    def value(path: str) -> Column:
        found = parsed
        for name in path.split("."):
            found = found[name]
        return found

    return F.array(*(_turn(F.lit(role), value(path)) for role, path in mapping.turns))


def canonical(records: DataFrame, mappings: list[Mapping] = MAPPINGS) -> DataFrame:
    """(conv_id, layout, schema, turns) from (conv_id, record), one row per row. A record
    that isn't an object, or whose fields no mapping has, gets null for layout and turns."""
    found = chosen(records, conv_id="long", record="string").withColumn(
        "schema", fingerprint(F.col("record"), mappings)
    )
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for mapping in mappings:
        same = F.col("schema") == fingerprint_of(mapping.paths)
        layout = F.when(same, F.lit(mapping.name)).otherwise(layout)
        turns = F.when(same, _turns(F.col("record"), mapping)).otherwise(turns)
    return found.select("conv_id", layout.alias("layout"), "schema", turns.alias("turns"))


def escaped(text: Column) -> Column:
    """No mark of the template is left: a backslash before b, l or g is marked itself,
    then ``<turn`` and ``</turn`` lose their first character."""
    for raw, told in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(told))
    return text


def unescaped(text: Column) -> Column:
    for told, raw in (("\\l", "<"), ("\\g", ">"), ("\\b", "\\")):
        text = F.replace(text, F.lit(told), F.lit(raw))
    return text


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(">"), F.lit("\\g"))


def formatted(turns: Column) -> Column:
    """Turns in the template."""

    def one(turn: Column) -> Column:
        return F.concat(F.lit(OPEN), _escaped_role(turn["role"]), F.lit(">\n"), escaped(turn["text"]), F.lit(CLOSE))

    return F.array_join(F.transform(turns, one), "")


def loss_mask(turns: Column) -> Column:
    """(start, end) in code points of each assistant text in the formatted turns."""

    def add(state: Column, turn: Column) -> Column:
        start = state["at"] + F.length(_escaped_role(turn["role"])) + len(OPEN) + 2
        end = start + F.length(escaped(turn["text"]))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            (end + len(CLOSE)).alias("at"),
            F.when(turn["role"] == "assistant", F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    none = F.array().cast("array<struct<start:int,end:int>>")
    begun = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.aggregate(turns, begun, add, lambda s: s["spans"])


def parsed(text: Column) -> Column:
    """The turns of a formatted text."""
    parts = F.filter(F.split(text, CLOSE), lambda p: p != "")

    def one(part: Column) -> Column:
        at = F.instr(part, ">\n")
        role = F.substring(part, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
        return F.struct(
            unescaped(role).alias("role"),
            unescaped(F.substring(part, at + 2, F.length(part))).alias("text"),
        )

    return F.transform(parts, one)


def format_records(records: DataFrame, mappings: list[Mapping] = MAPPINGS) -> DataFrame:
    """(conv_id, layout, schema, formatted, mask), one row per row: the training text and
    the spans of it that are learned. Of unknown layouts the last two are null."""
    found = canonical(records, mappings)
    return found.select(
        "conv_id",
        "layout",
        "schema",
        formatted(F.col("turns")).alias("formatted"),
        loss_mask(F.col("turns")).alias("mask"),
    )


def records_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, record): the conversations table as records in the layouts its turns
    allow: prompt and completion, instruction with input, or messages.

    Turns are ordered by number, then role and text; null texts and roles are empty.
    A row without conv_id is a conversation of its own.
    """
    rows = chosen(conversations, conv_id="long", turn="long", role="string", text="string")
    turn = F.struct(
        F.coalesce("turn", F.lit(-(1 << 62))).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("content"),
    )
    own = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    grouped = rows.groupBy("conv_id", own.alias("own")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    roles = F.transform("turns", lambda t: t["role"])
    said = lambda i: F.get("turns", F.lit(i))["content"]
    is_ = lambda *names: roles == F.array(*map(F.lit, names))
    record = (
        F.when(
            is_("user", "assistant"),
            F.to_json(F.struct(said(0).alias("prompt"), said(1).alias("completion"))),
        )
        .when(
            is_("system", "user", "assistant"),
            F.to_json(F.struct(said(0).alias("instruction"), said(1).alias("input"), said(2).alias("output"))),
        )
        .otherwise(
            F.to_json(F.struct(F.transform("turns", lambda t: F.struct(t["role"], t["content"])).alias("messages")))
        )
    )
    return grouped.select("conv_id", record.alias("record"))


def digest(texts: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, layout)
    read back from (conv_id, formatted, mask, layout)."""
    turns = parsed(F.col("formatted"))
    told = F.array_join(
        F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    learned = F.array_join(
        F.transform(
            "mask", lambda s: unescaped(F.substring("formatted", s["start"] + 1, s["end"] - s["start"]))
        ),
        "",
    )
    return texts.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "layout",
    )
