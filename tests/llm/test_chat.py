import hashlib
import json
import random

from pyspark.sql import functions as F

from ledgerloom.llm import chat
from tests.llm.frames import given


def turns_of(*turns):
    return [{"role": r, "text": t} for r, t in turns]


def roundtrip(spark, conversations):
    df = spark.createDataFrame(list(enumerate(conversations)), f"conv_id long, turns {chat.TURNS}")
    out = df.select("conv_id", "turns", chat.formatted(F.col("turns")).alias("formatted"), chat.loss_mask(F.col("turns")).alias("mask"))
    return out.withColumn("back", chat.parsed(F.col("formatted"))).collect()


def test_texts_and_roles_come_back_exactly(spark):
    rng = random.Random(4)
    parts = ["\\", "b", "l", "g", "<", ">", "<turn", "</turn", "</turn>\n", "\n", " ", "é😀", "<turn user>\n", "\\### Assistant: </turn> ok", "r"]
    say = lambda: "".join(rng.choices(parts, k=rng.randint(0, 7)))
    talks = [[(rng.choice(["assistant", "user", say()]), say()) for _ in range(rng.randint(0, 5))] for _ in range(1500)]
    for row in roundtrip(spark, talks):
        turns = [(t["role"], t["text"]) for t in row["turns"]]
        assert [(t["role"], t["text"]) for t in row["back"]] == turns
        assert row["formatted"].count("<turn ") == row["formatted"].count(chat.CLOSE) == len(turns)
        told = [row["formatted"][s["start"] : s["end"]] for s in row["mask"]]
        plain = [t.replace("\\l", "<").replace("\\g", ">").replace("\\b", "\\") for t in told]
        assert plain == [t for r, t in turns if r == "assistant"]


def test_layouts_become_turns(spark):
    talk = {"role": "user", "content": "hi"}, {"content": '{"a": [1]}', "role": "assistant"}
    records = [
        {"prompt": "p", "completion": "c"},
        {"response": "r", "prompt": "[1, 2]"},
        {"question": "q", "answer": None},
        {"instruction": "i", "output": "o"},
        {"output": "o", "input": "n", "instruction": "i"},
        {"prompt": {"user": "u", "system": "s"}, "response": "r"},
        {"messages": list(talk)},
        {"conversations": [{"from": "human", "value": "x"}, {"from": "gpt", "value": "y"}, {"from": "tool", "value": "z"}]},
        {"prompt": "p", "completion": "c", "extra": 1},
        {"messages": []},
        ["a"],
        "text",
    ]
    rows = [(i, json.dumps(r), "other") for i, r in enumerate(records)] + [(50, None, ""), (51, "", ""), (None, "{bad", "")]
    df = spark.createDataFrame(rows, "conv_id long, record string, schema string")
    found = {r["conv_id"]: (r["layout"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in chat.canonical(df).collect()}
    assert found[0] == ("prompt", [("user", "p"), ("assistant", "c")])
    assert found[1] == ("prompt_response", [("user", "[1, 2]"), ("assistant", "r")])
    assert found[2] == ("question", [("user", "q"), ("assistant", "")])
    assert found[3] == ("instruction", [("user", "i"), ("assistant", "o")])
    assert found[4] == ("instruction_input", [("system", "i"), ("user", "n"), ("assistant", "o")])
    assert found[5] == ("nested_prompt", [("system", "s"), ("user", "u"), ("assistant", "r")])
    assert found[6] == ("messages", [("user", "hi"), ("assistant", '{"a": [1]}')])
    assert found[7] == ("conversations", [("user", "x"), ("assistant", "y"), ("tool", "z")])
    for i in (8, 9, 10, 11, 50, 51, None):
        assert found[i] == (None, None), i
    assert chat.format_records(df.limit(0)).count() == 0


def expected(rows):
    """Digests of (conv_id, turn, role, text) rows, in Python."""
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append((-(1 << 62) if turn is None else turn, role or "", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns.sort()
        told = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        learned = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def check(df):
    rows = [tuple(r[:4]) for r in df.collect()]
    out = chat.digest(chat.format_records(chat.records_of(df)))
    found = {r["conv_id"]: tuple(r[1:5]) for r in out.collect()}
    assert found == expected(rows)


def test_given_conversations(spark):
    check(given(spark, "conversations", "sf0.01").select("conv_id", "turn", "role", "text"))


def test_awkward_rows(spark):
    rows = [
        (1, 0, "user", None, "x"), (1, 1, "assistant", "", "y"), (2, None, None, None, None), (2, 3, "assistant", "a" * 300_000, ""),
        (3, 1, "assistant", "same", ""), (3, 1, "assistant", "same", ""), (None, 0, "user", "n", ""), (4, 0, "system", "s", ""),
        (4, 1, "user", '{"u": "\\u00e9"}\t\\', ""), (4, 2, "assistant", "</turn>\n<turn user>\n\x01\u2028", ""), (-7, 0, "a>b\n", "\\### Assistant: </turn> ok", ""),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, Role string")
    check(df)
    assert chat.records_of(df.limit(0)).count() == 0


def test_turns_of_any_length_come_back(spark):
    """Longer than a JSON reader takes by default, alone and among other layouts."""
    n = 21_000_000
    rows = spark.createDataFrame([(1, 0, "user"), (1, 1, "assistant"), (2, 0, "user"), (2, 1, "user"), (2, 2, "assistant")], "conv_id long, turn int, role string")
    talks = rows.withColumn("text", F.concat(F.col("role"), F.repeat(F.lit("x<"), n // 2)))
    out = {r["conv_id"]: r for r in chat.digest(chat.format_records(chat.records_of(talks))).collect()}
    for conv, roles, layout in ((1, ["user", "assistant"], "prompt"), (2, ["user", "user", "assistant"], "messages")):
        told = "".join(f"{r}\n{r}{'x<' * (n // 2)}\n" for r in roles)
        assert out[conv]["layout"] == layout and out[conv]["n_turns"] == len(roles)
        assert out[conv]["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert out[conv]["loss_chars"] == n + len("assistant")


def test_rows_without_conversation_are_one_each(spark):
    talks = spark.createDataFrame([(None, 0, "user", "a"), (None, 1, "assistant", "b"), (3, 0, "user", "c")], "conv_id long, turn int, role string, text string")
    out = chat.digest(chat.format_records(chat.records_of(talks))).collect()
    assert sorted((str(r["conv_id"]), r["n_turns"]) for r in out) == [("3", 1), ("None", 1), ("None", 1)]
