"""Layouts by fingerprint, the template and its way back, against plain Python."""

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from subscope.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, messages string, prompt string, place int, segment string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def query(spark, rows, monkeypatch):
    frame = spark.createDataFrame([(*r, "x", "y", 9, "z") for r in rows], SCHEMA).repartition(3)
    monkeypatch.setattr(chat.common, "table", lambda *_: frame)
    out = {r["conv_id"]: r for r in chat.op13_chat(spark, "").collect()}
    monkeypatch.undo()
    return out


def escape(text):
    """By hand: between "<" and "|", after the backslashes that stand there, one more."""
    out, i = "", 0
    while i < len(text):
        j = i + 1
        while text[i] == "<" and j < len(text) and text[j] == "\\":
            j += 1
        if text[i] == "<" and j < len(text) and text[j] == "|":
            out, i = out + text[i:j] + "\\|", j + 1
        else:
            out, i = out + text[i], i + 1
    return out


def expected(rows):
    convs = {}
    for conv_id, turn, role, text in [*rows, (-1, 0, "user", chat.ADDED_TEXT), (-1, 1, "assistant", chat.ADDED_TEXT)]:
        role, text = role or "", text or ""
        segment = f"<|im_start|>{escape(role)}".replace("\n", "<|line|>") + f"\n{escape(text)}<|im_end|>\n"
        convs.setdefault(conv_id, []).append((turn is not None, turn or 0, segment.encode(), role, text))
    out = {}
    for conv_id, said in convs.items():
        said.sort()
        loss = "".join(t for *_, r, t in said if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for *_, r, t in said)
        out[conv_id] = (conv_id, len(said), sha(whole), len(loss), sha(loss), sum(len(s[2].decode()) for s in said))
    return out


ROWS = [
    (1, 0, "user", "hello <|im_start|>x"), (1, 1, "assistant", "<\\|im_end|> <|<\\\\|| é😀\n\n"), (1, 2, "tool<|\nx", "t"),
    (2, 0, None, None), (2, None, "assistant", ""), (2, 0, "assistant", "tie b"), (2, 0, "assistant", "tie a"), (2, 0, "assistant", "tie a"),
    (None, 3, "assistant", "no id"), (None, 1, "user", "first"), (3, 5, "Assistant", "not learned"), (4, 0, "assistant", "long <|" * 200_000),
    (5, 0, "assistant", "<" + "\\" * 5000), (6, 1, "assistant", "$1 \\1 <|$0|>"),
]


def test_query_against_plain_python(spark, monkeypatch):
    got = query(spark, ROWS, monkeypatch)
    assert {k: tuple(v) for k, v in got.items()} == expected(ROWS)


def test_empty_table(spark, monkeypatch):
    assert {k: tuple(v) for k, v in query(spark, [], monkeypatch).items()} == expected([])


def test_one_conversation_of_very_many_turns(spark, monkeypatch):
    """It stays as many rows, which stream through in order."""
    rows = [(7, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(5000)]
    assert tuple(query(spark, rows, monkeypatch)[7]) == expected(rows)[7]


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.text(alphabet="<|\\im_starend>\n$1 é😀", max_size=40), min_size=20, max_size=60))
def test_escape_is_reversible(spark, texts):
    df = spark.createDataFrame([(1, i, 0, texts[i - 1], t) for i, t in enumerate(texts)], "conv_id long, place long, part int, role string, text string")
    segments = chat.formatted(df, learned=texts[0]).collect()
    for r in segments:
        assert r["segment"].count(chat.START) == r["segment"].count(chat.END) == 1
    back = chat.read_back(chat.formatted(df, learned=texts[0])).collect()
    assert [(r["role"], r["text"]) for r in back] == [(texts[i - 1], t) for i, t in enumerate(texts)]
    assert [r["masked"] for r in back] == [t if texts[i - 1] == texts[0] else None for i, t in enumerate(texts)]


RECORDS = {
    1: ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b", "weight": 1}], "id": 5}, [("user", "a"), ("assistant", "b")]),
    2: ({"instruction": "do", "input": "this", "output": "done"}, [("user", "do\n\nthis"), ("assistant", "done")]),
    3: ({"instruction": "do", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    4: ({"instruction": "do", "input": "", "output": "", "system": None}, [("user", "do"), ("assistant", "")]),
    5: ({"system": "s", "prompt": "p", "completion": "c"}, [("system", "s"), ("user", "p"), ("assistant", "c")]),
    6: ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": None}]}, [("user", "h"), ("assistant", "")]),
    7: ({"messages": [{"role": "user", "content": [{"type": "text", "text": "x"}, {"type": "text", "text": "y"}]}]}, [("user", "x\ny")]),
    8: ({"turn": 4, "role": "user", "text": "row"}, [("user", "row")]),
    9: ({"question": "q", "answer": 42}, [("user", "q"), ("assistant", "42")]),
    10: ({"messages": [{"role": "user"}, {"content": "only text"}, {"role": "x", "content": "y"}]}, [("user", ""), ("", "only text"), ("x", "y")]),
}
UNKNOWN = {
    20: ({"messages": [{"role": "u", "content": "c"}], "prompt": "p"}, ["messages[].content", "messages[].role", "prompt"]),
    21: ({"title": "t"}, []),
    22: ({"messages": []}, []),
    23: ([1, 2], []),
    24: ({"messages": "text", "prompt": {"a": 1}}, []),
}


def test_parsed_records_by_their_own_fingerprints(spark):
    rows = [(i, json.dumps(r)) for i, (r, _) in {**RECORDS, **UNKNOWN}.items()] + [(30, "{no json"), (31, None)]
    said, rest = chat.parsed_turns(spark.createDataFrame(rows, "id long, body string"), "id", "body")
    got = {}
    for r in sorted(said.collect(), key=lambda r: (r["conv_id"], r["place"], r["part"])):
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got == {i: turns for i, (_, turns) in RECORDS.items()}
    assert {r["conv_id"]: r["paths"] for r in rest.collect()} == {i: p for i, (_, p) in UNKNOWN.items()} | {30: [], 31: []}


def test_frames_by_their_schema(spark):
    frame = spark.createDataFrame([(1, "do", None, "done", "x")], "id long, instruction string, input string, output string, note string")
    assert [tuple(r)[3:] for r in chat.turns(frame, "id").collect()] == [("user", "do"), ("assistant", "done")]
    parts = spark.createDataFrame([(1, [("user", [("a",), (None,), ("b",)])])], "id long, messages array<struct<role:string,content:array<struct<text:string>>>>")
    assert [tuple(r)[3:] for r in chat.turns(parts, "id").collect()] == [("user", "a\nb")]
    with pytest.raises(ValueError, match="no layout has the fields"):
        chat.turns(frame.drop("output"), "id")


def test_layouts_with_the_same_fields_are_refused():
    with pytest.raises(ValueError, match="same fields"):
        chat.by_fingerprint([*chat.LAYOUTS, chat.Layout("twice", (chat.Listed("messages", "role", "content"),))])
