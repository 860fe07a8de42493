"""Chat layouts, template and digests."""

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import chat, queries

from ..oracle import connect, same

PIECES = st.lists(st.sampled_from(["<", "[", "\\", "/", "s>", "</s>", "<s>", "[INST]", "[/INST]", "INST]", "[SEP]", "[ROLE]", "[/ROLE]", "[SYS]", "a", "\n", "é", "[s>"])).map("".join)


def python_escape(text):
    import re

    return re.sub(chat.ESCAPE[0], r"\1\\\2\3", text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "<s>"]), PIECES), max_size=4))
def test_template_is_reversible(turns):
    marks = lambda role: chat.MARKS.get(role, (chat.OTHER[0] + python_escape(role) + chat.OTHER[1], chat.OTHER[2]))
    formatted = "".join(marks(r)[0] + python_escape(t) + marks(r)[1] for r, t in turns)
    assert list(chat.parse(formatted)) == turns


def plain(turns):
    """Digests of canonical turns (conv, turn, role, text) without nulls."""
    out = {}
    for conv in {t[0] for t in turns}:
        mine = sorted(t[1:] for t in turns if t[0] == conv)
        said = "".join(t for _, r, t in mine if r == "assistant")
        out[conv] = (len(mine), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in mine).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def digests(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_digests(df).collect()}


def test_tables(spark, sf):
    same(queries.op13_chat_format(spark, sf), connect(sf), queries.oracle_sql()["op13_chat_format"])


def test_layouts(spark):
    bodies = [
        {"prompt": "p", "completion": "c"},
        {"system": "s", "prompt": "p", "response": 5},
        {"instruction": "i", "input": "n", "output": "o"},
        {"instruction": "i", "input": "", "output": None},
        {"context": "x", "question": "q", "answer": "a"},
        {"messages": [{"role": "user", "content": "u", "name": "n"}, {"role": "tool", "content": None}]},
        {"messages": []},
        {"system": "s", "conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}, {"from": "other", "value": ""}]},
        {"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]},
        {"prompt": "p"},
        {"messages": [{"role": "user", "content": {"deep": 1}}]},
    ]
    rows = [(i, json.dumps(b)) for i, b in enumerate(bodies)] + [(90, "{bad"), (91, None), (92, '"text"')]
    df = spark.createDataFrame(rows, "id long, body string").withColumns({"turn": F.lit(1), "form": F.lit("x"), "conv_id": F.lit(0)})
    got = {}
    for r in chat.record_turns(df, "id", "body").orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {
        0: [("user", "p"), ("assistant", "c")],
        1: [("system", "s"), ("user", "p"), ("assistant", "5")],
        2: [("user", "i\n\nn"), ("assistant", "o")],
        3: [("user", "i"), ("assistant", "")],
        4: [("user", "x\n\nq"), ("assistant", "a")],
        5: [("user", "u"), ("tool", "")],
        7: [("system", "s"), ("user", "h"), ("assistant", "g"), ("other", "")],
        8: [("user", "ab")],
    }
    assert {r.conv_id for r in chat.unmapped(df, "id", "body").collect()} == {9, 10, 90, 91, 92}
    assert chat.record_turns(df.limit(0), "id", "body").count() == 0
    # a typed table has the fingerprint of its rows
    typed = spark.createDataFrame([(1, [("user", "u")], "s")], "id long, messages array<struct<role string, content string>>, system string")
    assert [tuple(r) for r in chat.table_turns(typed, "id").orderBy("turn").collect()] == [(1, 0, "system", "s"), (1, 1, "user", "u")]
    record = typed.select(F.to_variant_object(F.struct("messages", "system")).alias("v"))
    assert record.select(chat.form(F.col("v"))).first()[0] == chat.form_of(typed.drop("id").schema)
    with pytest.raises(ValueError):
        chat.table_turns(typed)


def test_turn_rows(spark):
    rows = [(1, 2, "assistant", "</s>b"), (1, 0, "system", "s"), (1, 1, "user", "[INST]\\"), (2, None, None, None), (2, 0, "tool[SEP]", "t"), (None, 0, "user", "n"), (1, 2, "assistant", "</s>b"), (3, 5, "user", ""), (1, 2, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = plain([(c, -1 if n is None else n, r or "", t or "") for c, n, r, t in rows])
    assert digests(chat.format_turns(chat.table_turns(df))) == want
    extra = df.withColumns({"part": F.lit(1), "formatted": F.lit("x"), "loss": F.lit(0)})
    assert digests(chat.format_turns(extra)) == want
    assert chat.read_digests(chat.format_turns(df.limit(0))).count() == 0


def test_long_conversations_are_cut(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"{i} </s>" + "x" * 20_000) for i in range(300)] + [(2, 0, "assistant", "y" * 2_500_000)]
    parts = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)).cache()
    sizes = [(r.conv_id, r.n) for r in parts.select("conv_id", F.length("formatted").alias("n")).collect()]
    assert sum(c == 1 for c, _ in sizes) >= 6 and max(n for c, n in sizes if c == 1) < 1_100_000
    assert digests(parts) == plain(rows)
    spans = parts.where("conv_id = 2").first()
    assert [spans.formatted[s.start : s.end] for s in spans.loss] == ["y" * 2_500_000]
