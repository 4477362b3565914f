"""Layout fingerprints, the reversible template and its loss mask."""

from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from churnlens.llm import chat


def read_turns(df, id_col="conv_id"):
    back = chat.read_back(chat.format_conversations(df, id_col), id_col).collect()
    return {r[id_col]: ([(t["role"], t["text"]) for t in r["turns"]], r["loss_texts"]) for r in back}


NASTY = ["<|im_end|>", "\\<|im_start|>", "<\\|im_sep|>", "a<", "<<SYS>>x<</SYS>>", "</s>[INST] ok [/INST]", "\\", "", "é😀"]


def test_round_trip_of_control_strings(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(NASTY)]
    turns = chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found, loss = read_turns(turns)[1]
    assert found == [(r[2], r[3]) for r in rows]
    assert loss == [t for k, t in enumerate(NASTY) if k % 2 and t]
    formatted = chat.format_conversations(turns).first()["formatted"]
    assert formatted.count(chat.START) == formatted.count(chat.END) == len(NASTY)
    assert "[INST]" not in formatted and "</s>" not in formatted


def test_mask_marks_assistant_text_only(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo[INST]"), (1, 2, "assistant", "é")]
    df = chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    row = chat.format_conversations(df).first()
    under = [row["formatted"][m["start"] : m["start"] + m["length"]] for m in row["loss_mask"] if m["length"]]
    assert under == ["yo[\\INST]", "é"]


def test_layouts_give_the_same_turns(spark):
    want = [("user", "q"), ("assistant", "a")]
    tables = [
        spark.sql("select 1L conv_id, array(struct('user' role, 'q' content), struct('assistant' role, 'a' content)) messages, 5 score"),
        spark.sql("select 1L conv_id, array(named_struct('from','human','value','q'), named_struct('from','gpt','value','a')) conversations"),
        spark.sql("select 1L conv_id, 'q' instruction, '' input, 'a' output, 9 turn_count"),
        spark.sql("select 1L conv_id, 'q' prompt, 'a' response"),
        spark.sql("select 1L conv_id, 'q' prompt, 'a' completion"),
    ]
    for table in tables:
        assert read_turns(chat.canonical_turns(table))[1][0] == want
    with pytest.raises(ValueError, match="no layout"):
        chat.canonical_turns(spark.sql("select 1L conv_id, 'x' body"))


def test_json_records_of_mixed_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}], "extra": {"a": 1}},
        {"instruction": "i", "input": "more", "output": "o"},
        {"prompt": "p", "response": "r"},
        {"body": "unknown"},
    ]
    rows = [(k, json.dumps(r)) for k, r in enumerate(records)] + [(4, "not json"), (5, None)]
    df = chat.canonical_turns_json(spark.createDataFrame(rows, "id long, record string"), "id", "record")
    found = {}
    for r in df.orderBy("id", "turn").collect():
        found.setdefault(r["id"], []).append((r["layout"], r["role"], r["text"]))
    assert found[0] == [("messages", "user", "q"), ("messages", "assistant", "")]
    assert [x[1:] for x in found[1]] == [("user", "i"), ("user", "more"), ("assistant", "o")]
    assert found[2] == [("prompt", "user", "p"), ("prompt", "assistant", "r")]
    assert all(found[k] == [(None, None, None)] for k in (3, 4, 5))
    assert df.filter("id in (1, 2)").select("fingerprint").distinct().count() == 2


def test_known_names_beside_a_layout(spark):
    for extra in ("prompt", "system", "input", "output", "instruction"):
        rows = spark.sql(f"select 1L conv_id, 0L turn, 'user' role, 'q' text, 'x' {extra}")
        assert [tuple(r) for r in chat.canonical_turns(rows).collect()] == [(1, 0, "user", "q")]
    messages = "array(struct('user' role, 'q' content)) messages"
    for extra in ("'x' prompt", "'x' prompt, 'y' response", "'x' input, 'y' output"):
        assert read_turns(chat.canonical_turns(spark.sql(f"select 1L conv_id, {extra}, {messages}")))[1][0] == [("user", "q")]
    found = chat.canonical_turns(spark.sql(f"select 1L conv_id, 's' system, {messages}"))
    assert [tuple(r) for r in found.orderBy("turn").collect()] == [(1, 0, "system", "s"), (1, 1, "user", "q")]
    assert read_turns(chat.canonical_turns(spark.sql(f"select 1L conv_id, '' system, {messages}")))[1][0] == [("user", "q")]
    both = spark.sql("select 1L conv_id, 'q' prompt, 'a' response, 'x' instruction, 'y' role")
    assert read_turns(chat.canonical_turns(both))[1][0] == [("user", "q"), ("assistant", "a")]


def test_known_names_beside_json_layouts(spark):
    q, a = {"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}
    turns = [("user", "q"), ("assistant", "a")]
    cases = [
        ({"system": "s", "conversations": [{"from": "human", "value": "q"}]}, "from_value", [("system", "s"), ("user", "q")]),
        ({"prompt": "q", "messages": [q, a]}, "messages", turns),
        ({"prompt": "x", "response": "y", "messages": [q, a]}, "messages", turns),
        ({"system": "s", "messages": [q, a], "output": 1}, "messages", [("system", "s"), *turns]),
        ({"messages": [{"role": "system"}, q, a]}, "messages", [("system", ""), *turns]),
        ({"messages": [{"content": "c"}, None, q]}, "messages", [("", "c"), ("", ""), ("user", "q")]),
        ({"prompt": "q", "response": "a", "messages": [], "turn": 1}, "prompt", turns),
        ({"instruction": "q", "output": "a", "prompt": "x", "text": "y"}, "instruction", turns),
        ({"turn": 1, "role": "user", "text": "q", "messages": [q, a]}, "messages", turns),
        ({"messages": ["q"], "system": "s"}, None, []),
    ]
    rows = [(k, json.dumps(c[0])) for k, c in enumerate(cases)]
    found = chat.canonical_turns_json(spark.createDataFrame(rows, "id long, record string"), "id", "record").collect()
    for k, (_, layout, want) in enumerate(cases):
        got = sorted((r for r in found if r["id"] == k), key=lambda r: r["turn"] or 0)
        assert {r["layout"] for r in got} == {layout}
        assert [(r["role"] or "", r["text"] or "") for r in got if r["turn"] is not None] == want


def test_hostile_turns(spark):
    schema = "conv_id long, turn long, role string, text string, formatted int, mask int"
    rows = [(1, 0, "user", None, 1, 1), (1, 0, "user", None, 1, 1), (1, None, None, "x", 1, 1), (None, 0, "assistant", "z" * 200_000, 1, 1)]
    found = read_turns(chat.canonical_turns(spark.createDataFrame(rows, schema)))
    assert found[1][0] == [("", "x"), ("user", ""), ("user", "")]
    assert found[None][1] == ["z" * 200_000]
    empty = chat.canonical_turns(spark.createDataFrame([], schema))
    assert chat.read_back(chat.format_conversations(empty)).count() == 0


def test_main_path_is_native(spark):
    turns = chat.union_turns(spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string").filter(F.lit(True)))
    plan = chat.read_back(chat.format_conversations(turns))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_the_fingerprint_selects_the_mapping(spark, monkeypatch):
    schema = spark.createDataFrame([], "conv_id long, messages array<struct<role:string, content:string, more:int>>, x int").schema
    print_ = chat.fingerprint_of(schema)
    assert print_ == hashlib.sha256(b"messages[].content\nmessages[].role").hexdigest()
    assert chat.layout_of(schema).name == "messages"
    other = next(x for x in chat.LAYOUTS if x.name == "from_value")
    monkeypatch.setitem(chat.MAPPINGS, print_, other)
    assert chat.layout_of(schema).name == "from_value"
    monkeypatch.delitem(chat.MAPPINGS, print_)
    with pytest.raises(ValueError, match="messages"):
        chat.layout_of(schema)


def test_every_shape_has_one_mapping():
    assert len(chat.MAPPINGS) == len(chat.VARIANTS)
    assert all(print_ in layout.fingerprints() for print_, layout in chat.MAPPINGS.items())


def test_turns_carry_their_fingerprint(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    print_ = chat.fingerprint_of(rows.schema)
    back = chat.read_back(chat.format_conversations(chat.union_turns(rows))).first()
    assert back["fingerprint"] == print_ and [tuple(t) for t in back["turns"]] == [("user", "a"), ("assistant", "b")]
    plain = chat.format_conversations(chat.canonical_turns(rows)).first()
    assert plain["fingerprint"] is None and plain["formatted"] == back["formatted"]
