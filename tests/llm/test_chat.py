"""Chat formatting: exact round trips, loss mask, and layouts by fingerprint."""

import json
import random

import pytest

from seqtally.llm.chat import format_turns, json_to_turns, read_formatted, to_turns

TURNS = "conv_id long, turn long, role string, text string"


def test_round_trip_of_control_strings(spark):
    rnd = random.Random(4)
    bits = ["<|im_start|>", "<|im_end|>", "\\", "<", "|", "\n", "n", "\\n", "<\\|", "é", "assistant", "ok", " "]
    say = lambda: "".join(rnd.choice(bits) for _ in range(rnd.randrange(12)))
    rows = [(c, t, rnd.choice(["user", "assistant", "system", say()]), say()) for c in range(60) for t in range(rnd.randrange(1, 7))]
    rows += [(100, 0, None, None), (101, None, "assistant", "b"), (101, 0, "assistant", "c"), (101, 0, "assistant", "a"),
             (None, 0, "user", "x"), (102, 0, "assistant", "y" * 200_000)]
    rnd.shuffle(rows)
    got = read_formatted(format_turns(spark.createDataFrame(rows, TURNS).repartition(4))).collect()
    want = {}
    for c, t, r, x in sorted(rows, key=lambda r: (str(r[0]), (r[1] is not None, r[1] or 0), r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert {g.conv_id: [tuple(t) for t in g.turns] for g in got if g.conv_id != 100} == {c: v for c, v in want.items() if c != 100}
    for g in got:
        assert g.loss_texts == [x for r, x in (tuple(t) for t in g.turns) if r == "assistant"]
        assert g.formatted.count("<|im_end|>") == len(g.turns)


def test_null_role_and_text_are_empty(spark):
    rows = to_turns(spark.createDataFrame([(1, 0, None, None)], TURNS))
    assert [tuple(t) for t in read_formatted(format_turns(rows)).first().turns] == [("", "")]


def test_layouts(spark):
    records = [
        ("messages", {"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant", "extra": 1}]}),
        ("conversations", {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": 7}),
        ("prompt and response", {"prompt": "q", "response": "a", "meta": {"messages": 1}}),
        ("instruction, input and output", {"instruction": "q", "input": None, "output": "a"}),
        ("question and answer", {"answer": "a", "question": "q"}),
    ]
    data = [(i, json.dumps(r)) for i, (_, r) in enumerate(records)] + [(90, '{"other": 1}'), (91, None), (92, "no json")]
    rows = json_to_turns(spark.createDataFrame(data, "conv_id long, record string")).collect()
    for i, (name, _) in enumerate(records):
        own = sorted((r.turn, r.role, r.text, r.mapping) for r in rows if r.conv_id == i)
        assert own == [(0, "user", "q", name), (1, "assistant", "a", name)]
    assert all((r.mapping, r.turn, r.role, r.text) == (None,) * 4 for r in rows if r.conv_id >= 90)
    assert sum(r.conv_id >= 90 for r in rows) == 3


def test_typed_layouts(spark):
    df = spark.createDataFrame([(1, "s", "q", None)], "conv_id long, system string, prompt string, response string")
    assert [(r.turn, r.role, r.text) for r in to_turns(df).collect()] == [(0, "system", "s"), (1, "user", "q")]
    df = spark.createDataFrame([(1, [("human", "q"), ("gpt", None)])], "conv_id long, conversations array<struct<from:string,value:string>>")
    assert [(r.turn, r.role, r.text) for r in to_turns(df).collect()] == [(0, "user", "q"), (1, "assistant", "")]
    with pytest.raises(ValueError):
        to_turns(spark.createDataFrame([(1, "x")], "conv_id long, body string"))


def test_empty_table(spark):
    assert format_turns(spark.createDataFrame([], TURNS)).count() == 0


def test_extra_columns_known_to_other_layouts(spark):
    """Each name of the layouts as one more column, of several types, and all of
    them at once: the same turns."""
    from pyspark.sql import functions as F

    from seqtally.llm.chat import _TOP
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", None), (None, None, None, "x"), (1, 0, "user", "q")]
    base = spark.createDataFrame(rows, TURNS)
    turns = lambda df: sorted(map(str, (tuple(r) for r in to_turns(df).collect())))
    want = sorted(str((c, t, r or "", x or "")) for c, t, r, x in rows)
    assert turns(base) == want
    free = [n for n in _TOP if n not in ("turn", "role", "text")]
    every = base
    for i, name in enumerate(free):
        value = [F.lit("v"), F.lit(7), F.lit(None).cast("string"), F.array(F.struct(F.lit("user").alias("role"), F.lit("z").alias("content"))),
                 F.array(F.lit("s"))][i % 5]
        assert turns(base.withColumn(name, value)) == want, name
        every = every.withColumn(name, F.lit("v"))
    assert turns(every) == want


def test_more_fields_than_a_layout_needs(spark):
    """Layouts with a field of another one, and lists whose elements differ."""
    say = [{"role": "user", "content": "q", "text": "other"}, {"role": "assistant", "content": "a", "text": None}]
    records = [
        ("system and messages", {"system": "s", "messages": say}, [("system", "s"), ("user", "q"), ("assistant", "a")]),
        ("system and messages", {"messages": say, "system": None}, [("user", "q"), ("assistant", "a")]),
        ("messages", {"messages": say}, [("user", "q"), ("assistant", "a")]),
        ("prompt and response", {"prompt": "q", "response": "a", "text": "t"}, [("user", "q"), ("assistant", "a")]),
        ("prompt and completion", {"prompt": "q", "completion": "a", "input": "i", "role": "r"}, [("user", "q"), ("assistant", "a")]),
        ("messages with text", {"messages": [{"role": "user", "text": "q", "content": "c"}, {"role": "gpt", "text": "a"}]},
         [("user", "q"), ("assistant", "a")]),
        ("system and conversations", {"system": "s", "conversations": [{"from": "human", "value": "q"}]}, [("system", "s"), ("user", "q")]),
        ("prompt and response", {"messages": [], "prompt": "q", "response": "a"}, [("user", "q"), ("assistant", "a")]),
        ("turn rows", {"turn": 3, "role": "human", "text": "q", "prompt": "p", "response": "r"}, [("human", "q")]),
        (None, {"messages": []}, [(None, None)]),
        (None, {"messages": [{"role": "user", "content": "q"}, {"from": "gpt", "value": "a"}]}, [(None, None)]),
        (None, {"messages": [{"role": "user", "content": "q"}, "a"]}, [(None, None)]),
        (None, {"messages": "text"}, [(None, None)]),
        (None, {"prompt": "q"}, [(None, None)]),
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, (_, r, _) in enumerate(records)], "conv_id long, record string")
    rows = json_to_turns(df).collect()
    for i, (name, _, want) in enumerate(records):
        own = sorted((r.turn or 0, r.role, r.text, r.mapping) for r in rows if r.conv_id == i)
        assert [(r, t) for _, r, t, _ in own] == want and {m for *_, m in own} == {name}, records[i]


def test_query_passes_by_fingerprints_without_python(spark):
    import re

    from seqtally.llm.chat import chat_digests
    df = chat_digests(format_turns(to_turns(spark.createDataFrame([(1, 0, "user", "q")], TURNS))))
    plan = df._jdf.queryExecution().toString()
    assert "json_object_keys" in plan or "jsonObjectKeys" in plan
    assert not re.search("ArrowEval|BatchEvalPython|MapInArrow|MapInPandas|FlatMapGroups", plan)
