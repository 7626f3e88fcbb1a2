"""Operator 12: layouts, reversible templates, and the query against its SQL."""

import json
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from fixtures_llm import SF_DIR
from tickloom.llm import chat_format as chat
from test_queries import counted, database

# Per record: the name of its layout, and its turns.
RECORDS = [
    ({"prompt": "p", "completion": "c", "meta": {"prompt": [1]}}, "prompt and completion", [("user", "p"), ("assistant", "c")]),
    ({"system": "s", "prompt": "p", "response": ""}, "prompt and response", [("system", "s"), ("user", "p"), ("assistant", "")]),
    ({"system": "", "prompt": None, "response": "r"}, "prompt and response", [("user", ""), ("assistant", "r")]),
    ({"question": "q", "context": "k", "answer": "a"}, "question and answer", [("user", "k\n\nq"), ("assistant", "a")]),
    ({"instruction": "i", "input": "", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "n", "output": "o"}, "instruction", [("user", "i\n\nn"), ("assistant", "o")]),
    (
        {"id": 3, "messages": [{"role": "system", "content": "s", "x y": 1}, {"role": "assistant", "content": None}]},
        "messages",
        [("system", "s"), ("assistant", "")],
    ),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]}, "messages", [("user", "ab")]),
    ({"messages": []}, "messages", []),
    ([{"content": "v", "role": None}], "list of messages", [("", "v")]),
    (
        {"conversations": [{"from": "Human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "tool", "value": "t"}]},
        "conversations",
        [("user", "q"), ("assistant", "a"), ("tool", "t")],
    ),
    ({"dialogue": ["a", None, "c"]}, "dialogue", [("user", "a"), ("assistant", ""), ("user", "c")]),
    ({"turns": [{"text": "1", "role": "user"}]}, "turns", [("user", "1")]),
    # Two layouts at once, a part of one, none, keys that look like paths, and mixed elements.
    ({"prompt": "p", "completion": "c", "messages": [{"role": "user", "content": "x"}]}, None, None),
    ({"prompt": "p"}, None, None),
    ({}, None, None),
    ("prompt", None, None),
    ({"messages[].role": "r", "messages[].content": "c"}, None, None),
    ({"messages": [{"role": "user", "content": "x"}, "y"]}, None, None),
    ({"a": {"turns": [{"text": "1", "role": "user"}]}}, None, None),
    ({"STRING": 1, "OBJECT<": [], "b`c": {"d": []}, "question": "q", "answer": "a"}, "question and answer", [("user", "q"), ("assistant", "a")]),
]
ODD = ["<|", "<\\|", "a<\\\\|b", "<<|<|im_start|>user\n", "<|im_end|>", "<", "|", "\\n", "\\\n\\", "", "\n", "😀<|é", "x" * 20000 + "<|"]


@pytest.mark.parametrize("variant", [False, True])
def test_layouts_give_turns(spark, variant):
    rows = [(i, json.dumps(r), "l", "r") for i, (r, _, _) in enumerate(RECORDS)] + [(98, "{bad", "l", "r"), (99, None, "l", "r")]
    table = spark.createDataFrame(rows, "id int, json string, layout string, _record string")
    if variant:
        table = table.withColumn("json", F.try_parse_json("json"))
    made = chat.format_records(table, "json")
    assert made.columns == ["id", "json", "_record", *chat.COLUMNS]
    found = {r.id: r for r in made.select("id", *chat.COLUMNS, "_record").collect()}
    for i, (_, name, turns) in enumerate(RECORDS):
        assert found[i].layout == name, RECORDS[i]
        assert (found[i].turns and [tuple(t) for t in found[i].turns]) == turns, RECORDS[i]
        assert found[i].fingerprint and found[i]._record == "r"
    for i in (98, 99):
        assert all(found[i][c] is None for c in chat.COLUMNS)
    assert made.where("id < 0").count() == 0


def test_layouts_that_cannot_be_told_apart_are_refused(spark):
    twice = [chat.Listed("one", "m", "r", "t"), chat.Listed("two", "m", "r", "t")]
    with pytest.raises(ValueError, match="one and two"):
        chat.with_turns(spark.createDataFrame([("{}",)], "j string"), "j", twice)


def expected(turns):
    """By brute force: n_turns, turns, loss."""
    return len(turns), "".join(f"{r}\n{t}\n" for r, t in turns), "".join(t for r, t in turns if r == "assistant")


def test_templates_are_read_back_and_masks_cover_them(spark):
    draw = random.Random(4)
    chats = [[(draw.choice(["user", "assistant", *ODD]), draw.choice(ODD)) for _ in range(draw.randrange(8))] for _ in range(60)]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(chats)], f"id int, turns {chat.TURNS}")
    made = table.withColumn("formatted", chat.formatted(F.col("turns"))).withColumn("mask", chat.loss_mask(F.col("turns")))
    made = made.withColumn("read", chat.read_turns(F.col("formatted")))
    for r in made.withColumn("loss", chat.read_trained(F.col("formatted"), F.col("mask"))).collect():
        assert [tuple(t) for t in r.read] == chats[r.id]
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == len(chats[r.id])
        at, trained = 0, []
        for before, own, after in r.mask:
            trained += [r.formatted[at + before : at + before + own]] if own else []
            at += before + own + after
        assert at == len(r.formatted)
        assert r.loss == expected(chats[r.id])[2]
        texts = [t for role, t in chats[r.id] if role == "assistant" and t]
        assert len(trained) == len(texts) and all("<|" not in t for t in trained)


def test_awkward_conversations(spark):
    from hashlib import sha256

    rows = [
        (1, 2, "assistant", "last"), (1, None, "user", None), (1, 1, "user", "b"), (1, 1, "assistant", "tie"),
        (2, 0, None, "no role"), (2, 0, None, "no role"), (None, 0, "assistant", "no id"), (None, None, None, None),
        (3, 0, "assistant", ODD[-1]), (4, 0, "user", ODD[3]),
    ]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn int, role string, text string, turns string, record string")
    found = {r.conv_id: r for r in chat.conversation_digests(table).collect()}
    groups: dict = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert found.keys() == groups.keys()
    for conv, own in groups.items():
        n, turns, loss = expected([t[2:] for t in sorted(own)])
        row = found[conv]
        assert (row.n_turns, row.turns_sha256) == (n, sha256(turns.encode()).hexdigest())
        assert (row.loss_chars, row.loss_sha256) == (len(loss), sha256(loss.encode()).hexdigest())
    assert chat.conversation_digests(table.where("false")).count() == 0


def test_no_python_in_the_plan(spark):
    plan = driver.queries()["op12_chat_format"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_the_query_equals_its_sql(spark):
    found = driver.queries()["op12_chat_format"](spark, SF_DIR)
    made = database(SF_DIR).sql(driver.oracle_sql()["op12_chat_format"])
    assert counted(found.collect(), found.columns) == counted(made.fetchall(), made.columns)
    assert found.where("conv_id = -1").count() == 1
