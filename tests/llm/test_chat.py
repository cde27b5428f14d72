import json
import random

import pytest

from perigee.llm.chat import ASK, as_tool_calls, link_chats

SCHEMA = "conv bigint, turn bigint, kind string, role string, call_id string, name string, arguments string, after array<string>, content string, `_c` string, place int"
TOOLS = {"add": {"a": ("integer", True), "b": ("number", False), "note": ("string", False), "opts": ("object", False), "xs": ("array", False), "deep": ("boolean", False)}}


def call(turn, ident, arguments='{"a":1}', after=(), name="add", conv=1):
    return (conv, turn, "call", None, ident, name, arguments, list(after), None, "z", 1)


def answer(turn, ident, content="r", conv=1):
    return (conv, turn, "result", None, ident, None, None, None, content, "z", 1)


def linked(spark, rows):
    return link_chats(spark.createDataFrame(rows, SCHEMA), TOOLS).orderBy("conv", "position").collect()


@pytest.mark.parametrize(
    ("arguments", "errors"),
    [
        ('{"b": 1.5, "a": 2, "deep": true, "xs": [1], "opts": {"k": null}, "note": "n"}', []), ('{"a": "2"}', ["a is not of type integer"]), ("{}", ["a is missing"]),
        ('{"a": 1, "zz": 1, "b": "x"}', ["unknown argument zz", "b is not of type number"]), ("[1]", ["arguments are not an object"]), ("{broken", ["arguments are not an object"]), (None, ["arguments are not an object"]),
    ],
)
def test_arguments(spark, arguments, errors):
    row = linked(spark, [call(0, "x", arguments), answer(1, "x")])[0]
    assert sorted(row["errors"]) == sorted(errors) and row["status"] == ("invalid" if errors else "ok")
    if not errors:
        text = json.dumps(json.loads(arguments), sort_keys=True, separators=(",", ":"))
        assert row["json"] == f'{{"arguments":{text},"id":"x","name":"add","type":"call"}}'


def test_order_follows_dependencies(spark):
    rows = [call(0, "late", after=["mid"]), call(1, "mid", after=["base"]), call(5, "base"), answer(2, "base"), answer(9, "late"), answer(6, "mid")]
    rows += [call(7, "p", after=["q"]), call(8, "q", after=["p"]), call(10, "lost", after=["nobody"]), answer(11, "unknown"), call(12, "base")]
    rows += [(1, 3, "message", "user", None, None, None, None, 'say "é"\n', "z", 1)]
    random.Random(1).shuffle(rows)
    out = linked(spark, rows)
    place = {(r["kind"], r["call_id"], r["turn"]): r["position"] for r in out}
    assert place["call", "base", 5] < place["call", "mid", 1] < place["call", "late", 0]
    for ident, asked, told in (("base", 5, 2), ("mid", 1, 6), ("late", 0, 9)):
        assert place["call", ident, asked] < place["result", ident, told]
    status = {(r["kind"], r["call_id"], r["turn"]): r["status"] for r in out}
    assert status["call", "p", 7] == status["call", "q", 8] == status["call", "lost", 10] == "unmet"
    assert status["result", "unknown", 11] == "orphan" and status["call", "base", 12] == "duplicate"
    message = next(r["json"] for r in out if r["kind"] == "message")
    assert message == '{"content":"say \\"é\\"\\n","role":"user","type":"message"}'
    assert [r["position"] for r in out] == list(range(len(rows)))


def test_odd_rows(spark):
    rows = [call(0, None), call(0, "a", conv=None), answer(1, "a", conv=None), answer(1, None, None), call(2, "u", name=None), call(2, "u", name=None), call(3, "never")]
    rows.append((None, None, "message", None, None, None, None, None, None, "z", 1))
    out = linked(spark, rows)
    assert len(out) == len(rows)
    status = sorted((r["kind"], str(r["call_id"]), r["status"]) for r in out)
    assert ("call", "a", "ok") in status and ("call", "never", "unanswered") in status and status.count(("call", "u", "invalid")) == 2
    assert ("result", "None", "orphan") in status and ("call", "None", "unanswered") in status
    assert linked(spark, []) == []


def test_plan_has_no_python(spark, sf):
    events = as_tool_calls(spark.read.parquet(f"{sf}/conversations.parquet"))
    plan = link_chats(events, ASK)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
