"""Tool calls, their results, order, validation and canonical JSON."""

import json

import pytest

from larder.llm import tool_links
from larder.llm.queries import op6_tool_links

M, C, R = ("conv_id long, turn long, role string, text string", "conv_id long, turn long, place long, call_id string, name string, arguments string",
           "conv_id long, turn long, place long, call_id string, content string")
SCHEMAS = {"add": {"type": "object", "required": ["a", "b"], "additionalProperties": False,
                   "properties": {"a": {"type": "number"}, "b": {"type": "number", "maximum": 10}}}}


def linked(spark, messages, calls, results):
    frames = [spark.createDataFrame(rows, schema) for rows, schema in ((messages, M), (calls, C), (results, R))]
    rows = tool_links.link_tool_calls(*frames, SCHEMAS).collect()
    return sorted(rows, key=lambda r: [(x is not None, x or 0) for x in (r.conv_id, r.at, r.depth, r.part, r.turn, r.place)])


def call(conv, turn, ident, place=0, **arguments):
    return conv, turn, place, ident, "add", json.dumps(arguments)


def test_calls_follow_the_results_they_refer_to(spark):
    calls = [call(1, 1, "x", a=1, b={"$ref": "y"}), call(1, 2, "y", a=1.0, b=2), call(1, 2, "z", 1, a={"$ref": "x"}, b=3),
             call(2, 1, "p", a={"$ref": "q"}, b=1), call(2, 1, "q", 1, a={"$ref": "p"}, b=1)]
    results = [(1, 3, 0, "y", "3"), (1, 4, 0, "x", "4"), (1, 5, 0, "z", "7")]
    rows = linked(spark, [(1, 0, "user", "go")], calls, results)
    assert [(r.call_id, r.part) for r in rows if r.conv_id == 1] == [
        (None, 0), ("y", 1), ("y", 2), ("x", 1), ("x", 2), ("z", 1), ("z", 2)]
    assert [r.status for r in rows if r.conv_id == 2] == ["cycle", "cycle"]
    assert rows[1].json == '{"arguments":{"a":1,"b":2},"id":"y","name":"add","role":"assistant","type":"tool_call"}'
    assert json.loads(rows[2].json) == {"content": "3", "role": "tool", "tool_call_id": "y"}


def test_a_long_chain_in_reverse_order_is_unrolled(spark):
    n = 6
    calls = [call(1, k, f"c{k}", a=1, b={"$ref": f"c{k + 1}"}) for k in range(n)] + [call(1, n, f"c{n}", a=1, b=1)]
    rows = linked(spark, [], calls, [])
    assert [r.call_id for r in rows] == [f"c{k}" for k in range(n, -1, -1)] and {r.status for r in rows} == {"no_result"}


def test_statuses_and_errors_of_odd_rows(spark):
    calls = [call(1, 1, "x", a=1), call(1, 5, "x", a=1, b=11, c=0), (1, 1, 0, None, "add", "{"), (None, 1, 0, "n", "add", None),
             (1, 1, 0, "u", "unknown", "[1.0, NaN]"), (1, 2, 0, "w", "unknown", '{"b": 1, "a": [true, null, "é"]}'),
             call(1, 3, "v", a={"$ref": "nobody"}, b=1)]
    results = [(1, 2, 0, "x", None), (1, 3, 0, "x", "again"), (1, 2, 0, "lost", "?"), (1, 2, 0, None, "?"), (1, 1, 0, "v", "early")]
    messages = [(1, 0, None, None), (None, None, "system", "s"), (1, 0, None, None)]
    rows = linked(spark, messages, calls, results)
    assert len(rows) == len(calls) + len(results) + len(messages)
    by = {(r.part, r.call_id, r.turn): r for r in rows}
    assert by[1, "x", 1].status == "linked" and by[1, "x", 1].errors == ["$.b: missing"]
    assert by[1, "x", 5].status == "duplicate" and by[1, "x", 5].errors == ["$.b: above 10", "$.c: not allowed"]
    assert by[2, "x", 2].status == "linked" and by[2, "x", 3].status == "duplicate" and by[2, "lost", 2].status == "orphan"
    assert by[1, None, 1].status == by[2, None, 2].status == by[1, "n", 1].status == "no_id"
    assert by[1, None, 1].errors == ["$: no JSON"] and by[1, "u", 1].errors == ["$: no JSON"]
    assert by[1, "w", 2].errors == ["unknown tool unknown"] and '"arguments":{"a":[true,null,"é"],"b":1}' in by[1, "w", 2].json
    assert by[1, "v", 3].errors == ["unknown call nobody"]
    assert (by[2, "v", 1].at, by[2, "v", 1].depth) == (3, 0)
    assert by[0, None, 0].json == '{"content":"","role":"user"}'


def test_empty_tables(spark):
    assert linked(spark, [], [], []) == []


@pytest.mark.parametrize("value, schema, faults", [
    (1.0, {"type": "integer"}, 0), (1.5, {"type": "integer"}, 1), (True, {"type": "number"}, 1), (None, {"type": ["string", "null"]}, 0),
    ("ab", {"minLength": 3}, 1), ("ab", {"pattern": "^a"}, 0), ([1, "x"], {"items": {"type": "number"}}, 1), ("b", {"enum": ["a"]}, 1),
    ({"x": {"y": -1}}, {"properties": {"x": {"properties": {"y": {"minimum": 0}}}}}, 1), ([1, 2, 3], {"maxItems": 2}, 1)])
def test_schema_errors(value, schema, faults):
    assert len(tool_links.schema_errors(value, schema)) == faults


def test_every_turn_of_the_conversations_is_there(spark):
    folder = "/root/testdata/sf0.001"
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = op6_tool_links(spark, folder).collect()
    assert len(rows) == turns.filter("role IN ('system', 'user', 'assistant')").count()
    linked_calls = {(r.conv_id, r.call_id) for r in rows if r.part == 1 and r.status == "linked"}
    assert linked_calls == {(r.conv_id, r.call_id) for r in rows if r.part == 2 and r.status == "linked"} and linked_calls
    assert all(json.loads(r.json) for r in rows)


def test_turns_of_null_and_other_roles_are_messages(spark, tmp_path):
    turns = [(1, k, role, f"text {k}") for k, role in enumerate(["system", "user", "assistant", None, "tool"])]
    spark.createDataFrame(turns, M).write.parquet(f"{tmp_path}/conversations.parquet")
    rows = op6_tool_links(spark, str(tmp_path)).collect()
    assert sorted(r.turn for r in rows) == [0, 1, 2, 3, 4]
    assert {r.turn: json.loads(r.json)["role"] for r in rows if r.part == 0} == {0: "system", 3: "user", 4: "tool"}


def test_deep_nesting_and_half_surrogates_are_no_json(spark):
    texts = ["[" * 1500 + "]" * 1500, "[" * 100_000, '{"a": "\\ud800"}'.replace("\\\\", "\\"), '{"a": 1}', None, '"' + "long " * 300_000 + '"']
    calls = spark.createDataFrame([(k, 0, k, f"c{k}", "t", t) for k, t in enumerate(texts)],
                                  "conv long, turn long, place long, id string, name string, arguments string")
    out = {r.conv: r for r in tool_links._checked(calls, {"t": {}}).collect()}
    assert [out[k].errors for k in range(6)] == [["$: no JSON"]] * 3 + [[], ["$: no JSON"], []]
    assert out[3].arguments == '{"a":1}' and len(out[5].arguments) == 1_500_002
