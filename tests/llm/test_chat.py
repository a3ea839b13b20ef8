import json

from quarry.llm.chat import format_chat

TOOLS = {
    "find": {"properties": {"q": {"type": "string"}, "n": {"type": "integer"}, "mode": {"enum": ["a", "b"]}}, "required": ["q"], "additionalProperties": False},
    "add": {"properties": {"x": {"type": "number"}, "y": {"type": "number"}}, "required": ["x", "y"]},
}


def canon(x):
    return json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def call(i, name, args, after=()):
    return {"id": i, "name": name, "arguments": args, "after": list(after)}


TURNS = [
    (1, 0, "user", "hello \"there\"\nyou é"),
    (1, 1, "assistant", json.dumps({"content": "on it", "tool_calls": [call("c2", "add", {"y": 2.5, "x": 1}, ["c1"]), call("c1", "find", {"q": "z", "n": 3, "mode": "b"}), call("c1", "find", {"q": "again"})]})),
    (1, 2, "tool", json.dumps({"tool_call_id": "c1", "content": {"b": [2, {"d": 1, "c": 0}], "a": 1}})),
    (1, 3, "tool", json.dumps({"tool_call_id": "c2", "content": "plain"})),
    (1, 4, "tool", json.dumps({"tool_call_id": "c2", "content": "twice"})),
    (1, 5, "tool", json.dumps({"tool_call_id": "zz", "content": "lost"})),
    (2, 0, "assistant", "Look: <tool_call>{\"id\":\"t\",\"name\":\"find\",\"arguments\":{\"n\":\"3\",\"mode\":\"c\",\"k\":1}}</tool_call>"),
    (3, 0, "assistant", json.dumps({"tool_calls": [call("p", "find", {"q": "1"}, ["r"]), call("r", "nope", {}, ["p"]), call("s", "add", [1])]})),
    (3, 1, "tool", json.dumps({"tool_call_id": "s", "content": None})),
    (4, None, None, None),
    (None, 0, "user", "{not json}"),
    (4, 2, "user", ""),
]


def test_links_order_validation_and_json(spark):
    df = spark.createDataFrame([(*t, "x", 1) for t in TURNS], "conv_id long, turn long, role string, text string, id string, item int")
    rows = format_chat(df, TOOLS).collect()
    by = {(r.conv_id, r.turn, r.kind, r.call_id, r.order_item): r for r in rows}
    assert len(rows) == len(TURNS) + 3 + 1 + 2  # calls beside a message, a tag beside one, three calls alone
    one = sorted((r for r in rows if r.conv_id == 1), key=lambda r: (r.order_turn, r.order_level, r.order_part, r.order_item, r.turn))
    assert [(r.kind, r.call_id) for r in one] == [("message", None), ("message", None), ("call", "c1"), ("call", "c1"), ("result", "c1"), ("call", "c2"), ("result", "c2"), ("result", "c2"), ("result", "zz")]
    assert [r.problem for r in one] == [None, None, None, "duplicate id", None, None, None, "duplicate result", "no call"]
    for r in rows:
        assert canon(json.loads(r.json)) == r.json, r
    assert json.loads(one[5].json)["arguments"] == {"x": 1, "y": 2.5}
    assert one[4].json == '{"content":{"a":1,"b":[2,{"c":0,"d":1}]},"role":"tool","tool_call_id":"c1","turn":2}'
    t = by[2, 0, "call", "t", 0]
    assert t.problem == "no result; missing q; mode is not allowed; n is not integer; unexpected k"
    assert json.loads(by[2, 0, "message", None, 0].json)["content"] == "Look:"
    assert by[3, 0, "call", "p", 0].problem == "cycle; no result" and by[3, 0, "call", "r", 1].problem == "cycle; no result; unknown tool"
    assert by[3, 0, "call", "s", 2].problem == "arguments are not an object"
    assert json.loads(by[4, None, "message", None, 0].json) == {"content": None, "role": None, "turn": None}


def test_long_chain(spark):
    calls = [call(f"k{i}", "add", {"x": i, "y": 0}, [f"k{i - 1}"] if i else []) for i in range(6)]
    df = spark.createDataFrame([(9, 0, "assistant", json.dumps({"tool_calls": calls[::-1]}))], "conv_id long, turn long, role string, text string")
    got = {r.call_id: r.order_level for r in format_chat(df, TOOLS).collect()}
    assert got == {f"k{i}": i for i in range(6)}


def test_chains_cycles_and_joins_of_chains(spark):
    n = 300
    calls = [call(f"k{i}", "add", {"x": 1, "y": 1}, [f"k{i - 1}"] if i else ["unknown"]) for i in range(n)]
    calls += [call("m", "add", {"x": 1, "y": 1}, ["k100", "k20"]), call("n1", "add", {"x": 1, "y": 1}, ["m"]), call("n2", "add", {"x": 1, "y": 1}, ["n1", "k299"])]
    calls += [call("q", "add", {"x": 1, "y": 1}, ["r"]), call("r", "add", {"x": 1, "y": 1}, ["s"]), call("s", "add", {"x": 1, "y": 1}, ["q"]), call("t", "add", {"x": 1, "y": 1}, ["s"]), call("u", "add", {"x": 1, "y": 1}, ["t", "k0"])]
    df = spark.createDataFrame([(9, 0, "assistant", json.dumps({"tool_calls": calls}))], "conv_id long, turn long, role string, text string")
    rows = {r.call_id: r for r in format_chat(df, TOOLS).collect()}
    assert all(rows[f"k{i}"].order_level == i for i in range(n))
    assert (rows["m"].order_level, rows["n1"].order_level, rows["n2"].order_level) == (101, 102, 300)
    assert all(rows[i].problem == "cycle; no result" for i in "qrstu") and rows["m"].problem == "no result"


def test_nested_schemas(spark):
    tool = {"t": {"properties": {"o": {"type": "object", "properties": {"n": {"type": "integer", "minimum": 2, "maximum": 5}}, "required": ["n"], "additionalProperties": False}, "l": {"type": "array", "items": {"type": "string", "pattern": "^a"}}}}}
    args = [{"o": {"n": 3}, "l": ["a", "ab"]}, {"o": {"n": 9, "z": 1}}, {"o": {}, "l": ["a", 4, "b"]}, {"o": 7, "l": "x"}]
    df = spark.createDataFrame([(1, i, "assistant", json.dumps({"tool_calls": [call(f"c{i}", "t", a)]})) for i, a in enumerate(args)], "conv_id long, turn long, role string, text string")
    got = {r.turn: r.problem for r in format_chat(df, tool).collect()}
    assert got[0] == "no result"
    assert got[1] == "no result; o.n is above 5; unexpected o.z"
    assert got[2] == "no result; an item of l does not match; an item of l is not string; missing o.n"
    assert got[3] == "no result; l is not array; o is not object"


def test_no_ids(spark):
    rows = [(1, 0, "assistant", json.dumps({"tool_calls": [call(None, "add", {"x": 1, "y": 2})] * 3})), (None, 0, "assistant", json.dumps({"tool_calls": [call("a", "add", {"x": 1, "y": 2})]})), (1, 1, "tool", json.dumps({"tool_call_id": "a", "content": "x"}))]
    got = format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), TOOLS).collect()
    assert sorted((r.kind, r.problem) for r in got) == sorted([("call", "no id; no result")] * 3 + [("call", "no result"), ("result", "no call")])


def test_empty_and_plain(spark, sf):
    e = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert format_chat(e, {}).count() == 0
    long = spark.createDataFrame([(1, i, "user", "w " * 50_000) for i in range(3)] * 2, e.schema)
    assert format_chat(long, {}).count() == 6
