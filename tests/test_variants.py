import json

from quern.operators import variants as V


def rows(spark, *records, fields="id string, messages_json string, tools_json string, extra string"):
    return spark.createDataFrame(list(records), fields)


def links(df):
    return sorted(tuple(r) for r in V.links(df).distinct().collect())


CALLS = [
    {"role": "user", "content": "x"},
    {"role": "assistant", "content": None, "tool_calls": [{"id": "a", "function": {"name": "f", "arguments": "{}"}}, {"id": "a", "function": {"arguments": {}}}, {"function": None}, "odd"]},
    {"role": "tool", "tool_call_id": "a", "content": []},
    {"role": "tool", "content": "no id"},
    {"role": "user", "content": "y"},
    {"role": "tool", "tool_call_id": "a", "content": "too late"},
]
TOOLS = [{"type": "function", "function": {"name": "f", "parameters": {"properties": {"p": {"type": "array", "items": {"properties": {"q": {}}}}, "r": {"properties": {"s": True}}, "t": {"anyOf": [{"properties": {"no": {}}}]}}}}}, {"name": "g", "parameters": json.dumps({"properties": {"u": {}}})}, 7]


def test_links(spark):
    df = rows(spark, ("i", json.dumps(CALLS), json.dumps(TOOLS), "e"))
    want = [("i", "", "answer", 1, "0:2"), ("i", "", "answer", 1, "1:2"), *(("i", "", "call", 1, str(k)) for k in range(3)), *(("i", "", "param", 0, p) for p in ("p", "p.q", "r", "r.s", "t")), ("i", "", "param", 1, "u")]
    assert links(df) == sorted(want)


def test_dirt(spark):
    text = json.dumps(CALLS)
    df = rows(spark, ("null", None, None, None), ("blank", " ", "", None), ("cut", text[:-5], "[{", None), ("object", "{}", "3", None), (None, text, None, None), ("twice", json.dumps(text), json.dumps("x"), None), ("twice", json.dumps(text), None, "other"))
    assert {r[0] for r in links(df)} == {"twice"} and len(links(df)) == 5
    assert links(df.limit(0)) == []


def test_provenance(spark):
    spans = [{"source_indices": [0, 1], "origin": "o"}, {"source_indices": None, "review_decision": {"decision": "context", "rejection_reasons": ["R", None]}}, None]
    df = rows(spark, ("i", "t", json.dumps(spans)), fields="id string, target_harness string, bridge_provenance_json string")
    assert links(df) == [("i", "t", "reason", 1, "R"), ("i", "t", "span", 0, "0"), ("i", "t", "span", 0, "1")]
    assert [r["origin"] for r in V.table(df, "region").orderBy("pos").collect()] == ["o", None]
    assert V.table(df, "decision").first()["parent_pos"] == 1


def test_tables_keep_keys_and_values(spark):
    df = rows(spark, ("i", json.dumps(CALLS), json.dumps(TOOLS), "e"), ("i", json.dumps(CALLS), json.dumps(TOOLS), "e"))
    calls = V.table(df, "call").orderBy("pos").collect()
    assert [(c["parent_pos"], c["pos"], c["arguments_are"]) for c in calls] == [(1, 0, "text"), (1, 1, "object"), (1, 2, "absent")]
    assert len({c["variant"] for c in calls}) == 3
    assert V.table(df, "message").count() == 6 and V.table(df, "param").where("type = 'array'").first()["path"] == "p"


def test_automaton_states():
    a = V.ShapeAutomaton()
    one, two = {"role": "user", "content": "x"}, {"content": "other", "role": "tool"}
    assert a.state(one) == a.state(two) != a.state({"role": "user", "content": None})
    assert a.state([1, 2]) == a.state([3]) != a.state([1, "x"]) and a.name({"arguments": {"any": 1}}) == a.name({"arguments": {}})


def test_deep_nesting():
    deep = value = {}
    for _ in range(200):
        value["properties"] = {"x": {}}
        value = value["properties"]["x"]
    assert len(list(V.tool_nodes([{"name": "f", "parameters": deep}]))) > 60
    assert V.ShapeAutomaton().name(deep)
