import json

from quern.operators import variants as V

MESSAGES = [
    {"role": "assistant", "content": [{"type": "text", "text": "a"}, {"type": "thinking", "thinking": "b"}, "c"], "possible_tool_call_ids": ["p", "q"], "tool_calls": [{"id": "i", "type": "function", "function": {"name": "f", "arguments": {"k": [1]}}}]},
    {"role": "user", "content": "x", "more": {"n": 3, "on": True, "list": [[1.5], {"z": None}]}},
]
TOOLS = [{"name": "f", "parameters": {"properties": {"p": {"type": "array", "description": "d", "items": {"type": "string", "properties": {"q": {"type": "string"}}}}}}}]
SPANS = [{"origin": "o", "source_indices": [0], "review_decision": {"decision": "d", "verified_properties": {"call_0": ["cwd"]}}}]


def sessions(spark):
    return spark.createDataFrame([("i", json.dumps(MESSAGES), json.dumps(TOOLS))], "id string, messages_json string, tools_json string")


def exported(spark):
    return spark.createDataFrame([("i", "t", json.dumps(SPANS))], "id string, target_harness string, bridge_provenance_json string")


def of_kind(tables, kind):
    return [r.asDict() for (k, _), df in V.subtypes(tables).items() if k == kind for r in df.collect()]


def test_every_member_has_a_column_or_row(spark):
    got = V.subtypes(V.routed(sessions(spark)))
    types = [dict(df.dtypes) for (kind, _), df in got.items() if kind == "message"]
    assert {"more.n": "bigint", "more.on": "boolean"}.items() <= max(types, key=len).items()
    rows = [r.asDict() for df in got.values() for r in df.collect()]
    assert [r["thinking"] for r in rows if "thinking" in r] == ["b"] and "c" in [r.get("value") for r in rows]
    assert [(r["type"], r["function.arguments"]) for r in rows if "function.arguments" in r] == [("function", '{"k":[1]}')]
    assert sorted(r["id"] for r in V.table(sessions(spark), "possible_call").collect()) == ["i", "i"]
    assert {(r["owner.path"], r.get("value")) for r in rows if "owner.path" in r} == {("more.list", None), ("more.list[0]", 1.5)}
    assert [(r["description"], r["items.type"]) for r in rows if "items.type" in r] == [("d", "string")]


def test_verified_properties_have_rows(spark):
    tables = V.routed(exported(spark))
    assert [r["name"] for r in V.table(exported(spark), "verification").collect()] == ["call_0"]
    assert [r["value"] for r in of_kind(tables, "item")] == ["cwd"]


def test_links_come_from_routed_rows(spark):
    tables = V.routed(sessions(spark))
    assert tables.where("variant IS NULL OR own IS NULL").count() == 0
    plan = V.links(sessions(spark))._jdf.queryExecution().toString()
    assert "quern-subtypes" in plan and "MapInArrow" not in plan


def test_members_hold_all_columns(spark):
    got = {(r["kind"], r["name"], r["value"]) for r in V.members(sessions(spark)).collect()}
    assert {("block", "thinking", "b"), ("call", "type", "function"), ("possible_call", "value", "q"), ("message", "more.n", "3")} <= got


def test_names_that_differ_in_case_only_stay_apart(spark):
    df = spark.createDataFrame([("i", json.dumps([{"role": "r", "Role": "R", "id": "own", "a.b": 1, "a": {"b": 2**70}}]))], "id string, messages_json string")
    (row,) = of_kind(V.routed(df), "message")
    assert {"r", "R", "own", 1, str(2**70)} <= set(row.values()) and row["id"] == "i"


def test_properties_at_any_depth():
    for depth in (200, 3000):
        deep = value = {}
        for k in range(depth):
            value["properties" if k % 2 else "items"] = {"x": {}} if k % 2 else {"properties": {"x": {}}}
            value = value["properties"]["x"] if k % 2 else value["items"]["properties"]["x"]
        got = [path for kind, _, _, path, *_ in V.tool_nodes([{"name": "f", "parameters": deep}]) if kind == "param"]
        assert len(got) == depth and got[-1] == ".".join("x" * depth)


def test_shapes_of_any_depth_differ():
    def nested(leaf, depth=3000):
        for _ in range(depth):
            leaf = {"m": leaf}
        return leaf

    a = V.ShapeAutomaton()
    assert a.state(nested(1)) != a.state(nested("x")) and a.name(nested(1, 40)) != a.name(nested("x", 40))


def test_items_hold_no_answers(spark):
    messages = [{"role": "assistant", "tool_calls": [{"id": "a"}]}, {"role": "tool", "tool_call_id": "a", "more": [1]}]
    df = spark.createDataFrame([("i", json.dumps(messages))], "id string, messages_json string")
    assert [r["path"] for r in V.table(df, "item").collect()] == ["more"]


def test_all_kinds_come_from_one_pass(spark):
    rows = sessions(spark)
    all_ = V.kinds_of(V.routed(rows))
    assert set(all_) == set(V.COLUMNS)
    for kind in ("message", "call", "param", "block", "item"):
        assert sorted(all_[kind].collect(), key=str) == sorted(V.table(rows, kind).collect(), key=str)
    assert all_["message"].count() == 2
