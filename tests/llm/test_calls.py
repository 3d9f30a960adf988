import json

from catalith.llm.calls import Field, argument_errors, canonical, linked_calls, parsed

SCHEMAS = {"add": {"a": Field("number", low=0), "b": Field("integer", required=False)}, "say": {"text": Field("string", high=5)}}
CALLS = "conv_id bigint, call_id string, turn bigint, name string, arguments string, after array<string>, status string"
RESULTS = "conv_id bigint, call_id string, turn bigint, content string, position string"


def _run(spark, calls, results):
    out = linked_calls(
        spark.createDataFrame([(*c, "x") for c in calls], CALLS), spark.createDataFrame([(*r, "x") for r in results], RESULTS), SCHEMAS
    )
    return {(r["conv_id"], r["call_id"]): r for r in out.collect()}


def test_links_order_and_errors(spark):
    calls = [
        (1, "c", 0, "add", '{"b": 1, "a": 2.5}', ["b"]), (1, "b", 0, "add", '{"a": -1}', ["a"]), (1, "a", 0, "add", '{"a": true, "z": 1}', None),
        (1, "d", 4, "say", '{"text": "too long"}', ["c", "gone"]), (1, "e", 2, "nope", "{}", ["d"]), (1, "e", 2, "nope", "{}", ["d"]),
        (2, "x", 0, "say", "not json", ["y"]), (2, "y", 0, "say", '{"text": "\\ud800"}', ["x"]), (2, "z", 0, "say", "[1]", ["y"]),
        (None, "n", 0, "say", "{}", None), (3, None, 0, "say", "{}", None),
    ]
    results = [(1, "a", 1, "A"), (1, "a", 1, "B"), (1, "b", 0, "early"), (1, "q", 5, "lost"), (2, "x", None, None), (None, "n", 1, "m")]
    got = _run(spark, calls, results)
    assert {k: (r["position"], r["status"], r["n_results"]) for k, r in got.items()} == {
        (1, "a"): (0, "linked", 2), (1, "b"): (1, "early", 1), (1, "c"): (2, "open", 0), (1, "e"): (3, "open", 0), (1, "d"): (4, "open", 0),
        (1, "q"): (None, "orphan", 1), (2, "x"): (0, "early", 1), (2, "y"): (1, "open", 0), (2, "z"): (2, "open", 0),
    }
    errors = {k: list(r["errors"]) for k, r in got.items()}
    assert errors[1, "a"] == ["extra z", "type a"] and errors[1, "b"] == ["bound a"] and errors[1, "c"] == []
    assert errors[1, "d"] == ["bound text", "unknown call gone"] and errors[1, "e"] == ["later call d", "repeated call", "unknown tool"]
    assert errors[2, "x"] == ["cycle", "no JSON"] and "cycle" in errors[2, "z"]
    record = json.loads(got[1, "c"]["record"])
    assert record == {"arguments": {"a": 2.5, "b": 1}, "conv_id": 1, "id": "c", "name": "add", "position": 2, "result": None, "status": "open"}
    assert got[1, "c"]["record"] == canonical(record)


def test_empty_tables_and_long_chains(spark):
    assert _run(spark, [], []) == {}
    got = _run(spark, [(1, f"k{i:02}", 0, "say", '{"text": "' + "x" * 200000 + '"}', [f"k{i - 1:02}"] if i else []) for i in range(8)][::-1], [])
    assert [got[1, f"k{i:02}"]["position"] for i in range(8)] == list(range(8))


def test_arguments():
    assert parsed('{"a": NaN}') == ('{"a": NaN}', False) and parsed(None) == (None, False)
    assert parsed("[" * 100000)[1] is False
    assert argument_errors([], SCHEMAS["add"]) == ["no object"] and argument_errors({}, SCHEMAS["add"]) == ["missing a"]
    assert canonical({"b": "é", "a": [1, 2]}) == '{"a":[1,2],"b":"é"}'
