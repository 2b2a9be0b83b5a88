"""Tool calls: order and status against a plain walk, validation, canonical JSON, and DuckDB."""
from __future__ import annotations

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from dealhouse.llm import tool_calls as tc

CALLS = "conv_id long, call_id string, parent_id string, at long, name string, arguments string"
RESULTS = "conv_id long, call_id string, at long, content string"
SCHEMAS = {"add": {"type": "object", "required": ["x"], "additionalProperties": False,
                   "properties": {"x": {"type": "integer"}, "note": {"type": "string"}}}}


def linked(spark, calls, results):
    out = tc.link_tool_calls(spark.createDataFrame(calls, CALLS).repartition(3), spark.createDataFrame(results, RESULTS), SCHEMAS)
    return out.collect()


def test_chain_cycle_and_strangers(spark):
    calls = [(1, f"c{i}", f"c{i - 1}" if i else None, i, "add", '{"x":%d}' % i) for i in range(37)]
    calls += [(2, "a", "b", 0, "add", '{"x":1}'), (2, "b", "a", 1, "add", '{"x":1}'), (2, "c", "a", 2, "add", '{"x":1}'),
              (2, "self", "self", 3, "add", '{"x":1}'), (3, "x", "c5", 0, "add", '{"x":1}'),   # another conversation's call
              (None, "n", None, 0, "add", '{"x":1}'), (None, "m", "n", 1, "add", '{"x":1}'),
              (4, None, None, 0, "add", '{"x":1}'), (4, None, None, 0, "add", '{"x":1}')]
    calls += calls[:3]                                       # repeated rows
    calls.append((1, "c0", None, 9, "add", "later copy"))    # same id, later: the first stands
    results = [(1, "c0", 5, "r"), (1, "c0", 6, "r2"), (1, "zz", 7, "lost"), (2, "a", 8, None), (5, None, 0, "x"), (None, "n", 3, "y")]
    rows = linked(spark, calls, results)
    got = {(r["conv_id"], r["call_id"]): r for r in rows if r["kind"] == "call"}
    assert all(got[1, f"c{i}"]["depth"] == i for i in range(37))
    assert [got[2, i]["status"] for i in ("a", "b", "c", "self")] == ["cyclic"] * 4 and got[2, "c"]["depth"] is None
    assert got[3, "x"]["depth"] == 0 and got[None, "m"]["depth"] == 1 and got[None, "n"]["status"] == "answered"
    assert got[1, "c0"]["status"] == "answered" and got[1, "c1"]["status"] == "unanswered"
    assert json.loads(got[1, "c0"]["message"])["arguments"] == {"x": 0}
    assert sum(r["status"] == "unidentified" for r in rows) == 2
    out = sorted((r["call_id"] or "", r["status"], r["depth"]) for r in rows if r["kind"] == "result" and r["conv_id"] != 2)
    assert out == [("", "orphan", None), ("c0", "linked", 0), ("c0", "linked", 0), ("n", "linked", 0), ("zz", "orphan", None)]
    assert len(rows) == 37 + 4 + 1 + 2 + 2 + 6


def test_arguments(spark):
    bad = [None, "", "{", '{"x":NaN}', "[" * 5000, '{"x":"1"}', '{"y":1}', "[1]", '{"x":1.5}', '{"x":true}', '{"x":' + "9" * 5000 + "}"]
    good = ['{"x":1}', ' {"note":"\\ud800 é", "x":2.0}']
    calls = [(1, f"c{i}", None, i, "add", a) for i, a in enumerate(bad + good)] + [(1, "u", None, 0, "other", '{"x":1}'),
                                                                                  (1, "v", None, 0, None, '{"x":1}')]
    got = {r["call_id"]: r for r in linked(spark, calls, [])}
    assert [got[f"c{i}"]["valid"] for i in range(len(bad + good))] == [False] * len(bad) + [True] * len(good)
    assert not got["u"]["valid"] and not got["v"]["valid"]
    assert got["c12"]["message"] == ('{"arguments":{"note":"\\ud800 é","x":2},"call_id":"c12","name":"add","role":"assistant"}')
    assert got["c6"]["errors"] == "$.x: missing; $.y: not expected"
    assert got["c5"]["errors"] == "$.x: not of type integer"


def test_canonical_json():
    assert tc.canonical_json({"b": 1.0, "a": [True, None, 1e300, 0.5], "é": {"z": "\n\"", "a": {}}}) == (
        '{"a":[true,null,1e+300,0.5],"b":1,"é":{"a":{},"z":"\\n\\""}}')
    text = tc.canonical_json({"\U0001f600": 1, "￮": 2})
    assert text.index("\U0001f600") < text.index("￮")  # UTF-16 order


@pytest.mark.parametrize("value,schema,n", [
    (5, {"type": "integer", "minimum": 6}, 1), (5, {"maximum": 5}, 0), ("ab", {"minLength": 3}, 1),
    ("ab", {"maxLength": 1}, 1), (None, {"type": ["null", "string"]}, 0), ([1, "a"], {"items": {"type": "integer"}}, 1),
    ("x", {"enum": ["y"]}, 1), (3.0, {"type": "integer"}, 0), (True, {"type": "number"}, 1), ({"a": {"b": 1}}, {
        "properties": {"a": {"properties": {"b": {"type": "string"}}}}}, 1)])
def test_violations(value, schema, n):
    assert len(tc.violations(value, schema)) == n


def conversations(spark):
    rows = [(c, t, ["user", "assistant"][t % 2], f"text {'word ' * ((c * 7 + t * 40) % 170)}\n\"{c}\"") for c in range(12)
            for t in range(c % 9)]
    rows += [(50, 0, "system", "s"), (50, 1, "user", "u"), (50, 2, "assistant", "a b"), (50, 3, "user", "")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def test_conversations_equal_sql(spark):
    df = conversations(spark)
    got = tc.link_tool_calls(*tc.calls_and_results(df), tc.SCHEMAS)
    with duckdb.connect() as con:
        con.register("conversations", df.toPandas())
        want = con.execute(tc.oracle_sql()).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())


def test_null_turns_empty_table_and_clashing_columns(spark):
    odd = spark.createDataFrame([(None, 1, "assistant", "a"), (1, None, "assistant", None), (1, 2, None, "x"), (2, 1, "user", None)],
                                "conv_id long, turn long, role string, text string")
    odd = odd.withColumn("call_id", F.lit("clash")).withColumn("words", F.lit("clash"))
    rows = tc.link_tool_calls(*tc.calls_and_results(odd), tc.SCHEMAS).collect()
    assert sorted((r["kind"], r["status"]) for r in rows) == [("call", "unidentified")] * 2 + [("result", "orphan")]
    empty = odd.limit(0)
    assert tc.link_tool_calls(*tc.calls_and_results(empty), tc.SCHEMAS).count() == 0
