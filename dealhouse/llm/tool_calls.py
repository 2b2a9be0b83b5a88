"""Tool calls and their results: linked, ordered, validated, and written as canonical JSON.

Calls and results are joined by identifier. A call may name the call whose result it builds
on; its depth in that forest, found by pointer doubling (a join per doubling, so chains of n
calls take log n rounds), gives the topological order: a call comes after its parent, a
result after its call. Rows stay one per message, so a conversation of any length is never
gathered in one place; ``(depth, kind, at, call_id)`` is the order within it.
"""
from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealhouse.llm.common import map_rows, materialize

# --- JSON -------------------------------------------------------------------------------


class _NotJson(ValueError):
    pass


def _refuse(name: str) -> float:
    raise _NotJson(name)


def parse_json(text: str | None) -> object:
    """The value of ``text``; a ValueError for anything that is not strict JSON."""
    if text is None:
        raise _NotJson("null")
    try:
        return json.loads(text, parse_constant=_refuse)
    except RecursionError as e:
        raise _NotJson("nested too deeply") from e


def _ordered(value: object) -> object:
    if isinstance(value, dict):
        return {k: _ordered(value[k]) for k in sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))}
    if isinstance(value, list):
        return [_ordered(v) for v in value]
    if isinstance(value, float) and value.is_integer() and abs(value) < 1e15:
        return int(value)
    return value


def canonical_json(value: object) -> str:
    """Keys in UTF-16 order, no blanks, whole numbers without a point, text as it is."""
    text = json.dumps(_ordered(value), separators=(",", ":"), ensure_ascii=False)
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", text)


TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value: object, kind: str) -> bool:
    if kind in ("integer", "number"):
        whole = isinstance(value, int) or isinstance(value, float) and value.is_integer()
        return not isinstance(value, bool) and (whole if kind == "integer" else isinstance(value, (int, float)))
    return isinstance(value, TYPES[kind])


def violations(value: object, schema: dict, at: str = "$") -> list[str]:
    """What in ``value`` breaks ``schema``: type, enum, bounds, lengths, required, properties,
    additionalProperties and items of JSON Schema."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{at}: not of type {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: none of {canonical_json(schema['enum'])}")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if "minimum" in schema and value < schema["minimum"]:
            out.append(f"{at}: under {schema['minimum']}")
        if "maximum" in schema and value > schema["maximum"]:
            out.append(f"{at}: over {schema['maximum']}")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{at}: shorter than {schema['minLength']}")
        if "maxLength" in schema and len(value) > schema["maxLength"]:
            out.append(f"{at}: longer than {schema['maxLength']}")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{at}.{k}: not expected" for k in sorted(value) if k not in known]
        for k in sorted(known):
            if k in value:
                out += violations(value[k], known[k], f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            out += violations(v, schema["items"], f"{at}[{i}]")
    return out


# --- order ------------------------------------------------------------------------------

def depths(calls: DataFrame) -> DataFrame:
    """``(conv_id, call_id, depth)`` for calls unique by conv_id and call_id, with a ``parent_id``.

    A call without a parent, or whose parent is no call of its conversation, has depth 0.
    Calls on a cycle, or below one, have a null depth.
    """
    ids = calls.select(F.col("conv_id").alias("p_conv"), F.col("call_id").alias("p_call"))
    state = (calls.select("conv_id", "call_id", "parent_id")
             .join(ids, (F.col("conv_id").eqNullSafe(F.col("p_conv"))) & (F.col("parent_id") == F.col("p_call")), "left")
             .select("conv_id", "call_id", F.col("p_call").alias("up"), F.col("p_call").isNotNull().cast("long").alias("depth")))
    state = materialize(state, "call-depths")
    waiting = state.filter("up is not null").count()
    while waiting:
        above = state.select(F.col("conv_id").alias("a_conv"), F.col("call_id").alias("a_call"),
                             F.col("up").alias("a_up"), F.col("depth").alias("a_depth"))
        state = materialize(
            state.join(above, (F.col("conv_id").eqNullSafe(F.col("a_conv"))) & (F.col("up") == F.col("a_call")), "left")
            .select("conv_id", "call_id", F.col("a_up").alias("up"),
                    (F.col("depth") + F.coalesce("a_depth", F.lit(0))).alias("depth")), "call-depths")
        left = state.filter("up is not null").count()
        if left == waiting:  # every chain that ends was followed twice as far: the rest are cycles
            break
        waiting = left
    return state.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


# --- messages ---------------------------------------------------------------------------

MESSAGE = [T.StructField("valid", T.BooleanType()), T.StructField("errors", T.StringType()),
           T.StructField("message", T.StringType())]


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per message: ``(conv_id, call_id, kind, at, name, depth, status, valid, errors, message)``.

    ``calls``: conv_id, call_id, parent_id, at (long), name, arguments (JSON text).
    ``results``: conv_id, call_id, at, content. ``schemas``: the tools' argument schemas by name.

    Calls that repeat an id count once, by the least (at, name, arguments, parent); results may
    answer a call more than once. A call is ``answered`` or ``unanswered``, ``cyclic`` if its
    parents never end, and ``unidentified`` without an id; a result is ``linked``, or an
    ``orphan`` if no call has its id. Arguments that are null, no JSON, or for an unknown tool
    are invalid; such text stands in the message as a string.
    """
    named = calls.select("conv_id", "call_id", "parent_id", F.col("at").cast("long").alias("at"), "name", "arguments")
    once = materialize(
        named.filter("call_id is not null").groupBy("conv_id", "call_id")
        .agg(F.min(F.struct("at", "name", "arguments", "parent_id")).alias("c"))
        .select("conv_id", "call_id", "c.*"), "calls")
    answers = results.select("conv_id", "call_id", F.col("at").cast("long").alias("at"), "content")
    placed = once.join(depths(once).withColumnsRenamed({"conv_id": "d_conv", "call_id": "d_call"}),
                       F.col("conv_id").eqNullSafe(F.col("d_conv")) & (F.col("call_id") == F.col("d_call")))
    got = answers.filter("call_id is not null").groupBy("conv_id", "call_id").agg(F.count(F.lit(1)).alias("n"))
    # Both hashed sides are unique by id and narrow; the probing side may hold one id many times.
    got = got.select(F.col("conv_id").alias("g_conv"), F.col("call_id").alias("g_call"), "n").hint("shuffle_hash")
    status = F.when(F.col("depth").isNull(), "cyclic").when(F.col("n").isNull(), "unanswered").otherwise("answered")
    call_rows = placed.join(got, F.col("conv_id").eqNullSafe(F.col("g_conv")) & (F.col("call_id") == F.col("g_call")), "left").select(
        "conv_id", "call_id", F.lit("call").alias("kind"), "at", "name", "depth", status.alias("status"),
        F.col("arguments").alias("body"))
    no_id = named.filter("call_id is null").select(
        "conv_id", "call_id", F.lit("call").alias("kind"), "at", "name", F.lit(0).cast("long").alias("depth"),
        F.lit("unidentified").alias("status"), F.col("arguments").alias("body"))
    known = placed.select(F.col("conv_id").alias("k_conv"), F.col("call_id").alias("k_call"), "name", "depth").hint("shuffle_hash")
    result_rows = answers.join(
        known, F.col("conv_id").eqNullSafe(F.col("k_conv")) & (F.col("call_id") == F.col("k_call")), "left").select(
        "conv_id", "call_id", F.lit("result").alias("kind"), "at", "name", "depth",
        F.when(F.col("k_call").isNull(), "orphan").otherwise("linked").alias("status"), F.col("content").alias("body"))
    rows = call_rows.unionByName(no_id).unionByName(result_rows)
    names = rows.columns[:-1]

    def messages(source: Iterator[tuple]) -> Iterator[tuple]:
        for *head, body in source:
            row = dict(zip(names, head, strict=True))
            if row["kind"] == "result":
                message = {"call_id": row["call_id"], "content": body, "name": row["name"], "role": "tool"}
                yield (*head, None, "", canonical_json(message))
                continue
            try:
                value = parse_json(body)
                errors = (violations(value, schemas[row["name"]]) if row["name"] in schemas
                          else [f"no tool {canonical_json(row['name'])}"])
                text = canonical_json({"arguments": value, "call_id": row["call_id"], "name": row["name"], "role": "assistant"})
            except (ValueError, RecursionError):
                errors = ["$: not JSON"]
                text = canonical_json({"arguments": body, "call_id": row["call_id"], "name": row["name"], "role": "assistant"})
            yield (*head, not errors, "; ".join(errors), text)

    return map_rows(rows, rows.columns, messages, T.StructType([*rows.schema.fields[:-1], *MESSAGE]))


# --- the conversations table --------------------------------------------------------------
# Its turns hold plain text, so the registered query reads each assistant turn as a call of one
# of these tools, and the user turn after it as the result.

TOOLS = ("search", "summarise", "translate")
SCHEMAS = {
    "search": {"type": "object", "required": ["limit", "query"], "additionalProperties": False, "properties": {
        "limit": {"type": "integer", "minimum": 1, "maximum": 150}, "query": {"type": "string", "minLength": 1}}},
    "summarise": {"type": "object", "required": ["text"], "additionalProperties": False, "properties": {
        "text": {"type": "string", "maxLength": 1500}, "words": {"type": "integer", "minimum": 10}}},
    "translate": {"type": "object", "required": ["target", "text"], "additionalProperties": False, "properties": {
        "target": {"type": "string", "enum": ["de", "en", "es", "fr"]}, "text": {"type": "string"}}},
}
TARGETS = ("de", "en", "es", "fr", "xx")


def calls_and_results(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that the turns of ``conversations`` (conv_id, turn, role, text) stand for."""
    def identifier(turn):
        return F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))

    text, turn = F.col("text"), F.col("turn")
    words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    target = F.element_at(F.array(*[F.lit(t) for t in TARGETS]), (F.char_length(text) % 5 + 1).cast("int"))
    arguments = (F.when(words % 3 == 0, F.to_json(F.struct(text.alias("query"), words.alias("limit"))))
                 .when(words % 3 == 1, F.to_json(F.struct(text, (words / 4).cast("long").alias("words"))))
                 .otherwise(F.to_json(F.struct(text, target.alias("target")))))
    calls = conversations.filter("role = 'assistant'").select(
        "conv_id", identifier(turn).alias("call_id"), identifier(turn - 2).alias("parent_id"), turn.alias("at"),
        F.element_at(F.array(*[F.lit(t) for t in TOOLS]), (words % 3 + 1).cast("int")).alias("name"),
        arguments.alias("arguments"))
    results = conversations.filter("role = 'user' and turn > 0").select(
        "conv_id", identifier(turn - 1).alias("call_id"), turn.alias("at"), text.alias("content"))
    return calls, results


def oracle_sql() -> str:
    """The registered query's rows in DuckDB SQL; depth by a recursive query."""
    def message(body: str, role: str) -> str:
        return (f"'{{' || {body} || ',\"call_id\":' || to_json(call_id)::VARCHAR || ',\"name\":' || "
                f"coalesce(to_json(name)::VARCHAR, 'null') || ',\"role\":\"{role}\"}}'")

    return f"""
WITH RECURSIVE t AS (SELECT *, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM conversations),
c AS (SELECT conv_id, 'call-' || conv_id || '-' || turn AS call_id, 'call-' || conv_id || '-' || (turn - 2) AS parent_id,
        turn AS "at", ['search', 'summarise', 'translate'][words % 3 + 1] AS name, words, text,
        ['de', 'en', 'es', 'fr', 'xx'][length(text) % 5 + 1] AS target FROM t WHERE role = 'assistant'),
d AS (SELECT conv_id, call_id, 0::BIGINT AS depth FROM c WHERE parent_id NOT IN (SELECT call_id FROM c)
      UNION ALL SELECT c.conv_id, c.call_id, d.depth + 1 FROM c JOIN d ON c.parent_id = d.call_id),
r AS (SELECT conv_id, 'call-' || conv_id || '-' || (turn - 1) AS call_id, turn AS "at", text AS content
      FROM t WHERE role = 'user' AND turn > 0),
e AS (SELECT c.*, depth, concat_ws('; ',
        CASE WHEN name = 'search' AND words < 1 THEN '$.limit: under 1' WHEN name = 'search' AND words > 150 THEN '$.limit: over 150' END,
        CASE WHEN name = 'summarise' AND length(text) > 1500 THEN '$.text: longer than 1500' END,
        CASE WHEN name = 'summarise' AND words // 4 < 10 THEN '$.words: under 10' END,
        CASE WHEN name = 'translate' AND target = 'xx' THEN '$.target: none of ["de","en","es","fr"]' END) AS errors,
        '"arguments":' || CASE name
          WHEN 'search' THEN '{{"limit":' || words || ',"query":' || to_json(text)::VARCHAR || '}}'
          WHEN 'summarise' THEN '{{"text":' || to_json(text)::VARCHAR || ',"words":' || (words // 4) || '}}'
          ELSE '{{"target":"' || target || '","text":' || to_json(text)::VARCHAR || '}}' END AS body
      FROM c JOIN d USING (conv_id, call_id))
SELECT conv_id, call_id, 'call' AS kind, "at", name, depth,
  CASE WHEN call_id IN (SELECT call_id FROM r) THEN 'answered' ELSE 'unanswered' END AS status,
  errors = '' AS valid, errors, {message('body', 'assistant')} AS message FROM e
UNION ALL
SELECT conv_id, call_id, 'result', r."at", name, depth, CASE WHEN e.call_id IS NULL THEN 'orphan' ELSE 'linked' END,
  NULL, '', '{{"call_id":' || to_json(call_id)::VARCHAR || ',"content":' || to_json(content)::VARCHAR || ',"name":'
  || coalesce(to_json(name)::VARCHAR, 'null') || ',"role":"tool"}}'
FROM r LEFT JOIN e USING (conv_id, call_id)"""
