"""Chat formatting: tool calls linked to their results, ordered, validated, as canonical JSON.

An assistant message that makes calls is JSON with ``tool_calls``, a list of objects with
id, name, arguments (an object, or its JSON text) and optionally depends_on (ids); an
argument of the form {"$ref": id} is a dependency too. A message of role ``tool`` is JSON
with ``tool_call_id`` and ``content``. Everything else is a plain message.

Calls and results meet in a hash join on (conversation, id). Calls are ordered by levels: a
call's level is one more than the highest of those it depends on, found in rounds of joins,
as many as the longest chain; (level, turn, idx) is a topological order. Canonical JSON has
sorted keys, no blanks and no escapes that aren't needed.

Defined cases: a null text is empty and a null role plain; JSON that can't be read is a plain
message; JSON nested deeper than MAX_DEPTH is too, with the error ``nested too deeply``; of calls that share an id, and of results for one call, the first by turn and place
counts and the others are marked as repeated; a result without a call is an orphan; calls in
a cycle, and those after one, have no level and the error ``cycle``; a dependency on an id
that is no call of the conversation is ignored. Rows without a conv_id or id don't link.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, read_table

MAX_ROUNDS = 10_000
#: Lists and objects inside each other that a JSON text may have; deeper ones count as unreadable.
MAX_DEPTH = 500
SURROGATE = re.compile("[\ud800-\udfff]")

#: The tools of the registered query, in JSON Schema's words.
SCHEMAS = {
    "search": {"properties": {"query": {"type": "string"}, "limit": {"type": "integer"}}, "required": ["query"]},
    "lookup": {"properties": {"key": {"type": "string"}, "exact": {"type": "boolean"}}, "required": ["key"]},
    "measure": {"properties": {"values": {"type": "array", "items": {"type": "number"}}, "of": {"type": "object"}}, "required": ["values"]},
}


def _finite(text: str) -> float:
    if text in ("NaN", "Infinity", "-Infinity") or not math.isfinite(float(text)):
        raise ValueError(f"{text} has no JSON form")
    return float(text)


class TooDeep(ValueError):
    pass


def parsed(text: str):
    """The value of a JSON text; ValueError if it isn't JSON or has a number out of range, TooDeep beyond MAX_DEPTH."""
    try:
        value = json.loads(text, parse_constant=_finite, parse_float=_finite)
    except RecursionError as e:
        raise TooDeep("nested too deeply") from e
    level = [value]
    for _ in range(MAX_DEPTH + 1):
        level = [x for v in level if isinstance(v, (dict, list)) for x in (v.values() if isinstance(v, dict) else v)]
        if not level:
            return value
    raise TooDeep("nested too deeply")


def canonical(value) -> str:
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    # Half of a surrogate pair has no UTF-8 form: it stays escaped.
    return text if text.isascii() or not SURROGATE.search(text) else SURROGATE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def _clean(text: str) -> str:
    return SURROGATE.sub("\ufffd", text)


def _is(value, kind: str) -> bool:
    if kind == "integer":
        return isinstance(value, int) and not isinstance(value, bool)
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    kinds = {"string": str, "boolean": bool, "array": list, "object": dict, "null": type(None)}
    return isinstance(value, kinds[kind])


def problem(value, schema: dict, at: str = "") -> str | None:
    """The first violation of a schema (type, enum, required, properties, items), or None."""
    if "type" in schema and not _is(value, schema["type"]):
        return f"{at or 'arguments'}: not {schema['type']}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{at}: not allowed"
    if isinstance(value, dict):
        properties = schema.get("properties", {})
        for name in sorted(schema.get("required", [])):
            if name not in value:
                return f"{at}{name}: missing"
        for name in sorted(value):
            if name in properties:
                if found := problem(value[name], properties[name], f"{at}{name}"):
                    return found
            elif schema.get("additionalProperties", True) is False:
                return f"{at}{name}: unknown"
    if isinstance(value, list) and "items" in schema:
        for item in value:
            if found := problem(item, schema["items"], f"{at}[]"):
                return found
    return None


def _references(value) -> Iterator[str]:
    left = [value]
    while left:
        v = left.pop()
        if isinstance(v, dict):
            if isinstance(v.get("$ref"), str):
                yield v["$ref"]
            left.extend(v.values())
        elif isinstance(v, list):
            left.extend(v)


EVENT = pa.schema(
    [
        ("conv_id", pa.int64()), ("turn", pa.int64()), ("idx", pa.int32()), ("kind", pa.string()), ("call_id", pa.string()),
        ("name", pa.string()), ("error", pa.string()), ("body", pa.string()), ("needs", pa.list_(pa.string())),
    ]
)
EVENTS = "conv_id long, turn long, idx int, kind string, call_id string, name string, error string, body string, needs array<string>"


def _call(call: dict, schemas: dict) -> tuple:
    """(call_id, name, error, canonical members, ids it needs)."""
    name, arguments = call.get("name"), call.get("arguments", {})
    error = None
    if isinstance(arguments, str):
        try:
            arguments = parsed(arguments)
        except TooDeep:
            error = "arguments: nested too deeply"
        except ValueError:
            error = "arguments: not JSON"
    if name not in schemas if isinstance(name, str) else True:
        error = error or "name: unknown"
    elif not error:
        error = problem(arguments, {"type": "object", "additionalProperties": False, **schemas[name]})
    needs = call.get("depends_on")
    needs = [x for x in needs if isinstance(x, str)] if isinstance(needs, list) else []
    call_id = call.get("id")
    call_id = call_id if isinstance(call_id, str) else None
    name = name if isinstance(name, str) else None
    # The canonical object's members up to the result, which the join adds.
    body = canonical({"arguments": arguments, "id": call_id, "name": name})[1:-1]
    return call_id and _clean(call_id), name and _clean(name), error and _clean(error), body, sorted(map(_clean, {*needs, *_references(arguments)}))


def _parse(schemas: dict) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def events(conv, turn, role, text) -> Iterator[tuple]:
        value = error = None
        if text.lstrip()[:1] == "{" and role in ("assistant", "tool"):
            try:
                value = parsed(text)
            except TooDeep as e:
                error = str(e)
            except ValueError:
                value = None
        if role == "tool" and isinstance(value, dict) and isinstance(value.get("tool_call_id"), str):
            call_id = value["tool_call_id"]
            yield conv, turn, 0, "result", _clean(call_id), canonical(call_id), None, canonical(value.get("content")), []
            return
        calls = value.get("tool_calls") if role == "assistant" and isinstance(value, dict) else None
        if isinstance(calls, list) and all(isinstance(c, dict) for c in calls):
            yield conv, turn, 0, "message", None, role, None, canonical({"content": value.get("content"), "role": role}), []
            for i, call in enumerate(calls):
                call_id, name, error, body, needs = _call(call, schemas)
                yield conv, turn, i + 1, "call", call_id, name, error, body, needs
            return
        yield conv, turn, 0, "message", None, role, error, canonical({"content": text, "role": role}), []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [e for x in zip(*(c.to_pylist() for c in batch.columns), strict=True) for e in events(*x)]
            columns = zip(*rows, strict=True) if rows else [()] * len(EVENT)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, EVENT, strict=True)], schema=EVENT)

    return run


def _levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of the calls that depend on others; those without a level are in or after a cycle."""
    known = calls.select("conv_id", F.col("call_id").alias("need"))
    edges = calls.select("conv_id", "call_id", F.explode("needs").alias("need")).distinct().join(known, ["conv_id", "need"])
    edges = materialize(edges.select("conv_id", "call_id", "need"), "call-edges")
    done = None
    left = edges.count()
    for level in range(1, MAX_ROUNDS):
        if not left:
            break
        waiting = edges.select("conv_id", "call_id").distinct()
        # Edges to calls that still wait stay; who has none of them is ready.
        rest = edges.join(waiting.withColumnRenamed("call_id", "need"), ["conv_id", "need"], "left_semi").select("conv_id", "call_id", "need")
        rest = materialize(rest, "call-edges")
        ready = waiting.join(rest, ["conv_id", "call_id"], "left_anti").withColumn("level", F.lit(level))
        done = ready if done is None else done.union(ready)
        now = rest.count()
        if now == left:  # only cycles
            break
        edges, left = rest, now
    else:
        raise RuntimeError(f"dependencies are deeper than {MAX_ROUNDS}")
    none = edges.select("conv_id", "call_id", F.lit(0).alias("level")).limit(0)
    stuck = edges.select("conv_id", "call_id").distinct().withColumn("level", F.lit(None).cast("int"))
    return (done if done is not None else none).union(stuck if left else none)


def link_tool_calls(messages: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """The conversations' messages, linked calls and orphans, a row each.

    Columns conv_id, turn, idx, kind (message, call, repeated_call, orphan_result,
    repeated_result), call_id, name (of the tool, or the role), level, linked, result_turn,
    valid, error, json. Order by (conv_id, level, turn, idx) for the calls' topological order.
    """
    rows = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", F.coalesce("text", F.lit("")).alias("text"))
    events = materialize(rows.mapInArrow(_parse(schemas), EVENTS), "call-events")
    keyed = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    place = F.struct("turn", "idx", F.coalesce("name", F.lit("")).alias("name"), "body", "error", "needs")
    by = lambda kind: events.where((F.col("kind") == kind) & keyed).groupBy("conv_id", "call_id").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    calls = materialize(by("call").select("conv_id", "call_id", "first.*", "n"), "calls")
    results = by("result").select("conv_id", "call_id", F.col("first.turn").alias("result_turn"), F.col("first.name").alias("quoted"), F.col("first.body").alias("result"), F.col("n").alias("results"))
    linked = calls.join(results.hint("shuffle_hash"), ["conv_id", "call_id"], "full_outer")
    linked = linked.join(_levels(calls).withColumn("waited", F.lit(True)), ["conv_id", "call_id"], "left")
    is_call = F.col("turn").isNotNull() | F.col("n").isNotNull()
    level = F.when(F.col("waited"), F.col("level")).when(is_call, F.lit(0))
    error = F.coalesce("error", F.when(F.col("waited") & F.col("level").isNull(), F.lit("cycle")))
    # Canonical members were made where the JSON was read; keys are in order.
    text = F.concat(F.lit("{"), F.col("body"), F.lit(',"result":'), F.coalesce("result", F.lit("null")), F.lit("}"))
    orphan = F.concat(F.lit('{"content":'), F.col("result"), F.lit(',"tool_call_id":'), F.col("quoted"), F.lit("}"))
    out = linked.select(
        "conv_id", F.when(is_call, F.col("turn")).otherwise(F.col("result_turn")).alias("turn"), F.coalesce("idx", F.lit(0)).alias("idx"),
        F.when(is_call, "call").otherwise("orphan_result").alias("kind"), "call_id", F.when(F.col("name") != "", F.col("name")).alias("name"),
        level.cast("int").alias("level"), (is_call & F.col("results").isNotNull()).alias("linked"), F.when(is_call, F.col("result_turn")).alias("result_turn"),
        (is_call & error.isNull()).alias("valid"), error.alias("error"), F.when(is_call, text).otherwise(orphan).alias("json"),
    )
    # What isn't in the join: messages, rows without keys, and all but the first of those that share an id.
    firsts = by("call").withColumn("kind", F.lit("call")).unionByName(by("result").withColumn("kind", F.lit("result"))).where("n > 1")
    extra = events.where((F.col("kind") != "message") & keyed).withColumn("place", place).join(firsts, ["conv_id", "call_id", "kind"])
    later = extra.where(F.col("place") > F.col("first")).select(events.columns)
    # Rows that equal the first one: all but one of them.
    equal = extra.where(F.col("place") == F.col("first")).groupBy(*(c for c in events.columns)).agg(F.count(F.lit(1)).alias("m"))
    equal = equal.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("m")))).where("again > 1").select(events.columns)
    again = later.union(equal).select(*_plain(F.concat(F.lit("repeated_"), "kind"), F.lit("repeated")))
    unkeyed = events.where((F.col("kind") != "message") & ~keyed).select(*_plain(F.concat(F.lit("unkeyed_"), "kind"), F.lit("no id")))
    plain = events.where(F.col("kind") == "message").select(*_plain(F.col("kind"), F.col("error")))
    return out.unionByName(plain).unionByName(unkeyed).unionByName(again)


def _plain(kind, error) -> list:
    none = lambda t: F.lit(None).cast(t)
    return [
        F.col("conv_id"), F.col("turn"), F.col("idx"), kind.alias("kind"), F.col("call_id"), F.col("name"), none("int").alias("level"), F.lit(False).alias("linked"),
        none("long").alias("result_turn"), error.isNull().alias("valid"), error.alias("error"), F.col("body").alias("json"),
    ]


def with_tool_calls(conversations: DataFrame) -> DataFrame:
    """The conversations with each assistant turn as a message that makes calls, and their results.

    Derived from the rows alone: an assistant turn makes one to four calls, each depending on
    the one before; a few have arguments of a wrong type, no result, or a result of no call.
    """
    size = F.length(F.coalesce("text", F.lit("")))
    words = F.slice(F.split(F.coalesce("text", F.lit("")), " "), 1, 6)

    def call(k):
        pick = (size + k) % 3
        limit = F.when(size % 7 == 0, F.concat(F.lit('"'), size, F.lit('"'))).otherwise(size.cast("string"))
        query = F.to_json(F.struct(F.array_join(words, " ").alias("query")))
        search = F.concat(F.regexp_replace(query, r"\}$", ""), F.lit(',"limit":'), limit, F.lit("}"))
        lookup = F.to_json(F.struct(F.element_at(words, 1).alias("key"), (size % 2 == 0).alias("exact")))
        measure = F.to_json(F.struct(F.transform(words, F.length).alias("values")))
        arguments = F.when(pick == 0, search).when(pick == 1, lookup).otherwise(measure)
        name = F.when(pick == 0, "search").when(pick == 1, "lookup").otherwise("measure")
        call_id = F.concat(F.lit("call_"), F.col("turn"), F.lit("_"), k)
        needs = F.when(k > 0, F.concat(F.lit('["call_'), F.col("turn"), F.lit("_"), k - 1, F.lit('"]'))).otherwise("[]")
        return F.concat(F.lit('{"id":"'), call_id, F.lit('","depends_on":'), needs, F.lit(',"name":"'), name, F.lit('","arguments":'), arguments, F.lit("}"))

    content = F.regexp_replace(F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("content"))), r"\}$", "")
    making = F.concat(content, F.lit(',"tool_calls":['), F.array_join(F.transform(F.sequence(F.lit(0), size % 4), call), ","), F.lit("]}"))
    assistant = F.col("role") == "assistant"
    said = conversations.select("conv_id", "turn", "role", F.when(assistant, making).otherwise(F.col("text")).alias("text"))
    answered = conversations.where(assistant).withColumn("k", F.explode(F.sequence(F.lit(0), size % 4)))
    which = F.when(size % 11 == 0, F.lit("x")).otherwise(F.col("k").cast("string"))
    answered = answered.where((size % 5 != 0) | (F.col("k") != 0))
    answer = F.to_json(F.struct(F.concat(F.lit("call_"), F.col("turn"), F.lit("_"), which).alias("tool_call_id"), F.col("text").alias("content")))
    return said.union(answered.select("conv_id", "turn", F.lit("tool").alias("role"), answer.alias("text")))


def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_tool_calls(with_tool_calls(read_table(spark, sf_dir, "conversations")))
