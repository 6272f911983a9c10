"""Operator 7: chat formatting with tool calls linked to their results.

A turn of role "assistant" whose text is a JSON object with a list ``tool_calls`` (each {"id", "name", "arguments"})
makes calls; a turn of role "tool" whose text is a JSON object with ``tool_call_id`` gives a result. Calls and results
are hash-joined by conversation and identifier, so that a conversation is never gathered in one task. A call depends on
those whose ids its arguments name as {"$ref": id}; levels are found by repeated joins over the calls alone. Arguments
are validated against the tool's JSON schema. The output is a line of canonical JSON (sorted keys, no white space,
UTF-8) for each message, with its place: results stand after the last call of their turn, by level, then call.

Statuses: of a call "ok", "unknown_tool", "invalid_arguments", "duplicate_id", "missing_dependency" or "cycle", with
"+no_result" where none came; of a result "ok", "orphan" (no earlier call of that id) or "duplicate_result" (all but the
first by turn); of other turns "ok". A call is "missing_dependency" if it, or one it depends on, names an id that no call
has, else "cycle" if no order puts it after all it names. Defined results: a null text is null content, a null role
"unknown"; text of an assistant or tool turn that isn't such a JSON object is ordinary content, and so is JSON with numbers
that no double holds (NaN, Infinity, 1e999), with half a surrogate pair, or nested more than MAX_DEPTH deep; arguments
given as text that isn't such JSON stay text. A null conversation id is one conversation; a null turn comes first; repeated
rows are repeated messages; ill-formed UTF-8 is mended first; long texts are taken whole, in batches of bounded bytes; an
empty table gives an empty table; further columns are left out.
"""

from __future__ import annotations

import contextlib
import json
import math
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunweave.llm.arrow import slices, strings
from sunweave.sources.shared import written

BATCH_BYTES = 8 << 20
#: Levels of nesting in a turn's JSON.
MAX_DEPTH = 100

# Example tools and the schemas of their arguments.
TOOLS: dict[str, dict] = {
    "search": {"type": "object", "properties": {"query": {"type": "string", "minLength": 1}, "top_k": {"type": "integer", "minimum": 1, "maximum": 100}}, "required": ["query"], "additionalProperties": False},
    "calculator": {"type": "object", "properties": {"expression": {"type": "string"}}, "required": ["expression"], "additionalProperties": False},
    "weather": {"type": "object", "properties": {"city": {"type": "string"}, "unit": {"enum": ["c", "f"]}}, "required": ["city"]},
}


def canonical(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def parse_json(text: str) -> Any:
    """The value of a JSON text; ValueError also for what can't be written again as canonical UTF-8 JSON."""

    def no_number(name: str) -> float:
        raise ValueError(name)

    try:
        value = json.loads(text, parse_constant=no_number)
    except RecursionError as e:
        raise ValueError("nested too deep") from e
    level = [value]
    for _ in range(MAX_DEPTH):
        below: list = []
        for v in level:
            if isinstance(v, dict):
                below += [*v.keys(), *v.values()]
            elif isinstance(v, list):
                below += v
            elif isinstance(v, str):
                v.encode()  # UnicodeEncodeError is a ValueError
            elif isinstance(v, float) and not math.isfinite(v):
                raise ValueError("a number beyond doubles")
        if not below:
            return value
        level = below
    raise ValueError("nested too deep")


def is_reference(value: Any) -> bool:
    return isinstance(value, dict) and set(value) == {"$ref"} and isinstance(value["$ref"], str)


def references(value: Any) -> set[str]:
    """Ids named as {"$ref": id} anywhere in a value."""
    if is_reference(value):
        return {value["$ref"]}
    inside = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return set().union(*map(references, inside))


_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def valid(value: Any, schema: dict) -> bool:
    """Whether the value satisfies a JSON schema of the keywords below; a reference stands for any value."""
    if is_reference(value):
        return True
    kind = schema.get("type")
    if kind in ("integer", "number"):
        if isinstance(value, bool) or not isinstance(value, (int, float)) or kind == "integer" and value != int(value):
            return False
    elif kind and not isinstance(value, _TYPES[kind]):
        return False
    if "enum" in schema and value not in schema["enum"]:
        return False
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return schema.get("minimum", value) <= value <= schema.get("maximum", value)
    if isinstance(value, str):
        return schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value))
    if isinstance(value, list):
        return all(valid(v, schema["items"]) for v in value) if "items" in schema else True
    if isinstance(value, dict):
        known = schema.get("properties", {})
        if any(r not in value for r in schema.get("required", ())) or schema.get("additionalProperties") is False and set(value) - set(known):
            return False
        return all(valid(v, known[k]) for k, v in value.items() if k in known)
    return True


def parse_turn(role: str | None, text: str | None, tools: dict[str, dict]) -> list[dict]:
    """The messages of one turn: itself, or its calls, or its result."""
    plain = {"kind": "text", "index": 0, "json": canonical({"content": text, "role": role or "unknown"})}
    if role not in ("assistant", "tool") or not text or not text.lstrip().startswith("{"):
        return [plain]
    try:
        value = parse_json(text)
    except ValueError:
        return [plain]
    if role == "tool" and isinstance(value.get("tool_call_id"), str):
        return [{"kind": "result", "index": 0, "id": value["tool_call_id"], "json": canonical({"content": value.get("content"), "role": "tool", "tool_call_id": value["tool_call_id"]})}]
    calls = value.get("tool_calls")
    if role != "assistant" or not isinstance(calls, list) or not calls or not all(isinstance(c, dict) and isinstance(c.get("id"), str) and isinstance(c.get("name"), str) for c in calls):
        return [plain]
    out = []
    for i, c in enumerate(calls):
        arguments = c.get("arguments")
        if isinstance(arguments, str):
            with contextlib.suppress(ValueError):
                arguments = parse_json(arguments)
        state = "unknown_tool" if c["name"] not in tools else "ok" if valid(arguments, tools[c["name"]]) else "invalid_arguments"
        body = {"content": value.get("content") if i == 0 else None, "role": "assistant", "tool_call": {"arguments": arguments, "id": c["id"], "name": c["name"]}}
        out.append({"kind": "call", "index": i, "id": c["id"], "state": state, "refs": sorted(references(arguments)), "json": canonical(body)})
    return out


def _texts(column: pa.Array) -> list[str | None]:
    return [x if good else None for x, good in zip(strings(column).to_pylist(), column.is_valid().to_pylist(), strict=True)]


_PARTS = "conv_id {}, turn {}, kind string, index int, id string, state string, refs array<string>, json string"


def messages(turns: DataFrame, tools: dict[str, dict] = TOOLS) -> DataFrame:
    """The messages of all turns with their parsed calls and results, unlinked."""
    rows = turns.select("conv_id", "turn", "role", "text")
    types = [rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", BATCH_BYTES):
            schema = pa.schema([("conv_id", b.column("conv_id").type), ("turn", b.column("turn").type), ("kind", pa.string()), ("index", pa.int32()), ("id", pa.string()), ("state", pa.string()), ("refs", pa.list_(pa.string())), ("json", pa.string())])
            columns = [b.column("conv_id").to_pylist(), b.column("turn").to_pylist(), *(_texts(b.column(c)) for c in ("role", "text"))]
            out = [m | {"conv_id": c, "turn": t} for c, t, role, text in zip(*columns, strict=True) for m in parse_turn(role, text, tools)]
            yield pa.RecordBatch.from_pylist(out, schema)

    return rows.mapInArrow(run, _PARTS.format(*types))


def format_chat(turns: DataFrame, tools: dict[str, dict] = TOOLS) -> DataFrame:
    """(conv_id, turn, kind, place_turn, place_level, place_index, place_part, call_id, status, json), a row a message.

    Sorted by the four places, the lines of a conversation are its formatted chat.
    """
    parts = written(messages(turns, tools), "messages")
    calls = parts.where("kind = 'call'")
    text = parts.where("kind = 'text'").select("conv_id", "turn", "kind", F.col("turn").alias("place_turn"), F.lit(0).alias("place_level"), F.lit(0).alias("place_index"), F.lit(0).alias("place_part"), F.lit(None).cast("string").alias("call_id"), F.lit("ok").alias("status"), "json")
    # Of several calls of one id in a conversation the first counts.
    first = written(calls.groupBy("conv_id", "id").agg(F.min(F.struct("turn", "index", "state", "refs")).alias("c")).select("conv_id", "id", "c.*"), "calls")
    levels = _levels(first)
    results = parts.where("kind = 'result'")
    earliest = results.groupBy(F.col("conv_id").alias("r_conv"), F.col("id").alias("r_id")).agg(F.min("turn").alias("r_turn"))
    same = lambda a, b: F.col("conv_id").eqNullSafe(F.col(a)) & (F.col("id") == F.col(b))
    known = first.select(F.col("conv_id").alias("f_conv"), F.col("id").alias("f_id"), F.col("turn").alias("f_turn"), F.col("index").alias("f_index"))
    level = levels.select(F.col("conv_id").alias("l_conv"), F.col("id").alias("l_id"), "level", "problem")
    linked = calls.join(known, same("f_conv", "f_id")).join(level, same("l_conv", "l_id")).join(earliest, same("r_conv", "r_id"), "left")
    is_first = F.col("turn").eqNullSafe(F.col("f_turn")) & (F.col("index") == F.col("f_index"))
    status = F.when(~is_first, F.lit("duplicate_id")).when(F.col("state") != "ok", F.col("state")).otherwise(F.coalesce("problem", F.lit("ok")))
    status = F.concat(status, F.when(F.col("r_id").isNull(), F.lit("+no_result")).otherwise(""))
    call_rows = linked.select("conv_id", "turn", "kind", F.col("turn").alias("place_turn"), F.when(is_first, F.coalesce("level", F.lit(0))).otherwise(0).alias("place_level"), F.col("index").alias("place_index"), F.lit(0).alias("place_part"), F.col("id").alias("call_id"), status.alias("status"), "json")
    answered = results.join(known, same("f_conv", "f_id"), "left").join(level, same("l_conv", "l_id"), "left").join(earliest, same("r_conv", "r_id"))
    orphan = F.col("f_id").isNull() | (F.col("f_turn") >= F.col("turn"))
    status = F.when(orphan, "orphan").when(~F.col("turn").eqNullSafe(F.col("r_turn")), "duplicate_result").otherwise("ok")
    place = lambda c, else_: F.when(orphan, else_).otherwise(c)
    result_rows = answered.select("conv_id", "turn", "kind", place(F.col("f_turn"), F.col("turn")).alias("place_turn"), place(F.coalesce("level", F.lit(0)), F.lit(0)).alias("place_level"), place(F.col("f_index"), F.lit(0)).alias("place_index"), F.lit(1).alias("place_part"), F.col("id").alias("call_id"), status.alias("status"), "json")
    return text.unionByName(call_rows).unionByName(result_rows)


def _levels(first: DataFrame) -> DataFrame:
    """(conv_id, id, level, problem): 0 for calls that name no other, else one more than the highest they name.

    A round of joins for each level, over the calls that name one of the level below. Calls of which one is missing, or that
    depend on such, and cycles have no level.
    """
    edges = first.select("conv_id", "id", F.explode(F.array_distinct("refs")).alias("on"))
    new = first.where(F.size("refs") == 0).select("conv_id", "id", F.lit(0).alias("level"))
    if edges.isEmpty():
        return new.withColumn("problem", F.lit(None).cast("string"))
    edges, new = written(edges, "references"), written(new, "levels")
    named = lambda df, c, n: df.select(F.col("conv_id").alias(f"{n}_conv"), F.col(c).alias(f"{n}_id"), *[x for x in df.columns if x not in ("conv_id", c)])
    at = lambda c, n: F.col("conv_id").eqNullSafe(F.col(f"{n}_conv")) & (F.col(c) == F.col(f"{n}_id"))
    done = new
    while not new.isEmpty():
        near = edges.join(named(new.select("conv_id", "id"), "id", "d"), at("on", "d"), "left_semi").select("conv_id", "id").distinct()
        open_ = edges.join(named(near, "id", "n"), at("id", "n"), "left_semi").join(named(done, "id", "d"), at("on", "d"), "left")
        ready = open_.groupBy("conv_id", "id").agg(F.count("*").alias("n"), F.count("level").alias("have"), (F.max("level") + 1).alias("level"))
        new = written(ready.where("have = n").select("conv_id", "id", "level"), "levels")
        done = written(done.unionByName(new), "levels")
    new = written(edges.join(named(first.select("conv_id", "id"), "id", "k"), at("on", "k"), "left_anti").select("conv_id", "id").distinct(), "missing")
    gone = new
    while not new.isEmpty():
        after = edges.join(named(new, "id", "g"), at("on", "g"), "left_semi").select("conv_id", "id").distinct()
        new = written(after.join(named(gone, "id", "g"), at("id", "g"), "left_anti"), "missing")
        gone = written(gone.unionByName(new), "missing")
    out = first.select("conv_id", "id").join(named(done, "id", "d"), at("id", "d"), "left").join(named(gone, "id", "g"), at("id", "g"), "left")
    return out.select("conv_id", "id", "level", F.when(F.col("level").isNotNull(), F.lit(None)).when(F.col("g_id").isNotNull(), "missing_dependency").otherwise("cycle").cast("string").alias("problem"))
