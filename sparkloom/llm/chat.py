"""Chat formatting: tool calls linked to their results, ordered, validated and written as canonical JSON.

A message's text may be JSON. An object with ``tool_calls``, a list of {"id", "name", "arguments"}, makes calls; an
object with ``tool_call_id`` is a result, with its ``content``. Calls and results of a conversation are numbered for
each identifier, and the n-th call meets the n-th result in a join on a hash of conversation, identifier and number.
A result stands after the message that made its call, whatever its own turn says: messages are ordered by the later of
both turns, calls before results. Each message becomes one line of canonical JSON (sorted keys, no spaces, Unicode as
it is but for lone surrogates, which are escaped), so that no task ever holds a whole conversation.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Python types of JSON schema types; a boolean isn't a number.
TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}
PARSED = "row long, conv long, turn long, role string, kind string, calls array<struct<id: string, errors: array<string>>>, result_of string, json string"
#: Nesting from which JSON is taken for plain text (a message) or for no object (arguments).
DEPTH = 100
#: Turns of a conversation in a block of the numbering.
BLOCK_TURNS = 1024
LONE = re.compile("[\ud800-\udfff]")


def escaped(text: str) -> str:
    """Lone surrogates, which UTF-8 can't hold, as JSON escapes."""
    return LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def load(text: str | None) -> Any:  # noqa: ANN401
    """The value of a JSON text; None for what isn't JSON or is nested DEPTH levels deep or more."""
    try:
        x = json.loads(text or "")
    except (ValueError, RecursionError):
        return None
    level = [x]
    for _ in range(DEPTH):
        level = [w for v in level if isinstance(v, (dict, list)) for w in (v.values() if isinstance(v, dict) else v)]
        if not level:
            return x
    return None


def canonical(x: Any) -> str:  # noqa: ANN401
    """JSON with sorted keys and no white space; whole floats are written as integers, non-finite ones as null."""

    def plain(v: Any) -> Any:  # noqa: ANN401
        if isinstance(v, float):
            return None if not math.isfinite(v) else int(v) if v == int(v) and abs(v) < 2**53 else v
        if isinstance(v, dict):
            return {str(k): plain(w) for k, w in v.items()}
        return [plain(w) for w in v] if isinstance(v, list) else v

    return escaped(json.dumps(plain(x), sort_keys=True, ensure_ascii=False, separators=(",", ":")))


def violations(x: Any, schema: Mapping[str, Any], at: str = "$") -> list[str]:  # noqa: ANN401
    """Where a value breaks a schema of type, enum, required, properties, additionalProperties, items, minimum, maximum, maxLength."""
    kind = schema.get("type")
    if kind and (not isinstance(x, TYPES[kind]) or isinstance(x, bool) and kind in ("integer", "number")):
        return [f"{at}: not {kind}"]
    out = [] if "enum" not in schema or x in schema["enum"] else [f"{at}: not in enum"]
    if isinstance(x, (int, float)) and not isinstance(x, bool):
        out += [f"{at}: below minimum"] * (x < schema.get("minimum", x)) + [f"{at}: above maximum"] * (x > schema.get("maximum", x))
    if isinstance(x, str):
        out += [f"{at}: too long"] * (len(x) > schema.get("maxLength", len(x)))
    if isinstance(x, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in x]
        for k, v in x.items():
            if k in known:
                out += violations(v, known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: not allowed")
    if isinstance(x, list) and "items" in schema:
        out += [e for i, v in enumerate(x) for e in violations(v, schema["items"], f"{at}[{i}]")]
    return out


def parse(text: str | None, schemas: Mapping[str, Mapping[str, Any]]) -> tuple[str, list[dict], str | None, str]:
    """(kind, calls with errors, id of the call that this is a result of, canonical content) of a message's text."""
    x = load(text) if text and text.lstrip()[:1] == "{" else None
    if isinstance(x, dict) and isinstance(x.get("tool_calls"), list) and all(isinstance(c, dict) for c in x["tool_calls"]):
        calls = []
        for c in x["tool_calls"]:
            args = c.get("arguments")
            if isinstance(args, str):
                args = load(args)
            schema = schemas.get(str(c.get("name")))
            errors = ["unknown tool"] if schema is None else ["arguments are no object"] if not isinstance(args, dict) else violations(args, schema)
            calls.append({"id": None if c.get("id") is None else escaped(str(c["id"])), "errors": [escaped(e) for e in errors], "name": c.get("name"), "arguments": args})
        return "call", calls, None, canonical([{k: c[k] for k in ("id", "name", "arguments")} for c in calls])
    if isinstance(x, dict) and x.get("tool_call_id") is not None:
        return "result", [], escaped(str(x["tool_call_id"])), canonical(x.get("content"))
    return "text", [], None, canonical(text or "")


def line(message: tuple[str, list[dict], str | None, str], role: str | None) -> str:
    """A parsed message as canonical JSON; its content is canonical already, and keys stand in order."""
    kind, _, result_of, body = message
    if kind == "call":
        return f'{{"role":{canonical(role)},"tool_calls":{body}}}'
    return f'{{"content":{body},"role":{canonical(role)}' + (f',"tool_call_id":{canonical(result_of)}' if kind == "result" else "") + "}"


def nth(d: DataFrame) -> DataFrame:
    """``d`` (conv, id, turn, row, ...) with ``n``, the number of each row among those of its conversation and identifier.

    Numbers come from counts of blocks of turns and places within a block, so that an identifier which a conversation
    uses at very many turns isn't numbered by one task.
    """
    d = d.withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS))
    before = Window.partitionBy("conv", "id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = d.groupBy("conv", "id", "block").agg(F.count("*").alias("size")).withColumn("ahead", F.coalesce(F.sum("size").over(before), F.lit(0)))
    within = Window.partitionBy("conv", "id", "block").orderBy("turn", "row")
    d = d.withColumn("place", F.row_number().over(within)).join(blocks.drop("size"), ["conv", "id", "block"])
    return d.withColumn("n", F.col("ahead") + F.col("place")).drop("block", "ahead", "place")


def linked(calls: DataFrame, results: DataFrame) -> DataFrame:
    """(call_row, call_turn, result_row): the n-th call of each identifier of a conversation with its n-th result."""
    key = F.xxhash64("conv", "id", "n").alias("key")
    a = nth(calls).select(key, "conv", "id", "n", F.col("row").alias("call_row"), F.col("turn").alias("call_turn"))
    b = nth(results).select(key, "conv", "id", "n", F.col("row").alias("result_row"))
    return a.join(b, ["key", "conv", "id", "n"]).select("call_row", "call_turn", "result_row")


def format_messages(messages: DataFrame, schemas: Mapping[str, Mapping[str, Any]], conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, kind, order_turn, order_step, linked, call_errors, json), one row for each message.

    Order within a conversation is by order_turn, order_step, turn. ``linked`` is true for a result whose call exists
    and for a call message all of whose calls have a result, null for plain text. An identifier that a conversation uses
    more than once links by number: its n-th call (by turn) with its n-th result; what has no counterpart is not linked.
    ``call_errors`` lists what calls break in their schemas. Null and empty texts are empty content, a null role is null
    in the JSON, text that isn't an object of the two kinds, or is nested DEPTH levels deep, is plain text; texts of any
    length are kept whole. Null conversations and turns are kept and link nothing. Repeated rows each give a row, and of
    equal turns any may come first; an empty table gives an empty result; other columns, whatever their names, aren't read.
    Texts are parsed once: the parsed messages are written, and all joins read those.
    """
    m = messages.select(F.monotonically_increasing_id().alias("row"), F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            got = [parse(x, schemas) for x in b.column("text").to_pylist()]
            calls = [[{"id": c["id"], "errors": c["errors"]} for c in g[1]] for g in got]
            kinds = pa.list_(pa.struct([("id", pa.string()), ("errors", pa.list_(pa.string()))]))
            bodies = [line(g, r) for g, r in zip(got, b.column("role").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("row", "conv", "turn", "role")), pa.array([g[0] for g in got], pa.string()), pa.array(calls, kinds), pa.array([g[2] for g in got], pa.string()), pa.array(bodies, pa.string())],
                names=["row", "conv", "turn", "role", "kind", "calls", "result_of", "json"],
            )

    d = written(m.mapInArrow(run, PARSED), "messages")
    placed = d.where("conv IS NOT NULL AND turn IS NOT NULL")
    calls = placed.where("kind = 'call'").select("conv", "turn", "row", F.explode("calls.id").alias("id")).where("id IS NOT NULL")
    results = placed.where("kind = 'result'").select("conv", "turn", "row", F.col("result_of").alias("id"))
    links = written(linked(calls, results), "links")
    errors = F.flatten(F.transform("calls", lambda c: F.transform(c["errors"], lambda e: F.concat(F.coalesce(c["id"], F.lit("?")), F.lit(": "), e))))
    # Only messages with calls or results take part in a join; plain text passes by.
    of_result = links.select(F.col("result_row").alias("row"), "call_turn")
    got = d.where("kind = 'result'").join(of_result, "row", "left").withColumn("linked", F.col("call_turn").isNotNull())
    of_call = links.groupBy(F.col("call_row").alias("row")).agg(F.count("*").alias("hits"))
    made = d.where("kind = 'call'").join(of_call, "row", "left").withColumn("linked", F.coalesce("hits", F.lit(0)) == F.size("calls"))
    plain = d.where("kind = 'text'").withColumn("linked", F.lit(None).cast("boolean"))
    out = plain.unionByName(got, True).unionByName(made, True)
    return out.select(
        F.col("conv").alias(conv), F.col("turn").alias(turn), F.col("role").alias(role), "kind",
        F.when(F.col("turn").isNotNull(), F.greatest("turn", "call_turn")).alias("order_turn"), F.when(F.col("kind") == "result", 1).otherwise(0).alias("order_step"),
        "linked", errors.alias("call_errors"), "json",
    )
