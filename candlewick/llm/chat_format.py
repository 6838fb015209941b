"""Chat formatting: tool calls linked to results, ordered, validated and serialised.

Calls and results are hash-joined by (conversation, call identifier). A call may name the call whose result it uses; the
depth in that forest is the topological order, found by pointer doubling: each round joins every call with the call its
pointer has reached, so a chain of n calls takes log2(n) rounds, and a conversation of any length is never gathered in
one place. Calls on a cycle reach no root. Arguments are checked against the schema of the call's name, and the linked
message is written as canonical JSON (keys sorted by UTF-16 code units, no blanks, numbers with the fewest digits that give
the same double, in plain notation from 1e-6 up to 1e21). Arguments with lone surrogates are not JSON.
"""
from __future__ import annotations

import json
import math
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, table, workers_ready

_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list,
          "null": type(None)}


def _number(x: float) -> str:
    if not math.isfinite(x):
        raise ValueError("not a JSON number")
    if x == 0:
        return "0"
    d = Decimal(repr(x)).normalize()
    if 1e-6 <= abs(x) < 1e21:
        return format(d, "f")
    sign, digits, _ = d.as_tuple()
    head, rest, e = str(digits[0]), "".join(map(str, digits[1:])), d.adjusted()
    return f"{'-' * sign}{head}{'.' + rest if rest else ''}e{'+' if e > 0 else '-'}{abs(e)}"


def canonical(x) -> str:
    """Canonical JSON of a parsed value; ValueError for numbers and strings that it lacks."""
    if isinstance(x, dict):
        keys = sorted(x, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(k)}:{canonical(x[k])}" for k in keys) + "}"
    if isinstance(x, list):
        return "[" + ",".join(map(canonical, x)) + "]"
    if isinstance(x, float):
        return _number(x)
    text = json.dumps(x, ensure_ascii=False)
    if isinstance(x, str):
        text.encode()  # a ValueError for lone surrogates
    return text


def faults(value, schema: dict, at: str = "$") -> list[str]:
    """What in ``value`` breaks the schema: type, enum, minimum, maximum, minLength, maxLength, required, properties,
    additionalProperties (false) and items are checked."""
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        if not any(isinstance(value, _TYPES[k]) and (k == "boolean" or not isinstance(value, bool)) for k in kinds):
            return [f"{at}: not {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            out.append(f"{at}: below minimum")
        if value > schema.get("maximum", value):
            out.append(f"{at}: above maximum")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{at}: too short")
        if len(value) > schema.get("maxLength", len(value)):
            out.append(f"{at}: too long")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}: {k} missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += faults(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{at}: {k} not allowed")
    if isinstance(value, list) and "items" in schema:
        for k, x in enumerate(value):
            out += faults(x, schema["items"], f"{at}[{k}]")
    return out


def _write(schemas: dict[str, dict]):
    def run(batches):
        for batch in batches:
            wrong, message = [], []
            names = ("conv_id", "call_id", "name", "arguments", "after", "result", "has_call", "has_result")
            for conv, call, name, raw, after, result, has_call, has_result in zip(*(batch.column(c).to_pylist() for c in names)):
                bad, value = [], None
                if has_call:
                    try:
                        value = json.loads(raw if raw is not None else "null")
                        canonical(value)
                        bad = faults(value, schemas[name]) if name in schemas else ["$: no schema"]
                    except (ValueError, RecursionError):
                        bad, value = ["$: not JSON"], raw
                body = {"conversation": conv, "id": call}
                if has_call:
                    body["call"] = {"name": name, "arguments": value}
                    if after is not None:
                        body["call"]["after"] = after
                if has_result:
                    body["result"] = result
                wrong.append("; ".join(bad))
                message.append(canonical(body))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(wrong, pa.string()), pa.array(message, pa.string())],
                [*batch.schema.names, "faults", "message"])

    return run


def depths(calls: DataFrame) -> DataFrame:
    """calls: conv_id, call_id, after (null or a call of the same conversation) -> conv_id, call_id, depth (0 without a
    predecessor; null on or behind a cycle). A predecessor that is not a call counts as none."""
    known = calls.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("there"))
    now = calls.join(known, ["conv_id", "after"], "left").select(
        "conv_id", "call_id", F.when(F.col("there"), F.col("after")).alias("to"),
        F.when(F.col("there"), 1).otherwise(0).alias("depth"))
    now = stage(now, "depth")
    n = now.where("to is not null").count()
    for _ in range(n.bit_length() + 1 if n else 0):
        beyond = now.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("depth").alias("more"))
        now = stage(now.join(beyond, ["conv_id", "to"], "left").select(
            "conv_id", "call_id", F.col("next").alias("to"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")),
            "depth")
        if now.where("to is not null").isEmpty():
            break
    return now.select("conv_id", "call_id", F.when(F.col("to").isNull(), F.col("depth")).alias("depth"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """calls: conv_id, call_id, turn, name, arguments (JSON), after; results: conv_id, call_id, turn, result (text) -> a row
    for each identifier of a conversation: conv_id, call_id, depth (the topological order within the conversation; ties
    by turn, then call_id), turn, name, status, faults, result_turn, call_copies, result_copies, message.

    status: cycle, orphan_result (no call), no_result, invalid_arguments or ok, the first that holds. An identifier that
    repeats is one call (and one result), the least by turn, and is counted. Rows with a null conv_id or call_id take no
    part; null arguments are JSON null; a name without schema is a fault. Other columns are ignored; empty tables give
    what the other one implies.
    """
    workers_ready(calls.sparkSession)
    key = ["conv_id", "call_id"]
    usable = "conv_id is not null and call_id is not null"
    calls = calls.where(usable).groupBy(*key).agg(
        F.min(F.struct("turn", "name", "arguments", "after")).alias("c"), F.count("*").alias("call_copies"))
    calls = stage(calls.select(*key, "c.*", "call_copies"), "calls")
    results = results.where(usable).groupBy(*key).agg(
        F.min(F.struct("turn", "result")).alias("r"), F.count("*").alias("result_copies"))
    results = results.select(*key, F.col("r.turn").alias("result_turn"), "r.result", "result_copies")
    calls = calls.join(depths(calls.select(*key, "after")), key)
    both = calls.join(results, key, "full")
    both = both.withColumn("has_call", F.col("call_copies").isNotNull()).withColumn(
        "has_result", F.col("result_copies").isNotNull())
    types = {f.name: f.dataType.simpleString() for f in both.schema.fields}
    out = both.mapInArrow(_write(schemas), ", ".join(f"`{c}` {t}" for c, t in types.items()) +
                          ", faults string, message string")
    status = (F.when(F.col("has_call") & F.col("depth").isNull(), "cycle").when(~F.col("has_call"), "orphan_result")
              .when(~F.col("has_result"), "no_result").when(F.col("faults") != "", "invalid_arguments").otherwise("ok"))
    zero = F.lit(0).cast("long")
    return out.select(*key, "depth", "turn", "name", status.alias("status"), "faults", "result_turn",
                      F.coalesce("call_copies", zero).alias("call_copies"),
                      F.coalesce("result_copies", zero).alias("result_copies"), "message")


#: Schemas of the calls that ``turns_as_calls`` makes.
SCHEMAS = {
    "reply": {"type": "object", "required": ["prompt", "turn", "words"], "additionalProperties": False,
              "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0},
                             "words": {"type": "integer", "minimum": 1, "maximum": 200}}},
    "configure": {"type": "object", "required": ["prompt", "turn"],
                  "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "enum": [0]}}},
}


def turns_as_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations: each user turn calls reply and each system turn calls configure, with
    the turn as identifier and the call two turns before as predecessor; an assistant turn is the result of the call in
    the turn before."""
    asked = turns.where("role in ('user', 'system')")
    words = F.when(F.col("role") == "user", F.size(F.split(F.trim("text"), " +")))
    calls = asked.select(
        "conv_id", F.concat(F.lit("turn-"), F.col("turn")).alias("call_id"), "turn",
        F.when(F.col("role") == "user", "reply").otherwise("configure").alias("name"),
        F.to_json(F.struct(F.col("turn"), F.col("text").alias("prompt"), words.alias("words"))).alias("arguments"),
        F.concat(F.lit("turn-"), F.col("turn") - 2).alias("after"))
    results = turns.where("role = 'assistant'").select(
        "conv_id", F.concat(F.lit("turn-"), F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("result"))
    return calls, results


def op1(spark, sf_dir) -> DataFrame:
    calls, results = turns_as_calls(table(spark, sf_dir, "conversations"))
    return link_calls(calls, results, SCHEMAS)
