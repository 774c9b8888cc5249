"""Chat formatting: tool calls linked to their results, ordered by what they depend on, checked and serialised."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.arrow import map_text
from larder.session import configure, settle

_TYPES: dict[str, Callable[[object], bool]] = {
    "object": lambda v: isinstance(v, dict), "array": lambda v: isinstance(v, list), "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool), "null": lambda v: v is None,
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "integer": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool) and v == int(v),
}


def canonical(value: object) -> str:
    """JSON with sorted keys, no spaces, characters as they are, and whole numbers without a fraction."""
    def plain(v):
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        if isinstance(v, list):
            return [plain(x) for x in v]
        return int(v) if isinstance(v, float) and v == int(v) and abs(v) < 2**53 else v

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def parsed(text: str | None) -> object:
    """The value of a JSON text; ValueError if it is none, or holds NaN or an infinity."""
    def refuse(name: str):
        raise ValueError(name)

    def number(digits: str) -> float:
        value = float(digits)
        if not math.isfinite(value):
            raise ValueError(digits)
        return value

    return json.loads(text or "", parse_constant=refuse, parse_float=number)


def schema_errors(value: object, schema: dict, at: str = "$") -> list[str]:
    """What in a value goes against a JSON schema (types, enum, bounds, lengths, pattern, items, properties).

    A reference to another call's result, {"$ref": id}, stands for a value of any type.
    """
    if isinstance(value, dict) and set(value) == {"$ref"} and isinstance(value["$ref"], str):
        return []
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_TYPES[k](value) for k in kinds):
        return [f"{at}: not of type {' or '.join(kinds)}"]
    errors = []
    if "enum" in schema and value not in schema["enum"]:
        errors.append(f"{at}: not one of the values allowed")
    if _TYPES["number"](value):
        if value < schema.get("minimum", value):
            errors.append(f"{at}: below {schema['minimum']}")
        if value > schema.get("maximum", value):
            errors.append(f"{at}: above {schema['maximum']}")
    if isinstance(value, (str, list)):
        low, high = ("minLength", "maxLength") if isinstance(value, str) else ("minItems", "maxItems")
        if not schema.get(low, 0) <= len(value) <= schema.get(high, len(value)):
            errors.append(f"{at}: length {len(value)}")
    if isinstance(value, str) and "pattern" in schema and not re.search(schema["pattern"], value):
        errors.append(f"{at}: does not match the pattern")
    if isinstance(value, list) and "items" in schema:
        errors += [e for k, x in enumerate(value) for e in schema_errors(x, schema["items"], f"{at}[{k}]")]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        errors += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k, x in value.items():
            if k in known:
                errors += schema_errors(x, known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                errors.append(f"{at}.{k}: not allowed")
    return errors


def references(value: object) -> list[str]:
    """Ids of the calls whose results a value refers to."""
    if isinstance(value, dict):
        if set(value) == {"$ref"} and isinstance(value["$ref"], str):
            return [value["$ref"]]
        value = list(value.values())
    return sorted({r for x in value for r in references(x)}) if isinstance(value, list) else []


def _checked(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    def work(batch: pa.RecordBatch) -> dict:
        texts, errors, refs = [], [], []
        for name, text in zip(batch.column("name").to_pylist(), batch.column("arguments").to_pylist()):
            try:
                value = parsed(text)
                written = canonical(value)
                written.encode()  # an escaped half of a surrogate pair is no character
                wrong = schema_errors(value, schemas[name]) if name in schemas else [f"unknown tool {name}"]
                needs = references(value)
            except (ValueError, RecursionError):  # no JSON, or nested more deeply than can be followed
                written, wrong, needs = canonical(text or ""), ["$: no JSON"], []
            texts.append(written)
            errors.append(wrong)
            refs.append(needs)
        return dict(enumerate([*[batch.column(c) for c in ("conv", "turn", "place", "id", "name")], texts, errors, refs]))

    return settle(map_text(calls, work, "conv long, turn long, place long, id string, name string, arguments string, "
                                        "errors array<string>, refs array<string>", "arguments"), "calls")


def _later_dependencies(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows (conv, id, at, depth, cyclic) for the calls of conversations in which a call refers to a later result.

    A call is put at the turn of the last result it needs, ``depth`` counts calls put at one turn one after the
    other. Round by round those calls are placed whose needs are all placed; where none can be, the rest hangs
    on a cycle and stays at its own turn.
    """
    late = edges.filter("ready >= turn").select("conv").distinct()
    pending = settle(nodes.join(late, "conv", "left_semi"), "pending")
    edges = settle(edges.join(late, "conv", "left_semi"), "needs")
    placed = pending.select("conv", "id", F.col("turn").alias("at"), F.lit(0).alias("depth"), F.lit(False).alias("cyclic")).limit(0)
    while not pending.isEmpty():
        done = placed.select("conv", F.col("id").alias("ref"), F.col("at").alias("ref_at"), F.col("depth").alias("ref_depth"))
        open_edges = edges.join(done, ["conv", "ref"], "left_anti").select("conv", "id")
        free = pending.join(open_edges, ["conv", "id"], "left_anti")
        needs = edges.join(done, ["conv", "ref"]).groupBy("conv", "id").agg(F.max(F.struct(
            F.greatest("ready", "ref_at").alias("at"), (F.col("ref_depth") + 1).alias("depth"))).alias("need"))
        own = F.struct(F.col("turn").alias("at"), F.lit(0).alias("depth"))
        fresh = settle(free.join(needs, ["conv", "id"], "left").select(
            "conv", "id", F.greatest(own, F.coalesce("need", own)).alias("x")).select(
            "conv", "id", "x.at", "x.depth", F.lit(False).alias("cyclic")), "placed")
        if fresh.isEmpty():
            fresh = pending.select("conv", "id", F.col("turn").alias("at"), F.lit(0).alias("depth"), F.lit(True).alias("cyclic"))
        placed = settle(placed.unionAll(fresh), "placed")
        pending = settle(pending.join(placed, ["conv", "id"], "left_anti"), "pending")
    return placed


def link_tool_calls(messages: DataFrame, calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per message, call and result, in an order given by (conv_id, at, depth, part, turn, place).

    ``messages`` has conv_id, turn, role, text; ``calls`` conv_id, turn, place, call_id, name, arguments (JSON);
    ``results`` conv_id, turn, place, call_id, content; ``schemas`` a JSON schema for every tool. Calls and results
    are joined by conversation and identifier. A call follows the results it refers to ({"$ref": call id} among its
    arguments), and a result follows its call; all else stays at its turn. ``part`` is 0 for a message, 1 for a call,
    2 for a result; ``json`` is canonical.

    ``status``: message; linked; no_result (a call nobody answers); orphan (a result nobody asked for); duplicate
    (all but the first of an identifier, by turn and place; fully equal rows rank alike); no_id (null identifier or
    conversation); cycle. ``errors`` lists faults of the arguments and references to unknown calls; text that is no
    JSON is serialised as a string. Null texts become empty ones, null roles "user"; other columns are left out.
    Rows are never gathered by conversation, so one conversation may hold any share of them.
    """
    spark = configure(messages.sparkSession)
    number = lambda c: F.col(c).cast("long")
    asked = _checked(calls.select(number("conv_id").alias("conv"), number("turn").alias("turn"), number("place").alias("place"),
                                  F.col("call_id").alias("id"), "name", "arguments"), schemas)
    answers = results.select(number("conv_id").alias("conv"), number("turn").alias("turn"), number("place").alias("place"),
                             F.col("call_id").alias("id"), "content")
    spot = F.struct("turn", "place")
    first_call = asked.filter("conv IS NOT NULL AND id IS NOT NULL").groupBy("conv", "id").agg(F.min(spot).alias("call"))
    first_answer = answers.filter("conv IS NOT NULL AND id IS NOT NULL").groupBy("conv", "id").agg(F.min(spot).alias("answer"))
    links = settle(first_call.join(first_answer, ["conv", "id"], "full"), "links")
    known = links.filter("call IS NOT NULL")
    mine = asked.join(known.select("conv", "id", "call"), ["conv", "id"]).filter(spot.eqNullSafe(F.col("call")))
    wanted = mine.select("conv", "id", "turn", F.explode("refs").alias("ref")).distinct()
    targets = known.select("conv", F.col("id").alias("ref"), F.greatest("call.turn", "answer.turn").alias("ready"))
    found = settle(wanted.join(targets, ["conv", "ref"], "left").withColumn("known", F.col("ready").isNotNull()), "references")
    order = _later_dependencies(known.select("conv", "id", "call.turn"), found.filter("known").drop("known"))
    unknown = found.filter("NOT known").groupBy("conv", "id").agg(F.array_sort(F.collect_list(
        F.concat(F.lit("unknown call "), F.col("ref")))).alias("lost"))

    # an identifier's calls and results get their places from one small row
    plan = settle(links.join(order, ["conv", "id"], "left").join(unknown, ["conv", "id"], "left"), "plan")
    at, depth = F.coalesce("at", "call.turn"), F.coalesce("depth", F.lit(0))
    call_first = spot.eqNullSafe(F.col("call"))
    call_rows = asked.join(plan, ["conv", "id"], "left").select(
        "conv", F.coalesce(F.when(call_first, at), F.col("turn")).alias("at"), F.when(call_first, depth).otherwise(0).alias("depth"),
        F.lit(1).alias("part"), "turn", "place", "id",
        F.when(F.col("conv").isNull() | F.col("id").isNull(), "no_id").when(~call_first, "duplicate").when(F.col("cyclic"), "cycle")
        .when(F.col("answer").isNull(), "no_result").otherwise("linked").alias("status"),
        F.when(call_first, F.concat("errors", F.coalesce("lost", F.array().cast("array<string>")))).otherwise(F.col("errors")).alias("errors"),
        "name", F.col("arguments").alias("body"))
    answer_first = spot.eqNullSafe(F.col("answer")) & F.col("call").isNotNull()
    after = F.greatest(F.struct(F.col("turn").alias("at"), F.lit(0).alias("depth")), F.struct(at.alias("at"), depth.alias("depth")))
    none = F.array().cast("array<string>")
    answer_rows = answers.join(plan, ["conv", "id"], "left").select(
        "conv", F.when(answer_first, after["at"]).otherwise(F.col("turn")).alias("at"),
        F.when(answer_first, after["depth"]).otherwise(0).alias("depth"), F.lit(2).alias("part"), "turn", "place", "id",
        F.when(F.col("conv").isNull() | F.col("id").isNull(), "no_id").when(F.col("call").isNull(), "orphan")
        .when(~answer_first, "duplicate").otherwise("linked").alias("status"), none.alias("errors"), F.lit("tool").alias("name"),
        F.col("content").alias("body"))
    message_rows = messages.select(
        number("conv_id").alias("conv"), number("turn").alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("part"),
        number("turn").alias("turn"), F.lit(0).cast("long").alias("place"), F.lit(None).cast("string").alias("id"),
        F.lit("message").alias("status"), none.alias("errors"), F.coalesce("role", F.lit("user")).alias("name"),
        F.col("text").alias("body"))
    del spark

    def write(batch: pa.RecordBatch) -> dict:
        out = []
        for part, ident, name, body in zip(*(batch.column(c).to_pylist() for c in ("part", "id", "name", "body"))):
            if part == 1:  # the arguments are canonical already
                head = canonical({"id": ident, "name": name, "role": "assistant", "type": "tool_call"})
                out.append(f'{{"arguments":{body},{head[1:]}')
            elif part == 2:
                out.append(canonical({"content": body or "", "role": "tool", "tool_call_id": ident}))
            else:
                out.append(canonical({"content": body or "", "role": name}))
        return dict(enumerate([*[batch.column(c) for c in ("conv", "at", "depth", "part", "turn", "place", "id", "status", "errors")], out]))

    return map_text(message_rows.unionAll(call_rows).unionAll(answer_rows), write,
                    "conv_id long, at long, depth int, part int, turn long, place long, call_id string, status string, "
                    "errors array<string>, json string", "body")
