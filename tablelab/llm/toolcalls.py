"""Chat formatting with linked tool calls, one canonical JSON object per message.

Calls and results are joined by identifier, ordered so that whatever a call
depends on stands before it, validated against the tool's schema and written
as canonical JSON (keys in code-point order, no blanks, shortest escapes).
Messages stay rows of their own: no task or object ever holds a conversation.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.llm.common import mapped, pick, stored

MESSAGE, CALL, RESULT = "message", "call", "result"
REFERENCE = "$ref"


def canonical(value) -> str:
    """JSON with sorted keys and no blanks; whole floats as integers, so equal values have one form."""

    def plain(x):
        if isinstance(x, dict):
            return {str(k): plain(v) for k, v in x.items()}
        if isinstance(x, list):
            return [plain(v) for v in x]
        if isinstance(x, float):
            if not math.isfinite(x):
                raise ValueError("JSON has no such number")
            return int(x) if x.is_integer() and abs(x) < 2**53 else x
        return x

    return escaped(json.dumps(plain(value), sort_keys=True, ensure_ascii=False, separators=(",", ":"), allow_nan=False))


def escaped(text: str) -> str:
    """Surrogates without a partner, which no UTF-8 text can hold, as JSON escapes."""
    return _SURROGATE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def problems(value, schema: Mapping, path: str = "$") -> list[str]:
    """What in ``value`` breaks the schema: type, enum, const, required, properties, additionalProperties, items, ranges, lengths, pattern."""
    kinds = {"string": str, "integer": int, "number": (int, float), "object": dict, "array": list, "boolean": bool, "null": type(None)}
    wanted = schema.get("type")
    if wanted is not None:
        options = wanted if isinstance(wanted, list) else [wanted]
        fits = any(isinstance(value, kinds[o]) and not (o in ("integer", "number") and isinstance(value, bool)) or (o == "integer" and isinstance(value, float) and value.is_integer()) for o in options)
        if not fits:
            return [f"{path}: not {'/'.join(options)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path}: not in enum")
    if "const" in schema and value != schema["const"]:
        out.append(f"{path}: not const")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{path}: too short")
        if len(value) > schema.get("maxLength", math.inf):
            out.append(f"{path}: too long")
        if "pattern" in schema and not re.search(schema["pattern"], value):
            out.append(f"{path}: pattern")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", -math.inf) or value > schema.get("maximum", math.inf):
            out.append(f"{path}: out of range")
    if isinstance(value, list):
        if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", math.inf):
            out.append(f"{path}: number of items")
        for i, x in enumerate(value):
            out += problems(x, schema.get("items", {}), f"{path}[{i}]")
    if isinstance(value, dict):
        own = schema.get("properties", {})
        out += [f"{path}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        for k in sorted(value):
            if k in own:
                out += problems(value[k], own[k], f"{path}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{path}.{k}: unknown")
    return out


def references(value) -> list[str]:
    """Identifiers of calls whose results the arguments name by ``{"$ref": id}``."""
    if isinstance(value, dict):
        if set(value) == {REFERENCE} and isinstance(value[REFERENCE], str):
            return [value[REFERENCE]]
        return [r for k in sorted(value) for r in references(value[k])]
    return [r for v in value for r in references(v)] if isinstance(value, list) else []


_SURROGATE = re.compile("[\ud800-\udfff]")
CHECKED = "turn long, kind string, role string, name string, call_id string, content string, arguments string, needs array<string>, errors array<string>"


def checked(messages: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """Messages with canonical arguments, the calls they need, and what is wrong with them."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        arguments, needs, errors = [], [], []
        for kind, name, call, given in zip(*[batch.column(c).to_pylist() for c in ("kind", "name", "call_id", "arguments")]):
            text, wants, wrong = None, [], []
            if kind != MESSAGE and not call:
                wrong.append("no identifier")
            if kind == CALL:
                try:
                    value = json.loads(given or "")
                    text, wants = canonical(value), sorted(set(map(escaped, references(value))))
                    wrong += map(escaped, problems(value, schemas[name])) if name in schemas else ["unknown tool"]
                except (ValueError, RecursionError):
                    text = None
                    wrong.append("arguments are no JSON")
            arguments.append(text)
            needs.append(wants)
            errors.append(wrong)
        keep = [batch.column(c) for c in ("conv_id", "turn", "kind", "role", "name", "call_id", "content")]
        return pa.RecordBatch.from_arrays(
            [*keep, pa.array(arguments, pa.string()), pa.array(needs, pa.list_(pa.string())), pa.array(errors, pa.list_(pa.string()))],
            names=["conv_id", "turn", "kind", "role", "name", "call_id", "content", "arguments", "needs", "errors"],
        )

    rows = pick(messages, **{c: c for c in ("conv_id", "turn", "kind", "role", "name", "call_id", "content", "arguments")})
    rows = rows.withColumns({"turn": F.col("turn").try_cast("long"), "kind": F.coalesce("kind", F.lit(MESSAGE))})
    return mapped(rows, step, T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(CHECKED).fields]), "content")


def levels(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """conv_id, call_id, level: topological order by peeling off calls whose needs are all placed.

    ``edges`` are (conv_id, call_id, need). One round per level; a round joins
    the open edges with the calls placed last, so work falls as calls are
    placed. Calls on or behind a cycle get no level.
    """
    edges = stored(edges.select("conv_id", "call_id", "need").distinct(), "needs")
    waiting = edges.select("conv_id", "call_id").distinct()
    placed = stored(calls.select("conv_id", "call_id").distinct().join(waiting, ["conv_id", "call_id"], "left_anti").withColumn("level", F.lit(0)), "level")
    done, level = placed, 0
    while not edges.isEmpty():
        ready = placed.select("conv_id", F.col("call_id").alias("need"))
        left = stored(edges.join(ready, ["conv_id", "need"], "left_anti"), "needs")
        freed = edges.select("conv_id", "call_id").distinct().join(left.select("conv_id", "call_id").distinct(), ["conv_id", "call_id"], "left_anti")
        level += 1
        placed = stored(freed.withColumn("level", F.lit(level)), "level")
        if placed.isEmpty():
            break
        done, edges = done.unionByName(placed), left
    return done


def link(messages: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """Per message: conv_id, turn, kind, call_id, linked, level, valid, errors, json.

    Messages have conv_id, turn, kind (message, call, result), role, name,
    call_id, content, arguments (JSON text of a call). A call and a result are
    linked when the conversation holds both for one identifier. Of several
    calls, or results, with one identifier the one of the least turn counts
    (of one turn, the least content); others are errors and unlinked. A result
    before its call, a needed call that is missing, and a cycle are errors.
    A conv_id may be of any type; a turn that is no whole number counts as null.

    ``level`` orders a conversation: needs first, then turn. Where every need
    stands earlier by turn the turns are in order already and level is 0;
    other conversations get levels by need, a result that of its call; null on
    or behind a cycle. A plain message has level 0. Null contents become null
    in JSON; a null conv_id or call_id links with nothing. Empty tables give
    no rows. Identical rows stay, the further ones as repeats.
    """
    rows = stored(checked(messages, schemas), "checked")
    keyed = rows.where("kind IN ('call', 'result') AND call_id IS NOT NULL AND call_id <> '' AND conv_id IS NOT NULL")
    first = F.min(F.struct("turn", F.xxhash64("content", "arguments", "name").alias("h")))
    # Partial minima combine before the shuffle, whatever the number of repeats.
    chosen = keyed.groupBy("conv_id", "call_id", "kind").agg(first.alias("first"), F.count(F.lit(1)).alias("copies"))
    pairs = chosen.groupBy("conv_id", "call_id").agg(
        F.min(F.when(F.col("kind") == CALL, F.col("first"))).alias("call"), F.min(F.when(F.col("kind") == RESULT, F.col("first"))).alias("result"),
        F.max(F.when(F.col("kind") == CALL, F.col("copies"))).alias("calls"), F.max(F.when(F.col("kind") == RESULT, F.col("copies"))).alias("results"),
    )
    pairs = stored(pairs, "pairs")
    calls = pairs.where("call IS NOT NULL").select("conv_id", "call_id", F.col("call.turn").alias("call_turn"))
    wants = keyed.where(f"kind = '{CALL}' AND size(needs) > 0").join(pairs.select("conv_id", "call_id", "call"), ["conv_id", "call_id"])
    wants = wants.where(F.col("call.turn").eqNullSafe(F.col("turn")) & (F.col("call.h") == F.xxhash64("content", "arguments", "name")))
    wants = wants.select("conv_id", "call_id", "turn", F.explode("needs").alias("need"))
    held = calls.select("conv_id", F.col("call_id").alias("need"), F.col("call_turn").alias("need_turn"))
    wants = stored(wants.join(held, ["conv_id", "need"], "left"), "wants")
    lacking = wants.where("need_turn IS NULL").groupBy("conv_id", "call_id").agg(F.lit(True).alias("lacks"))
    edges = wants.where("need_turn IS NOT NULL")
    # Only conversations with a need at a later turn are put in another order than that of their turns.
    crossed = stored(edges.where("need_turn >= turn").select("conv_id").distinct(), "crossed")
    some = calls.join(crossed, "conv_id", "left_semi")
    placed = levels(some, edges.join(crossed, "conv_id", "left_semi")).withColumnRenamed("level", "placed")
    facts = pairs.join(lacking, ["conv_id", "call_id"], "left").join(placed, ["conv_id", "call_id"], "left")
    facts = facts.join(crossed.withColumn("crossed", F.lit(True)), "conv_id", "left")
    facts = stored(facts, "facts")
    out = rows.join(facts, ["conv_id", "call_id"], "left")
    me = F.struct("turn", F.xxhash64("content", "arguments", "name").alias("h"))
    is_call, is_result = F.col("kind") == CALL, F.col("kind") == RESULT
    chosen_one = F.when(is_call, F.col("call").eqNullSafe(me)).when(is_result, F.col("result").eqNullSafe(me)).otherwise(False)
    both = F.col("call").isNotNull() & F.col("result").isNotNull()
    named = F.coalesce(F.col("call_id") != "", F.lit(False)) & F.col("conv_id").isNotNull()
    wrong = F.array_compact(
        F.array(
            F.when((is_call | is_result) & named & ~chosen_one, F.lit("repeated identifier")),
            F.when((is_call & (F.col("calls") > 1) | is_result & (F.col("results") > 1)) & chosen_one, F.lit("identifier used again")),
            F.when(is_call & named & F.col("result").isNull(), F.lit("no result")),
            F.when(is_result & named & F.col("call").isNull(), F.lit("no call")),
            F.when(is_result & chosen_one & both & (F.col("result.turn") < F.col("call.turn")), F.lit("result before call")),
            F.when(is_call & chosen_one & F.col("lacks"), F.lit("needed call is missing")),
            F.when(is_call & chosen_one & F.col("crossed") & F.col("placed").isNull(), F.lit("cycle")),
        )
    )
    errors = F.concat("errors", wrong)
    level = F.when((is_call | is_result) & F.col("crossed"), F.col("placed")).otherwise(0)
    out = out.select(
        "conv_id", "turn", "kind", "role", "name", "call_id", "content", "arguments", "needs",
        F.coalesce(chosen_one & both, F.lit(False)).alias("linked"), level.cast("int").alias("level"), (F.size(errors) == 0).alias("valid"), errors.alias("errors"),
    )
    return written(out)


def written(rows: DataFrame) -> DataFrame:
    """Adds ``json`` and drops what it holds."""
    kept = ("conv_id", "turn", "kind", "call_id", "linked", "level", "valid", "errors")
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField("json", T.StringType())])

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for kind, role, name, call, content, given in zip(*[batch.column(c).to_pylist() for c in ("kind", "role", "name", "call_id", "content", "arguments")]):
            if kind == CALL:
                # Arguments are canonical already, however deep: they are put in as they stand, the keys in order.
                body = {"role": role or "assistant"} | ({} if content is None else {"content": content})
                function = f'{{"arguments":{"null" if given is None else given},"name":{canonical(name)}}}'
                calls = f'"tool_calls":[{{"function":{function},"id":{canonical(call)},"type":"function"}}]'
                out.append(f"{canonical(body)[:-1]},{calls}}}")
                continue
            if kind == RESULT:
                body = {"role": role or "tool", "tool_call_id": call, "content": content}
            else:
                body = {"role": role, "content": content}
            out.append(canonical(body))
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(out, pa.string())], names=schema.names)

    return mapped(rows, step, schema, "content")


#: Tools that :func:`from_turns` derives, with the schemas of their arguments.
TURN_SCHEMAS = {
    "reply": {
        "type": "object",
        "required": ["prompt", "turn"],
        "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}, "context": {"type": "object"}},
        "additionalProperties": False,
    }
}


def from_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages of a plain conversation table: each user turn calls the tool ``reply``, the next turn's assistant text is its result.

    A call names the turn before it as context. Identifiers are
    ``conversation:turn`` of the user's turn. Other turns are plain messages.
    """
    rows = pick(turns, conv_id=conv_id, turn=turn, role=role, text=text).withColumn("turn", F.col("turn").try_cast("long"))
    user, answer = F.col("role") == "user", F.col("role") == "assistant"
    name = lambda back: F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - back).cast("string"))
    context = F.when(F.col("turn") >= 2, F.struct(name(2).alias(REFERENCE)))
    arguments = F.to_json(F.struct(context.alias("context"), F.col("text").alias("prompt"), F.col("turn").alias("turn")))
    return rows.select(
        F.col("conv_id"), F.col("turn"),
        F.when(user, CALL).when(answer, RESULT).otherwise(MESSAGE).alias("kind"),
        F.when(user, "assistant").when(answer, "tool").otherwise(F.col("role")).alias("role"),
        F.when(user, "reply").alias("name"),
        F.when(user, name(0)).when(answer, name(1)).alias("call_id"),
        F.when(~user | F.col("role").isNull(), F.col("text")).alias("content"),
        F.when(user, arguments).alias("arguments"),
    )
