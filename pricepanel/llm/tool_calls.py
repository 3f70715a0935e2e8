"""Chat formatting: link tool calls to their results.

Messages (conv_id, turn, role, text) of role ``tool_call`` hold JSON
``{"id", "name", "arguments", "depends_on"?}`` (``depends_on`` an identifier or a
list of them), those of role ``tool_result`` ``{"tool_call_id", "content"}``.
Calls and results are hash-joined by conversation and identifier; a call's place
in the topological order is its longest way from a call without dependency
(``level``), ties by turn and identifier; arguments are validated against the
tool's JSON schema; every linked pair is serialised as canonical JSON.

Levels come from an edge table, a bounded number of joins a round, all on the key
(conversation, identifier), so one very long conversation spreads over all tasks.
A round drops the edges that a way over the last of a call's dependencies makes
redundant, resolves the edges to calls that have no edge left, and lets edges to
calls with one edge left jump over them (their distance and their level so far
add up). So a chain of n calls takes about log2(n) rounds, calls that depend on
several branches a round for each layer of branches. Calls that still have edges
when a round resolves none are on, or behind, a cycle.

Canonical JSON: keys sorted by code points, no blanks, UTF-8; numbers written
without fraction or exponent stay as they are, digit by digit; other numbers are
doubles in their shortest form, those without a fraction below 2**53 written as
integers (so 1.0 and 1 are the same, and -0.0 is 0). Of equal keys the last counts.

Statuses, the first that applies: ``malformed`` (text is no JSON object or lacks a
key, null and empty texts too; also what JSON or UTF-8 cannot hold: numbers beyond
a double, NaN, halves of surrogate pairs, nesting beyond Python's limit; ``errors``
says which), ``duplicate`` (not the first row of its identifier, by turn),
``orphan`` (a result without a call), ``cycle``, ``unknown_dependency``,
``unknown_tool``, ``invalid_arguments``, ``unanswered``, ``linked``. Every call and
every result that linked to none gives one row; messages of other roles none. Null
conversation ids are a conversation of their own; repeated rows are duplicates of
each other, and of equal turns the lesser text is the first; other columns are not
read.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, kept_table, scratch

_TYPES = {"string": str, "object": dict, "array": list, "boolean": bool, "null": type(None)}
_CALL = "id string, name string, depends_on array<string>, payload string, errors array<string>, fine boolean"
_FAR = 1 << 40  # a distance no chain has: those of cycles stop there


class Malformed(ValueError):
    """A message that is not what its role asks for; says why."""


def _plain(value):
    """Numbers in their canonical form."""
    if isinstance(value, float):
        return int(value) if value.is_integer() and abs(value) < 1 << 53 else value
    if isinstance(value, list):
        return [_plain(x) for x in value]
    if isinstance(value, dict):
        return {k: _plain(x) for k, x in value.items()}
    return value


def canonical(value) -> str:
    return json.dumps(_plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _fits(value, kind: str) -> bool:
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if kind == "integer":
        return number and (isinstance(value, int) or value.is_integer())
    if kind == "number":
        return number
    return kind in _TYPES and isinstance(value, _TYPES[kind])


def validate(value, schema: dict, at: str = "$") -> list[str]:
    """Violations of a JSON schema (type or list of types, enum, required, properties, additionalProperties, items,
    bounds)."""
    kind = schema.get("type")
    kinds = kind if isinstance(kind, list) else [kind]
    if kind is not None and not any(_fits(value, k) for k in kinds):
        return [f"{at}: not of type {' or '.join(map(str, kinds))}"]
    out = []
    if "enum" in schema and canonical(value) not in {canonical(x) for x in schema["enum"]}:
        out.append(f"{at}: not one of the allowed values")
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        out.append(f"{at}: too short")
    if _fits(value, "number") and value < schema.get("minimum", -math.inf):
        out.append(f"{at}: below the minimum")
    if _fits(value, "number") and value > schema.get("maximum", math.inf):
        out.append(f"{at}: above the maximum")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += validate(x, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += validate(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{at}.{k}: not allowed")
    return out


def _double(text: str) -> float:
    value = float(text)
    if not math.isfinite(value):
        raise Malformed(f"number beyond a double: {text[:40]}")
    return value


def _no_constant(text: str):
    raise Malformed(f"not a JSON number: {text}")


def _object(text) -> dict:
    if text is None or not text.strip():
        raise Malformed("no text")
    try:
        value = json.loads(text, parse_constant=_no_constant, parse_float=_double)
        canonical(value).encode()  # what cannot be written back is not read
    except Malformed:
        raise
    except UnicodeEncodeError as e:
        raise Malformed("half of a surrogate pair") from e
    except RecursionError as e:
        raise Malformed("nested too deeply") from e
    except ValueError as e:  # among them integers beyond the digits Python reads
        raise Malformed("no JSON") from e
    if not isinstance(value, dict):
        raise Malformed("no JSON object")
    return value


def _text(message: dict, key: str) -> str:
    if not isinstance(message.get(key), str) or not message[key]:
        raise Malformed(f"no {key}")
    return message[key]


def _read_call(text, schemas: dict) -> tuple:
    call = _object(text)
    id_, name, needs = _text(call, "id"), _text(call, "name"), call.get("depends_on")
    needs = [] if needs is None else [needs] if isinstance(needs, str) else needs
    if "arguments" not in call:
        raise Malformed("no arguments")
    if not isinstance(needs, list) or not all(isinstance(x, str) for x in needs):
        raise Malformed("depends_on names no calls")
    arguments = call["arguments"]
    if isinstance(arguments, str):  # some clients send the arguments as JSON in a string
        try:
            arguments = _object(arguments)
        except Malformed:
            pass
    schema = schemas.get(name)
    try:
        errors = None if schema is None else validate(arguments, schema)
    except RecursionError as e:
        raise Malformed("nested too deeply") from e
    return id_, name, sorted(set(needs)), canonical({"arguments": arguments, "id": id_, "name": name}), errors, True


def _read_result(text) -> tuple:
    result = _object(text)
    if "content" not in result:
        raise Malformed("no content")
    return _text(result, "tool_call_id"), None, [], canonical(result["content"]), [], True


def _read(role: str, text, schemas: dict) -> tuple:
    try:
        return _read_call(text, schemas) if role == "tool_call" else _read_result(text)
    except Malformed as e:
        return None, None, [], None, [str(e).encode("utf-8", "replace").decode()], False


def parsed(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """conv, turn, kind (call, result), ord (order key) and the parsed fields of every tool message."""

    @F.pandas_udf(_CALL)
    def read(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        names = ["id", "name", "depends_on", "payload", "errors", "fine"]
        for roles, texts in batches:
            yield pd.DataFrame([_read(r, t, schemas) for r, t in zip(roles, texts)], columns=names).astype(object)

    rows = messages.where(F.col("role").isin("tool_call", "tool_result")).select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), "conv_id", "turn", "role",
        F.col("text").cast("string").alias("text"))
    return (rows.withColumn("m", read("role", "text"))
            .select("conv", "conv_id", "turn", F.substring("role", 6, 6).alias("kind"),
                    F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"), "m.*"))


def _levels(calls: DataFrame, folder: str) -> DataFrame:
    """conv, id, level, cyclic, dangling of unique calls (conv, id, turn, depends_on)."""
    there = calls.select("conv", F.col("id").alias("dep"), F.struct("turn", "id").alias("ord"))
    asked = calls.select("conv", "id", F.explode("depends_on").alias("dep")).join(there, ["conv", "dep"], "left")
    asked = kept_table(asked, folder, "asked")
    dangling = asked.where(F.col("ord").isNull()).select("conv", "id").distinct().withColumn("dangling", F.lit(True))
    nodes = calls.select("conv", "id", F.lit(0).cast("long").alias("level"))
    edges = asked.where(F.col("ord").isNotNull()).select("conv", "id", "dep", F.lit(1).cast("long").alias("far"), "ord")
    k, open_ = 0, edges.count()
    while open_:
        # an edge is redundant if the last dependency of its call reaches as far: that one's own edge stays
        top = edges.groupBy("conv", "id").agg(F.max(F.struct("ord", "dep", "far")).alias("top"))
        via = edges.select("conv", F.col("id").alias("_via"), "dep", F.col("far").alias("_far"))
        edges = (edges.join(top, ["conv", "id"]).withColumn("_via", F.col("top.dep")).join(via, ["conv", "_via", "dep"], "left")
                 .where((F.col("dep") == F.col("_via")) | F.col("_far").isNull()
                        | (F.col("top.far") + F.col("_far") < F.col("far"))).select("conv", "id", "dep", "far", "ord"))
        edges = kept_table(edges, folder, f"edges{k}")
        ahead = edges.groupBy("conv", F.col("id").alias("dep")).agg(
            F.count(F.lit(1)).alias("n"), F.first(F.struct("dep", "far", "ord")).alias("on"))
        step = edges.join(nodes.select("conv", F.col("id").alias("dep"), F.col("level").alias("_level")), ["conv", "dep"]).join(
            ahead, ["conv", "dep"], "left")
        step = kept_table(step.withColumn("n", F.coalesce("n", F.lit(0))), folder, f"step{k}")
        # what a call is known to lie above, from dependencies that are resolved or have one edge left themselves
        known = step.where("n < 2").groupBy("conv", "id").agg(F.max(F.col("far") + F.col("_level")).alias("_known"))
        nodes = kept_table(nodes.join(known, ["conv", "id"], "left").select(
            "conv", "id", F.greatest("level", F.coalesce("_known", F.lit(0))).alias("level")), folder, f"nodes{k}")
        jump = F.col("n") == 1
        edges = step.where("n > 0").select(
            "conv", "id", F.when(jump, F.col("on.dep")).otherwise(F.col("dep")).alias("dep"),
            F.least(F.when(jump, F.col("far") + F.col("on.far")).otherwise(F.col("far")), F.lit(_FAR)).alias("far"),
            F.when(jump, F.col("on.ord")).otherwise(F.col("ord")).alias("ord")).groupBy("conv", "id", "dep").agg(
            F.max("far").alias("far"), F.max("ord").alias("ord"))
        if not step.where("n = 0").limit(1).count():  # nothing was resolved: what is left are cycles
            break
        k += 1
        open_ = step.where("n > 0").limit(1).count()
    stuck = (edges if open_ else edges.limit(0)).select("conv", "id").distinct().withColumn("cyclic", F.lit(True))
    return nodes.join(stuck, ["conv", "id"], "left").join(dangling, ["conv", "id"], "left").select(
        "conv", "id", F.least("level", F.lit(_FAR)).alias("level"), F.coalesce("dangling", F.lit(False)).alias("dangling"),
        F.coalesce("cyclic", F.lit(False)).alias("cyclic"))


def _first(rows: DataFrame) -> DataFrame:
    """Marks the first row of every identifier: by turn, then text; of equal rows one."""
    best = (rows.groupBy("conv", "id").agg(F.min(F.struct("turn", "digest", "row")).alias("_best"))
            .select("conv", "id", F.col("_best.row").alias("_row")))
    return rows.join(best, ["conv", "id"], "left").withColumn("first", F.coalesce(F.col("row") == F.col("_row"),
                                                                                 F.lit(False))).drop("_row")


def link(messages: DataFrame, schemas: dict[str, dict], folder: str | None = None) -> DataFrame:
    """conv_id, call_id, kind, turn, level, status, errors, record (canonical JSON) of every call and orphan."""
    folder = folder or scratch(messages.sparkSession, "tools")
    rows = kept_table(parsed(messages, schemas), folder, "parsed")
    # numbered as read back from the written table; equal rows differ by this number only
    rows = kept_table(rows.withColumn("row", F.monotonically_increasing_id()), folder, "numbered")
    fine = rows.where("fine")
    calls = kept_table(_first(fine.where("kind = 'call'")), folder, "calls")
    results = kept_table(_first(fine.where("kind = 'result'")), folder, "results")
    one = calls.where("first")
    answer = results.where("first").select("conv", "id", F.col("payload").alias("content"), F.lit(True).alias("answered"))
    placed = one.join(_levels(one, folder), ["conv", "id"]).join(answer, ["conv", "id"], "left")
    record = F.concat(F.lit('{"call":'), F.col("payload"), F.lit(',"result":'), F.coalesce("content", F.lit("null")),
                      F.lit("}"))
    status = (F.when(F.col("cyclic"), "cycle").when(F.col("dangling"), "unknown_dependency")
              .when(F.col("errors").isNull(), "unknown_tool").when(F.size("errors") > 0, "invalid_arguments")
              .when(F.col("answered").isNull(), "unanswered").otherwise("linked"))
    no = lambda kind: F.lit(None).cast(kind)
    linked = placed.select("conv_id", F.col("id").alias("call_id"), "kind", "turn",
                           F.when(~F.col("cyclic"), F.col("level")).alias("level"), status.alias("status"),
                           F.coalesce("errors", F.array().cast("array<string>")).alias("errors"), record.alias("record"))

    def other(frame: DataFrame, status: str) -> DataFrame:
        errors = F.col("errors") if status == "malformed" else F.array().cast("array<string>")
        return frame.select("conv_id", F.col("id").alias("call_id"), "kind", "turn", no("long").alias("level"),
                            F.lit(status).alias("status"), errors.alias("errors"),
                            F.col("payload").alias("record"))

    orphans = results.where("first").join(one.select("conv", "id"), ["conv", "id"], "left_anti")
    return (linked.unionByName(other(calls.where("not first"), "duplicate"))
            .unionByName(other(results.where("not first"), "duplicate"))
            .unionByName(other(orphans, "orphan"))
            .unionByName(other(rows.where("not fine"), "malformed")))


# Tools of the derived messages and their argument schemas.
SCHEMAS = {
    "search": {"type": "object", "required": ["query", "limit"], "additionalProperties": False,
               "properties": {"query": {"type": "string", "minLength": 1},
                              "limit": {"type": "integer", "minimum": 1, "maximum": 50}}},
    "translate": {"type": "object", "required": ["query", "target"],
                  "properties": {"query": {"type": "string"},
                                 "target": {"type": "string", "enum": ["en", "de", "fr", "es"]}}},
}


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Tool messages made from a plain chat, one of every turn: a user's turn calls a tool with its text, a turn of
    any other role answers the turn before.

    A call depends on the call of the user's turn before. Which tool and arguments follows from the text; some
    calls name a tool without schema or break the bounds, as real logs do."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("none"))
    name = lambda turn: F.concat(F.lit("call_"), conv, F.lit("_"), turn.cast("string"))
    pick = F.crc32(text.cast("binary")) % 8
    arguments = (F.when(pick < 4, F.to_json(F.struct(text.alias("query"), (F.length(text) % 60).alias("limit"))))
                 .otherwise(F.to_json(F.struct(text.alias("query"), F.element_at(
                     F.array(*map(F.lit, ("en", "de", "fr", "es", "xx"))),
                     (F.length(text) % 5 + 1).cast("int")).alias("target")))))
    tool = F.when(pick < 4, "search").when(pick < 7, "translate").otherwise("summarise")
    before = F.when(F.col("turn") >= 2, name(F.col("turn") - 2))
    call = F.to_json(F.struct(name(F.col("turn")).alias("id"), tool.alias("name"), arguments.alias("arguments"),
                              before.alias("depends_on")))
    result = F.to_json(F.struct(name(F.col("turn") - 1).alias("tool_call_id"), text.alias("content")))
    user = F.col("role").eqNullSafe("user")
    return conversations.select(
        "conv_id", "turn", F.when(user, "tool_call").otherwise("tool_result").alias("role"),
        F.when(user, call).otherwise(result).alias("text"))


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link the tool calls and results derived from every turn of ``conversations``."""
    arrow_batches(spark)
    return link(tool_messages(spark.read.parquet(f"{sf_dir}/conversations.parquet")), SCHEMAS)
