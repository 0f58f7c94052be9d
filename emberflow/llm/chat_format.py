"""Chat formatting with tool calls linked to their results (operator 4). DataFrame functions only.

Calls (conv_id, turn, call_id, name, arguments, after) and results (conv_id,
turn, call_id, content) are joined by (conv_id, call_id). ``after`` names the
call whose result a call needs; levels order the calls topologically: 0 without
a known predecessor, else one more than its level. They are found by pointer
doubling, so the joins needed grow with the logarithm of the longest chain.
Arguments are parsed, checked against the schema of the tool, and serialised as
canonical JSON: members in ascending order of names, no white space.

One line per message: calls at step 2 * level, their results at the step after;
no conversation is gathered into one row, so none needs to fit a task.
Messages that are neither (conv_id, turn, role, content) have one ``message``
line each, of status ``plain``: they link with nothing, so step and identifier
are null and the turn gives their place.

Defined cases: of several calls (results) with one identifier the first by turn
and content is linked, the others are ``duplicate``; equal repeated rows count
once, other messages as often as they come; ``unanswered`` calls have no result, ``orphan`` results no call; calls on
a cycle, or behind one, are ``cyclic`` and have no level; arguments that are no
JSON object (null, empty, malformed, repeated members) are invalid and written
as null; a null identifier links with nothing; null content and null roles are JSON null; empty
tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


@dataclass(frozen=True)
class Field:
    """A member of a tool's arguments. ``least`` and ``most`` bound numbers, or lengths of strings."""

    name: str
    kind: str  # string, integer, number, boolean, object or array
    required: bool = True
    least: float | None = None
    most: float | None = None


#: What schema_of_variant says of each kind of value.
_KINDS = {"string": "^STRING$", "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "number": r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$",
          "boolean": "^BOOLEAN$", "object": "^OBJECT", "array": "^ARRAY"}


def _field_errors(value: Column, field: Field) -> list[Column]:
    path = "$['" + field.name.replace("'", "\\'") + "']"
    member = F.try_variant_get(value, path, "variant")
    kind = F.schema_of_variant(member)
    missing = member.isNull() | (kind == "VOID")
    wrong = ~missing & ~kind.rlike(_KINDS[field.kind])
    errors = [F.when(missing, F.lit(f"{field.name}: missing"))] if field.required else []
    errors.append(F.when(wrong, F.lit(f"{field.name}: not {field.kind}")))
    if field.kind in ("string", "integer", "number"):
        amount = F.length(F.try_variant_get(value, path, "string")) if field.kind == "string" else F.try_variant_get(value, path, "double")
        if field.least is not None:
            errors.append(F.when(~missing & ~wrong & (amount < field.least), F.lit(f"{field.name}: below {field.least:g}")))
        if field.most is not None:
            errors.append(F.when(~missing & ~wrong & (amount > field.most), F.lit(f"{field.name}: above {field.most:g}")))
    return errors


def argument_errors(name: Column, arguments: Column, schemas: dict[str, list[Field]]) -> Column:
    """Array of what is wrong with arguments (a variant), empty if nothing is."""
    known = F.lit(False)
    out = []
    for tool, fields in schemas.items():
        known = known | name.eqNullSafe(tool)
        out += [F.when(name == tool, e) for f in fields for e in _field_errors(arguments, f)]
    out.append(F.when(~known, F.lit("unknown tool")))
    broken = arguments.isNull() | ~F.coalesce(F.schema_of_variant(arguments).startswith("OBJECT"), F.lit(False))
    return F.when(broken, F.array(F.lit("arguments: not an object"))).otherwise(F.array_compact(F.array(*out)))


def call_levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of distinct calls (conv_id, call_id, after); null on or behind cycles."""
    heads = calls.select("conv_id", F.col("call_id").alias("after"))
    known = calls.join(heads, ["conv_id", "after"], "left_semi").select("conv_id", "call_id", F.col("after").alias("up"))
    nodes = calls.select("conv_id", "call_id").join(known, ["conv_id", "call_id"], "left").withColumn("level", F.col("up").isNotNull().cast("long"))
    nodes = cut_lineage(nodes)
    left, limit, rounds = nodes.where("up is not null").count(), nodes.count(), 0
    while left and 2**rounds <= limit:
        above = nodes.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("level").alias("more"))
        nodes = cut_lineage(nodes.join(above, ["conv_id", "up"], "left")
                            .select("conv_id", "call_id", F.col("next").alias("up"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")))
        left, rounds = nodes.where("up is not null").count(), rounds + 1
    return nodes.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def _first(rows: DataFrame, *order: str) -> tuple[DataFrame, Column]:
    """Rows with the first of their identifier, and whether a row is it."""
    first = rows.where("call_id is not null").groupBy("conv_id", "call_id").agg(F.min(F.struct(*order)).alias("__first"))
    return rows.join(first, ["conv_id", "call_id"], "left"), F.struct(*order).eqNullSafe(F.col("__first"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, list[Field]]) -> DataFrame:
    """One line per message: conv_id, turn, kind, call_id, step, status, valid, errors, json."""
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", "after").distinct()
    results = results.select("conv_id", "turn", "call_id", "content").distinct()
    calls, call_first = _first(calls, "turn", "name", "arguments", "after")
    calls = cut_lineage(calls.withColumn("__lead", call_first).drop("__first"))
    results, result_first = _first(results, "turn", "content")
    results = cut_lineage(results.withColumn("__lead", result_first).drop("__first"))
    leads = calls.where("__lead")
    levels = call_levels(leads.select("conv_id", "call_id", "after"))
    answered = results.where("__lead").select("conv_id", "call_id", F.lit(True).alias("__answered"))
    lines = calls.join(levels, ["conv_id", "call_id"], "left").join(answered, ["conv_id", "call_id"], "left")
    variant = F.try_parse_json("arguments")
    errors = argument_errors(F.col("name"), variant, schemas)
    call_status = (F.when(F.col("call_id").isNotNull() & ~F.col("__lead"), "duplicate").when(F.col("__lead") & F.col("level").isNull(), "cyclic")
                   .when(F.col("__answered"), "linked").otherwise("unanswered"))
    member = [("arguments", F.when(~F.array_contains("errors", "arguments: not an object"), F.to_json(variant))), ("id", _string(F.col("call_id"))), ("name", _string(F.col("name"))), ("role", F.lit('"call"'))]
    call_lines = (lines.withColumn("errors", errors)
                  .select("conv_id", "turn", F.lit("call").alias("kind"), "call_id", F.when(F.col("__lead"), F.col("level") * 2).alias("step"),
                          call_status.alias("status"), (F.size("errors") == 0).alias("valid"), "errors", _object(member).alias("json")))
    asked = leads.select("conv_id", "call_id", F.lit(True).alias("__asked")).join(levels, ["conv_id", "call_id"])
    back = results.join(asked, ["conv_id", "call_id"], "left")
    result_status = (F.when(F.col("call_id").isNotNull() & ~F.col("__lead"), "duplicate").when(F.col("__asked").isNull(), "orphan")
                     .when(F.col("level").isNull(), "cyclic").otherwise("linked"))
    member = [("content", _string(F.col("content"))), ("id", _string(F.col("call_id"))), ("role", F.lit('"result"'))]
    result_lines = back.select("conv_id", "turn", F.lit("result").alias("kind"), "call_id",
                               F.when(F.col("__lead"), F.col("level") * 2 + 1).alias("step"), result_status.alias("status"),
                               F.lit(True).alias("valid"), F.array().cast("array<string>").alias("errors"), _object(member).alias("json"))
    return call_lines.unionByName(result_lines)


def plain_messages(messages: DataFrame) -> DataFrame:
    """One line per message (conv_id, turn, role, content) that is no call and no result; columns of ``link_tool_calls``."""
    member = [("content", _string(F.col("content"))), ("role", _string(F.col("role")))]
    return messages.select("conv_id", "turn", F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"),
                           F.lit(None).cast("long").alias("step"), F.lit("plain").alias("status"), F.lit(True).alias("valid"),
                           F.array().cast("array<string>").alias("errors"), _object(member).alias("json"))


def _string(value: Column) -> Column:
    """A string as a JSON string."""
    listed = F.to_json(F.array(value))
    return listed.substr(F.lit(2), F.length(listed) - 2)


def _object(members: list[tuple[str, Column]]) -> Column:
    """A JSON object of members given in ascending order of names; null becomes JSON null."""
    parts = [F.concat(F.lit(f'"{n}":'), F.coalesce(v, F.lit("null"))) for n, v in members]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
