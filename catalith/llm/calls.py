"""Chat formatting: tool calls linked to their results, put in order of dependence, checked against schemas, written as canonical JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalith.llm.common import stored, values, widened


@dataclass(frozen=True)
class Field:
    """An argument of a tool: its JSON type, whether it must be there, and bounds (of a number, or of a string's length)."""

    kind: str
    required: bool = True
    low: float | None = None
    high: float | None = None


#: JSON types and the Python ones that stand for them; a boolean is no number.
KINDS = {"string": (str,), "integer": (int,), "number": (int, float), "boolean": (bool,), "array": (list,), "object": (dict,)}


def argument_errors(arguments: object, schema: Mapping[str, Field] | None) -> list[str]:
    """What is wrong with a call's arguments, in order of name; an empty list for nothing."""
    if schema is None:
        return ["unknown tool"]
    if not isinstance(arguments, dict):
        return ["no object"]
    found = [f"extra {name}" for name in arguments if name not in schema]
    for name, field in schema.items():
        if name not in arguments:
            if field.required:
                found.append(f"missing {name}")
            continue
        value = arguments[name]
        if not isinstance(value, KINDS[field.kind]) or (isinstance(value, bool) and field.kind != "boolean"):
            found.append(f"type {name}")
            continue
        size = len(value) if isinstance(value, str | list | dict) else value
        if (field.low is not None and size < field.low) or (field.high is not None and size > field.high):
            found.append(f"bound {name}")
    return sorted(found)


def canonical(value: object) -> str:
    """JSON with sorted keys, no spaces, and characters as they are; as escapes where a lone surrogate cannot be written."""
    out = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return json.dumps(value, sort_keys=True, separators=(",", ":")) if any("\ud800" <= c <= "\udfff" for c in out) else out


def parsed(text: str | None) -> tuple[object, bool]:
    """(value, whether it is JSON); what is no JSON stays text."""

    def refuse(name: str) -> object:
        raise ValueError(name)

    try:
        return json.loads(text or "", parse_constant=refuse), True
    except (ValueError, RecursionError):
        return text, False


def first_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Per (conv_id, call_id): the smallest of the other columns as a row, and ``n`` rows. Aggregated in part before the shuffle."""
    picked = rows.where("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id").agg(
        F.min(F.struct(*columns)).alias("row"), F.count("*").alias("n")
    )
    return picked.select("conv_id", "call_id", "row.*", "n")


def dependence(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, faults) out of (conv_id, call_id, turn, after).

    An edge (conv_id, call_id, on) binds a call to another of its turn. What an earlier turn holds is there already; a call on one that does not exist or comes in
    a later turn is a fault (conv_id, call_id, fault) and binds nothing.
    """
    wanted = calls.select("conv_id", "call_id", "turn", F.explode(F.array_distinct(F.array_compact("after"))).alias("on"))
    other = calls.select("conv_id", F.col("call_id").alias("on"), F.col("turn").alias("there"))
    met = stored(wanted.join(other, ["conv_id", "on"], "left"), "dependence")
    same = met.where("there = turn").select("conv_id", "call_id", "on")
    fault = F.when(F.col("there").isNull(), F.concat(F.lit("unknown call "), "on")).when(F.col("there") > F.col("turn"), F.concat(F.lit("later call "), "on"))
    return same, met.select("conv_id", "call_id", fault.alias("fault")).where("fault is not null")


def levels(edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, level, cyclic) of the calls that wait for others of their turn: the longest chain of calls before them.

    A round takes off the calls that nothing holds back. A level is the number of rounds that a call is held back; when a round takes off none, what is left lies on or
    behind a cycle. Rounds are joins over all turns at once, as many as the longest chain in one turn; a chain is inside one message.
    """
    now = stored(edges, "waiting")
    held, left, k = [], now.count(), 0
    while left:
        held.append(now.select("conv_id", "call_id").distinct())
        now = stored(now.join(held[-1].withColumnRenamed("call_id", "on"), ["conv_id", "on"], "left_semi").select("conv_id", "call_id", "on"), "waiting")
        left, before = now.count(), left
        k += 1
        if left == before:
            break
    if not held:
        return edges.select("conv_id", "call_id", F.lit(0).cast("long").alias("level"), F.lit(False).alias("cyclic"))
    rounds = held[0]
    for more in held[1:]:
        rounds = rounds.unionByName(more)
    counted = rounds.groupBy("conv_id", "call_id").agg(F.count("*").alias("level"))
    cyclic = now.select("conv_id", "call_id", F.lit(True).alias("c")).distinct() if left else None
    if cyclic is None:
        return counted.withColumn("cyclic", F.lit(False))
    return counted.join(cyclic, ["conv_id", "call_id"], "left").select("conv_id", "call_id", "level", F.coalesce("c", F.lit(False)).alias("cyclic"))


def positions(calls: DataFrame) -> DataFrame:
    """``calls`` with ``position`` in the conversation, from 0, by (turn, level, call_id).

    Counts are summed per turn, per stretch of 1,024 turns and per conversation, so that no task ranks all calls of a conversation.
    """
    rows = calls.withColumn("stretch", F.floor(F.col("turn") / 1024))
    turns = rows.groupBy("conv_id", "stretch", "turn").agg(F.count("*").alias("n"))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    stretches = turns.groupBy("conv_id", "stretch").agg(F.sum("n").alias("n"))
    stretches = stretches.select("conv_id", "stretch", F.coalesce(F.sum("n").over(before("conv_id").orderBy("stretch")), F.lit(0)).alias("s"))
    turns = turns.withColumn("t", F.coalesce(F.sum("n").over(before("conv_id", "stretch").orderBy("turn")), F.lit(0)))
    base = stored(turns.join(stretches, ["conv_id", "stretch"]).select("conv_id", "turn", (F.col("s") + F.col("t")).alias("base")), "turns")
    inner = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("level", "call_id")) - 1
    return rows.withColumn("inner", inner).join(base, ["conv_id", "turn"]).withColumn("position", F.col("base") + F.col("inner")).drop("stretch", "inner", "base")


def linked_calls(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping[str, Field]]) -> DataFrame:
    """Calls with their results: conv_id, call_id, turn, position, status, n_results, errors, record.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON text), after (ids of calls that it builds on). ``results``: conv_id, call_id, turn, content. ``schemas``:
    fields by tool, a table of fixed size.

    Calls and results meet by (conv_id, call_id). ``status`` is ``linked``; ``open`` for a call without a result; ``early`` where the result's turn is not after
    the call's; ``orphan`` for a result without a call, which has no position. Of rows that repeat an id the smallest (turn, then the rest) counts:
    a repeated call is named in ``errors``, results are counted. Rows with a NULL id or conversation link with nothing and are left out; a NULL turn
    counts as turn -1. ``errors`` is a sorted list: of the arguments, of ids called for, cycles. ``record`` is the canonical JSON of the call and its result.
    Other columns are not read; empty tables give an empty result.
    """
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn")
    own = stored(first_rows(calls.select("conv_id", "call_id", turn, "name", "arguments", "after"), ["turn", "name", "arguments", "after"]), "calls")
    answers = first_rows(results.select("conv_id", "call_id", turn, "content"), ["turn", "content"])
    answers = answers.select("conv_id", "call_id", F.col("turn").alias("result_turn"), "content", F.col("n").alias("n_results"))
    edges, faults = dependence(own)
    depth = stored(levels(edges), "levels")
    order = own.select("conv_id", "call_id", "turn").join(depth, ["conv_id", "call_id"], "left")
    order = positions(order.withColumn("level", F.coalesce("level", F.lit(0)))).select("conv_id", "call_id", "position", F.coalesce("cyclic", F.lit(False)).alias("cyclic"))
    faults = faults.groupBy("conv_id", "call_id").agg(F.collect_set("fault").alias("faults"))
    rows = own.join(order, ["conv_id", "call_id"]).join(faults, ["conv_id", "call_id"], "left")
    rows = rows.join(answers, ["conv_id", "call_id"], "full_outer")
    status = (
        F.when(F.col("position").isNull(), F.lit("orphan")).when(F.col("n_results").isNull(), F.lit("open"))
        .when(F.col("result_turn") <= F.col("turn"), F.lit("early")).otherwise(F.lit("linked"))
    )
    rows = rows.select(
        "conv_id", "call_id", F.coalesce("turn", "result_turn").alias("turn"), "position", status.alias("status"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), "name", "arguments", "content", "faults", "cyclic", "n",
    )
    return _records(rows, schemas)


def _records(rows: DataFrame, schemas: Mapping[str, Mapping[str, Field]]) -> DataFrame:
    keep = ["conv_id", "call_id", "turn", "position", "status", "n_results"]
    schema = widened(rows.select(*keep).schema, "errors array<string>, record string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            errors, records = [], []
            for row in batch.to_pylist():
                found = list(row["faults"] or ()) + (["cycle"] if row["cyclic"] else []) + (["repeated call"] if (row["n"] or 1) > 1 else [])
                record = {"conv_id": row["conv_id"], "id": row["call_id"], "result": row["content"], "status": row["status"]}
                if row["status"] != "orphan":
                    arguments, fine = parsed(row["arguments"])
                    found += argument_errors(arguments, schemas.get(row["name"])) if fine else ["no JSON"]
                    record |= {"arguments": arguments, "name": row["name"], "position": row["position"]}
                errors.append(sorted(found))
                records.append(canonical(record))
            columns = [batch.column(c) for c in keep] + [pa.array(errors, pa.list_(pa.string())), pa.array(records, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


#: Schemas of the tools that ``sentence_calls`` calls.
SENTENCE_SCHEMAS = {
    "lookup": {"query": Field("string", low=1, high=40), "words": Field("integer", low=1, high=6)},
    "search": {"query": Field("string", low=1), "words": Field("integer", low=7, high=40), "place": Field("integer", required=False, high=5)},
}


def sentence_calls(chats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results out of plain conversations (conv_id, turn, role, text), which carry none of their own.

    Sentence k of a user's turn t is call ``t.k``, a lookup up to six words and else a search; it builds on call ``t.(k div 2)``, and sentence 0 on call 0 of the
    user's turn before. Sentence k of the assistant's turn t + 1 is its result.
    """
    said = chats.select("conv_id", "turn", "role", F.posexplode(F.filter(F.split("text", r"[.!?]+[ \n]+|\n+"), lambda s: F.trim(s) != "")).alias("k", "s"))
    asked = said.where("role = 'user'").withColumn("words", F.size(F.split(F.trim("s"), r" +")))
    short = F.col("words") <= 6
    arguments = F.to_json(F.struct(F.col("s").alias("query"), "words", F.when(~short, F.col("k")).alias("place")))
    below = F.concat(F.col("turn").cast("string"), F.lit("."), F.floor(F.col("k") / 2).cast("string"))
    after = F.when(F.col("k") > 0, F.array(below)).when(F.col("turn") >= 2, F.array(F.concat((F.col("turn") - 2).cast("string"), F.lit(".0")))).otherwise(F.array().cast("array<string>"))
    calls = asked.select(
        "conv_id", F.concat(F.col("turn").cast("string"), F.lit("."), F.col("k").cast("string")).alias("call_id"), "turn",
        F.when(short, F.lit("lookup")).otherwise(F.lit("search")).alias("name"), arguments.alias("arguments"), after.alias("after"),
    )
    told = said.where("role = 'assistant'").select(
        "conv_id", F.concat((F.col("turn") - 1).cast("string"), F.lit("."), F.col("k").cast("string")).alias("call_id"), "turn", F.col("s").alias("content")
    )
    return calls, told
