"""Tool calls of conversations with their results, in an order in which they can run.

Calls and results meet in a hash join on the call's identifier. A call may name one that
it comes after; its depth, how many calls must run before it, is found by pointer doubling,
so that a chain of n calls takes about log2 n joins whatever the sizes of conversations.
Arguments are checked against the schema of their tool, and each call is written as one
line of canonical JSON: keys sorted, no spaces, only what JSON demands escaped, whole
numbers without a fraction.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewise.session import work_folder

# The types that a schema may name and how Python's JSON reader gives them.
TYPES = {"string": (str,), "integer": (int,), "number": (int, float), "boolean": (bool,), "object": (dict,), "array": (list,), "null": (type(None),)}


# Arrays and objects inside each other, at most: what every JSON reader takes.
NESTING = 200
# Up to here a double stands for one whole number.
WHOLE = 1 << 53
_QUOTED, _NOT_BRACKETS = re.compile(r'"(?:[^"\\]|\\.)*"?', re.S), re.compile(r"[^\[\]{}]+")


def nesting(text: str) -> int:
    """How deep arrays and objects lie inside each other in a JSON text."""
    depth = deepest = 0
    for sign in _NOT_BRACKETS.sub("", _QUOTED.sub("", text)):
        depth += 1 if sign in "[{" else -1
        deepest = max(deepest, depth)
    return deepest


def plain(value):
    """The value with doubles that equal a whole number up to 2^53 as that number."""
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [plain(v) for v in value]
    return int(value) if isinstance(value, float) and abs(value) <= WHOLE and value.is_integer() else value


def canonical(value) -> str:
    """The same text for equal JSON values (1 and 1.0 are equal). Raises ValueError for what JSON or Unicode can't hold."""
    text = json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    text.encode()
    return text


def read(text: str | None) -> tuple[object, str | None]:
    """The value of a JSON text and what is wrong with it. Of equal keys the last counts; no text is no value."""
    if text is None:
        return None, None
    if text.count("[") + text.count("{") > NESTING and nesting(text) > NESTING:
        return None, "arguments are nested too deeply"
    try:
        value = plain(json.loads(text))
        canonical(value)
    except UnicodeEncodeError:
        return None, "arguments are no Unicode text"
    except ValueError:
        return None, "arguments are no JSON"
    return value, None


def fault(arguments, parameters: list | None) -> str | None:
    """What is wrong with the arguments of a call, the first by name; None if nothing is.

    ``parameters`` are ``(name, type, required)``; no parameters at all: the tool isn't known.
    A name that comes with several types may have any, and is required if it is so once. A
    schema that can't be followed is the fault of all its calls.
    """
    if parameters is None:
        return "unknown tool"
    known = {}
    for name, kind, required in parameters:
        if name is None:
            return "schema has an argument without a name"
        kinds, must = known.get(name, (set(), False))
        known[name] = (kinds | {kind}, must or bool(required))
    for name in sorted(known):
        if not known[name][0] <= TYPES.keys():
            return f"schema has no known type for {name}"
    if not isinstance(arguments, dict):
        return "arguments are no object"
    for name in sorted({*known, *arguments}):
        if name not in known:
            return f"unknown argument {name}"
        kinds, required = known[name]
        if name not in arguments:
            if required:
                return f"missing argument {name}"
        elif not any(_is(arguments[name], kind) for kind in kinds):
            return f"argument {name} is no {' or '.join(sorted(kinds))}"
    return None


def _is(value, kind: str) -> bool:
    return isinstance(value, TYPES[kind]) and isinstance(value, bool) == (kind == "boolean")


def checked(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
    for call_ids, tools, arguments, parameters, results in parts:
        rows = []
        for call_id, tool, text, known, result in zip(call_ids, tools, arguments, parameters, results, strict=True):
            value, wrong = read(text)
            wrong = wrong or fault(value, None if known is None else [(p["name"], p["type"], p["required"]) for p in known])
            rows.append((wrong, canonical({"arguments": value, "call_id": call_id, "result": result, "tool": tool})))
        yield pd.DataFrame(rows, columns=["fault", "json"])


def depths(calls: DataFrame) -> DataFrame:
    """``call_id, depth`` of the calls ``call_id, after``: calls before it. Null for calls on a circle or behind one.

    A call that comes after none, or after one that isn't there, has depth 0.
    """
    spark = calls.sparkSession
    folder = work_folder(spark, "depths")
    schema = "call_id string, up string, depth long"

    def written(df: DataFrame, number: int) -> tuple[DataFrame, int]:
        df.select("call_id", "up", "depth").write.parquet(f"{folder}/{number}")
        df = spark.read.schema(schema).parquet(f"{folder}/{number}")
        return df, df.where("up IS NOT NULL").count()

    there = calls.select(F.col("call_id").alias("up"))
    first = calls.select("call_id", F.col("after").alias("up")).join(there.withColumn("found", F.lit(1)), "up", "left")
    current, left = written(first.select("call_id", F.when(F.col("found") == 1, F.col("up")).alias("up"))
                            .withColumn("depth", F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("long")), 0)
    number, before = 0, None
    while left and left != before:
        number, before = number + 1, left
        above = current.select(F.col("call_id").alias("up"), F.col("up").alias("further"), F.col("depth").alias("more"))
        current, left = written(current.join(above, "up", "left").select(
            "call_id", F.col("further").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), number)
    return current.select("call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def linked(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """``conversation, call_id, tool, depth, n_results, fault, json`` of each call.

    ``calls`` has ``conversation, call_id, after, tool, arguments`` (JSON text), ``results``
    ``call_id, content``, ``schemas`` ``tool, name, type, required``. Of calls that share an
    id the smallest by the other columns stays; of several results the smallest text is
    linked and all are counted. Calls without an id and results without a call are left
    out. Null or broken arguments are a fault, not an error: also half characters, numbers
    out of range, more than ``NESTING`` levels, and schemas with unknown types or without a
    name; such arguments are null in ``json``. Texts of any length are taken whole. Ordered
    by ``depth`` the calls of a conversation can run; those on a circle have no depth.
    """
    columns = ("conversation", "after", "tool", "arguments")
    one = (calls.where("call_id IS NOT NULL").groupBy("call_id").agg(F.min(F.struct(*columns)).alias("c"))
           .select("call_id", "c.*"))
    of = results.where("call_id IS NOT NULL").groupBy("call_id").agg(F.min("content").alias("content"), F.count("*").alias("n_results"))
    parameters = schemas.groupBy("tool").agg(F.collect_set(F.struct("name", "type", "required")).alias("parameters"))
    rows = (one.join(of, "call_id", "left").join(parameters, "tool", "left").join(depths(one), "call_id"))
    out = rows.withColumn("checked", F.pandas_udf(checked, "fault string, json string")("call_id", "tool", "arguments", "parameters", "content"))
    return out.select("conversation", "call_id", "tool", "depth", F.coalesce("n_results", F.lit(0)).alias("n_results"), "checked.fault", "checked.json")


def ordered(linked_calls: DataFrame) -> DataFrame:
    """Conversation by conversation, each call after those that it depends on."""
    return linked_calls.orderBy("conversation", F.asc_nulls_last("depth"), "call_id")
