"""Chat formatting: tool calls linked to their results, ordered, validated, serialised.

Calls and results are hash-joined by (conversation, identifier); either side is first reduced to one
row per identifier, so no identifier is hot.  A call may refer to results
of other calls of its conversation; calls are ranked so that each stands after those
it refers to.  Conversations of up to ``small`` calls are ordered each in one array of
that bound; larger ones by rounds over the table, one round per level of reference.
Arguments are checked against the tool's schema, and call and result become one canonical
JSON object: keys sorted, no blanks, numbers in shortest form.

Defined results: a call without a result, a result without a call, a repeated
identifier (the first by position, then by content, counts), a reference to nothing
and a circle of references are each named in ``problems``; calls in or behind a circle
have a NULL ``level``; a NULL identifier is linked to nothing; arguments that are no JSON object
are kept as they came, as a string; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import discard, settle, work_path

SMALL = 10_000
KINDS = {
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "integer": lambda v: not isinstance(v, bool) and (isinstance(v, int) or isinstance(v, float) and v.is_integer()),
    "number": lambda v: not isinstance(v, bool) and isinstance(v, (int, float)),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
    "null": lambda v: v is None,
}


def canonical(value) -> str:
    """JSON with sorted keys, no blanks, whole numbers without a fraction."""

    def plain(v):
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        if isinstance(v, list):
            return [plain(x) for x in v]
        if isinstance(v, float) and v.is_integer() and abs(v) < 1e15:
            return int(v)
        return v

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def parsed(text: str | None):
    """(value, problem) of a JSON text; numbers JSON does not know are refused."""

    def refuse(name):
        raise ValueError(name)

    def number(text):
        value = float(text)
        if math.isinf(value):
            raise ValueError(text)
        return value

    try:
        return json.loads(text, parse_constant=refuse, parse_float=number), None
    except (TypeError, ValueError, RecursionError):
        return None, "arguments are not JSON"


def violations(value, schema: Mapping, path: str = "") -> list[str]:
    """What of ``value`` breaks ``schema``: type, enum, bounds, lengths, items, properties."""
    at = path or "arguments"
    kind = schema.get("type")
    if kind is not None and not KINDS[kind](value):
        return [f"{at} is not {kind}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at} is none of the choices")
    if KINDS["number"](value):
        if value < schema.get("minimum", -math.inf):
            out.append(f"{at} is too small")
        if value > schema.get("maximum", math.inf):
            out.append(f"{at} is too large")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{at} is too short")
        if len(value) > schema.get("maxLength", math.inf):
            out.append(f"{at} is too long")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += violations(x, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        prefix = f"{path}." if path else ""
        out += [f"{prefix}{name} is missing" for name in schema.get("required", ()) if name not in value]
        for name, x in value.items():
            if name in known:
                out += violations(x, known[name], f"{prefix}{name}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{prefix}{name} is unknown")
    return out


def levels(ids: list, refs: list) -> list[int | None]:
    """Level of each call: 0 without references, else one above the highest it refers to."""
    place = {x: i for i, x in enumerate(ids)}
    waits = [{place[r] for r in own if r in place} for own in refs]
    users: list[list[int]] = [[] for _ in ids]
    for i, own in enumerate(waits):
        for j in own:
            users[j].append(i)
    left = [len(own) for own in waits]
    out: list[int | None] = [0 if not n else None for n in left]
    ready = [i for i, n in enumerate(left) if not n]
    for i in ready:
        for user in users[i]:
            left[user] -= 1
            if not left[user]:
                out[user] = 1 + max(out[j] for j in waits[user])
                ready.append(user)
    return out


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _levels(ids: pd.Series, refs: pd.Series) -> pd.Series:
    return pd.Series([levels(list(a), [list(x) for x in b]) for a, b in zip(ids, refs)], dtype=object)


def first_of(rows: DataFrame, keys: list[str], order: list[str], prefix: str) -> DataFrame:
    """One row per key, the first by ``order``, with the number of rows ``<prefix>n``."""
    others = [c for c in rows.columns if c not in keys]
    ranked = [F.col(c) for c in order] + [F.to_json(F.struct(*others)).alias("_whole")]
    return (
        rows.groupBy(*keys)
        .agg(F.min_by(F.struct(*others), F.struct(*ranked)).alias("first"), F.count(F.lit(1)).alias(f"{prefix}n"))
        .select(*keys, f"{prefix}n", *(F.col("first")[c].alias(c) for c in others))
    )


def call_levels(calls: DataFrame, small: int = SMALL) -> DataFrame:
    """(conv_id, call_id, level) of calls with distinct ids; ``refs``: ids they refer to."""
    spark = calls.sparkSession
    plain = calls.select("conv_id", "call_id", F.array_distinct(F.coalesce("refs", F.array().cast("array<string>"))).alias("refs"))
    sizes = plain.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("conv_id", "c")
    sized = plain.join(sizes, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    few = (
        sized.where(F.col("n") <= small)
        .groupBy("conv_id")
        .agg(F.collect_list(F.struct("call_id", "refs")).alias("x"))
        .select("conv_id", F.col("x.call_id").alias("ids"), _levels("x.call_id", "x.refs").alias("levels"))
        .select("conv_id", F.inline(F.arrays_zip("ids", "levels")))
        .select("conv_id", F.col("ids").alias("call_id"), F.col("levels").alias("level"))
    )
    many_at = work_path(spark, "calls")
    many = settle(sized.where(F.col("n") > small).select("conv_id", "call_id", "refs"), many_at)
    out = few
    if not many.isEmpty():
        out = out.unionByName(_by_rounds(many))
    else:
        discard(spark, many_at)
    return out


def _by_rounds(calls: DataFrame) -> DataFrame:
    """Levels of large conversations: each round takes the calls whose references all have one."""
    spark = calls.sparkSession
    known_id = calls.select(F.col("conv_id").alias("k_conv"), F.col("call_id").alias("k_call"))
    refs = (
        calls.select("conv_id", "call_id", F.explode("refs").alias("ref"))
        .join(known_id, F.col("conv_id").eqNullSafe(F.col("k_conv")) & (F.col("ref") == F.col("k_call")))
        .select("conv_id", "call_id", "ref")
    )
    refs = settle(refs, work_path(spark, "call-refs"))
    waiting = refs.select("conv_id", "call_id").distinct()

    def same(a: DataFrame, b: DataFrame, how: str, by: str = "call_id") -> DataFrame:
        b = b.select(F.col("conv_id").alias("b_conv"), F.col("call_id").alias("b_call"))
        return a.join(b, F.col("conv_id").eqNullSafe(F.col("b_conv")) & (F.col(by) == F.col("b_call")), how)

    done = settle(
        same(calls.select("conv_id", "call_id"), waiting, "left_anti").withColumn("level", F.lit(0)),
        work_path(spark, "call-levels"),
    )
    out, level = done, 0
    while not done.isEmpty():
        level += 1
        refs = settle(same(refs, done, "left_anti", "ref").unionByName(
            same(refs, done, "left_semi", "ref").withColumn("ref", F.lit(None).cast("string"))
        ).distinct(), work_path(spark, "call-refs"))
        open_calls = refs.where(F.col("ref").isNotNull()).select("conv_id", "call_id").distinct()
        ready = same(refs.where(F.col("ref").isNull()), open_calls, "left_anti").select("conv_id", "call_id")
        done = settle(ready.withColumn("level", F.lit(level)), work_path(spark, "call-levels"))
        refs = same(refs, done, "left_anti")
        out = out.unionByName(done)
    circular = refs.select("conv_id", "call_id").distinct().withColumn("level", F.lit(None).cast("int"))
    return out.unionByName(circular)


def _message(schemas: Mapping[str, Mapping]):
    @F.pandas_udf(T.StructType([T.StructField("message", T.StringType()), T.StructField("problems", T.ArrayType(T.StringType()))]))
    def run(call_id: pd.Series, tool: pd.Series, arguments: pd.Series, result: pd.Series) -> pd.DataFrame:
        rows = []
        for ident, name, text, answer in zip(call_id, tool, arguments, result):
            value, problem = parsed(text)
            if problem is None and not isinstance(value, dict):
                problem = "arguments are not an object"
            if problem is not None:
                found, value = [problem], text
            elif name not in schemas:
                found = ["tool is unknown"]
            else:
                found = sorted(violations(value, schemas[name]))
            rows.append((canonical({"arguments": value, "id": ident, "name": name, "result": answer}), found))
        return pd.DataFrame(rows, columns=["message", "problems"])

    return run


def link(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping], small: int = SMALL) -> DataFrame:
    """``calls``: conv_id, call_id, pos, tool, arguments, refs; ``results``: conv_id,
    call_id, pos, content.  One row per identifier, and per call or result without one:
    ``level``, ``linked``, ``message``, ``problems``.  In the order of (level, pos) the calls of
    a conversation stand after those they refer to."""
    key = ["conv_id", "call_id"]
    named, nameless = calls.where(F.col("call_id").isNotNull()), calls.where(F.col("call_id").isNull())
    one_call = first_of(named, key, ["pos"], "calls_")
    one_result = first_of(results.where(F.col("call_id").isNotNull()), key, ["pos"], "results_")
    one_result = one_result.withColumnsRenamed({"conv_id": "r_conv", "call_id": "r_call", "pos": "r_pos"})
    settled = settle(one_call, work_path(calls.sparkSession, "calls"))
    leveled = call_levels(settled, small).withColumnsRenamed({"conv_id": "l_conv", "call_id": "l_call"})
    exists = settled.select(F.col("conv_id").alias("e_conv"), F.col("call_id").alias("e_call"))
    lost = (
        settled.select(*key, F.explode("refs").alias("ref"))
        .join(exists, F.col("conv_id").eqNullSafe(F.col("e_conv")) & (F.col("ref") == F.col("e_call")), "left_anti")
        .groupBy(*key)
        .agg(F.array_sort(F.collect_set("ref")).alias("lost"))
        .withColumnsRenamed({"conv_id": "x_conv", "call_id": "x_call"})
    )

    def on(conv: str, call: str) -> Column:
        return F.col("conv_id").eqNullSafe(F.col(conv)) & (F.col("call_id") == F.col(call))

    joined = (
        settled.join(leveled, on("l_conv", "l_call"), "left")
        .join(lost, on("x_conv", "x_call"), "left")
        .join(one_result.hint("shuffle_hash"), on("r_conv", "r_call"), "full")
        .select(
            F.coalesce("conv_id", "r_conv").alias("conv_id"),
            F.coalesce("call_id", "r_call").alias("call_id"),
            "pos",
            "tool",
            "arguments",
            "level",
            F.coalesce("lost", F.array().cast("array<string>")).alias("lost"),
            F.coalesce("calls_n", F.lit(0).cast("long")).alias("calls_n"),
            F.coalesce("results_n", F.lit(0).cast("long")).alias("results_n"),
            "content",
        )
    )
    without = nameless.select(
        "conv_id", "call_id", "pos", "tool", "arguments", F.lit(0).alias("level"),
        F.array().cast("array<string>").alias("lost"), F.lit(1).cast("long").alias("calls_n"),
        F.lit(0).cast("long").alias("results_n"), F.lit(None).cast("string").alias("content"),
    )
    orphaned = results.where(F.col("call_id").isNull()).select(
        "conv_id", "call_id", F.lit(None).cast("long").alias("pos"), F.lit(None).cast("string").alias("tool"),
        F.lit(None).cast("string").alias("arguments"), F.lit(None).cast("int").alias("level"),
        F.array().cast("array<string>").alias("lost"), F.lit(0).cast("long").alias("calls_n"),
        F.lit(1).cast("long").alias("results_n"), "content",
    )
    every = joined.unionByName(without).unionByName(orphaned)
    is_call = F.col("calls_n") > 0
    said = _message(schemas)("call_id", "tool", "arguments", "content")
    extra = F.array_compact(
        F.array(
            F.when(~is_call, F.lit("result without a call")),
            F.when(is_call & (F.col("results_n") == 0), F.lit("call without a result")),
            F.when(F.col("calls_n") > 1, F.lit("call repeated")),
            F.when(F.col("results_n") > 1, F.lit("result repeated")),
            F.when(is_call & F.col("level").isNull(), F.lit("circle of references")),
            F.when(is_call & F.col("call_id").isNull(), F.lit("call without an identifier")),
        )
    )
    out = every.withColumn("said", said)
    return out.select(
        "conv_id",
        "call_id",
        "pos",
        "tool",
        F.when(is_call, F.col("level")).alias("level"),
        (is_call & (F.col("results_n") > 0)).alias("linked"),
        "said.message",
        F.concat(
            extra,
            F.transform("lost", lambda x: F.concat(F.lit("refers to no call: "), x)),
            F.when(is_call, F.col("said.problems")).otherwise(F.array().cast("array<string>")),
        ).alias("problems"),
    )
