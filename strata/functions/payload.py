"""JSON payload parsing, access and serialisation, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse(c: Column) -> Column:
    """VARIANT of a JSON text, NULL when it is malformed."""
    return F.try_parse_json(c)


def parsed(df: DataFrame, payload: str = "payload", name: str = "v") -> DataFrame:
    """Replace the payload column by its VARIANT, parsed exactly once per row.

    The parse stands below a generator, which filters are not pushed through: a
    predicate or join key on a parsed field would otherwise parse the text again
    below the projection.  It is a column before it is exploded, as the planner then sizes the
    rows with the VARIANT in them (2 kB) both before and after the generator; sized without it before
    and with it after, fields read out of it would count for a hundredth of what they are, and a table of
    millions of rows would be broadcast.  The outer form lets no filter on the array be inferred.
    """
    others = [c for c in df.columns if c != payload]
    held = df.select(*others, F.array(parse(F.col(payload))).alias("_parsed_once"))
    return held.select(*others, F.explode_outer("_parsed_once").alias(name))


def serialise(*cols: str | Column) -> Column:
    """JSON object text of the given columns; NULL fields are written out."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def with_field(element: Column, name: str, value: Column) -> Column:
    """JSON object text with a field put at its end; anything but an object is left alone.

    The last of two fields of one name counts, so a field of that name which the
    object has itself gives way.
    """
    tail = F.regexp_replace(F.to_json(F.struct(value.alias(name))), r"\A\{", "")
    body = F.regexp_replace(element, r"\s*\}\s*\z", "")
    comma = F.when(body.rlike(r"\A\s*\{\s*\z"), F.lit("")).otherwise(F.lit(","))
    is_object = element.rlike(r"\A\s*\{") & element.rlike(r"\}\s*\z")
    return F.when(is_object, F.concat(body, comma, tail)).otherwise(element)


def whole_json(text: Column) -> Column:
    """VARIANT of a text that is one JSON value and nothing after it, else NULL.

    The parser stops after the first value; as the first of two array elements, a
    value that is followed by anything else is an error or not the first of two.
    """
    pair = F.try_variant_get(parse(F.concat(F.lit("["), text, F.lit(",0]"))), "$", "array<variant>")
    return F.when(F.size(pair) == 2, F.get(pair, F.lit(0)))


def element_texts(v: Column) -> Column:
    """JSON texts of the elements of an array value; strings keep their quotes."""
    return F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.to_json(x))


def as_json(c: Column) -> Column:
    """JSON text of an array, map or struct column."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def field(name: str) -> str:
    """Path of a top-level field; safe for names with hyphens or dots."""
    quote = '"' if "'" in name else "'"
    return f"$[{quote}{name}{quote}]"


def get(v: Column, path: str, dtype: str = "string") -> Column:
    """Typed value at ``path``, NULL when absent or not castable.

    As a string, a nested array or object comes back as JSON text.
    """
    return F.try_variant_get(v, path, dtype)


def get_or(v: Column, path: str, default: Column, dtype: str = "string") -> Column:
    return F.coalesce(get(v, path, dtype), default)


def kind(v: Column, path: str = "$") -> Column:
    """One of string, number, boolean, list, object, null; NULL when absent."""
    name = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    return (
        F.when(name == "STRING", F.lit("string"))
        .when(name == "BOOLEAN", F.lit("boolean"))
        .when(name == "VOID", F.lit("null"))
        .when(name.startswith("ARRAY"), F.lit("list"))
        .when(name.startswith("OBJECT"), F.lit("object"))
        .when(name.isNotNull(), F.lit("number"))
    )


def truthy_text(text: Column, what: Column) -> Column:
    """Text of a value of the given kind, NULL where it is empty: '', 0, false, [], {}."""
    empty = (
        (text == "")
        | ((what == "number") & (text.try_cast("double") == 0))
        | ((what == "boolean") & (text == "false"))
        | (what.isin("list", "object") & text.isin("[]", "{}"))
    )
    return F.when(~empty, text)
