"""Projections onto target tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import clean as C
from strata.functions import payload as P


def project_to(df: DataFrame, target: T.StructType, mapping: dict[str, str] | None = None) -> DataFrame:
    """Columns of the target, in its order and types, matched by name.

    ``mapping`` names the source column of a target column.  Source columns the
    target lacks are dropped, target columns the source lacks are NULL, values
    that do not fit the type are NULL.
    """
    mapping = mapping or {}
    have = {f.name: f.dataType for f in df.schema}

    def column(f: T.StructField) -> Column:
        name = mapping.get(f.name, f.name)
        if name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        if have[name] == f.dataType:
            return F.col(name).alias(f.name)
        return F.col(name).try_cast(f.dataType).alias(f.name)

    return df.select(*(column(f) for f in target.fields))


def key_alias(
    df: DataFrame, v: str = "v", names: Sequence[str] = ("id", "artist_id"), key: str = "id"
) -> DataFrame:
    """Add the key text of a payload: the first of the named fields that is not empty."""
    at = [P.field(n) for n in names]
    raw = df.select(
        *df.columns,
        *(P.get(F.col(v), path).alias(f"_text{i}") for i, path in enumerate(at)),
        *(P.kind(F.col(v), path).alias(f"_kind{i}") for i, path in enumerate(at)),
    )
    keys = (P.truthy_text(F.col(f"_text{i}"), F.col(f"_kind{i}")) for i in range(len(at)))
    return raw.select(*df.columns, F.coalesce(*keys).alias(key))


def key_alias_columns(df: DataFrame, names: Sequence[str], key: str = "id") -> DataFrame:
    """The same rule over plain columns."""
    return df.withColumn(key, C.truthy_coalesce(df, names))


def to_payload(df: DataFrame, name: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """Whole rows as JSON text, NULL fields included."""
    return df.select(*keep, P.serialise(*df.columns).alias(name))


def release_projection(df: DataFrame, artist_id: str | Column) -> DataFrame:
    """Release fields under their relational names, with the artist's key."""
    key = F.lit(artist_id) if isinstance(artist_id, str) else artist_id
    return df.select(
        F.col("id").alias("release_id"),
        key.alias("artist_id"),
        "title",
        "date",
        "country",
        "status",
    )


def keys_of(df: DataFrame, key: str = "id") -> DataFrame:
    """Key column that drives an expansion; stays a DataFrame."""
    return df.select(key)


@dataclass(frozen=True)
class Field:
    """Where a sanitised column comes from and how it is cleaned.

    ``rule`` is one of text, date_text, day, value (typed, not cleaned), or
    column, which takes ``path`` as a column that stands beside the payload.
    """

    name: str
    path: str
    rule: str = "text"
    dtype: str = "string"

    def read(self, v: Column) -> list[Column]:
        """Raw columns taken out of the payload."""
        if self.rule == "column":
            return [F.col(self.path).cast(self.dtype).alias(f"_{self.name}")]
        dtype = self.dtype if self.rule == "value" else "string"
        raw = [P.get(v, self.path, dtype).alias(f"_{self.name}")]
        if dtype != "string":
            given = C.null_if_sentinel(P.get(v, self.path))
            misfit = given.isNotNull() & (given != "") & P.get(v, self.path, dtype).isNull()
            raw.append(misfit.alias(f"_{self.name}_misfit"))
        if self.rule in ("day", "date_text"):
            raw.append((P.kind(v, self.path) == "string").alias(f"_{self.name}_is_text"))
        return raw

    def misfit(self) -> Column | None:
        """Why the value given does not fit the column's type; None for text columns."""
        if self.rule != "value" or self.dtype == "string":
            return None
        return F.when(F.col(f"_{self.name}_misfit"), F.lit(f"{self.name} is not {self.dtype}"))

    def clean(self) -> Column:
        """Target column from the raw ones."""
        raw = F.col(f"_{self.name}")
        if self.rule in ("column", "value"):
            return raw.alias(self.name)
        text = C.null_if_sentinel(raw)
        if self.rule == "text":
            return text.alias(self.name)
        # Only a JSON string is a date text: the number 1989 is left alone.
        completed = F.when(F.col(f"_{self.name}_is_text"), C.complete_partial_date(text)).otherwise(text)
        return (C.to_day(completed) if self.rule == "day" else completed).alias(self.name)


def explode_path(df: DataFrame, v: str, steps: Sequence[str], name: str = "child") -> DataFrame:
    """One row per leaf of nested arrays reached through ``steps``.

    Each step is the path of an array inside the element before it.  Column ``v``
    gives way to ``name``; the others, the parent key among them, are kept.  The
    positions on the way form ``_at``, which sorts the leaves of one value.
    """
    others = [c for c in df.columns if c != v]
    df = df.select(*others, F.col(v).alias(name), F.array().cast("array<int>").alias("_at"))
    for step in steps:
        items = F.try_variant_get(name, step, "array<variant>")
        df = df.select(*others, "_at", F.posexplode(items).alias("_pos", name)).select(
            *others, name, F.concat("_at", F.array("_pos")).alias("_at")
        )
    return df


def sanitise(
    df: DataFrame,
    fields: Sequence[Field],
    payload: str = "payload",
    child_steps: Sequence[str] = (),
    keep: Sequence[str] = (),
    reason: str | None = None,
) -> DataFrame:
    """Payload text to cleaned, typed columns.

    The payload is parsed once per row and each path is read once: the raw values
    are projected first, as a cleaning rule uses its input several times.  ``keep``
    names columns beside the payload, or ``_at``, the position of a child in it.
    ``reason`` names a column for the first value that does not fit its type.
    """
    columns = [c for c in df.columns if c != payload or c in keep]
    rows = P.parsed(df.select(*columns, F.col(payload).alias("_text")), "_text", "_v")
    rows = explode_path(rows, "_v", child_steps, "_c")
    raw = rows.select(*keep, *(c for f in fields for c in f.read(F.col("_c"))))
    cleaned = [f.clean() for f in fields]
    if reason is not None:
        misfits = [m for f in fields if (m := f.misfit()) is not None]
        cleaned.append(F.coalesce(*misfits, F.lit(None).cast("string")).alias(reason))
    return raw.select(*keep, *cleaned)
