"""Audit stamps and date/time text, as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.clean import null_if_sentinel


def moment(as_of: dt.datetime | str | None) -> Column:
    """The load time: one value for the whole query.

    A naive value is UTC, the zone every session uses.
    """
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(dt.timezone.utc)
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(as_of).cast("timestamp")


def created_stamp(c: Column, as_of: Column) -> Column:
    """Keep a supplied creation time; NULL, '' and null words become ``as_of``."""
    text = null_if_sentinel(c.cast("string"), empty_is_null=True)
    return F.when(text.isNull(), as_of).otherwise(F.try_to_timestamp(text))


def audit_stamps(df: DataFrame, as_of: dt.datetime | str | None = None) -> DataFrame:
    """Set ``created_at`` where absent, ``updated_at`` always."""
    now = moment(as_of)
    if "created_at" not in df.columns:
        created = now
    elif isinstance(df.schema["created_at"].dataType, T.StringType):
        created = created_stamp(F.col("created_at"), now)
    else:
        created = F.coalesce(F.col("created_at"), now)
    return df.withColumns({"created_at": created, "updated_at": now})


def column_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill NULLs with declared column defaults; adds a column that is missing."""
    return df.withColumns(
        {n: F.coalesce(F.col(n), d) if n in df.columns else d for n, d in defaults.items()}
    )


def iso_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssXXX")


def date_stamp(c: Column) -> Column:
    """Day as it appears in snapshot names, 2026_05_01."""
    return F.date_format(c, "yyyy_MM_dd")


def batch_id(ts: Column, source: str | Column) -> Column:
    """Run identity from start time and source system, 20260730173828_cv1."""
    source = F.lit(source) if isinstance(source, str) else source
    return F.concat_ws("_", F.date_format(ts, "yyyyMMddHHmmss"), source)


def stamp_batch(df: DataFrame, batch: str) -> DataFrame:
    return df.withColumn("etl_batch_id", F.lit(batch))
