"""String cleaning rules, as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that stand for "no value", compared without case.
NULL_WORDS = ("none", "null")


def is_null_word(c: Column) -> Column:
    """True for NULL and for a null word; surrounding blanks are not trimmed."""
    return c.isNull() | F.lower(c).isin(*NULL_WORDS)


def null_if_sentinel(c: Column, empty_is_null: bool = False) -> Column:
    """NULL for a null word, and for '' on request; any other text is kept."""
    absent = F.lower(c).isin(*NULL_WORDS)
    if empty_is_null:
        absent = absent | (c == "")
    return F.when(absent, F.lit(None)).otherwise(c)


def complete_partial_date(c: Column) -> Column:
    """``YYYY`` and ``YYYY-MM`` become the first day of the period.

    ASCII digits only, whole string only.  The byte length is tested first, so
    complete dates never reach the pattern.
    """
    size = F.octet_length(c)
    return (
        F.when((size == 4) & c.rlike(r"\A[0-9]{4}\z"), F.concat(c, F.lit("-01-01")))
        .when((size == 7) & c.rlike(r"\A[0-9]{4}-[0-9]{2}\z"), F.concat(c, F.lit("-01")))
        .otherwise(c)
    )


def to_day(c: Column) -> Column:
    """Typed date of a completed date string; NULL where it is no real date."""
    return F.try_to_date(c, "yyyy-MM-dd")


def bad_date(c: Column) -> Column:
    """Quality flag: text is present but is not a real date."""
    return c.isNotNull() & to_day(c).isNull()


def truthy(c: Column, dtype: T.DataType) -> Column:
    """NULL where the value counts as empty: '', zero or false."""
    if isinstance(dtype, T.StringType):
        return F.nullif(c, F.lit(""))
    if isinstance(dtype, T.BooleanType):
        return F.when(c, c)
    if isinstance(dtype, T.NumericType):
        return F.when(c != 0, c)
    return c


def truthy_coalesce(df: DataFrame, names: Iterable[str]) -> Column:
    """First non-empty of the named columns (the ``a or b`` rule)."""
    return F.coalesce(*(truthy(F.col(n), df.schema[n].dataType) for n in names))


def clean_strings(df: DataFrame, date_cols: Iterable[str] | None = ()) -> DataFrame:
    """Null words to NULL in every string column, partial dates completed.

    ``date_cols`` limits the date rule to the named columns; None applies it to
    all string columns.
    """
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    dates = set(strings if date_cols is None else date_cols)
    return df.withColumns(
        {
            n: complete_partial_date(null_if_sentinel(F.col(n)))
            if n in dates
            else null_if_sentinel(F.col(n))
            for n in strings
        }
    )
