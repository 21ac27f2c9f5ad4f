"""Signed differences between two states of a table of counts.

A table of counts is a bag: value columns that tell its rows apart, and sums.  A difference holds the rows
of the new state as they are and those of the old one with their signs turned, added up per value; what did
not change cancels out and moves no further.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def signed_sum(rows: DataFrame, values: Sequence[str], sums: Sequence[str], keep_zero: bool = False) -> DataFrame:
    """Rows of equal values (NULL equal to NULL) added up; rows whose sums are all zero go unless kept."""
    total = rows.groupBy(*values).agg(*(F.sum(c).alias(c) for c in sums))
    if keep_zero:
        return total
    return total.where(reduce(lambda a, b: a | b, (F.col(c) != 0 for c in sums)))


def signed(old: DataFrame, new: DataFrame, values: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """What has to be added to ``old`` to make it ``new``."""
    taken = old.select(*values, *((-F.col(c)).alias(c) for c in sums))
    return signed_sum(new.select(*values, *sums).unionByName(taken), values, sums)
