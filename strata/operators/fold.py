"""Folding of same-key rows within one batch, in arrival order.

All folds are aggregates with a map-side step, so a hot key shrinks to one row
per input partition before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.skew import SALTS

GROUP_LIMIT = 1000  # fixed value: default of spark.sql.optimizer.windowGroupLimitThreshold


def ordinal(order: Sequence[str]) -> Column:
    """One comparable column; a single number stays plain and can be hashed."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _kept(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None
) -> list[str]:
    if columns is not None:
        return list(columns)
    return [c for c in rows.columns if c in keys or c not in order]


def fold_last(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    first: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the last one to arrive.

    Columns named in ``first`` come from the row that arrived first instead.  The
    result holds ``columns``, by default all but the ordinal.
    """
    by, kept = ordinal(order), _kept(rows, keys, order, columns)
    values = [c for c in kept if c not in keys and c not in first]
    aggs = [F.max_by(F.struct(*values), by).alias("_last")] if values else []
    aggs += [F.min_by(c, by).alias(c) for c in first]
    folded = rows.groupBy(*keys).agg(*aggs) if aggs else rows.select(*keys).distinct()
    return folded.select(*(F.col(f"_last.{c}").alias(c) if c in values else F.col(c) for c in kept))


def fold_last_non_null(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    first: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: for every column, the last value that is not NULL."""
    by, kept = ordinal(order), _kept(rows, keys, order, columns)
    aggs = [
        (F.min_by(c, by) if c in first else F.max_by(c, F.when(F.col(c).isNotNull(), by))).alias(f"_{c}")
        for c in kept
        if c not in keys
    ]
    folded = rows.groupBy(*keys).agg(*aggs) if aggs else rows.select(*keys).distinct()
    return folded.select(*(F.col(c) if c in keys else F.col(f"_{c}").alias(c) for c in kept))


def fold_first(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the first one to arrive."""
    kept = _kept(rows, keys, order, columns)
    values = [c for c in kept if c not in keys]
    first = F.min_by(F.struct(*values), ordinal(order)).alias("_first")
    folded = rows.groupBy(*keys).agg(first) if values else rows.select(*keys).distinct()
    return folded.select(*(F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in kept))


def latest_row(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole latest row per key, for rows an aggregate cannot carry (VARIANT).

    The row-number filter is pushed below the shuffle as a group limit.
    """
    return top_n(rows, keys, [F.col(c).desc() for c in order], 1)


def _ranked(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def top_n(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """First ``n`` rows per key in the given order.

    Up to ``group_limit`` the planner limits each key before the shuffle.  For a
    larger ``n`` a key is first limited within salted parts, so that a hot key
    reaches its last task as at most ``n`` rows per part.
    """
    if n > group_limit:
        plain = [f.name for f in rows.schema if not isinstance(f.dataType, (T.VariantType, T.MapType))]
        salt = F.pmod(F.xxhash64(*plain), F.lit(SALTS))
        rows = _ranked(rows.withColumn("_salt", salt), [*keys, "_salt"], order, n).drop("_salt")
    return _ranked(rows, keys, order, n)


def head_n(rows: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows overall."""
    return rows.orderBy(*order).limit(n)
