"""Set-based keyed merges with the outcome of row-by-row upserts.

Target and folded batch both hold one row per key, so the full outer join moves
every row once and no key can grow.  With ``buckets`` both sides are dealt to that many
partitions by key; a multiple of a table's buckets keeps the rows of each in tasks of their own (see
``sinks.store``).  Rows with a NULL key must have been rejected before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.fold import fold_first, fold_last, fold_last_non_null

CREATED = "created_at"


def _match(target: DataFrame, incoming: DataFrame, keys: Sequence[str], buckets: int | None) -> DataFrame:
    def side(df: DataFrame, mark: str) -> DataFrame:
        df = df.repartition(buckets, *keys) if buckets else df
        values = [c for c in df.columns if c not in keys]
        return df.select(
            *keys, *(F.col(c).alias(f"{mark}_{c}") for c in values), F.lit(True).alias(mark)
        )

    return side(target, "_t").join(side(incoming, "_i"), list(keys), "full_outer")


def _merge(
    target: DataFrame,
    folded: DataFrame,
    keys: Sequence[str],
    created: str | None,
    pick: Callable[[Column, Column], Column],
    buckets: int | None,
) -> DataFrame:
    def column(name: str) -> Column:
        if name in keys:
            return F.col(name)
        old, new = F.col(f"_t_{name}"), F.col(f"_i_{name}")
        if name == created:
            return F.when(F.col("_t").isNotNull(), old).otherwise(new).alias(name)
        return pick(old, new).alias(name)

    return _match(target, folded, keys, buckets).select(*(column(c) for c in target.columns))


def upsert_overwrite(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    created: str | None = CREATED,
    buckets: int | None = None,
) -> DataFrame:
    """Incoming rows replace target rows, NULLs included.

    The ``created`` column keeps its first value; None overwrites it as well.
    """
    created = created if created in target.columns else None
    folded = fold_last(incoming, keys, order, [created] if created else [], target.columns)
    hit = F.col("_i").isNotNull()
    return _merge(target, folded, keys, created, lambda old, new: F.when(hit, new).otherwise(old), buckets)


def upsert_preserve(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    created: str | None = CREATED,
    buckets: int | None = None,
) -> DataFrame:
    """Only incoming values that are not NULL replace target values."""
    created = created if created in target.columns else None
    folded = fold_last_non_null(incoming, keys, order, [created] if created else [], target.columns)
    return _merge(target, folded, keys, created, lambda old, new: F.coalesce(new, old), buckets)


def insert_absent(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Target rows stay; the first incoming row of each new key is added."""
    fresh = fold_first(incoming, keys, order, target.columns).join(
        target.select(*keys), list(keys), "left_anti"
    )
    return target.unionByName(fresh)


def append_rows(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """All rows of both, no key."""
    return target.unionByName(incoming.select(*target.columns))
