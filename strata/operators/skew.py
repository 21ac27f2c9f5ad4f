"""Joins that stay balanced when one key holds a large share of the rows.

A plain inner, semi or anti join of two unaggregated inputs needs nothing from
here: hot partitions of its shuffles are split at run time.  That split does not
apply where one side is an aggregate on the join key, or where the hot side of an
outer join is the one that may be NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.hot import key_hash

HOT_ROWS = 1_000_000  # rows of one key that one task should not take alone
SALTS = 64


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str,
    spread_by: Sequence[str | Column],
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Join rows to a lookup that has at most one row per key.

    Keys with ``hot_rows`` rows or more are found by a partial aggregate over the
    key columns; there are at most ``rows / hot_rows`` of them, which bounds what
    is broadcast.  Only their rows are spread, over ``salts`` tasks for every ``salts * hot_rows``
    rows of the key or part of that, so a task's share does not grow with the key, by a hash of
    ``spread_by`` (columns that tell the rows of one key apart); and only their
    lookup rows are repeated, once per task.  With ``hot``, the hashes of the hot keys as ``hot.watch_keys`` gives
    them, nothing is counted and nothing broadcast.  Rows without a key match nothing and are spread as
    well.  The result does not depend on the salt, so a retried task is harmless.
    """
    no_key = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    many = F.lit(salts)
    if hot is None:
        named = F.broadcast(
            rows.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") >= hot_rows)
            .select(*keys, F.lit(True).alias("_hot"), (many * F.ceil(F.col("_n") / (salts * hot_rows))).cast("int").alias("_many"))
        )
        rows, lookup = rows.join(named, list(keys), "left"), lookup.join(named, list(keys), "left")
        is_hot, many = F.coalesce(F.col("_hot"), F.lit(False)), F.coalesce(F.col("_many"), many)
    else:
        rows, lookup = (df.withColumn("_hot", key_hash(keys).isin(list(hot))).withColumn("_many", many) for df in (rows, lookup))
        is_hot = F.col("_hot")
    salt = F.pmod(F.xxhash64(*spread_by), many).cast("int")
    salted_rows = rows.withColumn("_salt", F.when(is_hot | no_key, salt).otherwise(0))
    repeats = F.when(is_hot, F.sequence(F.lit(0), many - 1)).otherwise(F.array(F.lit(0)))
    salted_lookup = lookup.withColumn("_salt", F.explode(repeats))
    joined = salted_rows.drop("_hot", "_many").join(salted_lookup.drop("_hot", "_many"), [*keys, "_salt"], how)
    return joined.drop("_salt")


def left_join_many(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """Left join of unique parents to children of which one parent may own most.

    Only the left side of a left join can be split at run time, and here the
    right one is hot; an inner join splits either side, and the childless parents
    come from an anti join against the distinct keys.
    """
    matched = parents.join(children, F.col(parent_key) == F.col(child_key), "inner")
    owned = children.select(F.col(child_key).alias("_owned")).distinct()
    childless = parents.join(owned, F.col(parent_key) == F.col("_owned"), "left_anti")
    return matched.unionByName(childless, allowMissingColumns=True)
