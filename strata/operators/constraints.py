"""Constraint checks and the split into good and quarantined rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.operators.fold import ordinal
from strata.operators.skew import lookup_join

REASON = "reject_reason"


@dataclass(frozen=True)
class Constraints:
    """Declared constraints of a target table."""

    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    types: dict[str, str] = field(default_factory=dict)


def row_reason(rules: Constraints) -> Column:
    """First violated per-row rule as text, NULL for a good row."""
    checks = [
        F.when(F.col(c).isNull(), F.lit(f"{c} is null"))
        for c in dict.fromkeys((*rules.key, *rules.not_null))
    ]
    checks += [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(f"{c} is not {t}"))
        for c, t in rules.types.items()
    ]
    return F.coalesce(*checks, F.lit(None).cast("string"))


def check_rows(df: DataFrame, rules: Constraints) -> DataFrame:
    """Add ``reject_reason``; a reason set earlier is kept."""
    reason = row_reason(rules)
    return df.withColumn(REASON, F.coalesce(F.col(REASON), reason) if REASON in df.columns else reason)


def check_unique(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    existing: DataFrame | None = None,
) -> DataFrame:
    """Reject rows whose key is already taken, as plain inserts would.

    The first arrival of a key stays unless the target has the key.  Taken keys
    come from a partial aggregate; good rows are never gathered per key.  A row
    rejected earlier takes no key.  ``order`` must tell the rows of a key apart.
    """
    by = ordinal(order)
    if REASON not in df.columns:
        df = df.withColumn(REASON, F.lit(None).cast("string"))
    repeated = (
        df.where(F.col(REASON).isNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(by).alias("_first"))
        .where(F.col("_n") > 1)
        .select(*keys, "_first")
    )
    out = lookup_join(df, repeated, keys, "left", [*order])
    taken = F.col("_first").isNotNull() & (by > F.col("_first"))
    if existing is not None:
        # Both sides are plain rows here, so a hot incoming key is split at run time.
        held = existing.select(*keys).withColumn("_held", F.lit(True))
        out = out.join(held, list(keys), "left")
        taken = taken | F.col("_held").isNotNull()
    return out.withColumn(
        REASON, F.coalesce(F.col(REASON), F.when(taken, F.lit("duplicate key")))
    ).select(*df.columns)


def excess_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the row count and the excess."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
        .withColumn("n_excess", F.col("n_rows") - 1)
    )


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the reason, quarantined rows with it)."""
    return df.where(F.col(REASON).isNull()).drop(REASON), df.where(F.col(REASON).isNotNull())


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows read, good and rejected while the frame is being written."""
    seen = Observation(name)
    rejected = F.count(F.col(REASON)) if REASON in df.columns else F.lit(0).cast("long")
    total = F.count(F.lit(1))
    return (
        df.observe(
            seen, total.alias("rows_read"), rejected.alias("rows_rejected"), (total - rejected).alias("rows_good")
        ),
        seen,
    )
