"""Batch log, phase state and count reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.fold import latest_row

STARTED, SUCCEEDED, FAILED = "STARTED", "SUCCESS", "FAILED"
PASS, FAIL = "PASS", "FAIL"


def reconcile(
    source: DataFrame,
    target: DataFrame,
    source_name: str,
    target_name: str,
    phase: str,
    batch: str | Column,
    checked_at: Column,
) -> DataFrame:
    """Row counts of two stages side by side, as one reconciliation row."""
    counts = (
        source.agg(F.count(F.lit(1)).alias("s"))
        .select("s", F.lit(0).cast("long").alias("t"))
        .unionByName(
            target.agg(F.count(F.lit(1)).alias("t")).select(F.lit(0).cast("long").alias("s"), "t")
        )
        .agg(F.sum("s").alias("source_count"), F.sum("t").alias("target_count"))
    )
    return _verdict(counts, source_name, target_name, phase, batch, checked_at)


def reconcile_count(
    source_count: int,
    target: DataFrame,
    source_name: str,
    target_name: str,
    phase: str,
    batch: str | Column,
    checked_at: Column,
) -> DataFrame:
    """The same against a source whose rows were counted while it was read."""
    counts = target.agg(F.count(F.lit(1)).alias("target_count")).withColumn(
        "source_count", F.lit(source_count).cast("long")
    )
    return _verdict(counts, source_name, target_name, phase, batch, checked_at)


def _verdict(
    counts: DataFrame,
    source_name: str,
    target_name: str,
    phase: str,
    batch: str | Column,
    checked_at: Column,
) -> DataFrame:
    batch = F.lit(batch) if isinstance(batch, str) else batch
    diff = F.col("source_count") - F.col("target_count")
    return counts.select(
        batch.alias("etl_batch_id"),
        F.lit(phase).alias("phase_name"),
        F.lit(source_name).alias("source_table"),
        F.lit(target_name).alias("target_table"),
        "source_count",
        "target_count",
        diff.alias("diff"),
        F.when(diff == 0, F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"),
        checked_at.alias("checked_at"),
    )


def reconcile_by(source: DataFrame, target: DataFrame, by: Sequence[str]) -> DataFrame:
    """The same comparison per group, for example per batch or per country."""
    s = source.groupBy(*by).agg(F.count(F.lit(1)).alias("source_count"))
    t = target.groupBy(*by).agg(F.count(F.lit(1)).alias("target_count"))
    both = s.join(t, list(by), "full_outer").na.fill(0, ["source_count", "target_count"])
    diff = F.col("source_count") - F.col("target_count")
    return both.withColumns(
        {"diff": diff, "status": F.when(diff == 0, F.lit(PASS)).otherwise(F.lit(FAIL))}
    )


def phase_status(log: DataFrame, at: str, keys: Sequence[str] = ("etl_batch_id", "phase_name")) -> DataFrame:
    """Latest log row of every phase of every batch."""
    return latest_row(log, keys, [at])


def batch_rollup(
    log: DataFrame,
    at: Sequence[str],
    status: str = "status",
    rows: str = "rows_processed",
    error: str = "error_message",
    keys: Sequence[str] = ("etl_batch_id", "phase_name"),
) -> DataFrame:
    """State of every phase: latest status, rows, completeness, last error."""
    order = F.col(at[0]) if len(at) == 1 else F.struct(*at)
    return log.groupBy(*keys).agg(
        F.max_by(status, order).alias("status"),
        F.sum(rows).alias("rows_processed"),
        (F.max_by(status, order) == SUCCEEDED).alias("completed"),
        F.max(F.col(status) == FAILED).alias("ever_failed"),
        F.max_by(error, F.when(F.col(error).isNotNull(), order)).alias("last_error"),
    )


def batch_outcome(phases: DataFrame) -> DataFrame:
    """One row per batch from its rolled-up phases."""
    return phases.groupBy("etl_batch_id").agg(
        F.count(F.lit(1)).alias("phases"),
        F.count_if(~F.col("completed")).alias("incomplete_phases"),
        F.sum("rows_processed").alias("rows_processed"),
        F.bool_and("completed").alias("succeeded"),
    )
