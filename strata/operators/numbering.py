"""Dense surrogate ids without a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import settle, work_path

_ROW_BITS = 33  # fixed value: monotonically_increasing_id keeps the row number in the low 33 bits


def add_surrogate_id(
    df: DataFrame,
    order: Sequence[str],
    name: str = "ingestion_id",
    start_after: int = 0,
    partitions: int | None = None,
    path: str | None = None,
) -> DataFrame:
    """Number rows ``start_after + 1 ...`` in the given order.

    Rows are range partitioned and sorted, and settled once so that both passes
    see one placement.  The first pass counts rows per partition, the second adds
    the rows of all partitions before.  The running sum is over one row per
    partition, a size set by ``partitions`` and not by the data.  ``order`` must
    be a total order, or one hot value would fill one range.  The settled rows stand
    at ``path`` until the caller, who reads the result lazily, discards them.
    """
    spread = (
        df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    )
    placed = settle(
        spread.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()),
        path or work_path(df.sparkSession, "numbered"),
    )
    part = F.shiftright("_at", _ROW_BITS)
    local = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per partition, whatever the data
        .select(
            (F.col("_offset") + local + F.lit(start_after + 1)).cast("long").alias(name),
            *df.columns,
        )
    )
