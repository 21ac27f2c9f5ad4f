"""Raw snapshot sink."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import discard, file_system
from strata.sources.snapshots import dated_snapshot_path


def _one_line(element: str) -> Column:
    # Line breaks stand only between tokens of a JSON text, never inside a string.
    return F.translate(element, "\r\n", "  ").alias("value")


def write_snapshot(
    elements: DataFrame,
    folder: str,
    source: str,
    day: dt.date,
    element: str = "element",
    order: Sequence[str] = (),
) -> str:
    """One source object per line, UTF-8, under the dated snapshot name.

    Lines split across readers.  A second run on the same day replaces the first: it is
    written beside it and renamed when it is finished.
    With ``order``, part files and lines follow it, so a reader's ordinal is the
    arrival order.
    """
    if order:
        elements = elements.orderBy(*order)
    path = dated_snapshot_path(folder, source, day, "jsonl")
    spark = elements.sparkSession
    fresh = f"{folder}/_{source}_{uuid.uuid4().hex}"
    elements.select(_one_line(element)).write.text(fresh)
    written, files = file_system(spark, fresh)
    current, aside = (file_system(spark, p)[0] for p in (path, f"{fresh}_superseded"))
    # The old snapshot is put aside, not deleted, until the new one has its name.
    held = files.exists(current) and files.rename(current, aside)
    if not files.rename(written, current):
        if held:
            files.rename(aside, current)
        raise OSError(f"cannot rename {fresh} to {path}")
    if held:
        discard(spark, aside.toString())
    return path


def write_partitioned_snapshot(
    elements: DataFrame, folder: str, day: dt.date, element: str = "element"
) -> None:
    """The same as one folder partitioned by day; only that day is replaced."""
    (
        elements.select(_one_line(element), F.lit(day).alias("snapshot_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .text(folder)
    )
