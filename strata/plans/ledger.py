"""Which loads of a table a consumer has taken in: increments by batch, not by time.

A load is announced before it writes, under an id of its own, and stays pending for a consumer until
that consumer has written what it made of it.  Two runs of one time, a batch that comes late, a load that
is repeated and a consumer that dies are all read again and never passed over.  The ledger has one row per
load and consumer, so the pending loads of a table are a short list.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import functions as F

from strata.plans.config import LEDGER, Run
from strata.sinks.store import Store, TableDef


@dataclass(frozen=True)
class Pending:
    """Loads of a table that a consumer has not taken in, and the batches they belong to."""

    table: TableDef
    consumer: TableDef
    loads: tuple[tuple[str, str], ...]  # (load id, batch id)

    @property
    def batches(self) -> list[str]:
        return sorted({batch for _, batch in self.loads})


def _log(store: Store, rows: list[tuple[str, str, str, str | None]]) -> None:
    frame = store.spark.createDataFrame(rows, "table_name string, etl_batch_id string, load_id string, consumer string")
    store.append(LEDGER, frame.coalesce(1).withColumn("logged_at", F.current_timestamp()))


def announce(store: Store, table: TableDef, run: Run) -> None:
    """A load of ``table`` is about to write rows of the run's batch."""
    _log(store, [(table.full_name, run.etl_batch_id, uuid.uuid4().hex, None)])


def pending(store: Store, table: TableDef, consumer: TableDef) -> Pending:
    """The announced loads of ``table`` that ``consumer`` has not taken in."""
    log = store.read(LEDGER).where(F.col("table_name") == table.full_name)
    taken = log.where(F.col("consumer") == consumer.full_name).select("load_id")
    rows = log.where(F.col("consumer").isNull()).join(taken, "load_id", "left_anti").select("load_id", "etl_batch_id")
    return Pending(table, consumer, tuple(sorted(tuple(r) for r in rows.collect())))  # one row per load not taken in yet


def take_in(store: Store, found: Pending) -> None:
    """The consumer has written what these loads brought."""
    if found.loads:
        name = found.consumer.full_name
        _log(store, [(found.table.full_name, batch, load, name) for load, batch in found.loads])
