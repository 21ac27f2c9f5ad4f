"""Batch life cycle: open, run phases, reconcile, close; every step is logged."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import stamp
from strata.operators import audit
from strata.operators.project import sanitise
from strata.operators.relate import lost_records
from strata.plans.config import BATCH_LOG, RECON_LOG, Entity, Run
from strata.plans.curate import curate
from strata.plans.load import Loaded, load_landing, load_sanitised, set_up
from strata.plans.maintain import maintain
from strata.session import file_system
from strata.sinks.store import Store, TableDef
from strata.sources.tables import of_batches


# What curated tables are logged under: they are made from the tables of all groups.
CURATION = ("curated", "metrics")


class Batch:
    """One batch run, as logged for one entity group of one source system."""

    def __init__(self, store: Store, run: Run, source_system: str, group_name: str):
        self.store, self.run = store, run
        self.source_system, self.group_name = source_system, group_name

    def log(self, phase: str, status: str, started: dt.datetime, rows: int | None = None, error: str | None = None) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        row = {
            "etl_batch_id": self.run.etl_batch_id,
            "source_system": self.source_system,
            "group_name": self.group_name,
            "phase_name": phase,
            "status": status,
            "rows_processed": rows,
            "error_message": error,
            "started_at": started,
            "ended_at": None if status == audit.STARTED else now,
        }
        one = self.store.spark.range(0, 1, 1, 1)
        self.store.append(
            BATCH_LOG, one.select(*(F.lit(v).cast(BATCH_LOG.columns[c].dataType).alias(c) for c, v in row.items()))
        )

    def phase(self, name: str, work: Callable[[], Loaded | int | None]) -> Loaded | int | None:
        """Run one phase; a failure is logged and raised, what it read stays current."""
        started = dt.datetime.now(dt.timezone.utc)
        self.log(name, audit.STARTED, started)
        try:
            loaded = work()
        except Exception as e:
            self.log(name, audit.FAILED, started, error=str(e))
            raise
        rows = loaded.rows_good if isinstance(loaded, Loaded) else loaded
        self.log(name, audit.SUCCEEDED, started, rows)
        return loaded

    def reconcile(
        self, source: DataFrame | int, target: DataFrame, source_name: str, target_name: str, phase: str, accounted: int = 0
    ) -> None:
        """Compare two stages, the target as published, and log the result.  Rows
        ``accounted`` for, rejected or repeating a key, need not be in the target."""
        if isinstance(source, int):
            source -= accounted
        compare = audit.reconcile_count if isinstance(source, int) else audit.reconcile
        row = compare(
            source, target, source_name, target_name, phase, self.run.etl_batch_id, F.current_timestamp()
        )
        self.store.append(RECON_LOG, row)


def phase_log(log: DataFrame) -> DataFrame:
    """State of every phase; a row that ends a phase follows the one that starts it."""
    rows = log.withColumn("_at", F.coalesce("ended_at", "started_at")).withColumn(
        "_closed", F.col("ended_at").isNotNull()
    )
    keys = ("etl_batch_id", "source_system", "group_name", "phase_name")
    return audit.batch_rollup(rows, ["_at", "_closed"], keys=keys)


def expected_keys(store: Store, entity: Entity) -> DataFrame:
    """Keys the sanitised table should hold, taken from the published landing table."""
    rows = sanitise(store.read(entity.landing), entity.fields, child_steps=entity.child_steps)
    return rows.select(*entity.sanitised.key).distinct()


def lost_keys(store: Store, entity: Entity) -> DataFrame:
    """Keys that are in landing and did not arrive in the sanitised table."""
    return lost_records(
        expected_keys(store, entity), store.read(entity.sanitised), entity.sanitised.key
    )


def new_batch_id(started: dt.datetime, source: str) -> str:
    return f"{started:%Y%m%d%H%M%S}_{source}"


def run_batch(store: Store, entities: dict[str, Entity], run: Run, curation: bool = True, maintained: int = 0) -> dict[str, Loaded]:
    """All entities through landing and sanitised, group by group, then the curated tables; reconciled and
    logged on the way, every phase under the source system and group of its entities.

    Curated tables are rebuilt, or with ``maintained``, their number of buckets, brought up to date by what
    this batch changed (see ``plans.maintain``)."""
    set_up(store, entities)
    out: dict[str, Loaded] = {}
    groups: dict[tuple[str, str], dict[str, Entity]] = {}
    for name, e in entities.items():
        groups.setdefault((e.source_system, e.group_name), {})[name] = e
    for (system, group), members in groups.items():
        batch = Batch(store, run, system, group)
        batch.phase("batch", lambda batch=batch, members=members: _phases(batch, members, out))
    if curation and maintained:
        Batch(store, run, *CURATION).phase("maintain", lambda: maintain(store, entities, run, maintained) and None)
    elif curation:
        Batch(store, run, *CURATION).phase("curate", lambda: curate(store, entities, run) and None)
    return out


def _phases(batch: Batch, entities: dict[str, Entity], out: dict[str, Loaded]) -> int:
    """All phases of an open batch; returns the sanitised rows."""
    store, run = batch.store, batch.run
    rows = 0
    for name, e in entities.items():
        landed = out[f"landing.{name}"] = batch.phase(
            f"load_landing_{name}", lambda e=e: load_landing(store, e, run)
        )
        # Every key this run touched carries its batch; the other rows read were rejected
        # or repeat one of these keys.
        batch.reconcile(
            landed.rows_read,
            of_batches(store.read(e.landing), [run.etl_batch_id]),
            f"raw.{e.source_name}",
            e.landing.full_name,
            f"recon_raw_{name}",
            landed.rows_rejected + landed.rows_good - landed.keys,
        )
        cleaned = out[f"sanitised.{name}"] = batch.phase(
            f"load_sanitised_{name}", lambda e=e: load_sanitised(store, e, run)
        )
        rows += cleaned.rows_good
        # One landing row is one sanitised row unless children are exploded out of it.
        source = expected_keys(store, e) if e.child_steps else store.read(e.landing)
        batch.reconcile(
            source, store.read(e.sanitised), e.landing.full_name, e.sanitised.full_name, f"recon_{name}"
        )
        if run.archive:
            batch.phase(f"archive_{name}", lambda e=e: sum(archived_rows(store, t, run) for t in (e.landing, e.sanitised)))
    return rows


def archived_rows(store: Store, table: TableDef, run: Run) -> int:
    """Rows that the run's merge into ``table`` has superseded and kept."""
    path, files = file_system(store.spark, store.archive_folder(table, run.etl_batch_id))
    return store.spark.read.schema(table.columns).parquet(path.toString()).count() if files.exists(path) else 0
