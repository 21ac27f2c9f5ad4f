"""Generic loads: raw snapshot to landing, landing to sanitised, both audited."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import payload as P
from strata.functions import stamp
from strata.functions.clean import null_if_sentinel
from strata.operators import constraints as K
from strata.operators.numbering import add_surrogate_id
from strata.operators.project import key_alias, sanitise
from strata.operators.upsert import upsert_overwrite, upsert_preserve
from strata.plans import ledger
from strata.plans.config import AUDIT, CURATED, QUARANTINE_TABLE, Entity, Run
from strata.schemas import REGISTRY
from strata.session import discard, settle, spread, work_path
from strata.sinks.store import Store, TableDef
from strata.sources import snapshots
from strata.sources.tables import of_batches, target_schema


@dataclass(frozen=True)
class Loaded:
    """Exact counts of one load and the buckets it rewrote."""

    buckets: int
    rows_read: int
    rows_good: int
    rows_rejected: int
    keys: int  # keys among the good rows; the others repeat one of them


def set_up(store: Store, entities: dict[str, Entity]) -> None:
    """Create every layer and audit table that does not exist yet."""
    for e in entities.values():
        store.create_if_absent(e.landing)
        store.create_if_absent(e.sanitised)
    for table in (*CURATED.values(), *AUDIT):
        store.create_if_absent(table)


def check_target(store: Store, table: TableDef) -> None:
    """Look the target's columns up before anything is read; a load stops when there are none
    or when they are not those the load was declared with."""
    known = target_schema(store.spark, table.full_name, {table.full_name: table.columns} | REGISTRY)
    if not known.fieldNames():
        raise LookupError(f"target {table.full_name} has no columns")
    lost = [c for c in table.key if c not in known.fieldNames()]
    if lost:
        raise LookupError(f"target {table.full_name} has no column {', '.join(lost)}")


def snapshot_rows(store: Store, entity: Entity, run: Run) -> DataFrame:
    """Rows of the newest snapshot, or of the run's day."""
    folder, source = f"{run.raw_root}/{entity.source_name}", entity.source_name
    suffix = snapshots.SUFFIX[entity.layout]
    if run.day is None:
        path = snapshots.latest_snapshot_path(store.spark, folder, source, suffix)
    else:
        path = snapshots.dated_snapshot_path(folder, source, run.day, suffix)
    return spread(snapshots.READERS[entity.layout](store.spark, path))


def _castable(raw: Column, dtype: T.DataType) -> Column:
    return raw if isinstance(dtype, T.StringType) else raw.try_cast(dtype)


def landing_rows(rows: DataFrame, entity: Entity, run: Run) -> DataFrame:
    """Landing columns of each source object, with the reason where it is rejected."""
    name = entity.landing.key[0]
    v = F.col("_v")
    rows = P.parsed(rows.withColumn("payload", F.col("element")), "element", "_v")
    # Of a text that parses, the first sign tells whether it is an object; the kind of the whole value would be
    # read out of the schema of all its fields.
    is_object = F.when(v.isNotNull(), F.col("payload").startswith("{") | (P.kind(v) == "object"))
    rows = rows.withColumns({"_is_object": is_object, "_given": P.get(v, "$.created_at")})
    rows = key_alias(rows, "_v", entity.key_fields, "_key").drop("_v")
    given = null_if_sentinel(F.col("_given"), empty_is_null=True)
    rows = rows.withColumns({"_given": given, "_created": F.try_to_timestamp(given)})
    now = stamp.moment(run.as_of)
    key = _castable(F.col("_key"), entity.key_type)
    reason = F.coalesce(
        F.when(F.col("_is_object").isNull(), F.lit("invalid json")),
        F.when(~F.col("_is_object"), F.lit("not an object")),
        F.when(F.col("_key").isNull(), F.lit(f"{name} is null")),
        F.when(key.isNull(), F.lit(f"{name} is not {entity.key_type.simpleString()}")),
        F.when(F.col("_given").isNotNull() & F.col("_created").isNull(), F.lit("created_at is not a time")),
    )
    return rows.select(
        key.alias(name),
        "payload",
        F.coalesce("_created", now).alias("created_at"),
        now.alias("updated_at"),
        F.lit(run.etl_batch_id).alias("etl_batch_id"),
        "_ord",
        F.col("src_file").alias("_src"),
        reason.alias(K.REASON),
    )


@dataclass(frozen=True)
class _Staged:
    good: DataFrame
    bad: DataFrame
    counts: dict
    path: str


def _stage(rows: DataFrame, label: str) -> _Staged:
    """Read and check the source once: written out, counted on the way, then split."""
    watched, seen = K.counted(rows, label)
    path = work_path(rows.sparkSession, label)
    good, bad = K.split(settle(watched, path))
    return _Staged(good, bad, seen.get, path)


def _quarantine(store: Store, staged: _Staged, run: Run, table: TableDef, src: str) -> None:
    """Rejected rows, before the good ones are published; a repeated run replaces its own."""
    store.append(
        QUARANTINE_TABLE,
        staged.bad.select(
            F.lit(run.etl_batch_id).alias("etl_batch_id"),
            F.lit(table.full_name).alias("target_table"),
            F.col(K.REASON).alias("reject_reason"),
            F.col(src).cast("string").alias("src"),
            "payload",
        ),
        key=f"{run.etl_batch_id}-{table.full_name}",
    )


def _loaded(staged: _Staged, table: TableDef, hit: list[int]) -> Loaded:
    counts = staged.counts
    keys = staged.good.select(*table.key).distinct().count()
    return Loaded(len(hit), counts["rows_read"], counts["rows_good"], counts["rows_rejected"], keys)


def load_landing(store: Store, entity: Entity, run: Run) -> Loaded:
    """Newest snapshot into the landing table, incoming rows winning; buckets of the
    table that the snapshot does not hit are neither read nor written."""
    table = entity.landing
    check_target(store, table)
    rows = landing_rows(snapshot_rows(store, entity, run), entity, run)
    staged = _stage(rows, f"{table.table_name}-{run.etl_batch_id}")
    created = "created_at" if entity.created == "preserve" else None
    try:
        _quarantine(store, staged, run, table, "_src")
        ledger.announce(store, table, run)
        hit = store.merge(
            table,
            staged.good,
            lambda held, new: upsert_overwrite(held, new, table.key, ["_ord"], created, table.tasks(held, new)),
            run.etl_batch_id if run.archive else None,
        )
        return _loaded(staged, table, hit)
    finally:
        discard(store.spark, staged.path)


def refresh_landing(store: Store, entity: Entity, run: Run, serial: TableDef) -> Loaded:
    """Older landing form: truncate, then number every payload in arrival order."""
    rows = snapshot_rows(store, entity, run)
    path = work_path(store.spark, f"{serial.table_name}-{run.etl_batch_id}")
    numbered = add_surrogate_id(
        rows.select(F.col("element").alias("payload"), "_ord.*"),
        ["src_file", "block", "pos", "part"],
        path=path,
    ).withColumn("ingestion_date", stamp.moment(run.as_of).cast("timestamp_ntz"))
    store.refresh(serial, numbered, run.etl_batch_id)
    discard(store.spark, path)
    n = store.read(serial).count()
    return Loaded(0, n, n, 0, n)


def sanitised_rows(landing: DataFrame, entity: Entity, run: Run) -> DataFrame:
    """Cleaned, typed rows of the landing payloads, with reject reasons."""
    rows = sanitise(
        landing,
        entity.fields,
        child_steps=entity.child_steps,
        keep=("id", "payload", "updated_at", "etl_batch_id", "_at"),
        reason=K.REASON,
    )
    if "ingestion_date" in entity.sanitised.columns.fieldNames():
        rows = rows.withColumn("ingestion_date", stamp.moment(run.as_of).cast("timestamp_ntz"))
    checked = K.check_rows(rows, entity.rules)
    # Only a rejected row still needs its payload; a body may have many children.
    return checked.withColumn("payload", F.when(F.col(K.REASON).isNotNull(), F.col("payload")))


def load_sanitised(store: Store, entity: Entity, run: Run, incremental: bool = True) -> Loaded:
    """Landing payloads into the sanitised table, keeping values not sent again.

    Only landing rows of batches that this table has not taken in yet are read (see
    ``plans.ledger``), whatever their time.  What it takes in is noted once it is written, so
    a load that fails reads the same batches again, with the same result.
    """
    table = entity.sanitised
    check_target(store, table)
    found = ledger.pending(store, entity.landing, table)
    landing = store.read(entity.landing)
    if incremental:
        landing = of_batches(landing, found.batches)
    rows = sanitised_rows(landing, entity, run)
    staged = _stage(rows, f"{table.table_name}-{run.etl_batch_id}")
    created = "created_at" if entity.created == "preserve" else None
    order = ["updated_at", "id", "_at"]
    try:
        _quarantine(store, staged, run, table, "id")
        hit = store.merge(
            table,
            staged.good,
            lambda held, new: upsert_preserve(held, new, table.key, order, created, table.tasks(held, new)),
            run.etl_batch_id if run.archive else None,
        )
        ledger.take_in(store, found)
        return _loaded(staged, table, hit)
    finally:
        discard(store.spark, staged.path)
