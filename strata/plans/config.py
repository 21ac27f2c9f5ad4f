"""Configuration that drives the generic loads: a new entity is a new value here."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import types as T

from strata import schemas as S
from strata.functions.payload import field as at
from strata.operators.constraints import Constraints
from strata.operators.project import Field
from strata.sinks.store import TableDef

QUARANTINE = S.columns(
    "etl_batch_id string, target_table string, reject_reason string, src string, payload string"
)


@dataclass(frozen=True)
class Entity:
    """One source entity and its tables."""

    source_name: str
    landing: TableDef
    sanitised: TableDef
    fields: tuple[Field, ...]
    not_null: tuple[str, ...] = ()
    key_fields: tuple[str, ...] = ("id", "artist_id")
    child_steps: tuple[str, ...] = ()
    layout: str = "array"  # a key of sources.snapshots.READERS
    created: str = "preserve"  # or "overwrite"
    source_system: str = "src"
    group_name: str = "entities"

    @property
    def key_type(self) -> T.DataType:
        return self.landing.columns[self.landing.key[0]].dataType

    @property
    def rules(self) -> Constraints:
        return Constraints(key=self.sanitised.key, not_null=self.not_null)


@dataclass(frozen=True)
class Run:
    """Identity of one batch run, carried through all its stages."""

    etl_batch_id: str
    as_of: dt.datetime | str
    raw_root: str
    day: dt.date | None = None  # None reads the newest snapshot
    archive: bool = False  # keep the rows that a merge supersedes, under the batch's id


def landing_table(name: str, buckets: int, columns: T.StructType = S.LANDING) -> TableDef:
    # Sorted by batch within a bucket, so incremental reads skip row groups.
    return TableDef("landing", name, columns, ("id",), buckets, ("etl_batch_id",))


def standard_entities(
    buckets: int = 1,
    layout: str = "array",
    recording_steps: tuple[str, ...] = ("$.parts", "$.items"),
    url_steps: tuple[str, ...] = ("$.links",),
    source_system: str = "src",
    key_type: str = "string",
    groups: dict[str, tuple[str, str]] | None = None,
) -> dict[str, Entity]:
    """The four standard entities.  Where recordings and urls nest inside a
    release body is a setting, as are the file layout, the landing key type, and the
    (source system, group) of each entity that has one of its own."""
    landing = {"string": S.LANDING, "bigint": S.LANDING_BIGINT}[key_type]

    def entity(source, san, schema, key, fields, **more) -> Entity:
        system, group = (groups or {}).get(source, (source_system, "entities"))
        return Entity(
            source,
            landing_table(f"lnd_{source}", buckets, landing),
            TableDef("sanitised", san, schema, key, buckets),
            fields,
            layout=layout,
            source_system=system,
            group_name=group,
            **more,
        )

    return {
        "artists": entity(
            "artists",
            "san_artists",
            S.SAN_ARTISTS,
            ("artist_id",),
            (
                Field("artist_id", "id", "column"),
                Field("name", at("name")),
                Field("gender", at("gender")),
                Field("country", at("country")),
                Field("score", at("score"), "value", "int"),
            ),
            not_null=("name",),
        ),
        "releases": entity(
            "releases",
            "san_releases",
            S.SAN_RELEASES,
            ("release_id",),
            (
                Field("release_id", "id", "column"),
                Field("artist_id", at("artist_id")),
                Field("group_id", at("group_id")),
                Field("title", at("title")),
                Field("release_date", at("date"), "day"),
                Field("date_raw", at("date"), "date_text"),
                Field("country", at("country")),
                Field("status", at("status")),
            ),
        ),
        "recordings": entity(
            "recordings",
            "san_recordings",
            S.SAN_RECORDINGS,
            ("recording_id", "release_id"),
            (
                Field("recording_id", at("recording_id")),
                Field("release_id", "id", "column"),
                Field("song_name", at("song_name")),
            ),
            child_steps=recording_steps,
        ),
        "urls": entity(
            "urls",
            "san_urls",
            S.SAN_URLS,
            ("url_id", "release_id"),
            (
                Field("url_id", at("url_id")),
                Field("release_id", "id", "column"),
                Field("type", at("type")),
                Field("resource", at("resource")),
            ),
            child_steps=url_steps,
        ),
    }


def curated_table(name: str, columns: T.StructType, key: str) -> TableDef:
    return TableDef("curated", name, columns, (key,))


CURATED = {
    "artist_metrics": curated_table("artist_metrics", S.ARTIST_METRICS, "artist_id"),
    "release_metrics": curated_table("release_metrics", S.RELEASE_METRICS, "release_id"),
    "country_metrics": curated_table("country_metrics", S.COUNTRY_METRICS, "country"),
    "recording_metrics": curated_table("recording_metrics", S.RECORDING_METRICS, "recording_id"),
    "artist_discography": curated_table("artist_discography", S.DISCOGRAPHY, "artist_id"),
}
BATCH_LOG = TableDef("audit", "batch_log", S.BATCH_LOG)
RECON_LOG = TableDef("audit", "recon_log", S.RECON_LOG)
QUARANTINE_TABLE = TableDef("audit", "quarantine", QUARANTINE)
LEDGER = TableDef("audit", "batch_ledger", S.BATCH_LEDGER)
AUDIT = (BATCH_LOG, RECON_LOG, QUARANTINE_TABLE, LEDGER)
