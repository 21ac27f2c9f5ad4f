"""Fixed schemas of every layer.  Nothing is ever inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_NAMES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "ts": T.TimestampType(),
    "ntz": T.TimestampNTZType(),
}


def columns(spec: str) -> T.StructType:
    """``"id string, n int"`` to a schema; ts is zoned, ntz is without zone."""
    pairs = (part.split() for part in spec.split(","))
    return T.StructType([T.StructField(name, _NAMES[kind]) for name, kind in pairs])


RESPONSE = columns(
    "run_id string, endpoint string, request_key string, ord int, status_code int, body string"
)

# Column names and order are fixed by the layer tables' definitions.
# Layer rows also carry the batch that brought them.
BATCH_ID = ", etl_batch_id string"
LANDING = columns("id string, payload string, created_at ts, updated_at ts" + BATCH_ID)
LANDING_BIGINT = columns("id long, payload string, created_at ts, updated_at ts" + BATCH_ID)
LANDING_SERIAL = columns("ingestion_id long, ingestion_date ntz, payload string")

SAN_ARTISTS = columns(
    "artist_id string, name string, gender string, country string, score int, ingestion_date ntz" + BATCH_ID
)
SAN_RELEASES = columns(
    "release_id string, artist_id string, group_id string, title string,"
    " release_date date, date_raw string, country string, status string, ingestion_date ntz" + BATCH_ID
)
SAN_RECORDINGS = columns(
    "recording_id string, release_id string, song_name string, ingestion_date ntz" + BATCH_ID
)
SAN_URLS = columns(
    "url_id string, release_id string, type string, resource string, ingestion_date ntz" + BATCH_ID
)

ARTIST_METRICS = columns(
    "artist_id string, name string, country string, release_count long, album_count long,"
    " recording_count long, first_release_date date, last_release_date date" + BATCH_ID
)
RELEASE_METRICS = columns(
    "release_id string, artist_id string, release_year int, status string,"
    " recording_count long, url_count long" + BATCH_ID
)
COUNTRY_METRICS = columns(
    "country string, artist_count long, release_count long, recording_count long" + BATCH_ID
)
RECORDING_METRICS = columns("recording_id string, release_count long, artist_count long" + BATCH_ID)
DISCOGRAPHY = columns(
    "artist_id string, name string, release_count long, first_release_date date,"
    " last_release_date date, country_count long, status_count long" + BATCH_ID
)

BATCH_LOG = columns(
    "etl_batch_id string, source_system string, group_name string, phase_name string,"
    " status string, rows_processed long, error_message string, started_at ts, ended_at ts"
)
RECON_LOG = columns(
    "etl_batch_id string, phase_name string, source_table string, target_table string,"
    " source_count long, target_count long, diff long, status string, checked_at ts"
)

# One row per load of a layer table, and one per consumer that has taken it in.
BATCH_LEDGER = columns(
    "table_name string, etl_batch_id string, load_id string, consumer string, logged_at ts"
)

REGISTRY = {
    "landing.lnd_artists": LANDING,
    "landing.lnd_releases": LANDING,
    "landing.lnd_recordings": LANDING,
    "landing.lnd_urls": LANDING,
    "sanitised.san_artists": SAN_ARTISTS,
    "sanitised.san_releases": SAN_RELEASES,
    "sanitised.san_recordings": SAN_RECORDINGS,
    "sanitised.san_urls": SAN_URLS,
    "curated.artist_metrics": ARTIST_METRICS,
    "curated.release_metrics": RELEASE_METRICS,
    "curated.country_metrics": COUNTRY_METRICS,
    "curated.recording_metrics": RECORDING_METRICS,
    "curated.artist_discography": DISCOGRAPHY,
    "audit.batch_log": BATCH_LOG,
    "audit.recon_log": RECON_LOG,
    "audit.batch_ledger": BATCH_LEDGER,
}
