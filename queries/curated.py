"""Curated aggregates."""

from queries.joins import _BRIDGE, bridge_of_events
from queries.registry import Tables, query
from strata.operators import curated as A
from strata.operators.project import Field, sanitise, to_payload
from strata.session import spread

_ARTISTS = "artists AS (SELECT c_custkey AS artist_id, c_name AS name, c_nationkey AS country FROM customer)"
_RELEASES = """releases AS (
      SELECT o_orderkey AS release_id, o_custkey AS artist_id, o_custkey || '-' || o_orderpriority AS group_id,
             o_orderdate::date AS release_date, o_orderpriority AS country, o_orderstatus AS status
      FROM orders)"""
_RECORDINGS = "recordings AS (SELECT l_partkey AS recording_id, l_orderkey AS release_id FROM lineitem)"
_URLS = "urls AS (SELECT l_suppkey AS url_id, l_orderkey AS release_id FROM lineitem WHERE l_returnflag = 'R')"
_BASE = f"WITH {_ARTISTS}, {_RELEASES}, {_RECORDINGS}, {_URLS}"

_SONGS = f"""
    {_BASE}
    SELECT a.name, count(rec.recording_id) AS total_songs
    FROM artists a JOIN releases r ON a.artist_id = r.artist_id
    JOIN recordings rec ON r.release_id = rec.release_id
    GROUP BY a.name
"""


@query(f"SELECT tag_name, count(*) AS artist_count FROM ({_BRIDGE}) GROUP BY 1 ORDER BY 2 DESC, 1")
def tag_counts(t: Tables):
    return A.tag_counts(bridge_of_events(t))


@query(_SONGS)
def songs_per_artist(t: Tables):
    return A.songs_per_artist(t.artists, t.releases, t.recordings)


@query(f"{_SONGS} ORDER BY total_songs DESC, a.name LIMIT 10")
def most_active(t: Tables):
    return A.most_active(t.artists, t.releases, t.recordings, 10)


@query(
    f"""
    {_BASE}
    SELECT a.artist_id, a.name, count(DISTINCT r.group_id) AS album_count
    FROM artists a JOIN releases r ON a.artist_id = r.artist_id GROUP BY 1, 2
    """
)
def albums_per_artist(t: Tables):
    return A.albums_per_artist(t.artists, t.releases)


@query(f"{_BASE} SELECT year(release_date)::int AS release_year, count(*) AS release_count FROM releases GROUP BY 1")
def release_trend(t: Tables):
    return A.release_trend(t.releases)


@query(f"{_BASE} SELECT country, count(*) AS artist_count FROM artists GROUP BY 1")
def artists_by_country(t: Tables):
    return A.artists_by_country(t.artists)


@query(
    f"""
    {_BASE}, s AS (SELECT release_id, count(recording_id) AS n FROM recordings GROUP BY 1),
    r AS (SELECT artist_id, count(*) AS release_count, count(DISTINCT group_id) AS album_count,
                 sum(coalesce(s.n, 0))::bigint AS recording_count,
                 min(release_date) AS first_release_date, max(release_date) AS last_release_date
          FROM releases LEFT JOIN s USING (release_id) GROUP BY 1)
    SELECT a.artist_id, a.name, a.country, coalesce(release_count, 0) AS release_count,
           coalesce(album_count, 0) AS album_count, coalesce(recording_count, 0) AS recording_count,
           first_release_date, last_release_date
    FROM artists a LEFT JOIN r USING (artist_id)
    """
)
def artist_metrics(t: Tables):
    return A.artist_metrics(t.artists, t.releases, A.songs_per_release(t.recordings))


@query(
    f"""
    {_BASE}, s AS (SELECT release_id, count(recording_id) AS n FROM recordings GROUP BY 1),
    u AS (SELECT release_id, count(url_id) AS n FROM urls GROUP BY 1)
    SELECT r.release_id, artist_id, year(release_date)::int AS release_year, status,
           coalesce(s.n, 0) AS recording_count, coalesce(u.n, 0) AS url_count
    FROM releases r LEFT JOIN s USING (release_id) LEFT JOIN u USING (release_id)
    """
)
def release_metrics(t: Tables):
    return A.release_metrics(t.releases, t.recordings, t.urls)


@query(
    f"""
    {_BASE}, s AS (SELECT release_id, count(recording_id) AS n FROM recordings GROUP BY 1),
    r AS (SELECT artist_id, count(*) AS rc, sum(coalesce(s.n, 0)) AS sc
          FROM releases LEFT JOIN s USING (release_id) GROUP BY 1)
    SELECT country, count(*) AS artist_count, coalesce(sum(rc), 0)::bigint AS release_count,
           coalesce(sum(sc), 0)::bigint AS recording_count
    FROM artists LEFT JOIN r USING (artist_id) GROUP BY 1
    """
)
def country_metrics(t: Tables):
    songs = A.songs_per_release(t.recordings)
    return A.country_metrics(A.artist_metrics(t.artists, t.releases, songs))


@query(
    f"""
    {_BASE}
    SELECT recording_id, count(DISTINCT rec.release_id) AS release_count, count(DISTINCT r.artist_id) AS artist_count
    FROM recordings rec LEFT JOIN releases r ON rec.release_id = r.release_id GROUP BY 1
    """
)
def recording_metrics(t: Tables):
    return A.recording_metrics(t.releases, t.recordings)


@query(
    f"""
    {_BASE}
    SELECT a.artist_id, a.name, count(r.release_id) AS release_count,
           min(release_date) AS first_release_date, max(release_date) AS last_release_date,
           count(DISTINCT r.country) AS country_count, count(DISTINCT r.status) AS status_count
    FROM artists a LEFT JOIN releases r ON a.artist_id = r.artist_id GROUP BY 1, 2
    """
)
def discography(t: Tables):
    return A.discography(t.artists, t.releases)


@query(f"{_SONGS} ORDER BY total_songs DESC, a.name")
def payload_songs_per_artist(t: Tables):
    """The flagship: releases arrive as JSON payloads, are typed, joined and ranked."""
    payloads = to_payload(spread(t.orders), keep=("o_orderkey",))
    fields = (
        Field("release_id", "$.o_orderkey", "value", "bigint"),
        Field("artist_id", "$.o_custkey", "value", "bigint"),
    )
    return A.ranked_songs_per_artist(t.artists, sanitise(payloads, fields), t.recordings)
