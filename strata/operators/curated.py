"""Curated aggregates over the canonical entity tables (see ``relate``).

Every child is aggregated to its parent's key before it is joined: nothing is
counted twice, and a parent that owns most of the children moves one row per
input partition only.  ``COUNT(DISTINCT)`` is used at most once per aggregate,
which the planner spreads over (group, value); further distinct counts run on an
already grouped frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROWS = "*"


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name)


def _per_release(children: DataFrame, value: str, name: str) -> DataFrame:
    return children.groupBy("release_id").agg(F.count(value).alias(name))


def songs_per_release(recordings: DataFrame) -> DataFrame:
    """(release_id, recording_count): what the larger aggregates are built from."""
    return _per_release(recordings, "recording_id", "recording_count")


def tag_counts(bridge: DataFrame) -> DataFrame:
    """Artists per tag, most used tag first."""
    return (
        bridge.groupBy("tag_name")
        .agg(F.count(_ROWS).alias("artist_count"))
        .orderBy(F.desc("artist_count"), "tag_name")
    )


def songs_per_artist(artists: DataFrame, releases: DataFrame, recordings: DataFrame) -> DataFrame:
    """Recordings per artist name; a recording counts once per release it is on,
    and artists who share a name are counted together."""
    per_artist = (
        releases.select("release_id", "artist_id")
        .join(songs_per_release(recordings), "release_id")
        .groupBy("artist_id")
        .agg(F.sum("recording_count").alias("n"))
    )
    return (
        artists.select("artist_id", "name")
        .join(per_artist, "artist_id")
        .groupBy("name")
        .agg(F.sum("n").alias("total_songs"))
    )


def ranked_songs_per_artist(artists: DataFrame, releases: DataFrame, recordings: DataFrame) -> DataFrame:
    """Songs per artist, most songs first, ties by name."""
    return songs_per_artist(artists, releases, recordings).orderBy(F.desc("total_songs"), "name")


def most_active(artists: DataFrame, releases: DataFrame, recordings: DataFrame, k: int) -> DataFrame:
    """The ``k`` artist names with most songs."""
    return ranked_songs_per_artist(artists, releases, recordings).limit(k)


def albums_per_artist(artists: DataFrame, releases: DataFrame) -> DataFrame:
    """Distinct release groups per artist; artists without one are not listed."""
    albums = releases.groupBy("artist_id").agg(F.countDistinct("group_id").alias("album_count"))
    return artists.select("artist_id", "name").join(albums, "artist_id")


def release_trend(releases: DataFrame) -> DataFrame:
    """Releases per year; releases without a real date form the NULL year."""
    return releases.groupBy(F.year("release_date").alias("release_year")).agg(
        F.count(_ROWS).alias("release_count")
    )


def artists_by_country(artists: DataFrame) -> DataFrame:
    return artists.groupBy("country").agg(F.count(_ROWS).alias("artist_count"))


def artist_metrics(artists: DataFrame, releases: DataFrame, songs: DataFrame) -> DataFrame:
    """One row per artist; ``songs`` holds (release_id, recording_count)."""
    per_artist = (
        releases.select("release_id", "artist_id", "group_id", "release_date")
        .join(songs.select("release_id", "recording_count"), "release_id", "left")
        # Grouping by album first leaves one row per album, so the distinct count
        # below is a plain count of groups.
        .groupBy("artist_id", "group_id")
        .agg(
            F.count("release_id").alias("release_count"),
            F.sum("recording_count").alias("recording_count"),
            F.min("release_date").alias("first_release_date"),
            F.max("release_date").alias("last_release_date"),
        )
        .groupBy("artist_id")
        .agg(
            F.sum("release_count").alias("release_count"),
            F.count("group_id").alias("album_count"),
            F.sum("recording_count").alias("recording_count"),
            F.min("first_release_date").alias("first_release_date"),
            F.max("last_release_date").alias("last_release_date"),
        )
    )
    return (
        artists.select("artist_id", "name", "country")
        .join(per_artist, "artist_id", "left")
        .select(
            "artist_id",
            "name",
            "country",
            _zero("release_count"),
            _zero("album_count"),
            _zero("recording_count"),
            "first_release_date",
            "last_release_date",
        )
    )


def release_metrics(releases: DataFrame, recordings: DataFrame, urls: DataFrame) -> DataFrame:
    """One row per release."""
    return (
        releases.select(
            "release_id", "artist_id", F.year("release_date").alias("release_year"), "status"
        )
        .join(songs_per_release(recordings), "release_id", "left")
        .join(_per_release(urls, "url_id", "url_count"), "release_id", "left")
        .select(
            "release_id",
            "artist_id",
            "release_year",
            "status",
            _zero("recording_count"),
            _zero("url_count"),
        )
    )


def country_metrics(metrics: DataFrame) -> DataFrame:
    """One row per country of origin, from the artist metrics."""
    return metrics.groupBy("country").agg(
        F.count(_ROWS).alias("artist_count"),
        F.sum("release_count").alias("release_count"),
        F.sum("recording_count").alias("recording_count"),
    )


def recording_metrics(releases: DataFrame, recordings: DataFrame) -> DataFrame:
    """One row per recording: distinct releases it is on, distinct artists."""
    on_release = recordings.select("recording_id", "release_id").distinct()
    return (
        on_release.join(releases.select("release_id", "artist_id"), "release_id", "left")
        .groupBy("recording_id", "artist_id")
        .agg(F.count("release_id").alias("n"))
        .groupBy("recording_id")
        .agg(F.sum("n").alias("release_count"), F.count("artist_id").alias("artist_count"))
    )


def discography(artists: DataFrame, releases: DataFrame) -> DataFrame:
    """Discography summary, one row per artist."""
    reduced = releases.groupBy("artist_id", "country", "status").agg(
        F.count("release_id").alias("n"),
        F.min("release_date").alias("first"),
        F.max("release_date").alias("last"),
    )
    summary = reduced.groupBy("artist_id").agg(
        F.sum("n").alias("release_count"),
        F.min("first").alias("first_release_date"),
        F.max("last").alias("last_release_date"),
        F.countDistinct("country").alias("country_count"),
        F.countDistinct("status").alias("status_count"),
    )
    return (
        artists.select("artist_id", "name")
        .join(summary, "artist_id", "left")
        .select(
            "artist_id",
            "name",
            _zero("release_count"),
            "first_release_date",
            "last_release_date",
            _zero("country_count"),
            _zero("status_count"),
        )
    )


def request_counts(responses: DataFrame, by: Sequence[str] = ("request_key",)) -> DataFrame:
    """Records received per request."""
    return responses.groupBy(*by).agg(F.count(_ROWS).alias("n_records"))
